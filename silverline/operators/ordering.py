"""Sorting, samples and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.dates import parse_date


def text_date_order(date_column: str, key_column: str, locale: bool = True) -> list[Column]:
    """Sort keys for `M/D/YYYY` text: by day, missing last, ties by key.

    `locale` compares keys the way a dictionary does; otherwise byte by byte.
    """
    key = F.col(f"`{key_column}`")
    tie = F.collate(key, "UNICODE") if locale else key
    return [parse_date(F.col(f"`{date_column}`")).asc_nulls_last(), tie.asc_nulls_first()]


def sort_by_text_date(df: DataFrame, date_column: str, key_column: str, locale: bool = True) -> DataFrame:
    return df.orderBy(*text_date_order(date_column, key_column, locale))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def first_sample(
    df: DataFrame, order: Sequence[Column], size: int, in_stratum: Column, minimum: int = 2
) -> DataFrame:
    """The first `size` rows, topped up so that at least `minimum` come from a stratum.

    Both inputs are cut to a constant number of rows before they meet. Ties are settled by all other
    columns, so only equal rows are interchangeable; each counts as a row of its own.
    """
    ties = [F.col(f"`{name}`").asc_nulls_first() for name in df.columns]
    head = df.withColumn("in_stratum", F.coalesce(in_stratum, F.lit(False))).orderBy(*order, *ties)
    picked = head.limit(size)
    # The stratum's rows in the same order: those already picked come first.
    spare = head.where("in_stratum").limit(size + minimum)
    spare = spare.withColumn("_next", F.row_number().over(Window.partitionBy("in_stratum").orderBy(*order, *ties)))
    have = picked.agg(F.count_if("in_stratum").alias("_have"))
    more = spare.join(F.broadcast(have)).where((F.col("_next") > F.col("_have")) & (F.col("_next") <= minimum))
    return picked.unionByName(more.drop("_next", "_have"))


def latest_by(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of every group, kept as one running maximum per group."""
    rest = [name for name in df.columns if name not in groups]
    newest = F.max_by(F.struct(*[F.col(f"`{name}`") for name in rest]), F.struct(*order))
    return df.groupBy(*groups).agg(newest.alias("_newest")).select(
        *groups, *[F.col(f"_newest.`{name}`") for name in rest]
    )


def latest_successful_run(runs: DataFrame, groups: Sequence[str] = ("dataset",)) -> DataFrame:
    """The newest successful run per group that has a CSV with its data."""
    has_csv = F.exists(
        "files", lambda f: F.lower(f["name"]).endswith(".csv") & ~F.contains(f["name"], F.lit("_with_urls"))
    )
    return latest_by(runs.where((F.col("status") == "success") & has_csv), groups, ["run_id"])
