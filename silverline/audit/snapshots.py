"""What changed between two snapshots of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATUSES = ("added", "removed", "changed", "equal")


def read_snapshot(spark: SparkSession, silver_root: str, dataset: str, version: str, snapshot: str) -> DataFrame:
    """One snapshot of a dataset as a build left it."""
    return spark.read.parquet(f"{silver_root}/{dataset}/version={version}/snapshot={snapshot}")


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def snapshot_changes(previous: DataFrame, current: DataFrame, keys: Sequence[str], carried: Sequence[str] = (), row_hash: str = "row_hash") -> DataFrame:
    """One row per key of either snapshot: rows then and now, and its status.

    A key is `added` or `removed` if only one snapshot has it, `equal` if both hold the same row hashes
    equally often, else `changed`. Keys may repeat, and NULL is a key like any other. Both snapshots go
    through one aggregation on (key, row hash), combined in every task first, so neither a repeated row
    nor a key with many rows meets in one place; no rows are joined. `carried` columns come from the
    newer snapshot where it has the key (the largest row of several).
    """

    def side(df: DataFrame, new: bool) -> DataFrame:
        counts = F.lit(0 if new else 1).alias("_then"), F.lit(1 if new else 0).alias("_now")
        return df.select(*[_quoted(key) for key in keys], _quoted(row_hash).alias("_hash"), *counts, F.struct(F.lit(new).alias("new"), *[_quoted(c) for c in carried]).alias("_row"))

    by = [_quoted(key) for key in keys]
    per_hash = side(previous, False).unionByName(side(current, True)).groupBy(*by, "_hash").agg(
        F.sum("_then").alias("_then"), F.sum("_now").alias("_now"), F.max("_row").alias("_row")
    )
    per_key = per_hash.groupBy(*by).agg(
        F.sum("_then").alias("previous_rows"), F.sum("_now").alias("new_rows"),
        F.bool_or(F.col("_then") != F.col("_now")).alias("_differs"), F.max("_row").alias("_row"),
    )
    added, removed, changed, equal = STATUSES
    status = (
        F.when(F.col("previous_rows") == 0, added).when(F.col("new_rows") == 0, removed).when(F.col("_differs"), changed).otherwise(equal)
    )
    return per_key.select(*by, *[F.col(f"_row.`{c}`").alias(c) for c in carried], "previous_rows", "new_rows", status.alias("status"))


def change_summary(changes: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Per group: rows then and now, their signed difference, and keys by status."""
    counts = [F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in ("previous_rows", "new_rows")]
    statuses = [F.count_if(F.col("status") == name).alias(name) for name in STATUSES]
    summed = changes.groupBy(*[_quoted(name) for name in groups]).agg(*counts, *statuses)
    return summed.withColumn("difference", F.col("new_rows") - F.col("previous_rows"))


def compare_snapshots(
    spark: SparkSession, silver_root: str, dataset: str, version: str, previous: str, current: str, keys: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """The change summary of two snapshots, named by their ids."""
    then, now = (read_snapshot(spark, silver_root, dataset, version, snapshot) for snapshot in (previous, current))
    return change_summary(snapshot_changes(then, now, keys, groups), groups)
