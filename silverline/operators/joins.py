"""Joins, and set differences expressed as joins.

No side is broadcast by hint here: Spark picks a broadcast from measured sizes, and splits skewed
partitions of a sort-merge join at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def side_by_side(*rows: DataFrame) -> DataFrame:
    """The columns of several one-row tables as one row, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.first(F.col(f"`{name}`"), ignorenulls=True).alias(name) for name in stacked.columns])


def not_in(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the known ones (new files, new states, uncovered days)."""
    return df.join(known.select(*[F.col(f"`{name}`") for name in on]), list(on), "left_anti")


def members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in a set of keys."""
    return df.join(keys.select(*[F.col(f"`{name}`") for name in on]), list(on), "left_semi")


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], null_safe: bool = False) -> DataFrame:
    """Join a fact table with its dimensions, each on its own column.

    Rows with a NULL in a dimension column drop out unless `null_safe`.
    """
    out = fact
    for column, dim in dims.items():
        if null_safe:
            renamed = dim.withColumnRenamed(column, "_dim")
            out = out.join(renamed, F.col(f"`{column}`").eqNullSafe(F.col("_dim")), "left").drop("_dim")
        else:
            out = out.join(dim, column)
    return out


def range_days(ranges: DataFrame, start: str = "start_date", end: str = "end_date", day: str = "day") -> DataFrame:
    """One row per day of every inclusive date range."""
    return ranges.where(F.col(start) <= F.col(end)).withColumn(
        day, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day")))
    )


def in_ranges(df: DataFrame, day: Column, ranges: DataFrame) -> DataFrame:
    """Rows paired with every inclusive date range that holds their day; ranges may overlap.

    The ranges are spread over the calendar, which turns the range condition into an equality on
    the day.
    """
    return df.withColumn("day", day).join(range_days(ranges), "day").drop("day")


def pair_results(
    tasks: DataFrame, results: DataFrame, on: Sequence[str] = ("dataset", "kind", "label")
) -> DataFrame:
    """Every task with its result; a task without one is marked as interrupted."""
    fields = ["ok", "exit_code", "skipped", "error", "run_id", "manifest_path"]
    keys = {f"_on_{name}": F.col(name) for name in on}
    found = results.select(*[value.alias(name) for name, value in keys.items()], *fields, F.lit(True).alias("_found"))
    condition = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_on_{name}")) for name in on])
    joined = tasks.join(found, condition, "left").drop(*keys)
    missing = F.col("_found").isNull()
    result = F.struct(
        F.coalesce("ok", F.lit(False)).alias("ok"),
        F.col("exit_code"),
        F.coalesce("skipped", F.lit(False)).alias("skipped"),
        F.when(missing, "no result was recorded for this task").otherwise(F.col("error")).alias("error"),
        F.col("run_id"),
        F.col("manifest_path"),
    )
    return joined.withColumn("result", result).drop("_found", *fields)
