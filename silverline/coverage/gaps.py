"""Covered days, missing days, and the windows that would fill them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions.dates import as_date, parse_date, us_text, window_kind
from silverline.operators.joins import not_in

# Days looked back, and the first day of a backfill.
SNAPSHOT_DAYS = 14
BACKFILL_START = "2018-01-01"


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))))


def run_days(runs: DataFrame, groups: Sequence[str] = ("dataset",)) -> DataFrame:
    """Days on which a run ended (or started, when it never ended). Times are ISO text."""
    day = F.try_to_date(F.substring(F.coalesce("end_time", "start_time"), 1, 10), "yyyy-MM-dd")
    return runs.select(*groups, day.alias("day")).where("day IS NOT NULL").distinct()


def covered_days(runs: DataFrame, groups: Sequence[str] = ("dataset",)) -> DataFrame:
    """Days covered by the requested windows of runs; a run without one may be labelled with its day.

    Equal windows are merged before they are spread over days.
    """
    has_window = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    label = F.when(F.col("label").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date("label", "yyyy-MM-dd"))
    start = F.when(has_window, parse_date(F.col("start_date"))).otherwise(label)
    end = F.when(has_window, parse_date(F.col("end_date"))).otherwise(label)
    windows = runs.select(*groups, start.alias("_from"), end.alias("_to")).distinct()
    return windows.select(*groups, _days(F.col("_from"), F.col("_to")).alias("day")).distinct()


def missing_days(
    covered: DataFrame, datasets: DataFrame, asof: Column | dt.date | str, days: int = SNAPSHOT_DAYS,
    groups: Sequence[str] = ("dataset",),
) -> DataFrame:
    """Days of the last `days` before `asof` that a dataset has nothing for."""
    today = as_date(asof)
    wanted = datasets.select(*groups).distinct()
    expected = wanted.select(*groups, _days(F.date_add(today, -days), F.date_add(today, -1)).alias("day"))
    return not_in(expected, covered, [*groups, "day"])


def months_with_gaps(
    covered: DataFrame, datasets: DataFrame, asof: Column | dt.date | str, start: str = BACKFILL_START,
    groups: Sequence[str] = ("dataset",),
) -> DataFrame:
    """Months since `start` that hold an uncovered day up to `asof`, as windows to fetch."""
    wanted = datasets.select(*groups).distinct()
    expected = wanted.select(*groups, _days(F.trunc(as_date(start), "month"), as_date(asof)).alias("day"))
    gaps = not_in(expected, covered, [*groups, "day"])
    month = F.trunc("day", "month")
    return (
        gaps.groupBy(*groups, month.alias("month"))
        .agg(F.count("*").alias("missing_days"))
        .select(
            *groups,
            us_text(F.col("month")).alias("start_date"),
            us_text(F.last_day("month")).alias("end_date"),
            F.date_format("month", "yyyy-MM").alias("label"),
            "missing_days",
        )
    )


def month_windows(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per calendar month a period touches, clipped to the period."""
    months = F.when(start <= end, F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month")))
    spread = df.withColumns({"_from": start, "_to": end}).withColumn("_month", F.explode(months))
    clipped = spread.withColumns(
        {
            "window_start": F.greatest("_month", "_from"),
            "window_end": F.least(F.last_day("_month"), "_to"),
        }
    )
    return clipped.withColumn("kind", window_kind(F.col("window_start"), F.col("window_end"))).drop(
        "_from", "_to", "_month"
    )


def year_windows(df: DataFrame, start: Column, asof: Column) -> DataFrame:
    """One window per calendar year from the start year on; the current year ends at `asof`."""
    years = F.sequence(F.trunc(start, "year"), F.trunc(asof, "year"), F.expr("interval 1 year"))
    spread = df.withColumn("window_start", F.explode(years))
    last = F.date_add(F.add_months("window_start", 12), -1)
    return spread.withColumns(
        {
            "window_end": F.least(last, asof),
            "label": F.concat(F.lit("year_"), F.year("window_start").cast("string")),
        }
    )


def pending_today(
    tasks: DataFrame, runs: DataFrame, asof: Column | dt.date | str, on: Sequence[str] = ("dataset", "label")
) -> DataFrame:
    """Tasks without a successful run on the day; informational notes never run."""
    day = F.try_to_date(F.substring(F.coalesce("end_time", "start_time"), 1, 10), "yyyy-MM-dd")
    done = runs.where((F.col("status") == "success") & (day == as_date(asof)))
    return not_in(tasks.where(F.col("kind") != "note"), done.select(*on).distinct(), list(on))


def ranges_to_fetch(ranges: DataFrame, strategy: str = "last", position: str = "position", groups: Sequence[str] = ()) -> DataFrame:
    """Ranges by strategy: `all` and `incremental` give every range, `last` the newest one.

    An incremental plan is narrowed by `pending_today`.
    """
    if strategy in ("all", "incremental"):
        return ranges
    if strategy != "last":
        raise ValueError(f"unknown strategy: {strategy}")
    rest = [name for name in ranges.columns if name not in groups]
    newest = ranges.groupBy(*groups).agg(F.max_by(F.struct(*rest), position).alias("_last"))
    return newest.select(*groups, "_last.*")
