"""How full date ranges are, and how to extend or continue them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.dates import as_date, us_text
from silverline.operators.joins import range_days

# The export limit and the planning rules.
EXPORT_LIMIT = 50_000
TARGET = 49_500
WARNING = 49_000
NEXT_RANGE_TARGET = 49_000
EXTENSION_DAYS = 7
SAFETY = 0.9
DEFAULT_DAILY = 60.0
WEIGHT_HISTORICAL, WEIGHT_CURRENT, WEIGHT_RECENT = 1, 2, 3
RECENT_DAYS = 30
ENDING_SOON_DAYS = 7
WORTHWHILE_DAYS = 30


def daily_counts(df: DataFrame, day: Column, groups: Sequence[str] = ()) -> DataFrame:
    """Rows per day: however large the table, the result has one row per calendar day and group."""
    return df.where(day.isNotNull()).groupBy(*groups, day.alias("day")).agg(F.count("*").alias("rows"))


def range_counts(daily: DataFrame, ranges: DataFrame, limit: int = EXPORT_LIMIT, groups: Sequence[str] = ()) -> DataFrame:
    """Rows per inclusive date range against the export limit. Ranges may overlap.

    Joins two calendar-sized tables on the day.
    """
    keys = [*groups, "range_id", "start_date", "end_date"]
    spread = range_days(ranges).join(daily, [*groups, "day"], "left")
    counted = spread.groupBy(*keys).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    return counted.withColumn("percent_used", F.round(F.col("rows") / limit * 100).cast("long"))


def with_fallback(ranges: DataFrame, external: Column, bronze: Column) -> DataFrame:
    """A count per range with its source: external, else bronze, else none."""
    return ranges.withColumns(
        {
            "rows": F.coalesce(external, bronze, F.lit(0)).cast("long"),
            "count_source": F.when(external.isNotNull(), "external")
            .when(bronze.isNotNull(), "bronze_fallback")
            .otherwise("no_data"),
        }
    )


def recent_counts(daily: DataFrame, asof: Column | dt.date | str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows of the last 30 days, `asof` included."""
    today = as_date(asof)
    recent = daily.where(F.col("day").between(F.date_add(today, -RECENT_DAYS), today))
    return recent.groupBy(*groups).agg(F.sum("rows").alias("recent_rows"))


def _floor(value: Column) -> Column:
    return F.floor(value).cast("int")


def growth_rate(counts: DataFrame, recent: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Weighted rows per day: past ranges once, the current range twice, the last 30 days three times.

    `counts` has one row per range and group (a handful each).
    """
    newest = Window.partitionBy(*groups).orderBy(F.col("start_date").desc(), F.col("end_date").desc())
    ranged = counts.withColumn("_newest", F.row_number().over(newest) == 1).where(F.col("rows") > 0)
    days = F.date_diff("end_date", "start_date")
    points = ranged.where(days > 0).select(
        *groups,
        (F.col("rows") / days).alias("daily"),
        F.when(F.col("_newest"), WEIGHT_CURRENT).otherwise(WEIGHT_HISTORICAL).alias("weight"),
    )
    latest = recent.where(F.col("recent_rows") > 0).select(
        *groups, (F.col("recent_rows") / RECENT_DAYS).alias("daily"), F.lit(WEIGHT_RECENT).alias("weight")
    )
    weighted = points.unionByName(latest).groupBy(*groups).agg(
        (F.sum(F.col("daily") * F.col("weight")) / F.sum("weight")).alias("daily"),
        F.count("*").alias("data_points"),
    )
    everyone = counts.select(*groups).distinct().join(weighted, list(groups), "left")
    daily = F.coalesce("daily", F.lit(DEFAULT_DAILY))
    return everyone.select(
        *groups,
        daily.alias("daily"),
        (daily * 30).alias("monthly"),
        F.coalesce("data_points", F.lit(0)).cast("long").alias("data_points"),
    )


def capacity(
    counts: DataFrame, growth: DataFrame, asof: Column | dt.date | str, groups: Sequence[str],
    target: int = TARGET, warning: int = WARNING,
) -> DataFrame:
    """State of every range, and what to do with the newest one of its group.

    Room and days of room at the current rate; a range that ends within a week and has room is
    extended by the larger of a week and 90 % of that room; a full range is continued by a new one.
    """
    today = as_date(asof)
    newest = Window.partitionBy(*groups).orderBy(F.col("start_date").desc(), F.col("end_date").desc())
    rows = counts.join(growth, list(groups)).withColumn("active", F.row_number().over(newest) == 1)
    room = F.lit(target) - F.col("rows")
    left = F.date_diff("end_date", today)
    safe_days = _floor(F.col("days_of_room") * SAFETY)
    has_room = F.col("room_left") > 0
    known = F.col("active") & (F.col("rows") > 0)
    return (
        rows.withColumn("room_left", room)
        .withColumn("days_of_room", F.when(has_room, _floor(F.col("room_left") / F.col("daily"))))
        .withColumns(
            {
                "days_until_end": left,
                "state": F.when(~F.col("active"), "historical").when(left < 0, "ended").otherwise("active"),
                "near_limit": F.col("active") & (F.col("rows") >= warning),
                "action": F.when(known & has_room & (left <= ENDING_SOON_DAYS), "extend")
                .when(known & ~has_room, "add")
                .otherwise("ok"),
                "extension_days": F.when(
                    known & has_room & (left <= ENDING_SOON_DAYS), F.greatest(F.lit(EXTENSION_DAYS), safe_days)
                ),
            }
        )
        .withColumn("new_end", F.date_add("end_date", F.col("extension_days")))
    )


def planned_extension(end: Column, rows: Column, daily: Column, asof: Column, most: int = TARGET) -> dict[str, Column]:
    """Extension of a range that ends in the future: all of its room, at most two years from `asof`.

    NULL when it has no room or less than a month of it.
    """
    room = F.lit(most) - rows
    days = _floor(room / daily)
    useful = (end > asof) & (room > 0) & (days >= WORTHWHILE_DAYS)
    target = F.least(F.date_add(end, days), F.add_months(asof, 24))
    return {
        "suggested_end": F.when(useful, target),
        "additional_capacity": F.when(useful, room),
        "days_added": F.when(useful, F.date_diff(target, end)),
    }


def range_id(start: Column, end: Column) -> Column:
    return F.concat(F.date_format(start, "MMddyyyy"), F.lit("_to_"), F.date_format(end, "MMddyyyy"))


def next_range(end: Column, daily: Column, target: int = NEXT_RANGE_TARGET) -> dict[str, Column]:
    """The range after one that is full, sized for 90 % of the target."""
    days = _floor(F.lit(int(target * SAFETY)) / daily)
    start = F.date_add(end, 1)
    new_end = F.date_add(start, days)
    return {
        "next_id": range_id(start, new_end),
        "next_start": start,
        "next_end": new_end,
        "estimated_count": F.lit(target).cast("long"),
        "estimated_months": F.round(days / 30).cast("long"),
    }


def apply_changes(ranges: DataFrame, extensions: DataFrame, additions: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Ranges with new end dates (and ids made from them), and with the added ranges."""
    changed = ranges.join(extensions.select(*groups, "range_id", "new_end"), [*groups, "range_id"], "left")
    end = F.coalesce("new_end", "end_date")
    updated = changed.select(
        *groups,
        F.when(F.col("new_end").isNotNull(), range_id(F.col("start_date"), F.col("new_end")))
        .otherwise(F.col("range_id"))
        .alias("range_id"),
        "start_date",
        end.alias("end_date"),
    )
    return updated.unionByName(additions.select(*groups, "range_id", "start_date", "end_date"))


def split_ranges(daily: DataFrame, limit: int = EXPORT_LIMIT, groups: Sequence[str] = ()) -> DataFrame:
    """Contiguous date ranges of at most `limit` rows, each as long as possible.

    Walks the days of a group in order (a calendar, however many rows it stands for). A single day
    above the limit gets a range of its own and is marked.
    """
    days = F.sort_array(F.collect_list(F.struct("day", "rows")))
    empty = "array<struct<start_date:date,end_date:date,rows:bigint>>"

    def closed(state: Column) -> Column:
        current = F.struct(
            state["start_date"].alias("start_date"), state["end_date"].alias("end_date"), state["rows"].alias("rows")
        )
        return F.concat(state["done"], F.array(current).cast(empty))

    def state(done: Column, start: Column, end: Column, rows: Column) -> Column:
        return F.struct(
            done.cast(empty).alias("done"), start.cast("date").alias("start_date"),
            end.cast("date").alias("end_date"), rows.cast("bigint").alias("rows"),
        )

    def step(acc: Column, item: Column) -> Column:
        fits = acc["rows"] + item["rows"] <= limit
        return (
            F.when(acc["start_date"].isNull(), state(acc["done"], item["day"], item["day"], item["rows"]))
            .when(fits, state(acc["done"], acc["start_date"], item["day"], acc["rows"] + item["rows"]))
            .otherwise(state(closed(acc), item["day"], item["day"], item["rows"]))
        )

    start = state(F.array(), F.lit(None), F.lit(None), F.lit(0))
    walked = daily.groupBy(*groups).agg(F.aggregate(days, start, step, closed).alias("ranges"))
    return (
        walked.select(*groups, F.inline("ranges"))
        .withColumn("over_limit", F.col("rows") > limit)
        .withColumn("range_id", range_id(F.col("start_date"), F.col("end_date")))
    )


def config_ranges(df: DataFrame) -> DataFrame:
    """Configured ranges (`MM/DD/YYYY` text) with dates."""
    parsed = {name: F.try_to_date(name, "M/d/yyyy") for name in ("start_date", "end_date")}
    return df.withColumns(parsed).withColumnRenamed("id", "range_id")


def range_texts(df: DataFrame) -> DataFrame:
    return df.withColumns({name: us_text(F.col(name)) for name in ("start_date", "end_date")})
