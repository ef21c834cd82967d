"""Operators on groups of rows that share a key.

A single key may own a large part of the table, so none of these brings a whole group into one
task: rank limits are applied before the shuffle, counts are combined before the shuffle, and
full numbering works on slices of a large group whose sizes are added up afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.text import is_missing
from silverline.session import ensure_checkpointing

# Parts that a key's rows are ranked in first, so that a large key is cut down by many tasks.
RANKED_PARTS = 256

# A key with more rows than this is numbered in slices, about this many; lists of large keys up to this size are sent round.
LARGE_KEY = 100_000
SLICES = 1024
BROADCAST_KEYS = 500


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def newest_first(columns: Sequence[str]) -> list[Column]:
    return [_quoted(name).desc_nulls_last() for name in columns]


def oldest_first(columns: Sequence[str]) -> list[Column]:
    return [_quoted(name).asc_nulls_first() for name in columns]


def drop_keyless(df: DataFrame, keys: Sequence[str], null_policy: str = "blank") -> DataFrame:
    """Rows whose every key column is present."""
    for key in keys:
        df = df.where(~is_missing(_quoted(key), null_policy))
    return df


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under `order`.

    The filter on rank 1 is planned as a group limit on both sides of the shuffle, so a map task
    sends at most one row per key.
    """
    window = Window.partitionBy(*[_quoted(key) for key in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def with_instances(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    along: Column,
    number: str = "instance_number",
    total: str = "total_instances",
    large_key: int = LARGE_KEY,
) -> DataFrame:
    """Number the rows of every key along `order`, and give the size of its group.

    A combined count finds the keys with more than `large_key` rows. Without any, one window numbers
    the rows, which move once. Rows of large keys are cut into slices first, at quantiles of `along` (a
    number that never decreases along `order`, NULL last); every slice is numbered by itself and the
    sizes of the earlier ones are added. So no task gets more than about a thousandth of a large key,
    plus the rows that share one value of `along`.
    """
    ensure_checkpointing(df.sparkSession)
    by = [_quoted(key) for key in keys]
    large = df.groupBy(*by).agg(F.count("*").alias("_total")).where(F.col("_total") > large_key).checkpoint()
    count = large.count()
    if count == 0:
        same = Window.partitionBy(*by)
        numbered = F.row_number().over(same.orderBy(*order)).cast("long")
        return df.withColumns({number: numbered, total: F.count("*").over(same)})

    few = count <= BROADCAST_KEYS
    large = large.select(F.struct(*by).alias("_key"), "_total")
    tagged = df.withColumns({"_key": F.struct(*by), "_along": along.cast("double")})
    cuts = _cut_points(tagged.select("_key", "_along"), F.broadcast(large) if few else large)
    cut = tagged.join(F.broadcast(cuts) if few else cuts, "_key", "left").withColumn("_slice", _slice_of(F.col("_along")))
    # Without a broadcast the join has dealt the rows by key; slices are dealt out anew.
    cut = cut.drop("_coarse", "_fine") if few else cut.drop("_coarse", "_fine").repartition("_key", "_slice")

    sizes = cut.where(F.col("_total").isNotNull()).groupBy("_key", "_slice").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_key", "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_key", "_slice")
    local = cut.withColumns({"_local": F.row_number().over(inside.orderBy(*order)), "_count": F.count("*").over(inside)})
    return local.join(F.broadcast(before) if few else before, ["_key", "_slice"], "left").select(
        *[_quoted(name) for name in df.columns],
        (F.coalesce("_before", F.lit(0)) + F.col("_local")).cast("long").alias(number),
        F.coalesce("_total", "_count").cast("long").alias(total),
    )


def _cut_points(rows: DataFrame, large: DataFrame) -> DataFrame:
    """(_key, _total, _coarse, _fine): quantiles of a large key's `_along`, every 32nd of them, and those between."""
    shares = F.array(*[F.lit(k / SLICES) for k in range(1, SLICES)])
    found = rows.join(large, "_key").groupBy("_key").agg(
        F.first("_total").alias("_total"), F.coalesce(F.percentile_approx("_along", shares, 10 * SLICES), F.array().cast("array<double>")).alias("_cuts")
    )
    groups = F.sequence(F.lit(0), F.lit(SLICES // 32 - 1))
    fine = F.transform(groups, lambda k: F.slice("_cuts", k * 32 + 1, 31))
    coarse = F.filter(F.transform(groups, lambda k: F.get("_cuts", k * 32 + 31)), lambda c: c.isNotNull())
    return found.select("_key", "_total", coarse.alias("_coarse"), fine.alias("_fine"))


def _slice_of(along: Column) -> Column:
    """Which slice of its key a value falls into: two looks at 31 cut points; 0 where the key is not large, NULL last."""
    step = F.coalesce(F.size(F.filter("_coarse", lambda c: c < along)), F.lit(0))
    inner = F.size(F.filter(F.get("_fine", step), lambda c: c < along))
    return F.when(F.col("_total").isNull(), 0).when(along.isNull(), SLICES + 1).otherwise(step * 32 + inner)


def with_allowance(
    df: DataFrame, allowances: DataFrame, keys: Sequence[str], count: str, name: str = "allowed"
) -> DataFrame:
    """Add the number of rows a key may keep: its configured count if positive, else one."""
    config = (
        allowances.where(_quoted(count) > 0)
        .groupBy(*[_quoted(key) for key in keys])
        .agg(F.max(_quoted(count)).cast("long").alias(name))
    )
    joined = df.join(config, list(keys), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1).cast("long")))


def keep_last_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], allowances: DataFrame, count: str, large_key: int = LARGE_KEY
) -> DataFrame:
    """The last N rows of every key along `order`, N coming from `allowances` (one where a key has none).

    Keys of up to `large_key` rows are ranked by one window: rows move and are sorted once, and the
    allowances join what is sorted already. Larger ones, found by a combined count, are cut by their own N
    twice: inside parts of the key, dealt by a hash of the order, and then over what the parts kept. A row
    among the last N of its key is among the last N of its part, so a key of any size comes down to N rows
    a part before its rows meet.
    """
    ensure_checkpointing(df.sparkSession)
    columns = [_quoted(name) for name in df.columns]
    by = [_quoted(key) for key in keys]
    large = df.groupBy(*by).agg(F.count("*").alias("_total")).where(F.col("_total") > large_key).checkpoint()
    found = large.count()
    if found == 0:
        return _last_of_small(df, keys, order, allowances, count).select(*columns)

    sized = with_allowance(large.drop("_total"), allowances, keys, count, name="_allowed").select(F.struct(*by).alias("_key"), "_allowed")
    listed = F.broadcast(sized) if found <= BROADCAST_KEYS else sized
    tagged = df.withColumn("_key", F.struct(*by))
    dealt = tagged.join(listed, "_key").withColumn("_dealt", F.pmod(F.xxhash64(*[_quoted(name) for name in order]), F.lit(RANKED_PARTS)))
    # Rows dealt by key alone would do for a window over its parts too, so the parts are asked for.
    dealt = dealt.repartition("_key", "_dealt")
    for group in (["_key", "_dealt"], ["_key"]):
        window = Window.partitionBy(*group).orderBy(*newest_first(order))
        dealt = dealt.withColumn("_from_end", F.row_number().over(window)).where(F.col("_from_end") <= F.col("_allowed"))
    rest = tagged.join(listed, "_key", "left_anti").drop("_key")
    return dealt.select(*columns).unionByName(_last_of_small(rest, keys, order, allowances, count).select(*columns))


def _last_of_small(df: DataFrame, keys: Sequence[str], order: Sequence[str], allowances: DataFrame, count: str) -> DataFrame:
    """The last N rows of keys that one task can rank."""
    window = Window.partitionBy(*[_quoted(key) for key in keys]).orderBy(*newest_first(order))
    ranked = df.withColumn("_from_end", F.row_number().over(window))
    return with_allowance(ranked, allowances, keys, count, name="_allowed").where(F.col("_from_end") <= F.col("_allowed"))


def duplicate_census(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: str = "Duplicate Count"
) -> DataFrame:
    """Keys that occur more than once: their first row under `order`, and how often they occur."""
    rest = [name for name in df.columns if name not in keys]
    first = F.min_by(F.struct(*[_quoted(name) for name in rest]), F.struct(*[_quoted(name) for name in order]))
    grouped = df.groupBy(*[_quoted(key) for key in keys]).agg(
        first.alias("_first"), F.count("*").alias(count)
    )
    return grouped.where(_quoted(count) > 1).select(
        *[_quoted(key) for key in keys], *[F.col(f"_first.`{name}`") for name in rest], _quoted(count)
    )


def expected_extra_rows(allowances: DataFrame, count: str, name: str = "expected_duplicates") -> DataFrame:
    """One row: how many rows beyond the first the allowances permit in total."""
    extra = F.when(_quoted(count) > 0, _quoted(count) - 1).otherwise(0)
    return allowances.agg(F.coalesce(F.sum(extra), F.lit(0)).cast("long").alias(name))


def consolidation_stats(
    df: DataFrame, keys: Sequence[str], allowances: DataFrame, count: str
) -> DataFrame:
    """One row of counters for `keep_last_n`, with its own balance check.

    Works on one count per key, so the rows themselves are never shuffled.
    """
    per_key = df.groupBy(*[_quoted(key) for key in keys]).agg(F.count("*").alias("_found"))
    sized = with_allowance(per_key, allowances, keys, count, name="_allowed").withColumn(
        "_kept", F.least("_found", "_allowed")
    )
    stats = sized.agg(
        F.coalesce(F.sum("_found"), F.lit(0)).cast("long").alias("total_rows"),
        F.count("*").alias("unique_keys"),
        F.coalesce(F.sum(F.col("_found") - F.col("_kept")), F.lit(0)).cast("long").alias("rows_skipped"),
        F.coalesce(F.sum(F.col("_kept") - 1), F.lit(0)).cast("long").alias("extra_rows_kept"),
        F.count_if(F.col("_kept") > 1).alias("keys_with_extra_rows"),
        F.coalesce(F.sum("_kept"), F.lit(0)).cast("long").alias("final_rows"),
    )
    return stats.withColumns(
        {
            "total_duplicate_rows": F.col("total_rows") - F.col("unique_keys"),
            "balanced": (F.col("final_rows") == F.col("unique_keys") + F.col("extra_rows_kept"))
            & (F.col("total_rows") == F.col("final_rows") + F.col("rows_skipped")),
        }
    )
