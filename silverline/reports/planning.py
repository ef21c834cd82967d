"""Coverage gaps, range capacity and change plans, derived from the order calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.coverage import capacity as C
from silverline.coverage import gaps as G
from silverline.functions.dates import us_text
from silverline.operators.joins import not_in
from silverline.reports.scalars import DAY_SQL, _order_days
from silverline.reports.shapes import flat, table

BY = ["dataset"]
ASOF = "2025-07-28"
ASOF_SQL = f"DATE '{ASOF}'"
TARGET, LIMIT = 260, 500


def _days(spark: SparkSession, d: str) -> DataFrame:
    return _order_days(spark, d).withColumnRenamed("o_orderpriority", "dataset")


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return C.daily_counts(_days(spark, d), F.col("day"), BY)


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    """One range per priority and calendar year with orders; the last one ends on 2025-08-01."""
    years = _daily(spark, d).select(*BY, F.trunc("day", "year").alias("start_date")).distinct()
    end = F.least(F.date_add(F.add_months("start_date", 12), -1), F.lit("2025-08-01").cast("date"))
    return years.withColumn("end_date", end).withColumn("range_id", C.range_id(F.col("start_date"), F.col("end_date")))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return C.range_counts(_daily(spark, d), _ranges(spark, d), LIMIT, BY)


def _growth(spark: SparkSession, d: str) -> DataFrame:
    return C.growth_rate(_counts(spark, d), C.recent_counts(_daily(spark, d), ASOF, BY), BY)


def _capacity(spark: SparkSession, d: str) -> DataFrame:
    return C.capacity(_counts(spark, d), _growth(spark, d), ASOF, BY, TARGET, TARGET - 10)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Orders as runs: most requested a window of days, some are labelled with their day."""
    day, k = F.col("day"), F.col("o_orderkey")
    has_window = k % 3 != 0
    window_start = F.when(has_window, us_text(day))
    window_end = F.when(has_window, us_text(F.date_add(day, (k % 4).cast("int"))))
    return _days(spark, d).select(
        "dataset",
        window_start.alias("start_date"),
        window_end.alias("end_date"),
        F.when(k % 3 == 0, F.when(k % 2 == 0, F.date_format("day", "yyyy-MM-dd")).otherwise("all")).alias("label"),
        F.date_format("day", "yyyy-MM-dd'T'00:00:00.000'Z'").alias("start_time"),
        F.when(k % 5 != 0, F.date_format(F.date_add("day", 1), "yyyy-MM-dd'T'01:00:00.000'Z'")).alias("end_time"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("error").alias("status"),
    )


_RUNS = f"""(
SELECT o_orderpriority AS dataset, {DAY_SQL} AS day, CASE WHEN o_orderkey % 3 <> 0 THEN {DAY_SQL} END AS s,
       CASE WHEN o_orderkey % 3 <> 0 THEN {DAY_SQL} + CAST(o_orderkey % 4 AS INTEGER) END AS e,
       CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN CAST({DAY_SQL} AS VARCHAR) ELSE 'all' END END AS label,
       {DAY_SQL} + CASE WHEN o_orderkey % 5 <> 0 THEN 1 ELSE 0 END AS run_day,
       CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'error' END AS status FROM orders)"""
_COVERED = f"""(
SELECT DISTINCT dataset, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM {_RUNS} r WHERE s IS NOT NULL
UNION SELECT DISTINCT dataset, day FROM {_RUNS} r WHERE s IS NULL AND label <> 'all')"""


def covered_days(spark: SparkSession, d: str) -> DataFrame:
    """PLN-03, AGG-24, DAT-12: days covered by windows or labels."""
    return flat(G.covered_days(_runs(spark, d)))


def run_days(spark: SparkSession, d: str) -> DataFrame:
    """AGG-24: days on which runs ended."""
    return flat(G.run_days(_runs(spark, d)))


def coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    """PLN-01, JN-05: missing days of the last fortnight, per dataset."""
    runs = _runs(spark, d)
    return flat(G.missing_days(G.run_days(runs.where("status = 'success'")), runs, ASOF))


def month_gaps(spark: SparkSession, d: str) -> DataFrame:
    """PLN-02: months with uncovered days, per dataset."""
    runs = _runs(spark, d)
    return G.months_with_gaps(G.covered_days(runs.where("status = 'success'")), runs, ASOF, "2018-11-15")


def day_difference(spark: SparkSession, d: str) -> DataFrame:
    """SET-03: the (kind, day) pairs of days on which some kind had no orders."""
    days = _daily(spark, d)
    kinds = days.select(F.col(days.columns[0])).distinct().count()
    everywhere = days.groupBy("day").agg(F.count("*").alias("_kinds"))
    full = everywhere.where(F.col("_kinds") == kinds).select("day")
    return flat(not_in(days, full, ["day"]))


def date_span(spark: SparkSession, d: str) -> DataFrame:
    """AGG-20: first, last and number of days per status."""
    days = _order_days(spark, d).groupBy("o_orderstatus", "day").agg(F.count("*").alias("n"))
    span = days.groupBy("o_orderstatus").agg(
        F.min("day").alias("earliest"), F.max("day").alias("latest"), F.count("*").alias("distinct_dates"), F.sum("n").alias("orders")
    )
    return flat(span)


def month_windows(spark: SparkSession, d: str) -> DataFrame:
    """DAT-13, DAT-14: calendar months touched by every customer's active period, clipped."""
    days = _order_days(spark, d)
    spans = days.groupBy("o_custkey").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return flat(G.month_windows(spans, F.col("first"), F.col("last")).drop("first", "last"))


def year_windows(spark: SparkSession, d: str) -> DataFrame:
    """PLN-08: yearly windows since every customer's first order."""
    first = _order_days(spark, d).groupBy("o_custkey").agg(F.min("day").alias("first"))
    return flat(G.year_windows(first, F.col("first"), F.lit(ASOF).cast("date")).drop("first"))


def range_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG-22, JN-07: rows per range against the limit."""
    return flat(_counts(spark, d))


def growth_rate(spark: SparkSession, d: str) -> DataFrame:
    """AGG-21: weighted daily growth per dataset."""
    rounded = _growth(spark, d).withColumns({name: F.round(name, 6) for name in ("daily", "monthly")})
    return flat(rounded)


def range_capacity(spark: SparkSession, d: str) -> DataFrame:
    """PLN-04, PLN-05: room, days left, state and action of every range."""
    return flat(_capacity(spark, d), "daily", "monthly", "data_points", "percent_used")


def planned_extensions(spark: SparkSession, d: str) -> DataFrame:
    """PLN-05: extension by all of the remaining room."""
    rows = _counts(spark, d).join(_growth(spark, d), BY)
    plan = C.planned_extension(F.col("end_date"), F.col("rows"), F.col("daily") / 20, F.lit(ASOF).cast("date"), 400)
    return flat(rows.select("dataset", "range_id", *[v.alias(k) for k, v in plan.items()]))


def next_ranges(spark: SparkSession, d: str) -> DataFrame:
    """PLN-06: the range that follows each one."""
    rows = _counts(spark, d).join(_growth(spark, d), BY)
    plan = C.next_range(F.col("end_date"), F.col("daily"), 400)
    return flat(rows.select("dataset", "range_id", *[v.alias(k) for k, v in plan.items()]))


def range_changes(spark: SparkSession, d: str) -> DataFrame:
    """PLN-11: ranges after extensions and additions."""
    rows = _capacity(spark, d)
    extended = rows.where("action = 'extend'")
    plan = C.next_range(F.col("end_date"), F.col("daily"), 400)
    added = rows.where("action = 'add'").select(
        "dataset", plan["next_id"].alias("range_id"), plan["next_start"].alias("start_date"), plan["next_end"].alias("end_date")
    )
    return flat(C.apply_changes(_ranges(spark, d), extended, added, BY))


def range_split(spark: SparkSession, d: str) -> DataFrame:
    """PLN-07: longest contiguous ranges within the limit."""
    return flat(C.split_ranges(_daily(spark, d), LIMIT, BY))


def count_fallback(spark: SparkSession, d: str) -> DataFrame:
    """PLN-12: counts from shipments, else from orders, else none, with their source."""
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    shipped = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("external"))
    other = table(spark, d, "lineitem").where("l_linestatus = 'O'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count_distinct("l_orderkey").alias("bronze")
    )
    parts = table(spark, d, "part").select("p_partkey").join(shipped, "p_partkey", "left").join(other, "p_partkey", "left")
    return C.with_fallback(parts, F.col("external"), F.col("bronze")).select("p_partkey", "rows", "count_source")


def ranges_to_fetch(spark: SparkSession, d: str) -> DataFrame:
    """PLN-09: the newest range per dataset."""
    return flat(G.ranges_to_fetch(_ranges(spark, d), "last", "start_date", BY))


def pending_today(spark: SparkSession, d: str) -> DataFrame:
    """PLN-10: tasks without a successful run on the day."""
    runs = _runs(spark, d).withColumn("label", F.coalesce("label", F.lit("window")))
    kind = F.when(F.col("label") == "all", "snapshot").when(F.col("label") == "window", "window").otherwise("note")
    tasks = runs.select("dataset", "label", kind.alias("kind")).distinct()
    return G.pending_today(tasks, runs, "2025-06-11")


QUERIES = {
    "covered_days": covered_days, "run_days": run_days, "coverage_gaps": coverage_gaps, "month_gaps": month_gaps,
    "day_difference": day_difference, "date_span": date_span, "month_windows": month_windows, "year_windows": year_windows,
    "range_counts": range_counts, "growth_rate": growth_rate, "range_capacity": range_capacity,
    "planned_extensions": planned_extensions, "next_ranges": next_ranges, "range_changes": range_changes,
    "range_split": range_split, "count_fallback": count_fallback, "ranges_to_fetch": ranges_to_fetch,
    "pending_today": pending_today,
}

_DAILY = f"(SELECT o_orderpriority AS dataset, {DAY_SQL} AS day, count(*) AS n FROM orders GROUP BY ALL)"
_ID = "strftime({s}, '%m%d%Y') || '_to_' || strftime({e}, '%m%d%Y')"
_RANGES = f"""(
SELECT *, {_ID.format(s='start_date', e='end_date')} AS range_id
FROM (SELECT DISTINCT o_orderpriority AS dataset, make_date(year({DAY_SQL}), 1, 1) AS start_date,
             least(make_date(year({DAY_SQL}), 12, 31), DATE '2025-08-01') AS end_date FROM orders))"""
_COUNTS = f"""(
SELECT r.dataset, range_id, start_date, end_date, coalesce(sum(n), 0)::BIGINT AS rows
FROM {_RANGES} r LEFT JOIN {_DAILY} d ON d.dataset = r.dataset AND day BETWEEN start_date AND end_date GROUP BY ALL)"""
_GROWTH = f"""(
SELECT dataset, sum(daily * w) / sum(w) AS daily, count(*) AS points FROM (
  SELECT dataset, rows / (end_date - start_date) AS daily,
         CASE WHEN start_date = max(start_date) OVER (PARTITION BY dataset) THEN 2 ELSE 1 END AS w FROM {_COUNTS} c WHERE rows > 0
  UNION ALL
  SELECT dataset, sum(n) / 30, 3 FROM {_DAILY} d WHERE day BETWEEN {ASOF_SQL} - 30 AND {ASOF_SQL} GROUP BY dataset) GROUP BY dataset)"""
_CAPACITY = f"""(
SELECT *, CASE WHEN active AND room > 0 AND left_days <= 7 THEN 'extend' WHEN active AND room <= 0 THEN 'add' ELSE 'ok' END AS action,
       CASE WHEN active AND room > 0 AND left_days <= 7 THEN greatest(7, CAST(floor(floor(room / daily) * 0.9) AS INTEGER)) END AS ext
FROM (SELECT c.*, g.daily, {TARGET} - rows AS room, end_date - {ASOF_SQL} AS left_days,
             start_date = max(start_date) OVER (PARTITION BY c.dataset) AS active
      FROM {_COUNTS} c JOIN {_GROWTH} g USING (dataset)))"""
_NEXT_DAYS = "CAST(floor(360 / daily) AS INTEGER)"
SQL = {
    "covered_days": f"SELECT dataset, CAST(day AS VARCHAR) AS day FROM {_COVERED} c",
    "run_days": f"SELECT DISTINCT dataset, CAST(run_day AS VARCHAR) AS day FROM {_RUNS} r",
    "coverage_gaps": f"""
SELECT dataset, CAST(day AS VARCHAR) AS day
FROM (SELECT DISTINCT dataset FROM {_RUNS} r), (SELECT {ASOF_SQL} - CAST(range AS INTEGER) AS day FROM range(1, 15)) c
WHERE (dataset, day) NOT IN (SELECT dataset, run_day FROM {_RUNS} r WHERE status = 'success')""",
    "month_gaps": f"""
SELECT dataset, strftime(date_trunc('month', day), '%m/%d/%Y') AS start_date, strftime(last_day(day), '%m/%d/%Y') AS end_date,
       strftime(day, '%Y-%m') AS label, count(*) AS missing_days
FROM (SELECT DISTINCT dataset FROM {_RUNS} r), (SELECT CAST(unnest(generate_series(DATE '2018-11-01', {ASOF_SQL}, INTERVAL 1 DAY)) AS DATE) AS day) c
WHERE (dataset, day) NOT IN (SELECT dataset, day FROM {_COVERED.replace(f'FROM {_RUNS} r WHERE', f"FROM {_RUNS} r WHERE status = 'success' AND")} v)
GROUP BY ALL""",
    "day_difference": f"""
SELECT CAST(day AS VARCHAR) AS day, dataset, n AS rows FROM {_DAILY} d
WHERE day NOT IN (SELECT day FROM {_DAILY} e GROUP BY day HAVING count(*) = 5)""",
    "date_span": f"""
SELECT o_orderstatus, CAST(min({DAY_SQL}) AS VARCHAR) AS earliest, CAST(max({DAY_SQL}) AS VARCHAR) AS latest,
       count(DISTINCT {DAY_SQL}) AS distinct_dates, count(*) AS orders FROM orders GROUP BY 1""",
    "month_windows": f"""
SELECT o_custkey, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end,
       CASE WHEN day(ws) = 1 AND we = last_day(ws) THEN 'full_month' WHEN ws = we THEN 'single_day' ELSE 'custom' END AS kind
FROM (SELECT o_custkey, greatest(m, f) AS ws, least(last_day(m), l) AS we
      FROM (SELECT o_custkey, f, l, CAST(unnest(generate_series(date_trunc('month', f), l, INTERVAL 1 MONTH)) AS DATE) AS m
            FROM (SELECT o_custkey, min({DAY_SQL}) AS f, max({DAY_SQL}) AS l FROM orders GROUP BY 1)))""",
    "year_windows": f"""
SELECT o_custkey, CAST(make_date(CAST(y AS INTEGER), 1, 1) AS VARCHAR) AS window_start,
       CAST(least(make_date(CAST(y AS INTEGER), 12, 31), {ASOF_SQL}) AS VARCHAR) AS window_end, 'year_' || y AS label
FROM (SELECT o_custkey, unnest(range(min(year({DAY_SQL})), 2026)) AS y FROM orders GROUP BY 1)""",
    "range_counts": f"""
SELECT dataset, range_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, rows,
       CAST(round(rows / {LIMIT} * 100) AS BIGINT) AS percent_used FROM {_COUNTS} c""",
    "growth_rate": f"SELECT dataset, round(daily, 6) AS daily, round(daily * 30, 6) AS monthly, points AS data_points FROM {_GROWTH} g",
    "range_capacity": f"""
SELECT dataset, range_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, rows, active,
       room AS room_left, CASE WHEN room > 0 THEN CAST(floor(room / daily) AS BIGINT) END AS days_of_room,
       CAST(left_days AS BIGINT) AS days_until_end,
       CASE WHEN NOT active THEN 'historical' WHEN left_days < 0 THEN 'ended' ELSE 'active' END AS state,
       active AND rows >= {TARGET - 10} AS near_limit, action, CAST(ext AS BIGINT) AS extension_days,
       CAST(end_date + ext AS VARCHAR) AS new_end FROM {_CAPACITY} c""",
    "planned_extensions": f"""
SELECT dataset, range_id, CASE WHEN ok THEN CAST(t AS VARCHAR) END AS suggested_end, CASE WHEN ok THEN room END AS additional_capacity,
       CASE WHEN ok THEN CAST(t - end_date AS BIGINT) END AS days_added
FROM (SELECT *, end_date > {ASOF_SQL} AND room > 0 AND dd >= 30 AS ok, least(end_date + dd, DATE '2027-07-28') AS t
      FROM (SELECT c.*, 400 - rows AS room, CAST(floor((400 - rows) / (daily / 20)) AS INTEGER) AS dd FROM {_COUNTS} c JOIN {_GROWTH} g USING (dataset)))""",
    "next_ranges": f"""
SELECT dataset, range_id, {_ID.format(s='end_date + 1', e=f'end_date + 1 + {_NEXT_DAYS}')} AS next_id, CAST(end_date + 1 AS VARCHAR) AS next_start,
       CAST(end_date + 1 + {_NEXT_DAYS} AS VARCHAR) AS next_end, CAST(400 AS BIGINT) AS estimated_count,
       CAST(round({_NEXT_DAYS} / 30) AS BIGINT) AS estimated_months FROM {_COUNTS} c JOIN {_GROWTH} g USING (dataset)""",
    "range_changes": f"""
SELECT dataset, {_ID.format(s='start_date', e='end_date + coalesce(ext, 0)')} AS range_id, CAST(start_date AS VARCHAR) AS start_date,
       CAST(end_date + coalesce(ext, 0) AS VARCHAR) AS end_date FROM {_CAPACITY} c
UNION ALL
SELECT dataset, {_ID.format(s='end_date + 1', e=f'end_date + 1 + {_NEXT_DAYS}')}, CAST(end_date + 1 AS VARCHAR),
       CAST(end_date + 1 + {_NEXT_DAYS} AS VARCHAR) FROM {_CAPACITY} c WHERE action = 'add'""",
    "range_split": f"""
WITH RECURSIVE days AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY day) AS i FROM {_DAILY} d),
walk AS (
  SELECT dataset, i, day, n AS total, day AS s FROM days WHERE i = 1
  UNION ALL
  SELECT d.dataset, d.i, d.day, CASE WHEN w.total + d.n <= {LIMIT} THEN w.total + d.n ELSE d.n END,
         CASE WHEN w.total + d.n <= {LIMIT} THEN w.s ELSE d.day END
  FROM walk w JOIN days d ON d.dataset = w.dataset AND d.i = w.i + 1)
SELECT dataset, CAST(s AS VARCHAR) AS start_date, CAST(max(day) AS VARCHAR) AS end_date, max(total) AS rows,
       max(total) > {LIMIT} AS over_limit, {_ID.format(s='s', e='max(day)')} AS range_id
FROM walk GROUP BY dataset, s""",
    "count_fallback": """
SELECT p_partkey, coalesce(a.n, b.n, 0) AS rows, CASE WHEN a.n IS NOT NULL THEN 'external' WHEN b.n IS NOT NULL THEN 'bronze_fallback' ELSE 'no_data' END AS count_source
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a ON a.l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey, count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) b ON b.l_partkey = p_partkey""",
    "ranges_to_fetch": f"""
SELECT dataset, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, range_id FROM {_RANGES} r
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY start_date DESC) = 1""",
    "pending_today": f"""
SELECT DISTINCT dataset, coalesce(label, 'window') AS label, CASE WHEN label = 'all' THEN 'snapshot' ELSE 'window' END AS kind
FROM {_RUNS} r WHERE coalesce(label, 'all') = 'all' AND (dataset, coalesce(label, 'window')) NOT IN
  (SELECT dataset, coalesce(label, 'window') FROM {_RUNS} q WHERE status = 'success' AND run_day = DATE '2025-06-11')""",
}
