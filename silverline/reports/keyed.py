"""Deduplication, numbering, joins, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators import joins, keyed, ordering, positions
from silverline.plans.bronze import new_files
from silverline.reports import shapes as S
from silverline.reports.shapes import flat, table

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_DESC = ", ".join(f"{name} DESC" for name in LINE_ORDER)
_LINE_COLUMNS = (
    "l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"
)


def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    """WIN-01: the newest version of every order line."""
    rows = table(spark, d, "lineitem")
    return flat(keyed.latest_per_key(rows, ["l_orderkey", "l_linenumber"], keyed.newest_first(LINE_ORDER)))


def _allowances(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").where("o_orderkey % 3 = 0")
    return orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 4).alias("allowed_rows"))


_ALLOWANCES = "(SELECT o_orderkey AS k, o_custkey % 4 AS n FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 4 > 0)"
_KEEP_ORDER = [*LINE_ORDER, "l_linenumber"]


def keep_last_n(spark: SparkSession, d: str) -> DataFrame:
    """WIN-05, JN-02: the last N lines of every order, N set per order."""
    rows = table(spark, d, "lineitem")
    return flat(keyed.keep_last_n(rows, ["l_orderkey"], _KEEP_ORDER, _allowances(spark, d), "allowed_rows"))


def instance_markers(spark: SparkSession, d: str) -> DataFrame:
    """WIN-02, WIN-03: every sale of a part numbered over time, with the number of sales."""
    rows = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", *LINE_ORDER[:1], *LINE_ORDER[2:])
    order = keyed.oldest_first(["l_shipdate", "l_orderkey", "l_linenumber", *LINE_ORDER[2:]])
    numbered = keyed.with_instances(rows, ["l_partkey"], order, F.unix_date(F.col("l_shipdate").cast("date")))
    return flat(numbered.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "instance_number", "total_instances"))


def consolidation_stats(spark: SparkSession, d: str) -> DataFrame:
    """AGG-10: counters of keep_last_n with their balance check."""
    rows = table(spark, d, "lineitem")
    return keyed.consolidation_stats(rows, ["l_orderkey"], _allowances(spark, d), "allowed_rows")


def expected_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-08: rows beyond the first that the allowances permit."""
    return keyed.expected_extra_rows(_allowances(spark, d), "allowed_rows")


def duplicate_census(spark: SparkSession, d: str) -> DataFrame:
    """AGG-07: texts that occur more than once, with their first document."""
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("content_hash"), "doc_id", "lang", "source")
    return keyed.duplicate_census(docs, ["content_hash"], ["doc_id"], "copies")


def star_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """AGG-09, WIN-04, SET-02: dimensions with surrogate ids."""
    names = {"Organization": "id", "Department": "id", "Status": "id"}
    out = None
    for column, dim in positions.dimensions(S.purchase_orders(spark, d), names).items():
        part = dim.select(F.lit(column).alias("dimension"), F.col(column).alias("value"), "id")
        out = part if out is None else out.unionByName(part)
    return out


def _dim_sql(column: str) -> str:
    return (
        f"SELECT '{column}' AS dimension, v AS value, row_number() OVER (ORDER BY v NULLS LAST) AS id "
        f'FROM (SELECT DISTINCT "{column}" AS v FROM {S.PO_SQL} p)'
    )


def star_join(spark: SparkSession, d: str) -> DataFrame:
    """JN-01: a fact table joined with three dimensions, summed per dimension row."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    fact = orders.join(customer, orders.o_custkey == customer.c_custkey)
    keys = {c: f"{c}_id" for c in ("c_mktsegment", "o_orderstatus", "o_orderpriority")}
    joined = joins.star_join(fact, positions.dimensions(fact, keys))
    ids = list(keys.values())
    return joined.groupBy(*ids).agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


def _star_sql() -> str:
    def dim(column: str, source: str) -> str:
        return f"(SELECT {column}, row_number() OVER (ORDER BY {column}) AS {column}_id FROM (SELECT DISTINCT {column} FROM {source}))"

    return f"""
SELECT c_mktsegment_id, o_orderstatus_id, o_orderpriority_id, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
     JOIN {dim('c_mktsegment', 'customer JOIN orders ON o_custkey = c_custkey')} a USING (c_mktsegment)
     JOIN {dim('o_orderstatus', 'orders')} b USING (o_orderstatus)
     JOIN {dim('o_orderpriority', 'orders')} c USING (o_orderpriority)
GROUP BY ALL"""


def sorted_text_dates(spark: SparkSession, d: str) -> DataFrame:
    """SRT-01, SRT-02: position of every record in date order, unreadable dates last."""
    rows = S.purchase_orders(spark, d).select("PO #", "Sent Date", "source_row")
    order = [*ordering.text_date_order("Sent Date", "PO #", locale=False), F.col("source_row").asc()]
    return positions.with_positions(rows, order)


def first_sample(spark: SparkSession, d: str) -> DataFrame:
    """SRT-05: the first five events, with at least two purchases among them."""
    events = table(spark, d, "events").select("event_id", "event_type", "user_id")
    return ordering.first_sample(events, [F.col("event_id")], 5, F.col("event_type") == "purchase", 2)


def large_allowance(spark: SparkSession, d: str) -> DataFrame:
    """WIN-05: the last N lines of every return flag; one flag keeps 1,500, the others one."""
    rows = table(spark, d, "lineitem")
    allowances = rows.where("l_returnflag = 'R'").select("l_returnflag").distinct().withColumn("allowed_rows", F.lit(1500))
    return flat(keyed.keep_last_n(rows, ["l_returnflag"], [*_KEEP_ORDER, "l_orderkey"], allowances, "allowed_rows"))


def repeated_sample(spark: SparkSession, d: str) -> DataFrame:
    """SRT-05: the first seven of many equal rows, with at least nine of the last kind among the result."""
    events = table(spark, d, "events").select("event_type")
    last = events.agg(F.max("event_type")).first()[0]
    return ordering.first_sample(events, [F.col("event_type")], 7, F.col("event_type") == last, 9)


_SAMPLE_SQL = """
WITH head AS (SELECT event_id, event_type, user_id, event_type = 'purchase' AS in_stratum FROM events ORDER BY event_id LIMIT 5),
spare AS (SELECT *, row_number() OVER (ORDER BY event_id) AS n
          FROM (SELECT event_id, event_type, user_id, true AS in_stratum FROM events
                WHERE event_type = 'purchase' AND event_id NOT IN (SELECT event_id FROM head)))
SELECT * FROM head UNION ALL
SELECT event_id, event_type, user_id, in_stratum FROM spare
WHERE n <= 2 - (SELECT count(*) FROM head WHERE in_stratum)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    files = F.array(
        F.struct(
            F.when(F.col("event_id") % 4 == 0, "data_with_urls.csv").when(F.col("event_id") % 4 == 1, "page.html")
            .otherwise("data.csv").alias("name"),
            (F.col("event_id") % 50).alias("records"),
        )
    )
    return table(spark, d, "events").select(
        F.col("event_type").alias("dataset"),
        (F.col("user_id") % 5).cast("string").alias("label"),
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("run_id"),
        F.when(F.col("value") < 5, "failed").otherwise("success").alias("status"),
        files.alias("files"),
    )


def latest_run(spark: SparkSession, d: str) -> DataFrame:
    """SRT-06: the newest successful run with data, per dataset and label."""
    newest = ordering.latest_successful_run(_runs(spark, d), ["dataset", "label"])
    return newest.select("dataset", "label", "run_id", "status", F.col("files")[0]["records"].alias("records"))


_LATEST_RUN_SQL = """
SELECT event_type AS dataset, CAST(user_id % 5 AS VARCHAR) AS label,
       max('run_' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || lpad(CAST(event_id AS VARCHAR), 12, '0')) AS run_id,
       'success' AS status,
       arg_max(event_id % 50, strftime(ts, '%Y%m%dT%H%M%S') || '_' || lpad(CAST(event_id AS VARCHAR), 12, '0')) AS records
FROM events WHERE value >= 5 AND event_id % 4 > 1 GROUP BY ALL"""


def anti_ingest(spark: SparkSession, d: str) -> DataFrame:
    """JN-03: documents whose content is not among the labelled ones, one per content."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"))
    known = joins.members(docs, table(spark, d, "labels"), ["doc_id"])
    return new_files(docs, known).drop("path")


def semi_members(spark: SparkSession, d: str) -> DataFrame:
    """JN-06: orders of customers in debt."""
    debtors = table(spark, d, "customer").where("c_acctbal < 0").withColumnRenamed("c_custkey", "o_custkey")
    return joins.members(table(spark, d, "orders"), debtors, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


def union_versions(spark: SparkSession, d: str) -> DataFrame:
    """SET-01: two parts of a dataset as one bag."""
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b)


def snapshot_compare(spark: SparkSession, d: str) -> DataFrame:
    """AGG-25: rows per brand this time and last time, with the signed difference."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"))
    sold = lines.join(table(spark, d, "part"), "p_partkey").groupBy("p_brand").agg(
        F.coalesce(F.sum(F.when(F.col("y") == 1998, F.col("n"))), F.lit(0)).alias("previous_rows"),
        F.coalesce(F.sum(F.when(F.col("y") == 1999, F.col("n"))), F.lit(0)).alias("new_rows"),
    )
    return sold.withColumn("difference", F.col("new_rows") - F.col("previous_rows"))


QUERIES = {
    "latest_per_key": latest_per_key,
    "keep_last_n": keep_last_n,
    "instance_markers": instance_markers,
    "consolidation_stats": consolidation_stats,
    "expected_duplicates": expected_duplicates,
    "duplicate_census": duplicate_census,
    "star_dimensions": star_dimensions,
    "star_join": star_join,
    "sorted_text_dates": sorted_text_dates,
    "first_sample": first_sample, "large_allowance": large_allowance, "repeated_sample": repeated_sample,
    "latest_run": latest_run,
    "anti_ingest": anti_ingest,
    "semi_members": semi_members,
    "union_versions": union_versions,
    "snapshot_compare": snapshot_compare,
}
SQL = {
    "latest_per_key": f"""
SELECT {_LINE_COLUMNS} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_DESC}) = 1""",
    "keep_last_n": f"""
SELECT {_LINE_COLUMNS} FROM lineitem LEFT JOIN {_ALLOWANCES} a ON k = l_orderkey
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_DESC}, lineitem.l_linenumber DESC) <= coalesce(n, 1)""",
    "instance_markers": """
SELECT l_partkey, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, l_extendedprice,
       row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, lineitem.l_linenumber, l_suppkey,
                          l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS instance_number,
       count(*) OVER (PARTITION BY l_partkey) AS total_instances
FROM lineitem""",
    "consolidation_stats": f"""
SELECT sum(f)::BIGINT AS total_rows, count(*) AS unique_keys, (sum(f) - sum(kept))::BIGINT AS rows_skipped,
       (sum(kept) - count(*))::BIGINT AS extra_rows_kept, count(*) FILTER (kept > 1) AS keys_with_extra_rows,
       sum(kept)::BIGINT AS final_rows, (sum(f) - count(*))::BIGINT AS total_duplicate_rows, true AS balanced
FROM (SELECT f, least(f, coalesce(n, 1)) AS kept
      FROM (SELECT l_orderkey, count(*) AS f FROM lineitem GROUP BY 1) LEFT JOIN {_ALLOWANCES} a ON k = l_orderkey)""",
    "expected_duplicates": f"SELECT sum(n - 1)::BIGINT AS expected_duplicates FROM {_ALLOWANCES} a",
    "duplicate_census": """
SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang,
       arg_min(source, doc_id) AS source, count(*) AS copies
FROM documents GROUP BY 1 HAVING count(*) > 1""",
    "star_dimensions": " UNION ALL ".join(_dim_sql(c) for c in ("Organization", "Department", "Status")),
    "star_join": _star_sql(),
    "sorted_text_dates": f"""
SELECT "PO #", "Sent Date", source_row,
       row_number() OVER (ORDER BY try_strptime("Sent Date", '%m/%d/%Y') NULLS LAST, "PO #" NULLS FIRST, source_row) AS position
FROM {S.PO_SQL} p""",
    "first_sample": _SAMPLE_SQL,
    "large_allowance": f"""
SELECT {_LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_DESC}, l_linenumber DESC, l_orderkey DESC) AS n FROM lineitem)
WHERE n <= CASE WHEN l_returnflag = 'R' THEN 1500 ELSE 1 END""",
    "repeated_sample": """
SELECT event_type, event_type = (SELECT max(event_type) FROM events) AS in_stratum
FROM (SELECT event_type FROM events ORDER BY 1 LIMIT 7)
UNION ALL
SELECT event_type, true FROM (SELECT event_type, row_number() OVER () AS n FROM events WHERE event_type = (SELECT max(event_type) FROM events))
WHERE n > (SELECT count(*) FROM (SELECT event_type FROM events ORDER BY 1 LIMIT 7) WHERE event_type = (SELECT max(event_type) FROM events)) AND n <= 9""",
    "latest_run": _LATEST_RUN_SQL,
    "anti_ingest": """
SELECT min(doc_id) AS doc_id, sha256(text) AS sha256 FROM documents
WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id)) GROUP BY 2""",
    "semi_members": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""",
    "union_versions": "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "snapshot_compare": """
SELECT p_brand, count(*) FILTER (year(l_shipdate) = 1998) AS previous_rows, count(*) FILTER (year(l_shipdate) = 1999) AS new_rows,
       count(*) FILTER (year(l_shipdate) = 1999) - count(*) FILTER (year(l_shipdate) = 1998) AS difference
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
}
