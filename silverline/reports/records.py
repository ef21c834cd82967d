"""Audit rows: state hashes, manifests, roll-ups, lineage events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.audit import ids, lineage, manifests
from silverline.operators.joins import pair_results
from silverline.plans.bronze import content_digest, write_back_stats
from silverline.plans.silver import find
from silverline.quality import expectations as Q
from silverline.reports import shapes as S
from silverline.reports.scalars import DAY_SQL, _order_days
from silverline.reports.shapes import flat, table
from silverline.sources.readers import coverage_counts


def state_digest(spark: SparkSession, d: str) -> DataFrame:
    """AUD-01: a state hash per source, over any number of files."""
    files = table(spark, d, "documents").select("source", F.format_string("%s/%012d.parquet", "lang", "doc_id").alias("path"))
    return ids.state_digest(files, "v0.3.0", ["source"])


def run_ids(spark: SparkSession, d: str) -> DataFrame:
    """AUD-02: deterministic run ids."""
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.000'Z'")
    run = ids.deterministic_run_id(at, F.concat("event_type", F.lit("/"), F.col("event_id").cast("string")), F.lit("unknown"))
    return table(spark, d, "events").select("event_id", run.alias("run_id"))


def bronze_manifest(spark: SparkSession, d: str) -> DataFrame:
    """AGG-06, AUD-03: rows and distinct row hashes per bronze content."""
    rows = S.purchase_orders(spark, d).drop("row_hash").withColumn("row_hash", F.md5("Buyer"))
    stats = write_back_stats(rows, "source_file_hash")
    return flat(stats, "last_row")


def silver_manifest(spark: SparkSession, d: str) -> DataFrame:
    """AUD-04: bronze and silver row counts of four datasets."""
    out = None
    for dataset, version in (("purchase_orders", "v0.3.0"), ("contracts", "v0.2.0"), ("vendors", "v0.2.0"), ("bids", "v0.2.0")):
        bronze = getattr(S, dataset)(spark, d)
        silver = find(dataset, version)(bronze, S.RUN)
        sides = bronze.select(F.lit(0).alias("side")).unionByName(silver.select(F.lit(1).alias("side")))
        counts = sides.agg(F.count_if(F.col("side") == 0).alias("b"), F.count_if(F.col("side") == 1).alias("s"))
        fields = {"dataset": F.lit(dataset), "transform_version": F.lit(version)}
        part = counts.select(*manifests.silver_manifest(F.col("b"), F.col("s"), fields))
        out = part if out is None else out.unionByName(part)
    return out


def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    """AGG-18, AUD-05: succeeded, skipped and failed runs per dataset."""
    runs = table(spark, d, "events").select(
        F.col("event_type").alias("dataset"), (F.col("value") >= 5).alias("success"), (F.col("user_id") % 4 == 0).alias("skipped")
    )
    return flat(manifests.status_rollup(runs, ["dataset"]))


def availability(spark: SparkSession, d: str) -> DataFrame:
    """DQ-10: availability against its target."""
    return Q.availability(table(spark, d, "events").select((F.col("event_type") != "error").alias("success")))


def total_records(spark: SparkSession, d: str) -> DataFrame:
    """AGG-23: records per run over its files."""
    files = F.array(
        F.struct(F.lit("a.csv").alias("name"), F.year("o_orderdate").cast("long").alias("records")),
        F.struct(F.lit("b.html").alias("name"), F.lit(None).cast("long").alias("records")),
        F.struct(F.lit("c.csv").alias("name"), F.col("o_custkey").alias("records")),
    )
    runs = table(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), files.alias("files"))
    return manifests.total_records(runs, ["run_id"])


def _paired(spark: SparkSession, d: str) -> DataFrame:
    """Months with orders as tasks; months with finished orders have a result."""
    label = F.date_format("day", "yyyy-MM")
    days = _order_days(spark, d).select(F.col("o_orderpriority").alias("dataset"), F.lit("window").alias("kind"), label.alias("label"), "o_orderstatus", "o_totalprice")
    keys = ["dataset", "kind", "label"]
    tasks = days.select(*keys).distinct()
    open_orders = F.count_if(F.col("o_orderstatus") == "P")
    results = days.where("o_orderstatus <> 'O'").groupBy(*keys).agg(
        (open_orders % 7 != 0).alias("ok"), open_orders.alias("exit_code"), (open_orders % 5 == 0).alias("skipped"),
    ).where("exit_code % 11 <> 3")
    absent = {"error": F.lit(None).cast("string"), "run_id": F.concat(F.lit("run_"), "label"), "manifest_path": F.lit(None).cast("string")}
    return pair_results(tasks, results.withColumns(absent))


def task_results(spark: SparkSession, d: str) -> DataFrame:
    """JN-08, AUD-07: tasks paired with their results by key."""
    return _paired(spark, d).select("dataset", "kind", "label", "result.*").drop("manifest_path")


def orchestration_summary(spark: SparkSession, d: str) -> DataFrame:
    """AUD-07: counters over paired tasks."""
    return manifests.orchestration_summary(_paired(spark, d), ["dataset"])


def validation_attached(spark: SparkSession, d: str) -> DataFrame:
    """DQ-11, AUD-06: validation outcomes joined to manifests."""
    stats = table(spark, d, "documents").groupBy(F.col("source").alias("dataset")).agg(F.count("*").alias("row_count"))
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").groupBy(F.col("source").alias("dataset")).agg(
        F.count("*").alias("labelled"), (F.sum("toxic") == 0).alias("passed")
    )
    joined = manifests.attach_validation(stats, docs)
    return joined.select("dataset", "row_count", "validation.labelled", "validation.passed")


def reconcile(spark: SparkSession, d: str) -> DataFrame:
    """AGG-19, AUD-11: our line counts against external control totals, per part brand."""
    ours = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count("*").alias("ours"))
    external = table(spark, d, "part").groupBy("p_brand").agg((F.count("*") * 30).alias("external"))
    return ours.join(external, "p_brand").withColumns(manifests.reconcile(F.col("ours"), F.col("external")))


def coverage_counts_report(spark: SparkSession, d: str) -> DataFrame:
    """AGG-11, SRC-19: rows, years and months covered."""
    parted = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy").alias("year"), F.date_format("o_orderdate", "MM").alias("month"))
    return coverage_counts(parted)


def _event_runs(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("dataset"), F.concat(F.lit("/raw/"), k.cast("string"), F.lit(".csv")).alias("source_path"),
        F.concat(F.lit("/bronze/"), k.cast("string")).alias("output_path"), F.concat(F.lit("bronze-"), k.cast("string")).alias("run_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.000'Z'").alias("event_time"), F.col("o_custkey").alias("row_count"),
        (F.col("o_custkey") * 10).alias("byte_size"), F.md5(k.cast("string")).alias("file_hash"), (k % 1000).alias("duration_ms"),
        F.when(F.col("o_orderstatus") == "P", "disk full").alias("error_message"), F.lit(None).cast("string").alias("error_stack"),
    )


def lineage_events(spark: SparkSession, d: str) -> DataFrame:
    """AUD-08: START, COMPLETE and FAIL events of one run per order."""
    runs = _event_runs(spark, d)
    events = lineage.start_events(runs).unionByName(lineage.finish_events(runs))
    first_in, first_out = F.get("inputs", F.lit(0)), F.get("outputs", F.lit(0))
    return events.select(
        "eventType", "eventTime", F.col("job.name").alias("job"), F.col("run.runId").alias("run_id"),
        first_in["name"].alias("input"), first_out["name"].alias("output"),
        F.get_json_object(first_out["facets"]["storage"], "$.contentHash").alias("content_hash"),
        F.get_json_object(first_out["facets"]["dataQualityMetrics"], "$.rowCount").cast("long").alias("row_count"),
        F.get_json_object(F.col("run.facets")["errorMessage"], "$.message").alias("error"),
    )


def validation_events(spark: SparkSession, d: str) -> DataFrame:
    """AUD-08: one validation event per dataset with its assertions."""
    from silverline.reports.checks import _results

    results = _results(spark, d)
    runs = results.groupBy("dataset").agg(F.max("element_count").alias("row_count")).withColumns(
        {
            "bronze_path": F.concat(F.lit("/bronze/"), "dataset"), "run_id": F.concat(F.lit("bronze-"), "dataset"),
            "event_time": F.lit("2024-01-20T12:00:00.000Z"), "byte_size": F.lit(0).cast("long"),
        }
    )
    events = lineage.validation_events(results, runs)
    checks = F.from_json(F.get_json_object(F.col("run.facets")["dataQuality"], "$.assertions"), "array<struct<assertion:string,success:boolean>>")
    return events.select(
        F.col("job.name").alias("job"), F.size(checks).cast("long").alias("assertions"),
        F.size(F.filter(checks, lambda c: ~c["success"])).cast("long").alias("failed"),
        F.get_json_object(F.get("inputs", F.lit(0))["facets"]["dataQualityMetrics"], "$.rowCount").cast("long").alias("row_count"),
    )


def log_records(spark: SparkSession, d: str) -> DataFrame:
    """AUD-09: structured log records."""
    events = table(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.000'Z'").alias("event_time"), F.col("event_id").cast("string").alias("run_id"), "event_type", "user_id",
    )
    severity = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    logs = lineage.log_records(events, severity, F.concat(F.lit("user."), "event_type"), F.create_map(F.lit("user"), F.col("user_id").cast("string")))
    return logs.select("timestamp", "severity", "body", F.col("attributes")["user"].alias("user"), "traceId", "date")


def error_records(spark: SparkSession, d: str) -> DataFrame:
    """AUD-09: error records with defaults."""
    rows = table(spark, d, "events").where("event_type = 'error'").select(
        F.when(F.col("user_id") % 2 == 0, "TimeoutError").alias("name"), F.col("props").alias("message"),
        F.lit(None).cast("string").alias("stack"), F.when(F.col("user_id") % 3 == 0, "download").alias("stage"),
        F.lit(None).cast("string").alias("selector"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
    )
    return lineage.error_records(rows).drop("url", "selector", "stack")


def content_totals(spark: SparkSession, d: str) -> DataFrame:
    """SRC-09: size of a content in bytes; its hash is the same for any row order."""
    pages = table(spark, d, "pages").select("url", "html")
    mixed = content_digest(pages.repartition(7, "html"), ["url", "html"]).withColumnRenamed("content_hash", "_h")
    straight = content_digest(pages, ["url", "html"])
    same = straight.join(mixed.withColumnRenamed("content_bytes", "_b"), F.col("content_hash") == F.col("_h"))
    return same.select("content_bytes", (F.col("content_bytes") == F.col("_b")).alias("order_free"))


def run_manifests(spark: SparkSession, d: str) -> DataFrame:
    """AUD-06: nested run manifests, one per order, with their files."""
    start = F.col("o_orderdate").cast("timestamp")
    none = F.lit(None).cast("string")
    runs = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("dataset"), F.lit("all").alias("label"),
        start.alias("start_time"), F.when(F.col("o_orderstatus") != "P", start + F.expr("interval 90 second")).alias("end_time"),
        F.when(F.col("o_orderstatus") == "P", "error").otherwise("success").alias("status"), none.alias("error"),
        none.alias("start_date"), none.alias("end_date"), none.alias("filter"),
    )
    files = table(spark, d, "orders").where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.lit("a.csv").alias("name"), F.col("o_custkey").alias("size_bytes"),
        F.lit("csv").alias("kind"), F.col("o_custkey").alias("records"), (F.col("o_orderstatus") == "P").alias("partial"),
    )
    rows = manifests.run_manifest(runs, files)
    return rows.select(
        F.col("run.id").alias("run_id"), "run.dataset", "run.status", "run.duration_ms",
        F.size("files").cast("long").alias("files"), F.get("files", F.lit(0))["records"].alias("records"),
    )


def batch_summary(spark: SparkSession, d: str) -> DataFrame:
    """AUD-05: one summary over the validated datasets."""
    from silverline.reports.checks import _results

    statuses = Q.severity(_results(spark, d)).select("dataset", F.col("passed").alias("success"), (F.col("status") == "healthy").alias("skipped"))
    summary = manifests.batch_summary(statuses, "batch_1", S.NOW)
    names = F.array_sort(F.transform("results", lambda r: r["dataset"]))
    return summary.select("run_id", "timestamp", "datasets_processed", "successful", "skipped", "failed", F.concat_ws(",", names).alias("datasets"))


def consolidation_report(spark: SparkSession, d: str) -> DataFrame:
    """AUD-11: consolidated lines against the number of orders."""
    from silverline.operators.keyed import consolidation_stats
    from silverline.reports.keyed import _allowances

    stats = consolidation_stats(table(spark, d, "lineitem"), ["l_orderkey"], _allowances(spark, d), "allowed_rows")
    report = manifests.consolidation_report(stats, table(spark, d, "orders").count(), S.NOW)
    return report.select("final_rows", "external_count", "difference", "percent_captured", "verdict")


def sorted_silver(spark: SparkSession, d: str) -> DataFrame:
    """SRT-01: silver orders by date, newest first, then by key."""
    from silverline.operators.positions import with_positions

    transform = find("purchase_orders", "v0.4.0")
    rows = transform(S.purchase_orders(spark, d), S.RUN).select("po_id", "sent_date")
    return flat(with_positions(rows, transform.sort_columns()))


QUERIES = {
    "state_digest": state_digest, "run_ids": run_ids, "bronze_manifest": bronze_manifest, "silver_manifest": silver_manifest,
    "status_rollup": status_rollup, "availability": availability, "total_records": total_records, "task_results": task_results,
    "orchestration_summary": orchestration_summary, "validation_attached": validation_attached, "reconcile": reconcile,
    "coverage_counts": coverage_counts_report, "lineage_events": lineage_events, "validation_events": validation_events,
    "log_records": log_records, "error_records": error_records, "content_totals": content_totals,
    "run_manifests": run_manifests, "batch_summary": batch_summary, "consolidation_report": consolidation_report, "sorted_silver": sorted_silver,
}

_PATHS = "SELECT source, lang || '/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '.parquet' AS path FROM documents"
_TASKS = f"""(
SELECT t.*, coalesce(ok, false) AS ok, exit_code, coalesce(skipped, false) AS skipped,
       CASE WHEN exit_code IS NULL THEN 'no result was recorded for this task' END AS error,
       CASE WHEN exit_code IS NOT NULL THEN 'run_' || label END AS run_id
FROM (SELECT DISTINCT o_orderpriority AS dataset, 'window' AS kind, strftime({DAY_SQL}, '%Y-%m') AS label FROM orders) t
LEFT JOIN (SELECT dataset AS ds, label AS lb, p % 7 <> 0 AS ok, p AS exit_code, p % 5 = 0 AS skipped
           FROM (SELECT o_orderpriority AS dataset, strftime({DAY_SQL}, '%Y-%m') AS label, count(*) FILTER (o_orderstatus = 'P') AS p
                 FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL) WHERE p % 11 <> 3) r ON ds = dataset AND lb = label)"""


def _silver_counts() -> str:
    from silverline.reports.silver import SQL as SILVER

    parts = []
    for dataset, version, name, source in (
        ("purchase_orders", "v0.3.0", "po_v030", S.PO_SQL), ("contracts", "v0.2.0", "contracts_v020", S.CONTRACTS_SQL),
        ("vendors", "v0.2.0", "vendors_v020", S.VENDORS_SQL), ("bids", "v0.2.0", "bids_v020", S.BIDS_SQL),
    ):
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{version}' AS transform_version, b AS bronze_rows, s AS silver_rows, b - s AS filtered_rows, "
            f"round((b - s) / b * 100, 1) AS filter_rate FROM (SELECT count(*) AS b FROM {source} x), (SELECT count(*) AS s FROM ({SILVER[name]}))"
        )
    return " UNION ALL ".join(parts)


def _more_sql() -> dict[str, str]:
    from silverline.reports.checks import SQL as CHECKS
    from silverline.reports.keyed import SQL as KEYED
    from silverline.reports.silver import SQL as SILVER

    return {
        "run_manifests": """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS dataset, CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'success' END AS status,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(90000 AS BIGINT) END AS duration_ms, CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS BIGINT) AS files,
       CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS records FROM orders""",
        "batch_summary": f"""
SELECT 'batch_1' AS run_id, '2024-01-20T12:00:00.000Z' AS timestamp, count(*) AS datasets_processed,
       count(*) FILTER (passed AND status <> 'healthy') AS successful, count(*) FILTER (status = 'healthy') AS skipped,
       count(*) FILTER (NOT passed) AS failed, string_agg(dataset, ',' ORDER BY dataset) AS datasets FROM ({CHECKS['severity']})
HAVING count(*) FILTER (status <> 'healthy') > 0""",
        "consolidation_report": f"""
SELECT final_rows, n AS external_count, n - final_rows AS difference, round(final_rows / n * 100, 2) AS percent_captured,
       CASE WHEN n > final_rows THEN 'missing' WHEN n < final_rows THEN 'extra' ELSE 'match' END AS verdict
FROM ({KEYED['consolidation_stats']}), (SELECT count(*) AS n FROM orders)""",
        "sorted_silver": f"""
SELECT po_id, sent_date, row_number() OVER (ORDER BY sent_date DESC NULLS LAST, po_id) AS position FROM ({SILVER['po_v040']})""",
    }


def _validation_sql() -> str:
    from silverline.reports.checks import SQL as CHECKS

    return f"""
SELECT 'bronze.validate.' || dataset AS job, count(*) AS assertions, count(*) FILTER (NOT success) AS failed, max(element_count) AS row_count
FROM ({CHECKS['expectations']}) GROUP BY dataset"""


SQL = {
    "state_digest": f"""
SELECT source, sum(n)::BIGINT AS bronze_files,
       sha256('v0.3.0' || chr(10) || string_agg(bucket || ':' || h, chr(10) ORDER BY bucket)) AS bronze_state_hash
FROM (SELECT source, left(sha256(path), 3) AS bucket, count(*) AS n, sha256(string_agg(path, chr(10) ORDER BY path)) AS h
      FROM ({_PATHS}) GROUP BY ALL) GROUP BY source""",
    "run_ids": """
SELECT event_id, 'bronze-' || left(sha256(strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' || event_type || '/' || event_id || 'unknown'), 16) AS run_id
FROM events""",
    "bronze_manifest": f"""
SELECT source_file_hash, count(*) AS row_count, count(DISTINCT md5("Buyer")) AS unique_rows, min(bronze_run_id) AS run_id,
       strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S') AS min_ingest, strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') AS max_ingest
FROM {S.PO_SQL} p GROUP BY 1""",
    "silver_manifest": _silver_counts(),
    "status_rollup": """
SELECT event_type AS dataset, count(*) AS datasets_processed, count(*) FILTER (value >= 5 AND user_id % 4 <> 0) AS successful,
       count(*) FILTER (user_id % 4 = 0) AS skipped, count(*) FILTER (value < 5) AS failed,
       round(count(*) FILTER (value >= 5) / count(*) * 100, 2) AS success_rate FROM events GROUP BY 1""",
    "availability": "SELECT avg(CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.0 END) AS value, avg(CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.0 END) >= 0.999 AS target_met FROM events",
    "total_records": "SELECT o_orderkey AS run_id, year(o_orderdate) + o_custkey AS total_records, CAST(3 AS BIGINT) AS files FROM orders",
    "task_results": f"SELECT dataset, kind, label, ok, exit_code, skipped, error, run_id FROM {_TASKS} t",
    "orchestration_summary": f"""
SELECT dataset, count(*) AS tasks_total, count(*) FILTER (ok) AS tasks_succeeded, count(*) FILTER (NOT ok) AS tasks_failed,
       count(*) FILTER (skipped) AS tasks_skipped FROM {_TASKS} t GROUP BY 1""",
    "validation_attached": """
SELECT dataset, row_count, labelled, passed FROM (SELECT source AS dataset, count(*) AS row_count FROM documents GROUP BY 1)
LEFT JOIN (SELECT source AS dataset, count(*) AS labelled, sum(toxic) = 0 AS passed FROM documents JOIN labels USING (doc_id) GROUP BY 1) USING (dataset)""",
    "reconcile": """
SELECT p_brand, ours, external, external - ours AS difference, round(ours / external * 100, 2) AS percent_captured,
       CASE WHEN external > ours THEN 'missing' WHEN external < ours THEN 'extra' ELSE 'match' END AS verdict
FROM (SELECT p_brand, count(*) AS ours FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
JOIN (SELECT p_brand, count(*) * 30 AS external FROM part GROUP BY 1) USING (p_brand)""",
    "coverage_counts": "SELECT count(*) AS row_count, count(DISTINCT year(o_orderdate)) AS year_count, count(DISTINCT month(o_orderdate)) AS month_count FROM orders",
    "lineage_events": """
WITH e AS (SELECT *, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS stamp, 'bronze.ingest.' || o_orderpriority AS job,
                  'bronze-' || o_orderkey AS run_id, o_orderstatus = 'P' AS bad FROM orders)
SELECT 'START' AS eventType, stamp AS eventTime, job, run_id, '/raw/' || o_orderkey || '.csv' AS input, NULL AS output, NULL AS content_hash,
       CAST(NULL AS BIGINT) AS row_count, NULL AS error FROM e
UNION ALL
SELECT CASE WHEN bad THEN 'FAIL' ELSE 'COMPLETE' END, stamp, job, run_id, NULL, CASE WHEN NOT bad THEN '/bronze/' || o_orderkey END,
       CASE WHEN NOT bad THEN md5(CAST(o_orderkey AS VARCHAR)) END, CASE WHEN NOT bad THEN o_custkey END, CASE WHEN bad THEN 'disk full' END FROM e""",
    "validation_events": _validation_sql(),
    "log_records": """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS timestamp, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity,
       'user.' || event_type AS body, CAST(user_id AS VARCHAR) AS user, CAST(event_id AS VARCHAR) AS traceId, strftime(ts, '%Y-%m-%d') AS date FROM events""",
    "error_records": """
SELECT CASE WHEN user_id % 2 = 0 THEN 'TimeoutError' ELSE 'Error' END AS name, props AS message,
       CASE WHEN user_id % 3 = 0 THEN 'download' ELSE 'unknown' END AS stage, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp
FROM events WHERE event_type = 'error'""",
    "content_totals": "SELECT sum(octet_length(encode(url || '|' || html)))::BIGINT AS content_bytes, true AS order_free FROM pages",
}
SQL.update(_more_sql())
