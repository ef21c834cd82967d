"""Readers, writers and incremental ingestion: tables go out to files and come back.

Files are written below the shared folder of the session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.audit.lineage import log_records as make_logs
from silverline.audit.manifests import batch_summary
from silverline.audit.snapshots import compare_snapshots
from silverline.operators.joins import side_by_side
from silverline.plans import batch as batches
from silverline.plans import bronze as B
from silverline.plans import consolidation
from silverline.plans.silver import SilverRun
from silverline.plans.silver.common import newest_version
from silverline.plans.silver_build import build_silver
from silverline.plans.typed_export import TYPED_MAPS, TypedColumn, TypedMap, export_typed, typed_projection
from silverline.reports import shapes as S
from silverline.reports.shapes import flat, table
from silverline.session import remove_path, scratch_path
from silverline.sources import files, readers, writers
from silverline.sources.registry import FileSchema, schema_for
from silverline.streaming.ingest import current_log_counts, stream_bronze, stream_log_counts

RUN = B.IngestRun(event_time=dt.datetime(2024, 1, 20, 12, 0, 0))


def _export(spark: SparkSession, d: str, dataset: str) -> tuple[str, FileSchema]:
    """A dataset's business columns as CSV files of one run."""
    schema = schema_for(dataset)
    path = f"{scratch_path(spark, dataset)}/raw/2024/01/19/run_20240119T000000.000Z_a/files"
    writers.write_csv_ordered(getattr(S, dataset)(spark, d), path, schema.columns)
    return path, schema


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """SRC-01, SRC-16: vendors written as CSV and read with their fixed schema."""
    path, schema = _export(spark, d, "vendors")
    rows = readers.read_csv_registry(spark, path, schema)
    return rows.groupBy(*[F.col(f"`{name}`") for name in schema.columns]).agg(F.count("*").alias("n"))


def csv_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """SRC-02, SRC-21, SRC-22: bids read tolerantly, with their provenance."""
    path, schema = _export(spark, d, "bids")
    rows = readers.raw_with_provenance(spark, path, schema)
    origin = F.split("_origin_file", "/")[0]
    return rows.groupBy("Status", origin.alias("run")).agg(F.count("*").alias("n"), F.count("Awarded Vendor(s)").alias("awarded"))


def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """SRC-03, SRC-20: detected types of the customer table as CSV."""
    path = scratch_path(spark, "customer")
    rows = table(spark, d, "customer")
    writers.write_csv_ordered(rows, path, rows.columns)
    read = readers.read_csv_inferred(spark, path)
    return read.agg(
        F.count("*").alias("n"), F.sum("c_custkey").alias("keys"), F.sum("c_nationkey").alias("nations"),
        F.round(F.sum(F.col("c_acctbal").cast("decimal(18,2)")), 2).cast("double").alias("balance"),
        F.lit(read.schema["c_acctbal"].dataType.simpleString()).alias("balance_type"),
    )


def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """SRC-04, SRC-08 to SRC-11: files with kinds, record counts and hashes."""
    path, schema = _export(spark, d, "contracts")
    listed = files.list_files(spark, path)
    counts = files.csv_record_counts(spark, path, schema)
    inventory = files.file_inventory(listed, counts)
    data = inventory.where("kind = 'csv'")
    lines = files.checksum_lines(files.content_hashes(spark, path, "*.csv"), path)
    good = lines.agg(F.every(F.col("line").rlike("^[0-9a-f]{64}  .+[.]csv$")).alias("checksums_ok"))
    totals = data.agg(F.sum("records").alias("records"), F.every(F.col("size_bytes") > 0).alias("sized"), F.every(~F.col("partial")).alias("whole"))
    return side_by_side(totals, good)


def split_exports(spark: SparkSession, d: str) -> DataFrame:
    """SRC-01, SRC-11: exports of which some have line breaks inside quotes; only these files are read whole."""
    path = scratch_path(spark, "mixed")
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("Customer"), F.concat("c_name", F.when(F.col("c_nationkey") % 5 == 0, "\n").otherwise(" "), "c_mktsegment").alias("Note"),
        (F.col("c_nationkey") % 5 == 0).alias("broken"),
    )
    schema = FileSchema(("Customer", "Note"), "Customer")
    for broken in (True, False):
        writers.write_csv_ordered(rows.where(F.col("broken") == broken), f"{path}/run_{'b' if broken else 'a'}/files", schema.columns)
    read = readers.raw_with_provenance(spark, f"{path}/*/files", schema)
    found = len(readers.unsplittable_files(spark, f"{path}/*/files"))
    run = F.split("_origin_file", "/")[0]
    counted = files.csv_record_counts(spark, f"{path}/*/files", schema).agg(F.sum("records").alias("records"))
    per_run = read.groupBy(run.alias("run")).agg(F.count("*").alias("n"), F.sum(F.length("Note")).alias("characters"), F.sum(F.col("Customer").cast("long")).alias("keys"))
    records = F.lit(counted.first()["records"]).cast("long")
    return per_run.withColumns({"records": records, "some_read_whole": F.lit(found > 0) & (F.col("run") == "b")})


def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    """SRC-09: hashes of one text file a nation, in memory and in pieces."""
    path = scratch_path(spark, "texts")
    lines = table(spark, d, "customer").select(F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("value"), "c_nationkey", "c_custkey")
    placed = lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("value", "c_nationkey")
    placed.write.partitionBy("c_nationkey").text(path)
    parts = []
    for way, most in (("memory", files.WHOLE_BYTES), ("pieces", 0)):
        hashes = files.content_hashes(spark, path, "*.txt", most)
        nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("long")
        parts.append(hashes.select(nation.alias("nation"), F.lit(way).alias("way"), "sha256", "source_file_bytes"))
    return parts[0].unionByName(parts[1])


_PO_MAP = TypedMap(
    (
        TypedColumn("PO #", "po_id", primary_key=True),
        TypedColumn("Sent Date", "date_sent", "date", "date"),
        TypedColumn("Total", "total_amount", "decimal(18,2)", "money"),
    ),
    "date_sent",
)


def year_month_export(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14, PRJ-01, PIPE-16, DAT-11: typed orders by year and month; the second run replaces its months."""
    path = scratch_path(spark, "typed")
    rows = S.purchase_orders(spark, d)
    export_typed(rows, _PO_MAP, path, S.NOW, "run_a")
    export_typed(rows.where("`Sent Date` LIKE '%/2023'"), _PO_MAP, path, S.NOW, "run_b")
    back = spark.read.schema("po_id string, total_amount decimal(18,2), run_id string, year string, month string").parquet(path)
    return back.groupBy("year", "month", "run_id").agg(
        F.count("*").alias("n"), F.count("po_id").alias("with_id"), F.sum("total_amount").cast("double").alias("total")
    )


def typed_rows(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-01, PRJ-06: the typed column map applied to bids."""
    return flat(typed_projection(S.bids(spark, d), TYPED_MAPS["bids"]))


def typed_table(spark: SparkSession, d: str) -> DataFrame:
    """SRC-15, SRC-19, SRC-20: a typed table written, registered and queried with SQL."""
    path = writers.write_typed(table(spark, d, "orders"), scratch_path(spark, "orders"))
    readers.load_table(spark, path, "typed_orders")
    return readers.query(spark, "SELECT o_orderstatus, count(*) AS n FROM typed_orders GROUP BY o_orderstatus")


def bronze_ingest(spark: SparkSession, d: str) -> DataFrame:
    """SRC-05, SRC-12, PRJ-02, WIN-06, AGG-06: vendors ingested twice; the repeat is skipped."""
    path, schema = _export(spark, d, "vendors")
    root = scratch_path(spark, "bronze")
    first = B.ingest_files(spark, path, "vendors", root, RUN)
    again = B.ingest_files(spark, path, "vendors", root, RUN)
    rows = readers.read_bronze(spark, root, "vendors")
    per_file = rows.groupBy("source_file").agg(F.max("source_row").alias("last"), F.count("*").alias("n"), F.count_distinct("source_row").alias("d"))
    numbered = per_file.agg(F.every((F.col("last") == F.col("n")) & (F.col("d") == F.col("n"))).alias("numbered"), F.sum("n").alias("rows"))
    both = first.select("row_count", F.lit(1).alias("turn"), "skipped").unionByName(again.select("row_count", F.lit(2).alias("turn"), "skipped"))
    totals = both.agg(
        F.sum(F.when(F.col("turn") == 1, F.col("row_count"))).alias("manifest_rows"),
        F.every((F.col("turn") == 1) | F.col("skipped")).alias("repeat_skipped"),
    )
    return side_by_side(numbered, totals)


def bronze_manifest_written(spark: SparkSession, d: str) -> DataFrame:
    """SRC-18, AUD-03, AUD-05: manifests and the batch summary of an ingestion, as they lie on disk."""
    path, schema = _export(spark, d, "vendors")
    root = scratch_path(spark, "bronze")
    done = B.ingest_files(spark, path, "vendors", root, RUN)
    batch = batch_summary(done.select("dataset", F.lit(True).alias("success"), "skipped"), "batch_1", RUN.event_time)
    written = writers.write_manifest(batch, f"{root}/_manifests/_batches")
    back = B.bronze_manifests(spark, root, "vendors")
    content = back.agg(
        F.sum("row_count").alias("row_count"), F.every(F.col("source_file_hash").rlike("^[0-9a-f]{64}$")).alias("hashed"),
        F.every(F.col("run_id").rlike("^bronze-[0-9a-f]{16}$")).alias("named"), F.count_distinct("ingested_at").alias("stamps"),
    )
    batches = spark.read.schema("run_id string, skipped bigint, failed bigint").json(written)
    return side_by_side(content, batches.select(F.col("run_id").alias("batch"), F.col("skipped").alias("batch_skipped"), F.col("failed").alias("batch_failed")))


def batch_ingest(spark: SparkSession, d: str) -> DataFrame:
    """SRC-18, AUD-05: two batches over three datasets, one of which can't be read; what their manifests say."""
    root = scratch_path(spark, "bronze")
    exports = [batches.Export(name, _export(spark, d, name)[0]) for name in ("vendors", "contracts")]
    exports.append(batches.Export("bids", exports[0].source))
    for hour, batch_id in enumerate(("batch_1", "batch_2")):
        run = B.IngestRun(event_time=RUN.event_time + dt.timedelta(hours=hour))
        batches.ingest_batch(spark, exports, root, run, batch_id).collect()
    ended = batches.batch_manifests(spark, root).select(F.col("run_id").alias("batch"), "successful", F.col("skipped").alias("batch_skipped"), "failed", F.explode("results").alias("r"))
    unfinished = F.lit(batches.unfinished_batches(spark, root).count()).cast("long").alias("unfinished")
    return ended.select(
        "batch", "successful", "batch_skipped", "failed", "r.dataset", "r.success", "r.skipped", (F.col("r.new_files") > 0).alias("landed"), "r.row_count", F.col("r.error").isNotNull().alias("explained"),
        unfinished,
    )


def bronze_recovery(spark: SparkSession, d: str) -> DataFrame:
    """SRC-12, PIPE-15: a content of which a third had landed on an earlier day is completed, once."""
    path, schema = _export(spark, d, "vendors")
    whole, root = scratch_path(spark, "bronze"), scratch_path(spark, "bronze")
    B.ingest_files(spark, path, "vendors", whole, RUN)
    part = readers.read_bronze(spark, whole, "vendors").where("source_row % 3 = 0").withColumn("ingest_date", F.lit("2024-01-18"))
    writers.write_bronze(part, root, "vendors")
    B.ingest_files(spark, path, "vendors", root, RUN)
    back = readers.read_bronze(spark, root, "vendors")
    return back.groupBy("State", "ingest_date").agg(F.count("*").alias("n"), F.count("Vendor ID").alias("with_id"))


def silver_rerun(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13, AUD-04: a snapshot built again after its manifest was lost has the same rows."""
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows = S.vendors(spark, d).withColumns({"ingest_date": F.lit("2024-01-19"), "sha256": F.col("source_file_hash")})
    writers.write_bronze(rows, root, "vendors")
    run = SilverRun("snapshot_a", S.ASOF, S.NOW)
    build_silver(spark, "vendors", root, silver, run, "v0.2.0")
    remove_path(spark, f"{silver}/_manifests")
    again = build_silver(spark, "vendors", root, silver, run, "v0.2.0")
    return again.select("dataset", "transform_version", "snapshot_id", "bronze_rows", "silver_rows", "filtered_rows", "filter_rate", "skipped")


def latest_over_files(spark: SparkSession, d: str) -> DataFrame:
    """PIPE-13: three files of one run with equal times and row numbers; which row wins does not depend on their order."""
    rows = S.vendors(spark, d).where("`Vendor ID` IS NOT NULL")
    parts = [
        rows.where(keep).withColumns({"source_file": F.lit(name), "source_row": F.lit(1).cast("long"), "Vendor Name": F.lit(name)})
        for name, keep in (("b.csv", "source_row % 2 = 0"), ("a.csv", "true"), ("c.csv", "source_row % 3 = 0"))
    ]
    tied = parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition(7)
    return newest_version(tied, "Vendor ID").select("Vendor ID", "Vendor Name", "row_hash")


def latest_content(spark: SparkSession, d: str) -> DataFrame:
    """SRC-06: two bronze contents, of which the newest is picked."""
    root = scratch_path(spark, "bronze")
    for day, keep in (("2024-01-19", "c_nationkey < 12"), ("2024-01-20", "c_nationkey >= 12")):
        rows = table(spark, d, "customer").where(keep).withColumns({"ingest_date": F.lit(day), "sha256": F.sha2(F.lit(day), 256)})
        writers.write_bronze(rows, root, "customer")
    newest = readers.latest_partition(readers.read_bronze(spark, root, "customer"))
    return newest.groupBy("ingest_date").agg(F.count("*").alias("n"), F.min("c_nationkey").cast("long").alias("lowest"))


def consolidated_bronze(spark: SparkSession, d: str) -> DataFrame:
    """PIPE-15, SRT-02, SRT-03: two overlapping exports consolidated and landed in date order."""
    schema = schema_for("purchase_orders")
    rows = S.purchase_orders(spark, d)
    base = scratch_path(spark, "po")
    for day, part in (("19", rows), ("20", rows.where("source_row % 2 = 0"))):
        writers.write_csv_ordered(part, f"{base}/raw/2024/01/{day}/run_{day}_a/files", schema.columns)
    exports = consolidation.read_exports(spark, f"{base}/raw/*/*/*/*/files", schema)
    allowances = _po_allowances(rows)
    root = scratch_path(spark, "bronze")
    B.ingest_consolidated(exports, allowances, "purchase_orders", root, RUN)
    landed = readers.read_bronze(spark, root, "purchase_orders")
    return landed.groupBy("PO #").agg(F.count("*").alias("n"))


def consolidated_order(spark: SparkSession, d: str) -> DataFrame:
    """PIPE-15, SRT-02, SRT-03: where every kept row of three overlapping exports lands, days by date and keys as a dictionary sorts them."""
    schema = schema_for("purchase_orders")
    rows = S.purchase_orders(spark, d)
    base = scratch_path(spark, "po")
    for day, part in (("18", "source_row % 4 = 0"), ("19", "source_row % 4 < 2"), ("20", "source_row % 5 <> 0")):
        # The number of a row in its file follows its number in the table.
        numbered = rows.where(part).repartitionByRange(4, "source_row").sortWithinPartitions("source_row")
        writers.write_csv_ordered(numbered, f"{base}/raw/2024/01/{day}/run_{day}_a/files", schema.columns)
    exports = consolidation.read_exports(spark, f"{base}/raw/*/*/*/*/files", schema)
    root = scratch_path(spark, "bronze")
    B.ingest_consolidated(exports, _po_allowances(rows), "purchase_orders", root, RUN)
    landed = readers.read_bronze(spark, root, "purchase_orders")
    return landed.select(F.col("source_row").alias("position"), F.col("PO #").alias("po"), F.col("Sent Date").alias("sent"), F.col("Total").alias("total"), F.col("Status").alias("status"))


def _po_allowances(rows: DataFrame) -> DataFrame:
    counted = rows.where("`PO #` LIKE '%SWC%'").groupBy("PO #").agg(F.count("*").alias(consolidation.COUNT))
    return counted.where(f"`{consolidation.COUNT}` > 1")


def silver_build(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13, SRC-18, JN-04, AUD-04, AUD-10: a silver snapshot built once; the repeat is skipped."""
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows = S.vendors(spark, d).withColumns({"ingest_date": F.lit("2024-01-19"), "sha256": F.col("source_file_hash")})
    writers.write_bronze(rows, root, "vendors")
    run = SilverRun("snapshot_a", S.ASOF, S.NOW)
    first = build_silver(spark, "vendors", root, silver, run, "v0.2.0")
    repeat = build_silver(spark, "vendors", root, silver, SilverRun("snapshot_b", S.ASOF, S.NOW), "v0.2.0")
    both = first.unionByName(repeat)
    return both.select("dataset", "transform_version", "snapshot_id", "bronze_rows", "silver_rows", "filtered_rows", "filter_rate", "skipped")


def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    """AGG-25: two silver snapshots of vendors, built from two exports, compared by key and row hash per state."""
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows = S.vendors(spark, d)
    changed = F.col("source_row") % 2 == 0
    exports = {
        "2024-01-18": rows.where("source_row % 3 <> 0"),
        "2024-01-19": rows.where("source_row % 3 <> 1").withColumns({"row_hash": F.when(changed, F.md5("row_hash")).otherwise(F.col("row_hash")), "State": F.when(changed, F.lit("OR")).otherwise(F.col("State"))}),
    }
    for day, export in exports.items():
        writers.write_bronze(export.withColumns({"ingest_date": F.lit(day), "sha256": F.lit(f"content-{day}")}), root, "vendors")
        build_silver(spark, "vendors", root, silver, SilverRun(f"snapshot_{day}", S.ASOF, S.NOW), "v0.3.0", bronze="latest")
    return compare_snapshots(spark, silver, "vendors", "v0.3.0", *[f"snapshot_{day}" for day in exports], ["vendor_id"], ["state"])


def _logs(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"), F.col("event_id").cast("string").alias("run_id"), "event_type"
    )
    return make_logs(events, F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"), F.col("event_type"), F.create_map(F.lit("k"), F.lit("v")))


def ndjson_events(spark: SparkSession, d: str) -> DataFrame:
    """SRC-17: log records as NDJSON per day, read back."""
    path = writers.append_ndjson(_logs(spark, d), scratch_path(spark, "logs"))
    back = spark.read.schema("timestamp string, severity string, body string, date string").json(path)
    return back.groupBy("date", "severity", "body").agg(F.count("*").alias("n"))


def stream_logs(spark: SparkSession, d: str) -> DataFrame:
    """STM-02: two arrivals of NDJSON logs counted incrementally per day and severity."""
    source, target, state = (scratch_path(spark, name) for name in ("logs", "counts", "state"))
    logs = _logs(spark, d)
    for part in ("severity = 'INFO'", "severity = 'ERROR'"):
        writers.append_ndjson(logs.where(part), source)
        stream_log_counts(spark, source, target, state).awaitTermination()
    return flat(current_log_counts(spark, target))


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """STM-01, JN-03: files ingested as they arrive; a repeated content adds nothing."""
    schema = schema_for("vendors")
    base, root, state = (scratch_path(spark, name) for name in ("raw", "bronze", "state"))
    rows = S.vendors(spark, d)
    for name, part in (("a", "State IS NULL"), ("b", "State IS NOT NULL"), ("c", "State IS NULL")):
        writers.write_csv_ordered(rows.where(part), f"{base}/{name}", schema.columns)
        stream_bronze(spark, base, "vendors", root, state, RUN).awaitTermination()
    back = readers.read_bronze(spark, root, "vendors")
    return back.groupBy("State").agg(F.count("*").alias("n"), F.count("Vendor ID").alias("with_id"))


def config_freshness(spark: SparkSession, d: str) -> DataFrame:
    """DQ-12: an allowance file written from the orders, checked for presence, size and age."""
    path = scratch_path(spark, "allowances")
    rows = _po_allowances(S.purchase_orders(spark, d))
    writers.write_csv_ordered(rows, path, ["PO #", consolidation.COUNT])
    listed = files.list_files(spark, path, "*.csv")
    fresh = files.config_freshness(listed, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), min_bytes=10)
    back = readers.read_csv_inferred(spark, path)
    extra = back.agg(F.sum(F.col(f"`{consolidation.COUNT}`") - 1).cast("long").alias("extra_rows"))
    return side_by_side(fresh.select("exists", "has_content", "is_recent", "needs_refresh"), extra)


def discovered_runs(spark: SparkSession, d: str) -> DataFrame:
    """SRC-04, SRC-07: files of the runs whose manifest reports success, counted per run."""
    base = scratch_path(spark, "runs")
    orders = table(spark, d, "orders")
    status = F.when(F.max("o_totalprice") > 0, F.when(F.col("o_orderpriority") < "3", "success").otherwise("error"))
    runs = orders.groupBy("o_orderpriority").agg(status.alias("status")).select(
        F.concat(F.lit("run_"), F.substring("o_orderpriority", 1, 1)).alias("run"),
        F.struct(F.struct(F.col("o_orderpriority").alias("dataset"), "status").alias("run")).alias("m"),
    )
    # One manifest per run: a handful, named the way the reader looks for them.
    for row in runs.select("run", F.to_json("m").alias("text")).collect():
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{row['run']}/manifest.json")
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        stream = system.create(folder)
        stream.write(bytearray(row["text"], "utf-8"))
        stream.close()
        part = orders.where(F.substring("o_orderpriority", 1, 1) == row["run"][-1])
        writers.write_csv_ordered(part, f"{base}/{row['run']}/files", ["o_orderkey", "o_orderpriority"])
    found = files.discover_files(files.list_files(spark, base, "*.csv"), readers.read_manifests(spark, base))
    named = found.select(files.plain_path(F.col("path")).alias("at"), "run_id")
    schema = FileSchema(("o_orderkey", "o_orderpriority"), "o_orderkey")
    counts = files.csv_record_counts(spark, f"{base}/*/files", schema).select(files.plain_path(F.col("path")).alias("at"), "records")
    return named.join(counts, "at").groupBy("run_id").agg(F.sum("records").alias("records"))


QUERIES = {
    "csv_roundtrip": csv_roundtrip, "csv_tolerant": csv_tolerant, "csv_inferred": csv_inferred, "file_inventory": file_inventory,
    "split_exports": split_exports, "content_hashes": content_hashes,
    "year_month_export": year_month_export, "typed_rows": typed_rows, "typed_table": typed_table, "bronze_ingest": bronze_ingest,
    "bronze_manifest_written": bronze_manifest_written, "bronze_recovery": bronze_recovery, "silver_rerun": silver_rerun,
    "latest_over_files": latest_over_files, "latest_content": latest_content, "consolidated_bronze": consolidated_bronze, "consolidated_order": consolidated_order, "silver_build": silver_build,
    "snapshot_changes": snapshot_changes, "batch_ingest": batch_ingest,
    "ndjson_events": ndjson_events, "stream_logs": stream_logs, "stream_ingest": stream_ingest,
    "config_freshness": config_freshness, "discovered_runs": discovered_runs,
}
_VENDOR = ", ".join(f'"{c}"' for c in schema_for("vendors").columns)
_OPENING = "try_strptime(\"Bid Opening Date\", '%m/%d/%Y %H:%M:%S')"


def _silver_build_sql(turns: str = "(VALUES (false), (true))") -> str:
    from silverline.reports.silver import SQL as SILVER

    return f"""
SELECT 'vendors' AS dataset, 'v0.2.0' AS transform_version, 'snapshot_a' AS snapshot_id, b AS bronze_rows, s AS silver_rows,
       b - s AS filtered_rows, round((b - s) / b * 100, 1) AS filter_rate, skipped
FROM (SELECT count(*) AS b FROM {S.VENDORS_SQL} v), (SELECT count(*) AS s FROM ({SILVER['vendors_v020']})), {turns} x(skipped)"""


SQL = {
    "csv_roundtrip": f"SELECT {_VENDOR}, count(*) AS n FROM {S.VENDORS_SQL} v GROUP BY ALL",
    "csv_tolerant": f"""
SELECT "Status", '20240119T000000.000Z_a' AS run, count(*) AS n, count(*) FILTER ("Awarded Vendor(s)" <> '') AS awarded FROM {S.BIDS_SQL} b GROUP BY 1""",
    "split_exports": """
SELECT CASE WHEN c_nationkey % 5 = 0 THEN 'b' ELSE 'a' END AS run, count(*) AS n, sum(length(c_name) + 1 + length(c_mktsegment))::BIGINT AS characters,
       sum(c_custkey)::BIGINT AS keys, (SELECT count(*) FROM customer) AS records, c_nationkey % 5 = 0 AS some_read_whole
FROM customer GROUP BY ALL""",
    "content_hashes": """
SELECT nation, way, sha256(content) AS sha256, strlen(content)::BIGINT AS source_file_bytes
FROM (SELECT c_nationkey::BIGINT AS nation, string_agg(concat_ws('|', c_custkey, c_name, c_mktsegment), chr(10) ORDER BY c_custkey) || chr(10) AS content
      FROM customer GROUP BY 1), (SELECT unnest(['memory', 'pieces']) AS way)""",
    "csv_inferred": """
SELECT count(*) AS n, sum(c_custkey)::BIGINT AS keys, sum(c_nationkey)::BIGINT AS nations,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, 'double' AS balance_type FROM customer""",
    "file_inventory": f"SELECT count(*) AS records, true AS sized, true AS whole, true AS checksums_ok FROM {S.CONTRACTS_SQL} c",
    "year_month_export": f"""
SELECT strftime(day, '%Y') AS year, strftime(day, '%m') AS month, CASE WHEN year(day) = 2023 THEN 'run_b' ELSE 'run_a' END AS run_id,
       count(*) AS n, count("PO #") AS with_id, CAST(sum(TRY_CAST(translate("Total", '$,', '') AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM (SELECT *, try_strptime("Sent Date", '%m/%d/%Y') AS day FROM {S.PO_SQL} p) GROUP BY ALL""",
    "typed_rows": f"""
SELECT "Bid Solicitation #" AS bid_id, "Organization Name" AS organization, nullif("Contract #", '') AS contract_id, "Buyer" AS buyer,
       "Description" AS description, strftime({_OPENING}, '%Y-%m-%d %H:%M:%S') AS bid_opening_date,
       "Bid Holder List" = '/bso/external/bidAckList.sdo' AS has_holder_list, nullif("Awarded Vendor(s)", '') AS awarded_vendors,
       "Status" AS status, nullif("Alternate Id", '') AS alternate_id FROM {S.BIDS_SQL} b""",
    "typed_table": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
    "bronze_ingest": f"SELECT true AS numbered, count(*) AS rows, count(*) AS manifest_rows, true AS repeat_skipped FROM {S.VENDORS_SQL} v",
    "bronze_manifest_written": f"""
SELECT count(*) AS row_count, true AS hashed, true AS named, 1::BIGINT AS stamps, 'batch_1' AS batch, 0::BIGINT AS batch_skipped,
       0::BIGINT AS batch_failed FROM {S.VENDORS_SQL} v""",
    "bronze_recovery": f"""SELECT "State", '2024-01-20' AS ingest_date, count(*) AS n, count("Vendor ID") AS with_id FROM {S.VENDORS_SQL} v GROUP BY 1""",
    "silver_rerun": _silver_build_sql("(VALUES (false))"),
    "latest_over_files": f"""
SELECT "Vendor ID", name AS "Vendor Name", row_hash
FROM {S.VENDORS_SQL} v JOIN (VALUES ('a.csv', 1), ('b.csv', 2), ('c.csv', 3)) f(name, step) ON source_row % step = 0
WHERE "Vendor ID" IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "Vendor ID" ORDER BY name DESC, row_hash DESC) = 1""",
    "latest_content": "SELECT '2024-01-20' AS ingest_date, count(*) AS n, min(c_nationkey)::BIGINT AS lowest FROM customer WHERE c_nationkey >= 12",
    "consolidated_bronze": f"""
SELECT "PO #", CASE WHEN contains("PO #", 'SWC') THEN count(*) ELSE 1 END AS n FROM {S.PO_SQL} p WHERE trim("PO #") <> '' GROUP BY 1""",
    "consolidated_order": f"""
WITH p AS (SELECT * FROM {S.PO_SQL} p WHERE trim("PO #") <> ''),
exports AS (SELECT 18 AS day, * FROM p WHERE source_row % 4 = 0 UNION ALL SELECT 19, * FROM p WHERE source_row % 4 < 2 UNION ALL SELECT 20, * FROM p WHERE source_row % 5 <> 0),
allowed AS (SELECT "PO #" AS k, count(*) AS n FROM p WHERE contains("PO #", 'SWC') GROUP BY 1),
kept AS (SELECT * FROM exports LEFT JOIN allowed ON k = "PO #" QUALIFY row_number() OVER (PARTITION BY "PO #" ORDER BY day DESC, source_row DESC) <= coalesce(n, 1))
SELECT row_number() OVER (ORDER BY CAST(try_strptime("Sent Date", '%m/%d/%Y') AS DATE) NULLS LAST, "PO #" COLLATE en, day, source_row) AS position,
       "PO #" AS po, "Sent Date" AS sent, "Total" AS total, "Status" AS status FROM kept""",
    "silver_build": _silver_build_sql(),
    "batch_ingest": f"""
SELECT batch, CASE WHEN batch = 'batch_1' THEN 2 ELSE 0 END::BIGINT AS successful, CASE WHEN batch = 'batch_1' THEN 0 ELSE 2 END::BIGINT AS batch_skipped, 1::BIGINT AS failed,
       dataset, n IS NOT NULL AS success, n IS NOT NULL AND batch = 'batch_2' AS skipped, n IS NOT NULL AND batch = 'batch_1' AS landed,
       CASE WHEN batch = 'batch_1' THEN coalesce(n, 0) ELSE 0 END::BIGINT AS row_count, n IS NULL AS explained, 0::BIGINT AS unfinished
FROM (SELECT unnest(['batch_1', 'batch_2']) AS batch),
     (SELECT 'vendors' AS dataset, count(*) AS n FROM {S.VENDORS_SQL} v UNION ALL SELECT 'contracts', count(*) FROM {S.CONTRACTS_SQL} c UNION ALL SELECT 'bids', NULL)""",
    "snapshot_changes": f"""
WITH v AS (SELECT * FROM {S.VENDORS_SQL} r WHERE "Vendor ID" IS NOT NULL),
then_ AS (SELECT "Vendor ID" AS k, "State" AS state, row_hash AS h FROM v WHERE source_row % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY "Vendor ID" ORDER BY source_row DESC) = 1),
now_ AS (SELECT "Vendor ID" AS k, CASE WHEN source_row % 2 = 0 THEN 'OR' ELSE "State" END AS state, CASE WHEN source_row % 2 = 0 THEN md5(row_hash) ELSE row_hash END AS h
         FROM v WHERE source_row % 3 <> 1 QUALIFY row_number() OVER (PARTITION BY "Vendor ID" ORDER BY source_row DESC) = 1)
SELECT CASE WHEN n.k IS NULL THEN t.state ELSE n.state END AS state, count(t.k) AS previous_rows, count(n.k) AS new_rows, count(*) FILTER (t.k IS NULL) AS added,
       count(*) FILTER (n.k IS NULL) AS removed, count(*) FILTER (t.h <> n.h) AS changed, count(*) FILTER (t.h = n.h) AS equal, count(n.k) - count(t.k) AS difference
FROM then_ t FULL JOIN now_ n ON t.k = n.k GROUP BY 1""",
    "ndjson_events": "SELECT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity, event_type AS body, count(*) AS n FROM events GROUP BY ALL",
    "stream_logs": "SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS kind, count(*) AS records FROM events GROUP BY ALL",
    "stream_ingest": f"""SELECT "State", count(*) AS n, count("Vendor ID") AS with_id FROM {S.VENDORS_SQL} v GROUP BY 1""",
    "config_freshness": f"""
SELECT true AS exists, true AS has_content, true AS is_recent, false AS needs_refresh, sum(n - 1)::BIGINT AS extra_rows
FROM (SELECT count(*) AS n FROM {S.PO_SQL} p WHERE contains("PO #", 'SWC') GROUP BY "PO #" HAVING count(*) > 1)""",
    "discovered_runs": "SELECT left(o_orderpriority, 1) AS run_id, count(*) AS records FROM orders WHERE o_orderpriority < '3' GROUP BY 1",
}
