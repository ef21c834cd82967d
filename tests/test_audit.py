"""Identifiers, manifests, events and streams."""

import datetime as dt
import hashlib
import json
import os

from pyspark.sql import functions as F

from silverline.audit import ids, lineage, manifests
from silverline.functions.numbers import percent
from silverline.session import scratch_path
from silverline.sources import writers
from silverline.streaming.ingest import current_log_counts, daily_log_counts, stream_log_counts

AT = dt.datetime(2025, 8, 23, 23, 48, 33, 261000)


def test_ids(spark):
    assert ids.snapshot_id(AT, "ac523c9a") == "snapshot_2025-08-23T23-48-33-261Z_ac523c9a"
    assert ids.run_id(AT, "9fd7d37") == "run_20250823T234833.261Z_9fd7d37"
    got = spark.range(1).select(ids.deterministic_run_id(F.lit("t"), F.lit("p"), F.lit("unknown"))).first()[0]
    assert got == "bronze-" + hashlib.sha256(b"tpunknown").hexdigest()[:16]


def test_state_hash_is_that_of_the_json_text(spark):
    paths = ["data/b.parquet", "data/a.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    text = json.dumps({"files": sorted(paths), "transform": "v0.5.0", "count": 2}, separators=(",", ":"))
    row = ids.state_hash(df, "v0.5.0").first()
    assert row["bronze_state_hash"] == hashlib.sha256(text.encode()).hexdigest() and row["bronze_files"] == 2
    assert ids.state_hash(df, "v0.4.0").first()[0] != row[0]
    state = ids.state_of(df, "v0.5.0").first()
    assert state == ids.state_digest(df.repartition(5), "v0.5.0", []).first() and state["bronze_files"] == 2


def test_state_digest_ignores_order_and_notices_changes(spark):
    df = spark.createDataFrame([("g", f"f{i}") for i in range(500)], "g string, path string")
    one = ids.state_digest(df, "v1", ["g"]).first()
    assert one["bronze_files"] == 500
    assert ids.state_digest(df.repartition(9), "v1", ["g"]).first() == one
    assert ids.state_digest(df.where("path <> 'f7'"), "v1", ["g"]).first()["bronze_state_hash"] != one["bronze_state_hash"]


def test_batch_summary(spark):
    schema = "dataset string, success boolean, skipped boolean"
    df = spark.createDataFrame([("a", True, False), ("b", True, True), ("c", False, None)], schema)
    row = manifests.batch_summary(df, "batch_1", AT).first()
    assert (row["datasets_processed"], row["successful"], row["skipped"], row["failed"]) == (3, 1, 1, 1)
    assert len(row["results"]) == 3 and row["timestamp"] == "2025-08-23T23:48:33.261Z"
    assert manifests.batch_summary(df.where("skipped"), "batch_2", AT).count() == 0
    rolled = manifests.status_rollup(df).first()
    assert rolled["success_rate"] == 66.67


def test_run_manifest(spark):
    runs = spark.createDataFrame(
        [("r1", "bids", "all", AT, AT + dt.timedelta(seconds=2), "success", None, None, None, None), ("r2", "bids", "x", AT, None, "error", "boom", "01/01/2024", None, None)],
        "run_id string, dataset string, label string, start_time timestamp, end_time timestamp, status string, error string, start_date string, end_date string, filter string",
    )
    files = spark.createDataFrame([("r1", "b.csv", 5, "csv", 3, False), ("r1", "a.html", 9, "blob", None, False)], "run_id string, name string, size_bytes bigint, kind string, records bigint, partial boolean")
    got = {r["run"]["id"]: r for r in manifests.run_manifest(runs, files).collect()}
    assert got["r1"]["run"]["duration_ms"] == 2000 and [f["name"] for f in got["r1"]["files"]] == ["a.html", "b.csv"]
    assert got["r2"]["files"] == [] and got["r2"]["run"]["duration_ms"] is None
    total = manifests.total_records(manifests.run_manifest(runs, files).select(F.col("run.id").alias("run_id"), "files"), ["run_id"])
    assert {r["run_id"]: r["total_records"] for r in total.collect()} == {"r1": 3, "r2": 0}


def test_consolidation_report(spark):
    stats = spark.createDataFrame([(96_985,)], "final_rows bigint")
    row = manifests.consolidation_report(stats, 97_000, AT).first()
    assert (row["difference"], row["percent_captured"], row["verdict"]) == (15, 99.98, "missing")
    assert spark.range(1).select(percent(F.lit(1), F.lit(0))).first()[0] is None


RUNS = (
    "dataset string, source_path string, output_path string, run_id string, event_time string, row_count bigint, byte_size bigint, "
    "file_hash string, duration_ms bigint, error_message string, error_stack string"
)


def test_lineage_events(spark):
    runs = spark.createDataFrame(
        [("bids", "/r/a.csv", "/b/a", "r1", "t", 5, 9, "h", 3, None, None), ("bids", "/r/b.csv", "/b/b", "r2", "t", 0, 9, "h", 3, "boom", "at x")], RUNS
    )
    start = lineage.start_events(runs).where("run.runId = 'r1'").first()
    assert start["eventType"] == "START" and start["job"]["name"] == "bronze.ingest.bids" and start["outputs"] == []
    assert json.loads(start["inputs"][0]["facets"]["dataSource"])["uri"] == "file:///r/a.csv"
    done = {r["run"]["runId"]: r for r in lineage.finish_events(runs).collect()}
    assert done["r1"]["eventType"] == "COMPLETE" and json.loads(done["r1"]["outputs"][0]["facets"]["storage"])["contentHash"] == "h"
    assert done["r2"]["eventType"] == "FAIL" and done["r2"]["outputs"] == []
    assert json.loads(done["r2"]["run"]["facets"]["errorMessage"])["message"] == "boom"
    sql = lineage.transform_events(runs, "select 1").first()
    assert json.loads(sql["job"]["facets"]["sql"])["query"] == "select 1"
    path = writers.append_ndjson(lineage.finish_events(runs).withColumn("date", F.lit("2025-08-23")), scratch_path(spark, "events"))
    back = spark.read.json(path)
    assert back.count() == 2 and "date=2025-08-23" in back.inputFiles()[0]


def test_validation_event(spark):
    results = spark.createDataFrame([("bids", "e1", "c", True), ("bids", "e2", None, False)], "dataset string, expectation_type string, column string, success boolean")
    runs = spark.createDataFrame([("bids", "/b", "r", "t", 4, 5)], "dataset string, bronze_path string, run_id string, event_time string, row_count bigint, byte_size bigint")
    event = lineage.validation_events(results, runs).first()
    checks = json.loads(event["run"]["facets"]["dataQuality"])["assertions"]
    assert [c["assertion"] for c in checks] == ["e1", "e2"]
    assert json.loads(event["inputs"][0]["facets"]["dataQualityMetrics"])["success"] is False


def test_log_and_error_records(spark):
    df = spark.createDataFrame([("2025-08-23T00:00:00.000Z", "r", None, "m")], "event_time string, run_id string, name string, message string")
    log = lineage.log_records(df, F.lit("WARN"), F.lit("x.y"), F.create_map(F.lit("k"), F.lit("v"))).first()
    assert (log["severity"], log["traceId"], log["date"], len(log["spanId"])) == ("WARN", "r", "2025-08-23", 16)
    err = lineage.error_records(df.withColumns({n: F.lit(None).cast("string") for n in ("stack", "stage", "selector")})).first()
    assert (err["name"], err["stage"], err["url"]) == ("Error", "unknown", None)


def log_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for day, severity in rows:
            f.write(json.dumps({"timestamp": f"{day}T05:00:00.000Z", "severity": severity, "body": "b", "attributes": {}, "traceId": None, "spanId": "s"}) + "\n")


def test_streamed_counts_equal_a_batch_count(spark, tmp_path):
    source, target, state = f"{tmp_path}/logs", scratch_path(spark, "counts"), scratch_path(spark, "state")
    arrivals = [[("2025-08-23", "INFO")] * 3 + [("2025-08-24", "ERROR")], [("2025-08-23", "INFO")], [("2025-08-20", "INFO"), ("2025-08-24", "ERROR")]]
    for i, rows in enumerate(arrivals):
        log_lines(f"{source}/{i}.ndjson", rows)
        stream_log_counts(spark, source, target, state).awaitTermination()
    got = sorted((str(r["day"]), r["kind"], r["records"]) for r in current_log_counts(spark, target).collect())
    assert got == [("2025-08-20", "INFO", 1), ("2025-08-23", "INFO", 4), ("2025-08-24", "ERROR", 2)]
    batch = daily_log_counts(spark.read.json(source))
    assert sorted((str(r["day"]), r["kind"], r["records"]) for r in batch.collect()) == got


def test_snapshot_changes_compare_rows_as_bags(spark):
    from silverline.audit.snapshots import change_summary, snapshot_changes

    schema = "k string, g string, row_hash string, `a.b` int"
    then = [("same", "x", "1", 0), ("twice", "x", "1", 0), ("twice", "x", "1", 0), ("gone", "y", "1", 0), ("moved", "x", "1", 0), (None, "x", "1", 0), ("more", "x", "1", 0)]
    now = [("same", "x", "1", 0), ("twice", "x", "1", 0), ("new", "y", "1", 0), ("moved", "y", "2", 0), (None, "x", "1", 0), ("more", "x", "1", 0), ("more", "x", "2", 0)]
    got = snapshot_changes(spark.createDataFrame(then, schema), spark.createDataFrame(now, schema), ["k"], ["g", "a.b"])
    assert {r["k"]: (r["g"], r["previous_rows"], r["new_rows"], r["status"]) for r in got.collect()} == {
        "same": ("x", 1, 1, "equal"), "twice": ("x", 2, 1, "changed"), "gone": ("y", 1, 0, "removed"), "moved": ("y", 1, 1, "changed"),
        None: ("x", 1, 1, "equal"), "new": ("y", 0, 1, "added"), "more": ("x", 1, 2, "changed"),
    }
    summary = change_summary(got, ["g"])
    assert {r["g"]: tuple(r[c] for c in ("previous_rows", "new_rows", "added", "removed", "changed", "equal", "difference")) for r in summary.collect()} == {
        "x": (5, 5, 0, 0, 2, 2, 0), "y": (2, 2, 1, 1, 1, 0, 0),
    }
    none = spark.createDataFrame([], schema)
    assert tuple(change_summary(snapshot_changes(none, none, ["k"])).first()) == (0, 0, 0, 0, 0, 0, 0)
