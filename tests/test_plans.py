"""Bronze ingestion, consolidation, silver builds and the catalogue."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from silverline.plans import batch, bronze, consolidation
from silverline.plans.silver import CATALOGUE, SilverRun, find, sql_transform, version_key
from silverline.plans.silver_build import build_silver
from silverline.plans.typed_export import TYPED_MAPS, typed_projection
from silverline.session import scratch_path
from silverline.sources import readers
from silverline.sources.registry import schema_for

AT = dt.datetime(2025, 8, 24, 1, 2, 3)
RUN = bronze.IngestRun(event_time=AT)
SILVER = SilverRun("snap_1", AT.date(), AT)
PO = schema_for("purchase_orders")


def write(path, rows, schema=PO):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(schema.columns) + "\n")
        for row in rows:
            f.write(",".join('"' + v.replace('"', '""') + '"' if v else "" for v in row) + "\n")


def po(key, sent="08/01/2025", total="$1.00", note="d"):
    return (key, note, "Dell", "Org", "Dept", "Buyer", "3PS - Sent", sent, total)


def vendor(key, name):
    return (key, name, "", "", "", "", "", "775-555-0100")


def test_ingest_lands_every_content_once(spark, tmp_path):
    schema = schema_for("vendors")
    write(f"{tmp_path}/a.csv", [vendor("VEN1", "A"), vendor("VEN2", "B")], schema)
    write(f"{tmp_path}/copy.csv", [vendor("VEN1", "A"), vendor("VEN2", "B")], schema)
    root = scratch_path(spark, "bronze")
    first = {os.path.basename(r["source_file"]): r for r in bronze.ingest_files(spark, str(tmp_path), "vendors", root, RUN).collect()}
    assert not first["a.csv"]["skipped"] and first["copy.csv"]["skipped"]
    assert first["a.csv"]["row_count"] == 2 == first["a.csv"]["unique_rows"]
    write(f"{tmp_path}/b.csv", [vendor("VEN3", "C")], schema)
    second = bronze.ingest_files(spark, str(tmp_path), "vendors", root, RUN).collect()
    assert sum(not r["skipped"] for r in second) == 1
    rows = readers.read_bronze(spark, root, "vendors")
    assert sorted((r["Vendor ID"], r["source_row"]) for r in rows.collect()) == [("VEN1", 1), ("VEN2", 2), ("VEN3", 1)]
    row = rows.where("`Vendor ID` = 'VEN3'").first()
    assert row["source_file_bytes"] == os.path.getsize(f"{tmp_path}/b.csv") and row["sha256"] == row["source_file_hash"]
    assert row["bronze_run_id"].startswith("bronze-") and len(row["bronze_run_id"]) == 23


def test_row_hash_parity_mode_counts_keys(spark, tmp_path):
    write(f"{tmp_path}/a.csv", [vendor("VEN1", "A"), vendor("VEN1", "B")], schema_for("vendors"))
    run = bronze.IngestRun(event_time=AT, row_hash_mode="first_column")
    got = bronze.ingest_files(spark, str(tmp_path), "vendors", scratch_path(spark, "bronze"), run).first()
    assert (got["row_count"], got["unique_rows"]) == (2, 1)


@pytest.fixture()
def exports(spark, tmp_path):
    base = f"{tmp_path}/raw"
    write(f"{base}/2025/08/23/run_1_a/files/po_1.csv", [po("P1", total="$1.00"), po("P2"), po("P2", note="e"), po("", note="x"), po("P3", sent="")])
    write(f"{base}/2025/08/23/run_2_a/files/po_1.csv", [po("P1", total="$2.00")])
    write(f"{base}/2025/08/24/run_0_a/files/po_1.csv", [po("P1", total="$3.00"), po("P2", note="f", sent="07/01/2025"), po("P4", sent="1/2/2024")])
    return consolidation.read_exports(spark, f"{base}/*/*/*/*/files", PO)


def test_consolidation_keeps_the_newest(spark, exports):
    allowed = spark.createDataFrame([("P2", 2), ("P9", 3)], f"`PO #` string, `{consolidation.COUNT}` int")
    kept = consolidation.consolidate(exports, allowed)
    got = sorted((r["PO #"], r["Total"], r["Description"]) for r in kept.collect())
    assert got == [("P1", "$3.00", "d"), ("P2", "$1.00", "e"), ("P2", "$1.00", "f"), ("P3", "$1.00", "d"), ("P4", "$1.00", "d")]
    stats = consolidation.statistics(exports, allowed).first()
    assert (stats["total_rows"], stats["unique_keys"], stats["final_rows"], stats["rows_skipped"]) == (8, 4, 5, 3)
    assert stats["extra_rows_kept"] == 1 and stats["balanced"]


def test_consolidated_bronze_is_in_date_order_and_idempotent(spark, exports):
    allowed = spark.createDataFrame([("P2", 2)], f"`PO #` string, `{consolidation.COUNT}` int")
    root = scratch_path(spark, "bronze")
    first = bronze.ingest_consolidated(exports, allowed, "purchase_orders", root, RUN).first()
    again = bronze.ingest_consolidated(exports.repartition(7), allowed, "purchase_orders", root, RUN).first()
    assert not first["skipped"] and again["skipped"] and first["row_count"] == 5
    rows = readers.read_bronze(spark, root, "purchase_orders").orderBy("source_row").collect()
    assert [(r["source_row"], r["PO #"]) for r in rows] == [(1, "P4"), (2, "P2"), (3, "P1"), (4, "P2"), (5, "P3")]


def test_content_digest_ignores_row_order(spark):
    df = spark.createDataFrame([(str(i), None if i % 7 == 0 else "x") for i in range(100)], "a string, b string")
    digests = {bronze.content_digest(d, ["a", "b"]).first()["content_hash"] for d in (df, df.repartition(9), df.orderBy(F.desc("a")))}
    assert len(digests) == 1
    assert bronze.content_digest(df.limit(99), ["a", "b"]).first()["content_hash"] not in digests
    doubled = bronze.content_digest(df.unionAll(df), ["a", "b"]).first()["content_hash"]
    assert doubled not in digests


def test_silver_is_built_once_per_state(spark, tmp_path):
    schema = schema_for("vendors")
    write(f"{tmp_path}/a.csv", [vendor("VEN1", "Acme, LLC"), vendor("VEN2", "TEST")], schema)
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    bronze.ingest_files(spark, str(tmp_path), "vendors", root, RUN)
    first = build_silver(spark, "vendors", root, silver, SILVER, "v0.2.0", sort=True).first()
    assert (first["bronze_rows"], first["silver_rows"], first["filtered_rows"], first["filter_rate"]) == (2, 1, 1, 50.0)
    other = SilverRun("snap_2", AT.date(), AT)
    assert build_silver(spark, "vendors", root, silver, other, "v0.2.0").first()["skipped"]
    assert not build_silver(spark, "vendors", root, silver, other).first()["skipped"]
    write(f"{tmp_path}/b.csv", [vendor("VEN1", "Acme, Inc")], schema)
    later = bronze.IngestRun(event_time=AT + dt.timedelta(days=1))
    bronze.ingest_files(spark, str(tmp_path), "vendors", root, later)
    third = build_silver(spark, "vendors", root, silver, SilverRun("snap_3", AT.date(), AT), "v0.2.0").first()
    assert (third["bronze_rows"], third["silver_rows"], third["bronze_files"]) == (3, 1, 2)
    newest = build_silver(spark, "vendors", root, silver, SilverRun("snap_4", AT.date(), AT), "v0.3.0", bronze="latest").first()
    assert (newest["bronze_rows"], newest["silver_rows"]) == (1, 1)
    back = spark.read.parquet(f"{silver}/vendors").where("snapshot = 'snap_3'").first()
    assert back["vendor_type"] == "Corporation"


def test_catalogue_versions():
    assert find("purchase_orders").version == "v0.5.0" and find("bids").version == "v0.3.0"
    assert find("purchase_orders", variant="optimized").version == "v0.2.0"
    assert version_key("v0.10.0") > version_key("v0.2.0")
    assert len(CATALOGUE) == 14
    with pytest.raises(KeyError):
        find("purchase_orders", "v9.9.9")


def test_sql_transform_placeholders(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    sql = "select n, '{transform_version}' v, '{snapshot_id}' s from {bronze_table} where n > 1"
    assert [tuple(r) for r in sql_transform(df, sql, "v1.0.0", "snap-1").collect()] == [(2, "v1.0.0", "snap-1")]
    with pytest.raises(ValueError):
        sql_transform(df, sql, "v1'; --", "s")


def test_silver_types(spark):
    row = {**dict(zip(PO.columns, po("72DOW-NV18-6:2", "07/01/2024", "$1,000.00"))), "source_system": "s", "source_file": "f",
           "source_file_hash": "h", "source_file_bytes": 1, "source_row": 1, "ingested_at": AT, "bronze_run_id": "b", "row_hash": "r"}
    df = spark.createDataFrame([row], "`PO #` string, Description string, Vendor string, Organization string, Department string, Buyer string, "
                               "Status string, `Sent Date` string, Total string, source_system string, source_file string, source_file_hash string, "
                               "source_file_bytes bigint, source_row bigint, ingested_at timestamp, bronze_run_id string, row_hash string")
    out = find("purchase_orders", "v0.4.0")(df, SILVER)
    kinds = dict(out.dtypes)
    assert kinds["total_amount"] == "decimal(15,2)" and kinds["sent_date"] == "date" and kinds["revision_number"] == "smallint"
    assert kinds["fiscal_quarter"] == "tinyint" and kinds["bronze_ingested_at"] == "timestamp_ntz"
    got = out.first()
    assert (got["base_po_id"], got["revision_number"], got["fiscal_year"], got["fiscal_quarter"]) == ("72DOW-NV18-6", 2, 2025, 1)
    now = find("purchase_orders")(df, SILVER).first()
    assert (now["org_code"], now["po_fiscal_year"], now["fiscal_year"], now["instance_number"], now["total_instances"]) == ("72DOW", 2018, 2024, 1, 1)


def test_typed_projection_with_sql_expression(spark):
    from silverline.plans.typed_export import TypedColumn, TypedMap

    df = spark.createDataFrame([("a", "5")], "K string, N string")
    mapping = TypedMap((TypedColumn("K", "key", primary_key=True), TypedColumn("N", "twice", "int", "cast(N as int) * 2")))
    assert tuple(typed_projection(df, mapping, "r").first()) == ("a", 10, "r")
    assert mapping.primary_key == "key" and mapping.id_column == "K"
    assert TYPED_MAPS["vendors"].partition_by is None and TYPED_MAPS["bids"].primary_key == "bid_id"


def test_half_landed_content_is_completed(spark, tmp_path):
    schema = schema_for("vendors")
    write(f"{tmp_path}/raw/a.csv", [vendor(f"VEN{k}", "A") for k in range(10)], schema)
    whole, root = scratch_path(spark, "bronze"), scratch_path(spark, "bronze")
    bronze.ingest_files(spark, f"{tmp_path}/raw", "vendors", whole, RUN)
    part = readers.read_bronze(spark, whole, "vendors").where("source_row <= 3")
    for day in ("2025-08-20", RUN.ingest_date):
        part.withColumn("ingest_date", F.lit(day)).write.mode("append").partitionBy("ingest_date", "sha256").parquet(f"{root}/vendors")
    got = bronze.ingest_files(spark, f"{tmp_path}/raw", "vendors", root, RUN).first()
    assert not got["skipped"] and got["row_count"] == 10
    assert sorted(r["source_row"] for r in readers.read_bronze(spark, root, "vendors").collect()) == list(range(1, 11))
    assert bronze.ingest_files(spark, f"{tmp_path}/raw", "vendors", root, RUN).first()["skipped"]


def test_row_statistics_sort_no_rows(spark):
    schema = "sha256 string, row_hash string, source_row long, bronze_run_id string, ingested_at timestamp"
    later = AT + dt.timedelta(hours=1)
    rows = [("a", "h1", 1, "r2", AT), ("a", "h1", 2, "r1", later), ("a", None, 3, "r1", AT), ("b", "h1", 1, None, None), (None, "h2", 7, "r", AT)]
    stats = bronze.write_back_stats(spark.createDataFrame(rows, schema))
    got = {r["sha256"]: tuple(r)[1:] for r in stats.select("sha256", "row_count", "unique_rows", "last_row", "run_id", "min_ingest", "max_ingest").collect()}
    assert got == {"a": (3, 1, 3, "r1", AT, later), "b": (1, 1, 1, None, None, None), None: (1, 1, 7, "r", AT, AT)}
    plan = stats._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("row_hash" in line and "Sort" in line for line in plan)


def test_rows_with_holes_are_not_committed(spark, tmp_path):
    schema = schema_for("vendors")
    write(f"{tmp_path}/raw/a.csv", [vendor(f"VEN{k}", "A") for k in range(10)], schema)
    root = scratch_path(spark, "bronze")
    bronze.ingest_files(spark, f"{tmp_path}/raw", "vendors", root, RUN)
    rows = readers.read_bronze(spark, root, "vendors").where("source_row <> 4")
    other = scratch_path(spark, "bronze")
    rows.write.partitionBy("ingest_date", "sha256").parquet(f"{other}/vendors")
    contents = rows.select("sha256", "source_file", "source_file_bytes").distinct()
    with pytest.raises(RuntimeError):
        bronze.commit(spark, other, "vendors", contents, RUN)
    assert bronze.known_hashes(spark, other, "vendors").isEmpty()


def test_star_schema_dedupes_once(spark):
    from silverline.plans.silver import find
    from silverline.reports import shapes

    out = find("purchase_orders", "v0.2.0", "optimized")(shapes.purchase_orders(spark, "/root/testdata/sf0.001"), shapes.RUN)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "row_number" in line]


def export_of(tmp_path, dataset, rows, name="a", columns=None):
    schema = schema_for(columns or dataset)
    write(f"{tmp_path}/{dataset}/{name}.csv", rows, schema)
    return batch.Export(dataset, f"{tmp_path}/{dataset}")


def test_batch_commits_datasets_and_then_itself(spark, tmp_path):
    root = scratch_path(spark, "bronze")
    good = export_of(tmp_path, "vendors", [vendor("VEN1", "A"), vendor("VEN2", "B")])
    bad = export_of(tmp_path, "contracts", [vendor("VEN1", "A")], columns="vendors")
    got = {r["dataset"]: r for r in batch.ingest_batch(spark, [good, bad], root, RUN, "b1").collect()}
    assert (got["vendors"]["success"], got["vendors"]["skipped"], got["vendors"]["row_count"]) == (True, False, 2)
    assert not got["contracts"]["success"] and got["contracts"]["error"]
    written = batch.batch_manifests(spark, root).collect()
    assert [(r["run_id"], r["successful"], r["skipped"], r["failed"], len(r["results"])) for r in written] == [("b1", 1, 0, 1, 2)]
    assert batch.unfinished_batches(spark, root).isEmpty()
    later = bronze.IngestRun(event_time=AT + dt.timedelta(hours=1))
    assert [r["skipped"] for r in batch.ingest_batch(spark, [good], root, later, "b2").collect()] == [True]
    assert batch.batch_manifests(spark, root).count() == 1  # nothing happened, nothing is recorded


def test_batch_that_broke_off_is_found_and_run_again(spark, tmp_path, monkeypatch):
    root = scratch_path(spark, "bronze")
    exports = [export_of(tmp_path, "vendors", [vendor("VEN1", "A")]), export_of(tmp_path, "contracts", [("C1", "", "", "V", "", "$1", "O", "S", "01/01/2024", "01/02/2024")])]
    real = batch.ingest_files

    def breaks(spark_, source, dataset, *rest):
        if dataset == "contracts":
            raise KeyboardInterrupt
        return real(spark_, source, dataset, *rest)

    monkeypatch.setattr(batch, "ingest_files", breaks)
    with pytest.raises(KeyboardInterrupt):
        batch.ingest_batch(spark, exports, root, RUN, "b1")
    monkeypatch.setattr(batch, "ingest_files", real)
    assert [(r["run_id"], r["datasets"]) for r in batch.unfinished_batches(spark, root).collect()] == [("b1", ["vendors", "contracts"])]
    assert batch.batch_manifests(spark, root).isEmpty()
    again = batch.ingest_batch(spark, exports, root, RUN, "b1").collect()
    assert [(r["dataset"], r["skipped"], r["new_files"], r["row_count"]) for r in again] == [("vendors", False, 1, 1), ("contracts", False, 1, 1)]
    assert batch.unfinished_batches(spark, root).isEmpty() and batch.batch_manifests(spark, root).count() == 1
    assert readers.read_bronze(spark, root, "vendors").count() == 1


def test_files_land_in_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "GROUP_FILES", 2)
    for k in range(5):
        export_of(tmp_path, "vendors", [vendor(f"VEN{k}", "A")], name=f"f{k}")
    root = scratch_path(spark, "bronze")
    got = bronze.ingest_files(spark, f"{tmp_path}/vendors", "vendors", root, RUN).collect()
    assert len(got) == 5 and all(not r["skipped"] and r["row_count"] == 1 for r in got)
    assert readers.read_bronze(spark, root, "vendors").count() == 5


def test_stream_takes_a_bounded_number_of_files_and_repeats_batches_harmlessly(spark, tmp_path, monkeypatch):
    from silverline.streaming import ingest as streaming

    for k in range(10):
        export_of(tmp_path, "vendors", [vendor(f"VEN{k}", "A")], name=f"f{k}")
    root, state = scratch_path(spark, "bronze"), scratch_path(spark, "state")
    real, sizes, failed = streaming.ingest_files, [], set()

    def fails_once(spark_, paths, dataset, root_, run, glob):
        sizes.append(len(paths))
        real(spark_, paths, dataset, root_, run, glob)
        if run.code_version not in failed:
            failed.add(run.code_version)
            raise RuntimeError("after the batch was ingested")

    monkeypatch.setattr(streaming, "ingest_files", fails_once)
    for _ in range(6):
        query = streaming.stream_bronze(spark, f"{tmp_path}/vendors", "vendors", root, state, RUN, max_files=4)
        try:
            query.awaitTermination()
            break
        except Exception:
            continue
    assert sizes == [4, 4, 4, 4, 2, 2]
    rows = readers.read_bronze(spark, root, "vendors").collect()
    assert sorted(r["Vendor ID"] for r in rows) == [f"VEN{k}" for k in range(10)]
    names = spark.read.parquet(streaming.batch_names_path(root, "vendors"))
    assert {int(r["batch"]): r["n"] for r in names.groupBy("batch").agg(F.count("*").alias("n")).collect()} == {0: 4, 1: 4, 2: 2}
