"""Readers, writers and file listings."""

import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from silverline.operators.positions import with_source_row
from silverline.session import scratch_path
from silverline.sources import files, readers, writers
from silverline.sources.registry import FileSchema, load_registry, schema_for

SCHEMA = FileSchema(("ID #", "Note", "Total"), "ID #")


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)
    return str(path)


def test_registry_csv_edge_cases(spark, tmp_path):
    text = '\ufeffID #,Note,Total\na,"say ""hi""\nthere","$1,000.00"\nb,,""\n\nc, x ,1\n'
    path = put(f"{tmp_path}/a.csv", text.encode(), "wb")
    got = sorted(tuple(r) for r in readers.read_csv_registry(spark, path, SCHEMA).collect())
    assert got == [("a", 'say "hi"\nthere', "$1,000.00"), ("b", None, None), ("c", " x ", "1")]


@pytest.mark.parametrize("header", ["ID #,Remark,Total", "ID #,Note", "Note,ID #,Total"])
def test_registry_csv_rejects_other_headers(spark, tmp_path, header):
    path = put(f"{tmp_path}/a.csv", f"{header}\na,b,c\n")
    with pytest.raises(Exception):
        readers.read_csv_registry(spark, path, SCHEMA).collect()


def test_registry_csv_fails_fast(spark, tmp_path):
    path = put(f"{tmp_path}/a.csv", "ID #,Note,Total\na,b\n")
    with pytest.raises(Exception):
        readers.read_csv_registry(spark, path, SCHEMA).collect()


def test_tolerant_csv(spark, tmp_path):
    path = put(f"{tmp_path}/a.csv", 'ID #,Note,Total\na,b\nc,d,e,f\n\ng,h "x" i,j\n')
    rows = readers.read_csv_tolerant(spark, path, SCHEMA).cache()
    got = {r["ID #"]: (r["Note"], r["Total"]) for r in rows.collect()}
    assert got == {"a": ("b", None), "c": ("d", "e"), "g": ('h "x" i', "j")}


def test_union_matches_by_position(spark, tmp_path):
    paths = [put(f"{tmp_path}/{n}.csv", f"{h}\n{n},1,2\n\n") for n, h in (("a", "ID #,Note,Total"), ("b", "Id,N,T"))]
    assert sorted(r["ID #"] for r in readers.union_csv_files(spark, paths, SCHEMA).collect()) == ["a", "b"]


def test_csv_write_keeps_text_and_order(spark, tmp_path):
    rows = [("a", ' lead,"q" ', None), ("b", "line\nbreak", "x")]
    df = spark.createDataFrame(rows, "`ID #` string, Note string, Total string").coalesce(1)
    writers.write_csv_ordered(df.select("Total", "Note", "ID #"), f"{tmp_path}/o", SCHEMA.columns)
    assert [tuple(r) for r in readers.read_csv_registry(spark, f"{tmp_path}/o", SCHEMA).collect()] == rows


def test_path_fields(spark):
    paths = ["/d/raw/2025/08/23/run_20250823T1.000Z_abc/files/po_1.csv", "C:\\raw\\2025\\08\\24\\x.csv", "/nothing/y.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    fields = readers.path_fields(F.col("p"), F.lit(dt.date(2020, 1, 1)))
    got = [tuple(r) for r in df.select(*fields.values()).collect()]
    assert got == [
        (dt.date(2025, 8, 23), "20250823T1.000Z_abc", "po_1.csv"),
        (dt.date(2025, 8, 24), "unknown", "x.csv"),
        (dt.date(2020, 1, 1), "unknown", "y.csv"),
    ]


def manifest(dataset, status, **extra):
    return json.dumps({"run": {"id": "r", "dataset": dataset, "status": status}, "output": {"files": []}, **extra}, indent=1)


def test_discovery_skips_failed_runs_and_bad_manifests(spark, tmp_path):
    base = f"{tmp_path}/raw/2025/08/23"
    for run, status in (("run_1", "success"), ("run_2", "error"), ("run_3", "success")):
        put(f"{base}/{run}/manifest.json", manifest("bids", status))
        folder = "downloads" if run == "run_3" else "files"
        put(f"{base}/{run}/{folder}/bids.csv", "x\n")
    put(f"{base}/run_4/manifest.json", "{not json")
    put(f"{base}/run_4/files/bids.csv", "x\n")
    manifests = readers.read_manifests(spark, str(tmp_path))
    assert sorted(r["run"]["status"] for r in manifests.collect()) == ["error", "success", "success"]
    found = files.discover_files(files.list_files(spark, str(tmp_path), "*.csv"), manifests)
    assert [r["run_id"] for r in found.collect()] == ["1"]


def test_hashes_inventory_and_checksums(spark, tmp_path):
    csv, blob = "ID #,Note,Total\na,b,c\nd,e,f\n", "<html>"
    put(f"{tmp_path}/files/a.csv", csv)
    put(f"{tmp_path}/files/b.html", blob)
    put(f"{tmp_path}/checksums.sha256", "old")
    hashes = files.content_hashes(spark, str(tmp_path))
    lines = [r["line"] for r in files.checksum_lines(hashes, str(tmp_path)).collect()]
    want = [f"{hashlib.sha256(t.encode()).hexdigest()}  files/{n}" for n, t in (("a.csv", csv), ("b.html", blob))]
    assert lines == sorted(want)
    listed = files.list_files(spark, f"{tmp_path}/files")
    counts = files.csv_record_counts(spark, f"{tmp_path}/files/a.csv", SCHEMA)
    got = {r["name"]: (r["size_bytes"], r["kind"], r["records"], r["partial"]) for r in files.file_inventory(listed, counts, "failed").collect()}
    assert got == {"a.csv": (len(csv), "csv", 2, True), "b.html": (6, "blob", None, True)}


def test_config_freshness(spark, tmp_path):
    path = put(f"{tmp_path}/dup.csv", "x" * 150)
    modified = dt.datetime.fromtimestamp(os.path.getmtime(path), dt.timezone.utc).replace(tzinfo=None)

    def check(at, glob="dup.csv"):
        return files.config_freshness(files.list_files(spark, str(tmp_path), glob), at).first()

    assert not check(modified + dt.timedelta(days=29))["needs_refresh"]
    assert check(modified + dt.timedelta(days=32))["needs_refresh"]
    absent = check(modified, "none.csv")
    assert absent["needs_refresh"] and not absent["exists"]
    put(f"{tmp_path}/small.csv", "x")
    assert check(modified, "small.csv")["has_content"] is False


def test_source_row_counts_within_each_file(spark, tmp_path):
    """Blocks much smaller than the files, several files of different sizes."""
    for name, n in (("a", 500), ("b", 3), ("c", 120)):
        put(f"{tmp_path}/{name}.csv", "ID #,Note,Total\n" + "".join(f"{name}{i},n,{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        rows = readers.read_csv_registry(spark, str(tmp_path), SCHEMA, multiline=False)
        assert rows.rdd.getNumPartitions() > 4
        got = with_source_row(rows).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 623 and all(int(r["Total"]) == r["source_row"] for r in got)


def test_rows_of_a_block_stay_where_they_were_read(spark, tmp_path):
    """Numbering sends counts round, not rows: a file of one block is not gathered in one task."""
    put(f"{tmp_path}/a.csv", "ID #,Note,Total\n" + "".join(f"a{i},n,{i}\n" for i in range(1, 50)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = with_source_row(readers.read_csv_registry(spark, str(tmp_path), SCHEMA, multiline=False))
        assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["source_row"] for r in numbered.collect()) == list(range(1, 50))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_year_month_overwrites_only_its_months(spark):
    path = scratch_path(spark, "ym")
    df = spark.createDataFrame([("a", dt.date(2024, 1, 5)), ("b", dt.date(2024, 2, 5))], "id string, d date")
    writers.write_year_month(df, path, "d")
    writers.write_year_month(spark.createDataFrame([("c", dt.date(2024, 2, 9))], "id string, d date"), path, "d")
    back = spark.read.schema("id string, year string, month string").parquet(path)
    assert sorted(tuple(r) for r in back.collect()) == [("a", "2024", "01"), ("c", "2024", "02")]


def test_latest_partition_prunes(spark):
    root = scratch_path(spark, "bronze")
    for day, sha, n in (("2025-08-23", "ff", 3), ("2025-08-24", "aa", 2), ("2025-08-24", "bb", 1)):
        df = spark.range(n).withColumns({"ingest_date": F.lit(day), "sha256": F.lit(sha)})
        writers.write_bronze(df, root, "x")
    newest = readers.latest_partition(readers.read_bronze(spark, root, "x"))
    assert newest.count() == 1 and newest.first()["sha256"] == "bb"
    assert "PartitionFilters: [isnotnull" in newest._jdf.queryExecution().executedPlan().toString()


def test_load_table_and_describe(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([("2024", "01"), ("2024", "02"), (None, "03")], "year string, month string").write.parquet(path)
    assert tuple(readers.load_table(spark, path, "loaded").first()) == (3, 1, 2)
    assert [r["column_name"] for r in readers.describe(readers.query(spark, "select * from loaded")).collect()] == ["year", "month"]


def test_registry_file(spark, tmp_path):
    entry = {"columns": {"ID #": "VARCHAR", "N": "VARCHAR"}, "csv_options": {"header": True, "delimiter": ";"}}
    path = put(f"{tmp_path}/r.json", json.dumps({"schemas": {"x": {"v1": entry}}}, indent=2))
    registry = load_registry(spark, path)
    schema = schema_for("x", "v1", registry)
    data = put(f"{tmp_path}/d.csv", "ID #;N\n1;2\n")
    assert tuple(readers.read_csv_registry(spark, data, schema).first()) == ("1", "2")
    with pytest.raises(KeyError):
        schema_for("x", "v2", registry)


def test_large_files_are_split_without_line_breaks(spark, tmp_path):
    with open(f"{tmp_path}/big.csv", "w") as f:
        f.write("ID #,Name\n" + "".join(f"{k},name {k}\n" for k in range(40_000)))
    schema = FileSchema(("ID #", "Name"), "ID #", multiline=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        rows = readers.read_csv_registry(spark, str(tmp_path), schema)
        assert rows.rdd.getNumPartitions() > 3 and rows.count() == 40_000
        assert files.csv_record_counts(spark, str(tmp_path), schema).first()["records"] == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    """Several files in small blocks; one has line breaks inside quotes, one a blank line of spaces, one a space in its name."""
    head = "ID #,Note,Total\n"
    put(f"{tmp_path}/plain.csv", head + "".join(f'p{k},"say ""{k}""",{k}\n' for k in range(3000)))
    put(f"{tmp_path}/with space.csv", (head + "".join(f"s{k},n,{k}\n" for k in range(500))).replace("\n", "\r\n").encode(), "wb")
    put(f"{tmp_path}/broken.csv", head + "".join(f'b{k},"line\n{k}",{k}\n' for k in range(700)))
    put(f"{tmp_path}/none.csv", head)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert [os.path.basename(path) for path in readers.unsplittable_files(spark, str(tmp_path))] == ["broken.csv"]
        rows = readers.read_csv_registry(spark, str(tmp_path), SCHEMA)
        whole = readers.read_csv_registry(spark, str(tmp_path), SCHEMA, multiline=True)
        assert whole.rdd.getNumPartitions() <= 4 < rows.rdd.getNumPartitions()
        got = sorted(tuple(r) for r in rows.collect())
        assert got == sorted(tuple(r) for r in whole.collect()) and len(got) == 4200
        counts = {os.path.basename(r["path"]): r["records"] for r in files.csv_record_counts(spark, str(tmp_path), SCHEMA).collect()}
        assert counts == {"plain.csv": 3000, "with%20space.csv": 500, "broken.csv": 700}
        numbered = readers.read_each(spark, str(tmp_path), SCHEMA, None, lambda part, multi: with_source_row(readers.read_csv_tolerant(spark, part, SCHEMA, multi)))
        assert all(int(r["Total"]) == r["source_row"] - 1 for r in numbered.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(("text", "kept"), [("a,b,c\n  \nd,e,f\n", True), ("a,b,c\rd,e,f\n", True), ('a,"x"" y",c\n', False), ('a,5" x,c\n', True), ("", False)])
def test_lines_that_readers_take_differently(spark, tmp_path, text, kept):
    path = put(f"{tmp_path}/a.csv", "ID #,Note,Total\n" + text)
    assert bool(readers.unsplittable_files(spark, path)) is kept


def test_registry_file_says_multiline(spark, tmp_path):
    entries = {"v1": {"columns": ["a"]}, "v2": {"columns": ["a"], "multiline": False}, "v3": {"columns": ["a"], "multiline": True}}
    path = put(f"{tmp_path}/r.json", json.dumps({"schemas": {"x": entries}}))
    registry = load_registry(spark, path)
    assert [schema_for("x", version, registry).multiline for version in entries] == [None, False, True]


def test_hashes_in_pieces_equal_hashes_in_memory(spark, tmp_path):
    for name, size in (("a", 1), ("b b", 10), ("c", 3_000_000)):
        put(f"{tmp_path}/{name}.bin", os.urandom(size), "wb")
    want = {name: (hashlib.sha256(data).hexdigest(), len(data)) for name in os.listdir(tmp_path) for data in [open(f"{tmp_path}/{name}", "rb").read()]}
    for whole_bytes in (0, 10, 1 << 30):
        rows = files.content_hashes(spark, str(tmp_path), whole_bytes=whole_bytes).collect()
        assert {os.path.basename(r["path"]): (r["sha256"], r["source_file_bytes"]) for r in rows} == want
        assert all(r["modificationTime"] is not None for r in rows)


def test_hash_of_a_file_beyond_two_gibibytes(spark, tmp_path):
    with open(f"{tmp_path}/large.bin", "wb") as f:
        f.write(b"begin")
        f.truncate((2 << 30) + 12_345)
    digest = hashlib.sha256()
    with open(f"{tmp_path}/large.bin", "rb") as f:
        while piece := f.read(1 << 24):
            digest.update(piece)
    row = files.content_hashes(spark, str(tmp_path)).first()
    assert (row["sha256"], row["source_file_bytes"]) == (digest.hexdigest(), (2 << 30) + 12_345)
