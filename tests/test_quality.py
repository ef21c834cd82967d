"""Expectations, metrics, profiling and key discovery."""

import datetime as dt
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.quality import expectations as Q
from silverline.quality import keys, profiling

SUITE = Q.Suite("t", ("k", "a", "b"), ("k",), {"b": 1.0, "a": 0.0}, not_null=("k", "a"))
META = "k string, a string, b string, row_hash string, source_file_hash string, source_file_bytes bigint, ingested_at timestamp"
NOW = dt.datetime(2025, 8, 24, 12)


def table(spark, rows):
    at = dt.datetime(2025, 8, 23, 12)
    return spark.createDataFrame([(*r, f"h{i}", "s", 10, at) for i, r in enumerate(rows)], META)


def results(spark, rows, duplicates=0, suite=SUITE):
    got = Q.expectations(Q.measure(table(spark, rows), suite), suite, duplicates)
    return {(r["expectation_type"], r["column"]): r for r in got.collect()}


def test_all_pass(spark):
    got = results(spark, [("1", "x", None), ("2", "y", None)])
    assert len(got) == 7 and all(r["success"] for r in got.values())
    assert got[(Q.NOT_NULL, "b")]["unexpected_percent"] == 100.0
    assert '"mostly": 0.0' in got[(Q.NOT_NULL, "b")]["kwargs"]


def test_zero_limit_is_honoured(spark):
    assert not results(spark, [("1", None, "z"), ("2", "y", "z")])[(Q.NOT_NULL, "a")]["success"]


def test_expected_duplicates(spark):
    rows = [("1", "x", "b"), ("1", "x", "b"), (None, "x", "b"), (None, "x", "b")]
    got = results(spark, rows, 2)
    assert got[(Q.KEY_UNIQUE, None)]["success"] and got[(Q.KEY_UNIQUE, None)]["observed_value"] == 2.0
    assert results(spark, rows, 0)[(Q.KEY_UNIQUE, None)]["unexpected_count"] == 2
    assert not got[(Q.ROW_HASH_UNIQUE, None)]["success"]


def test_empty_table_fails_and_is_critical(spark):
    df = table(spark, [("1", "x", "b")]).limit(0)
    got = Q.expectations(Q.measure(df, SUITE), SUITE)
    assert not any(r["success"] for r in got.collect() if r["expectation_type"] in (Q.NOT_NULL, Q.ROW_COUNT))
    status = Q.severity(got).first()
    assert (status["status"], status["exit_code"]) == ("failed", 2)


def test_severity_levels(spark):
    warn = Q.expectations(Q.measure(table(spark, [("1", None, "b"), ("2", "y", "b")]), SUITE), SUITE)
    assert Q.severity(warn).first()["status"] == "warning" and Q.severity(warn).first()["exit_code"] == 0
    assert Q.severity(warn, warning_code=1).first()["exit_code"] == 1
    assert Q.worst(Q.severity(warn), unreadable=1).first()[0] == 3
    assert [r["type"] for r in Q.failed_checks(warn).collect()] == ["column_values_to_not_be_null"]


def test_compound_keys_and_blank_policy(spark):
    suite = Q.Suite("t", ("k", "a"), ("k", "a"), null_policy="blank")
    got = results(spark, [("1", " ", "b"), ("1", "x", "b"), ("1", "x", "b")], 1, suite)
    assert got[(Q.KEY_UNIQUE, None)]["success"] and got[(Q.NOT_NULL, "a")]["unexpected_count"] == 1


def test_metrics_and_service_levels(spark):
    stats = Q.measure(table(spark, [("1", "x", None), ("2", None, None)]), SUITE)
    assert Q.volume_metrics(stats).first()["bytes_avg"] == 10.0
    assert Q.freshness_metrics(stats, NOW).first()["age_hours"] == 24.0
    levels = {r["measure"]: r for r in Q.service_levels(stats, SUITE, NOW).collect()}
    assert levels["completeness"]["value"] == 0.75 and not levels["completeness"]["target_met"]
    assert levels["freshness_hours"]["target_met"] and levels["uniqueness"]["state"] == "ok"
    outcome = Q.validation_outcome(Q.expectations(stats, SUITE), stats, SUITE, NOW).first()
    assert outcome["status"] == "warning" and len(outcome["warnings"]) == 1 and outcome["failures"] == []
    assert outcome["volume"]["row_count"] == 2 and outcome["freshness"]["age_hours"] == 24.0


def types(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return {r["column"]: r for r in profiling.exact_types(df).collect()}


def test_exact_types_of_text_columns(spark):
    rows = [
        (f"P{i}", "Open" if i % 2 else "Done", f"${i}.{'505' if i == 3 else '50'}", "08/01/2025 10:00:00", "8/1/2025" if i else "bad", None, "x" * (i + 1))
        for i in range(6)
    ]
    schema = "`PO #` string, Status string, Total string, `Bid Opening Date` string, `Sent Date` string, `Postal Code` string, Note string"
    got = types(spark, rows, schema)
    assert got["PO #"]["exact_type"] == "VARCHAR(12) PRIMARY KEY"
    assert got["Status"]["exact_type"] == "VARCHAR(9) CHECK (\"Status\" IN ('Done', 'Open')) NOT NULL"
    assert got["Total"]["exact_type"] == "DECIMAL(8,4) NOT NULL"
    assert got["Bid Opening Date"]["exact_type"] == "TIMESTAMP NOT NULL"
    assert got["Sent Date"]["exact_type"] == "VARCHAR(8) NOT NULL"
    assert got["Postal Code"]["exact_type"] == "VARCHAR(10)" and got["Postal Code"]["nullable"] and got["Postal Code"]["cardinality"] == "0.00%"
    assert got["Note"]["exact_type"] == "VARCHAR(14) NOT NULL" and got["Note"]["cardinality"] == "100.00%"


def test_exact_types_low_cardinality_and_width(spark):
    rows = [("a" if i % 2 else None, "w" * 70, "t" * 300, f"d{i}") for i in range(120)]
    got = types(spark, rows, "Kind string, Wide string, Long string, Many string")
    assert got["Kind"]["exact_type"] == "VARCHAR(11) CHECK (\"Kind\" IN ('a'))" and got["Kind"]["nullable"]
    assert got["Wide"]["exact_type"].startswith("VARCHAR(80) CHECK") and got["Long"]["exact_type"] == "VARCHAR(310) CHECK (\"Long\" IN ('" + "t" * 300 + "')) NOT NULL"
    assert got["Many"]["exact_type"] == "VARCHAR(12) NOT NULL"


@pytest.mark.parametrize(
    "low,high,want",
    [(0, 255, "UTINYINT"), (-1, 127, "TINYINT"), (0, 256, "USMALLINT"), (-129, 5, "SMALLINT"), (0, 70000, "UINTEGER"), (-70000, 1, "INTEGER"), (0, 2**40, "BIGINT")],
)
def test_exact_types_of_integers(spark, low, high, want):
    assert types(spark, [(low,), (high,)], "n bigint")["n"]["exact_type"] == f"{want} NOT NULL"


def test_profile_skips_metadata(spark):
    df = table(spark, [("1", "x", None)]).withColumns({"row_hash_1": F.lit("z"), "sha256": F.lit("s")})
    assert profiling.business_columns(df) == ["k", "a", "b"]


def test_column_profile_treats_blank_as_missing(spark):
    df = spark.createDataFrame([(" ",), ("",), (None,), ("b",), ("a",), ("c",), ("d",), ("a",)], "x string")
    row = profiling.column_profile(df).first()
    assert (row["null_count"], row["unique_values"], row["sample_values"], row["null_percent"]) == (3, 4, ["a", "b", "c"], 37.5)


def test_domains_leave_long_columns_out(spark):
    df = spark.createDataFrame([(f"v{i}", "ab"[i % 2]) for i in range(30)], "many string, few string")
    assert [(r["column"], r["domain"]) for r in profiling.domains(df, ["many", "few"]).collect()] == [("few", ["a", "b"])]


@pytest.fixture(scope="module")
def wide(spark):
    # id is a key; code determines name; other columns are free.
    rows = [(i, f"c{i % 7}", f"n{i % 7}", "x" if i % 3 else None, str(i % 5)) for i in range(200)]
    return spark.createDataFrame(rows, "id int, code string, name string, flag string, part string")


def test_combination_counts_match_brute_force(wide):
    got = {r["columns"]: (r["unique_count"], r["source"]) for r in keys.combination_counts(wide).collect()}
    pdf = wide.toPandas().fillna("")
    for size in range(1, 6):
        for combo in combinations(wide.columns, size):
            assert got[" + ".join(combo)][0] == len(pdf[list(combo)].drop_duplicates())
    assert len(got) == 31
    assert got["id + code"][1] == "implied" and got["code + name + part"][1] == "implied" and got["code + part"][1] == "counted"


def test_matches_and_rankings(spark, wide):
    counts = keys.combination_counts(wide.select("id", "code", "name"))
    assert {r["columns"] for r in keys.matches(counts).collect()} == {"id", "id + code", "id + name", "id + code + name"}
    assert {(r["columns"], r["diff"]) for r in keys.matches(counts, 10).collect()} == {("code", -3), ("name", -3), ("code + name", -3)}
    assert [tuple(r) for r in keys.common_counts(counts).collect()] == [(200, 4), (7, 3)]
    assert keys.closest(counts, 150, 1).first()["columns"] == "id"


def test_a_largest_size_admits_any_number_of_columns(spark):
    rows = [tuple((r * (c + 1)) % (c + 2) for c in range(13)) for r in range(40)]
    wide = spark.createDataFrame(rows, [f"c{i}" for i in range(13)])
    got = {r["columns"]: r["unique_count"] for r in keys.combination_counts(wide, max_size=2).collect()}
    combos = [combo for size in (1, 2) for combo in combinations(range(13), size)]
    assert got == {" + ".join(f"c{i}" for i in combo): len({tuple(row[i] for i in combo) for row in rows}) for combo in combos}


@pytest.fixture(scope="module")
def sharp(spark):
    # Pairs nearly identify a row, no single column does; one value holds a third of a column.
    rng = random.Random(4)
    rows = [(rng.randrange(60), rng.randrange(70), rng.choice(["hot", "a", "b"]), rng.randrange(2), rng.random() < 0.5, None if i % 9 else i) for i in range(600)]
    return spark.createDataFrame(rows + rows[:3], "a int, b int, c string, d int, e boolean, f int").repartition(3)


def brute_counts(df):
    rows = [tuple("" if v is None else str(v) for v in row) for row in df.collect()]
    every = [combo for size in range(1, len(df.columns) + 1) for combo in combinations(range(len(df.columns)), size)]
    return {" + ".join(df.columns[i] for i in combo): len({tuple(row[i] for i in combo) for row in rows}) for combo in every}, len(rows)


@pytest.mark.parametrize("share", [0.0, 0.25, 1.0])
def test_counts_on_unsettled_rows_are_exact(sharp, monkeypatch, share):
    monkeypatch.setattr(keys, "UNSETTLED_SHARE", share)
    want, total = brute_counts(sharp)
    got = keys.combination_counts(sharp).collect()
    assert {r["columns"]: r["unique_count"] for r in got} == want and {r["total_rows"] for r in got} == {total}


@pytest.mark.parametrize("large", [0, 20])
def test_counts_without_and_with_some_pivots(sharp, monkeypatch, large):
    """Columns with large classes deal no rows; the counts stay exact."""
    monkeypatch.setattr(keys, "LARGE_CLASS", large)
    want, _ = brute_counts(sharp)
    assert {r["columns"]: r["unique_count"] for r in keys.combination_counts(sharp, max_size=3).collect()} == {c: n for c, n in want.items() if c.count("+") < 3}


def test_rows_are_dealt_once_a_column_for_all_combinations(sharp, monkeypatch):
    """However many combinations there are, each column deals the rows once, and no level of them is counted by itself."""
    dealt, whole = [], []
    parts, exact = keys._Hashed.parts, keys._exact
    monkeypatch.setattr(keys._Hashed, "parts", lambda hashed, cells: dealt.append(cells // hashed.total) or parts(hashed, cells))
    monkeypatch.setattr(keys, "_exact", lambda hashed, unsettled, combos: whole.extend(combos) or exact(hashed, unsettled, combos))
    want, _ = brute_counts(sharp)
    assert {r["columns"]: r["unique_count"] for r in keys.combination_counts(sharp).collect()} == want
    assert sorted(dealt) == [1, 2, 3, 4, 5, 6] and not whole
    row = keys._along(keys._Hashed(sharp, sharp.columns), sharp.columns, 6)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(v0#", row) and not re.search(r"hashpartitioning\(p#", row)


def test_columns_with_large_classes_are_counted_on_their_distinct_rows(spark, monkeypatch):
    monkeypatch.setattr(keys, "LARGE_CLASS", 120)
    totals = []
    known = keys._Hashed.__init__
    monkeypatch.setattr(keys._Hashed, "__init__", lambda hashed, df, names: known(hashed, df, names) or totals.append(hashed.total))
    rows = spark.range(4000).selectExpr("id % 7 AS a", "id", "cast(id % 5 AS string) AS b", "id % 3 AS c")
    want, _ = brute_counts(rows)
    assert {r["columns"]: r["unique_count"] for r in keys.combination_counts(rows).collect()} == want
    assert totals == [4000, 105]


def test_odd_values_are_told_apart_as_grouping_tells_them(spark):
    values = [0.0, -0.0, float("nan"), None, 1.5]
    rows = [(values[i % 5], ["", "a", "A "][i % 3], [None, 0, 1][i * i % 3], dt.date(2025, 1, 1 + i % 4)) for i in range(90)]
    odd = spark.createDataFrame(rows, "x double, t string, k int, d date")
    for r in keys.combination_counts(odd).collect():
        assert r["unique_count"] == odd.select(*r["columns"].split(" + ")).distinct().count()


@pytest.mark.parametrize("most", [1, 2, 4])
def test_combinations_with_the_first_column_on_some_rows(most):
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, width, 500) for width in (40, 9, 3, 200)]
    got = list(keys._with_first([(1 << k, codes, 200) for k, codes in enumerate(columns)], most))
    inside = [(0, *more) for size in range(most) for more in combinations((1, 2, 3), size)]
    assert sorted(got) == sorted((sum(1 << k for k in combo), len(set(zip(*[columns[k].tolist() for k in combo])))) for combo in inside)


@pytest.mark.parametrize("rows", [5, 2**21 + 1])
def test_rows_are_parted_whether_key_and_place_fit_one_number_or_not(rows):
    codes = np.arange(rows) // 2
    n, kept, classes = keys._parted(np.zeros(rows, dtype=np.int64), codes, rows)
    assert n == rows // 2 + 1 and sorted(kept) == list(range(rows - 1)) and (classes == codes[kept]).all()


def test_cells_along_a_pivot_stay_where_they_are(sharp):
    hashed = keys._Hashed(sharp, sharp.columns)
    rows = hashed.worded(hashed.dealt(hashed.values, 0, 100), "p")
    plan = keys._distinct(hashed.cells(rows, [(0, ("a", "b")), (1, ("a", "c"))], "p"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(p#" in plan and "h1" not in " ".join(re.findall(r"hashpartitioning\([^)]*", plan))


def test_larger_combinations_are_counted_on_few_rows(sharp):
    hashed = keys._Hashed(sharp, sharp.columns)
    unsettled = keys._Unsettled(hashed)
    unsettled.add([(hashed.bits(("a", "b")), ("a", "b"))])
    table, number, size = unsettled.places[hashed.bits(("a", "b"))]
    assert 0 < size < hashed.total / 2 and unsettled.tables[table].where(F.col("sharp") == number).count() == size
    assert unsettled.source(hashed.bits(("a", "b", "c"))) == hashed.bits(("a", "b")) and unsettled.source(hashed.bits(("a", "c"))) == 0


@pytest.mark.parametrize(("target", "close"), [(None, 5), (60, 3), (350, 40), (10_000, 5)])
def test_sketched_search_finds_what_exact_counts_find(sharp, target, close):
    want, total = brute_counts(sharp)
    goal = total if target is None else target
    got = {r["columns"]: (r["unique_count"], r["diff"], r["match"]) for r in keys.near_counts(sharp, target, close).collect()}
    assert got == {c: (n, n - goal, "exact" if n == goal else "close") for c, n in want.items() if abs(n - goal) <= close}


def test_sketch_bounds_hold(sharp):
    hashed = keys._Hashed(sharp, sharp.columns)
    want, _ = brute_counts(sharp)
    combos = [combo for size in (1, 2, 3) for combo in combinations(sharp.columns, size)]
    for combo, (low, high) in keys.sketched_counts(hashed, combos).items():
        assert low <= want[" + ".join(combo)] <= high


def test_sketches_are_narrow_near_the_goal_and_never_wrong_far_above_it(spark):
    grid = spark.range(1_000_000).selectExpr("id % 1000 AS a", "id div 1000 AS b", "id % 7 AS c")
    hashed = keys._Hashed(grid, grid.columns)
    low, high = keys.sketched_counts(hashed, [("a", "b")])[("a", "b")]
    assert low <= 1_000_000 <= high and high - low < 100_000
    bounds = keys.sketched_counts(hashed, [("a", "b"), ("a", "c"), ("b", "c")], 7000, 5)
    assert bounds[("a", "c")] == bounds[("b", "c")] == (7000, 7000) and 7005 < bounds[("a", "b")][0] <= 1_000_000


def test_a_large_combination_below_the_target_settles_all_inside(spark, monkeypatch):
    """Six columns of eight values that repeat every 64 rows: no combination of them nears the number of orders, whatever the products say."""
    small = [f"shiftright(id % 64, {k}) % 8 AS s{k}" for k in range(6)]
    rows = spark.range(4000).selectExpr("id div 4 AS o", "id % 4 AS line", *small)
    asked = []
    sketched = keys.sketched_counts
    monkeypatch.setattr(keys, "sketched_counts", lambda hashed, combos, *rest: asked.extend(combos) or sketched(hashed, combos, *rest))
    got = {(r["columns"], r["unique_count"]) for r in keys.near_counts(rows, 1000, 50).collect()}
    want, _ = brute_counts(rows)
    assert got == {(c, n) for c, n in want.items() if abs(n - 1000) <= 50}
    assert sum(all(name.startswith("s") for name in combo) for combo in asked) <= 2


def test_key_discovery_of_no_rows(spark):
    none = spark.createDataFrame([], "a int, b string")
    assert [(r["columns"], r["unique_count"]) for r in keys.combination_counts(none).orderBy("columns").collect()] == [("a", 0), ("a + b", 0), ("b", 0)]
    assert keys.near_counts(none).count() == 3
