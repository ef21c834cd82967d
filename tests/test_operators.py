"""Keyed operators, joins, ordering and positions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from silverline.operators import joins, keyed, ordering, positions


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def versions():
    rng = random.Random(5)
    # Key 0 owns more than a third of the rows.
    keys = [0] * 400 + [rng.randrange(1, 40) for _ in range(600)]
    return [(k, i, rng.random()) for i, k in enumerate(keys)]


SCHEMA = "k int, n int, v double"


def test_latest_is_independent_of_input_order(spark, versions):
    want = rows_of(spark.createDataFrame([max(r for r in versions if r[0] == k) for k in {r[0] for r in versions}], SCHEMA))
    for seed in range(3):
        mixed = versions[:]
        random.Random(seed).shuffle(mixed)
        df = spark.createDataFrame(mixed, SCHEMA).repartition(5)
        assert rows_of(keyed.latest_per_key(df, ["k"], keyed.newest_first(["n"]))) == want


def test_latest_limits_before_the_shuffle(spark, versions):
    df = keyed.latest_per_key(spark.createDataFrame(versions, SCHEMA), ["k"], keyed.newest_first(["n"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    partial = plan.rindex("WindowGroupLimit")
    assert "Partial" in plan and plan.index("WindowGroupLimit") < plan.index("Exchange") < partial


def expected_kept(versions, allowed):
    out = []
    for k in {r[0] for r in versions}:
        group = sorted(r for r in versions if r[0] == k)
        out += group[-max(allowed.get(k, 1), 1):]
    return sorted(out)


@pytest.mark.parametrize("hot", [3, 5000])
def test_keep_last_n(spark, versions, hot):
    """The small limit runs ahead of the shuffle; the large one takes the sliced way."""
    allowed = {0: hot, 1: 2, 2: 1, 3: 0, 99: 7}
    config = spark.createDataFrame(list(allowed.items()), "k int, c int")
    df = spark.createDataFrame(versions, SCHEMA)
    kept = keyed.keep_last_n(df, ["k"], ["n"], config, "c")
    assert rows_of(kept) == expected_kept(versions, {k: c for k, c in allowed.items() if c > 0})


def test_a_large_limit_holds_for_its_own_key_only(spark):
    df = spark.range(9000).selectExpr("cast(id % 3 as int) as k", "cast(id as int) as n")
    config = spark.createDataFrame([(0, 2500), (1, 2)], "k int, c int")
    kept = keyed.keep_last_n(df, ["k"], ["n"], config, "c")
    assert {r["k"]: (r["a"], r["b"]) for r in kept.groupBy("k").agg(F.count("*").alias("a"), F.min("n").alias("b")).collect()} == {
        0: (2500, 8997 - 3 * 2499), 1: (2, 8995), 2: (1, 8999)
    }


@pytest.mark.parametrize("broadcast", [True, False])
def test_large_keys_are_cut_in_parts(spark, versions, monkeypatch, broadcast):
    """The rows of a large key are dealt by part before they are ranked; the result is that of one window."""
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 500 if broadcast else 0)
    allowed = {0: 30, 1: 2, 99: 7}
    config = spark.createDataFrame(list(allowed.items()), "k int, c int")
    df = spark.createDataFrame([*versions, *[(None, n, *versions[0][2:]) for n in range(60)]], SCHEMA)
    kept = keyed.keep_last_n(df, ["k"], ["n"], config, "c", large_key=40)
    assert rows_of(kept.where("k is not null")) == expected_kept(versions, allowed)
    assert [row["n"] for row in kept.where("k is null").collect()] == [59]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_key#\d+, _dealt#", plan)


def test_kept_and_dropped_make_up_the_input(spark, versions):
    config = spark.createDataFrame([(0, 3), (5, 4)], "k int, c int")
    df = spark.createDataFrame(versions, SCHEMA)
    stats = keyed.consolidation_stats(df, ["k"], config, "c").first()
    kept = keyed.keep_last_n(df, ["k"], ["n"], config, "c").count()
    assert stats["balanced"] and stats["final_rows"] == kept
    assert stats["total_rows"] == len(versions) == kept + stats["rows_skipped"]
    assert stats["final_rows"] == stats["unique_keys"] + stats["extra_rows_kept"]


@pytest.mark.parametrize(("large_key", "broadcast"), [(10**6, True), (40, True), (40, False), (0, True)])
def test_instances_match_a_plain_window(spark, versions, monkeypatch, large_key, broadcast):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 500 if broadcast else 0)
    df = spark.createDataFrame([*versions, (None, 1, 0.5), (None, 70, 0.25), (0, None, 1.0)], SCHEMA)
    got = keyed.with_instances(df, ["k"], [F.col("n").asc_nulls_last()], F.col("n"), large_key=large_key)
    df.createOrReplaceTempView("v")
    want = spark.sql(
        "select *, cast(row_number() over (partition by k order by n nulls last) as bigint) a, count(*) over (partition by k) b from v"
    )
    assert sorted(map(str, got.collect())) == sorted(
        map(str, want.withColumnsRenamed({"a": "instance_number", "b": "total_instances"}).collect())
    )


def test_instances_of_a_large_key_are_numbered_in_slices(spark):
    """A NULL key with a row of every number in each of 500 files, and one number that a tenth of the rows share."""
    rows = spark.range(50_000).selectExpr(
        "cast(null as string) as k", "if(id % 10 = 0, 40, id div 500 + 1) as n", "cast(id % 500 as string) as file", "id"
    )
    numbered = keyed.with_instances(rows, ["k"], [F.col("n"), F.col("file"), F.col("id")], F.col("n"), large_key=1000)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "row_number" in line]
    assert row_windows and all("_slice" in line for line in row_windows)
    cut = rows.withColumn("_key", F.struct("k")).withColumn("_along", F.col("n").cast("double"))
    large = cut.groupBy("_key").agg(F.count("*").alias("_total"))
    sizes = cut.join(keyed._cut_points(cut, large), "_key").groupBy(keyed._slice_of(F.col("_along"))).count().collect()
    assert len(sizes) >= 90 and max(r["count"] for r in sizes) <= 5500
    got = [r["instance_number"] for r in numbered.orderBy("n", "file", "id").select("instance_number").collect()]
    assert got == list(range(1, 50_001))


def test_duplicate_census(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z"), ("a", 3, "w")], "k string, n int, t string")
    assert rows_of(keyed.duplicate_census(df, ["k"], ["n"], "c")) == [("a", 1, "x", 3)]


def test_expected_extra_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0), ("d", None)], "k string, n int")
    assert keyed.expected_extra_rows(df, "n").first()[0] == 2


def test_positions_are_a_total_order(spark, versions):
    df = spark.createDataFrame(versions, SCHEMA).repartition(6)
    got = positions.with_positions(df, [F.col("v").desc(), F.col("n")], "p").select("p", "n").collect()
    want = [n for _, n, _ in sorted(versions, key=lambda r: (-r[2], r[1]))]
    assert [n for p, n in sorted((r["p"], r["n"]) for r in got)] == want
    assert sorted(r["p"] for r in got) == list(range(1, len(versions) + 1))


def test_dimensions(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("d", 1), ("c", 1), ("a", 9)], "x string, y int")
    dims = positions.dimensions(df, {"x": "x_id", "y": "y_id"})
    assert sorted(map(tuple, dims["y"].collect())) == [(1, 1), (2, 2), (3, 3), (9, 4)]
    assert sorted(map(tuple, dims["x"].where("x is not null").collect())) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert dims["x"].where("x is null").first()["x_id"] == 5


def test_star_join_null_handling(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2)], "x string, n int")
    dims = positions.dimensions(fact, {"x": "x_id"})
    assert rows_of(joins.star_join(fact, dims).select("n", "x_id")) == [(1, 1)]
    assert rows_of(joins.star_join(fact, dims, null_safe=True).select("n", "x_id")) == [(1, 1), (2, 2)]


def test_overlapping_ranges(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as d")
    ranges = spark.sql("select 'a' id, date'2024-01-02' start_date, date'2024-01-04' end_date union all select 'b', date'2024-01-04', date'2024-01-04' union all select 'c', date'2024-02-02', date'2024-01-01'")
    got = joins.in_ranges(df, F.col("d"), ranges).groupBy("id").count()
    assert rows_of(got) == [("a", 3), ("b", 1)]
    plan = joins.in_ranges(df, F.col("d"), ranges)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_first_sample_tops_up_from_the_stratum(spark):
    df = spark.createDataFrame([(i, i in (7, 8, 9)) for i in range(12)], "id int, listed boolean")
    got = ordering.first_sample(df, [F.col("id")], 5, F.col("listed"), 2)
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3, 4, 7, 8]
    assert ordering.first_sample(df, [F.col("id")], 9, F.col("listed"), 2).count() == 9
    none = ordering.first_sample(df.where("id < 7"), [F.col("id")], 3, F.col("listed"), 2)
    assert none.count() == 3


def test_first_sample_keeps_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (1, "a"), (2, "b"), (3, "c")], "id int, t string")
    got = ordering.first_sample(df, [F.col("id")], 5, F.col("t") == "c", 2)
    assert sorted((r["id"], r["t"]) for r in got.collect()) == [(1, "a")] * 4 + [(2, "b"), (3, "c")]
    twice = df.unionByName(df)
    got = ordering.first_sample(twice, [F.col("id")], 9, F.col("t") == "c", 3)
    assert sorted(r["id"] for r in got.collect()) == [1] * 8 + [2, 3, 3]


def test_text_date_order(spark):
    items = [("b", "01/02/2024"), ("a", "1/2/2024"), ("B", "01/02/2024"), ("z", "12/31/2023"), ("n", None), ("m", "bad")]
    df = spark.createDataFrame(items, "k string, d string")
    assert [r["k"] for r in ordering.sort_by_text_date(df, "d", "k").collect()] == ["z", "a", "b", "B", "m", "n"]
    assert [r["k"] for r in ordering.sort_by_text_date(df, "d", "k", locale=False).collect()] == ["z", "B", "a", "b", "m", "n"]


def test_latest_successful_run(spark):
    data = [
        ("bids", "run_1", "success", [("bids.csv",)]), ("bids", "run_3", "failed", [("bids.csv",)]),
        ("bids", "run_2", "success", [("bids.csv",)]), ("bids", "run_4", "success", [("bids_with_urls.csv",), ("page.html",)]),
        ("pos", "run_1", "success", []),
    ]
    df = spark.createDataFrame(data, "dataset string, run_id string, status string, files array<struct<name:string>>")
    assert [(r["dataset"], r["run_id"]) for r in ordering.latest_successful_run(df).collect()] == [("bids", "run_2")]


def test_pair_results_by_key(spark):
    tasks = spark.createDataFrame([("a", "window", "x"), ("a", "window", None), ("b", "note", "y")], "dataset string, kind string, label string")
    results = spark.createDataFrame(
        [("b", "note", "y", True, 0, True, None, None, None), ("a", "window", None, False, 1, None, "boom", "r", "p")],
        "dataset string, kind string, label string, ok boolean, exit_code int, skipped boolean, error string, run_id string, manifest_path string",
    )
    got = {(r["dataset"], r["label"]): r["result"].asDict() for r in joins.pair_results(tasks, results).collect()}
    assert got[("b", "y")]["ok"] and got[("b", "y")]["skipped"]
    assert got[("a", None)]["error"] == "boom" and got[("a", None)]["skipped"] is False
    assert got[("a", "x")]["error"].startswith("no result") and got[("a", "x")]["ok"] is False
