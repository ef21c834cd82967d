"""Gaps, windows, capacity and range changes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverline.coverage import capacity as C
from silverline.coverage import gaps as G

D = dt.date
RUNS = "dataset string, label string, status string, start_date string, end_date string, start_time string, end_time string"


def runs(spark, *rows):
    return spark.createDataFrame(list(rows), RUNS)


def test_covered_days(spark):
    df = runs(
        spark,
        ("po", "x", "success", "01/30/2024", "02/01/2024", None, None),
        ("po", "2024-02-01", "success", None, None, None, None),
        ("po", "2024-03", "success", None, None, None, None),
        ("po", "2024-03-05", "success", "03/01/2024", None, None, None),
        ("po", "back", "success", "03/05/2024", "03/01/2024", None, None),
    )
    assert sorted(r["day"] for r in G.covered_days(df).collect()) == [D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1), D(2024, 3, 5)]


def test_missing_days(spark):
    df = runs(spark, ("bids", "all", "success", None, None, "2024-03-09T23:59:00Z", "2024-03-10T00:01:00Z"), ("pos", "all", "success", None, None, "2024-01-01T00:00:00Z", None))
    got = G.missing_days(G.run_days(df), df, "2024-03-12", 3)
    assert sorted((r["dataset"], r["day"].day) for r in got.collect()) == [("bids", 9), ("bids", 11), ("pos", 9), ("pos", 10), ("pos", 11)]


def test_months_with_gaps(spark):
    df = runs(spark, ("po", "w", "success", "01/01/2024", "02/29/2024", None, None), ("po", "w", "success", "03/01/2024", "03/09/2024", None, None))
    got = G.months_with_gaps(G.covered_days(df), df, "2024-03-10", "2024-01-15").collect()
    assert [(r["label"], r["start_date"], r["end_date"], r["missing_days"]) for r in got] == [("2024-03", "03/01/2024", "03/31/2024", 1)]


def windows(spark, start, end):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    return [(r["window_start"], r["window_end"], r["kind"]) for r in G.month_windows(df, F.col("s"), F.col("e")).orderBy("window_start").collect()]


def test_month_windows_are_clipped(spark):
    assert windows(spark, D(2024, 1, 15), D(2024, 3, 1)) == [
        (D(2024, 1, 15), D(2024, 1, 31), "custom"), (D(2024, 2, 1), D(2024, 2, 29), "full_month"), (D(2024, 3, 1), D(2024, 3, 1), "single_day"),
    ]
    assert windows(spark, D(2024, 1, 5), D(2024, 1, 9)) == [(D(2024, 1, 5), D(2024, 1, 9), "custom")]
    assert windows(spark, D(2024, 2, 1), D(2024, 1, 1)) == []


def test_year_windows(spark):
    df = spark.createDataFrame([(D(2023, 6, 1),)], "s date")
    got = G.year_windows(df, F.col("s"), F.lit(D(2024, 3, 1))).orderBy("label").collect()
    assert [(r["label"], r["window_start"], r["window_end"]) for r in got] == [
        ("year_2023", D(2023, 1, 1), D(2023, 12, 31)), ("year_2024", D(2024, 1, 1), D(2024, 3, 1)),
    ]


def test_pending_today(spark):
    tasks = spark.createDataFrame([("a", "x", "window"), ("a", "y", "window"), ("b", "z", "note")], "dataset string, label string, kind string")
    done = runs(spark, ("a", "x", "success", None, None, "2024-01-02T01:00:00Z", None), ("a", "y", "error", None, None, "2024-01-02T01:00:00Z", None))
    assert [r["label"] for r in G.pending_today(tasks, done, "2024-01-02").collect()] == ["y"]


def ranges(spark, *rows):
    return spark.createDataFrame([("g", *r) for r in rows], "g string, range_id string, start_date date, end_date date")


def daily(spark, *rows):
    return spark.createDataFrame([("g", *r) for r in rows], "g string, day date, rows bigint")


def test_range_counts_overlap_and_empty(spark):
    r = ranges(spark, ("a", D(2024, 1, 1), D(2024, 1, 3)), ("b", D(2024, 1, 3), D(2024, 1, 4)), ("c", D(2025, 1, 1), D(2025, 1, 2)))
    d = daily(spark, (D(2024, 1, 1), 10), (D(2024, 1, 3), 5), (D(2024, 1, 9), 99))
    got = {x["range_id"]: (x["rows"], x["percent_used"]) for x in C.range_counts(d, r, 10, ["g"]).collect()}
    assert got == {"a": (15, 150), "b": (5, 50), "c": (0, 0)}


def growth(spark, counts, recent):
    c = spark.createDataFrame([("g", *r) for r in counts], "g string, range_id string, start_date date, end_date date, rows bigint")
    r = spark.createDataFrame([("g", recent)], "g string, recent_rows bigint")
    return c, C.growth_rate(c, r, ["g"])


def test_growth_rate_weights(spark):
    _, got = growth(spark, [("a", D(2024, 1, 1), D(2024, 1, 11), 100), ("b", D(2024, 1, 12), D(2024, 1, 22), 200)], 900)
    row = got.first()
    assert row["daily"] == pytest.approx((10 * 1 + 20 * 2 + 30 * 3) / 6) and row["data_points"] == 3
    _, none = growth(spark, [("a", D(2024, 1, 1), D(2024, 1, 11), 0)], 0)
    assert tuple(none.first())[1:] == (60.0, 1800.0, 0)


@pytest.mark.parametrize(
    "rows,end,asof,action,extension",
    [
        (49_000, D(2024, 3, 1), "2024-03-01", "extend", 7),
        (10_000, D(2024, 3, 1), "2024-02-27", "extend", None),
        (10_000, D(2024, 9, 1), "2024-02-27", "ok", None),
        (49_500, D(2024, 9, 1), "2024-02-27", "add", None),
        (0, D(2024, 3, 1), "2024-03-01", "ok", None),
    ],
)
def test_capacity_actions(spark, rows, end, asof, action, extension):
    counts, rate = growth(spark, [("a", D(2023, 1, 1), D(2023, 12, 31), 30_000), ("b", D(2024, 1, 1), end, rows)], 0)
    got = {r["range_id"]: r for r in C.capacity(counts, rate, asof, ["g"]).collect()}
    assert got["a"]["state"] == "historical" and got["a"]["action"] == "ok"
    assert got["b"]["action"] == action
    if action == "extend":
        days = int(int((49_500 - rows) / got["b"]["daily"]) * 0.9)
        assert got["b"]["extension_days"] == max(7, days) and (extension is None or extension == got["b"]["extension_days"])


def test_planned_extension_limits(spark):
    df = spark.createDataFrame([(D(2024, 6, 1), 10_000, 1.0), (D(2024, 6, 1), 49_000, 100.0), (D(2023, 6, 1), 1, 1.0), (D(2024, 6, 1), 10_000, 100.0)], "e date, n int, d double")
    plan = C.planned_extension(F.col("e"), F.col("n"), F.col("d"), F.lit(D(2024, 1, 1)))
    got = [tuple(r) for r in df.select(*plan.values()).collect()]
    assert got[0] == (D(2026, 1, 1), 39_500, 579) and got[1] == (None, None, None) and got[2] == (None, None, None)
    assert got[3] == (D(2025, 7, 1), 39_500, 395)


def test_next_range(spark):
    df = spark.createDataFrame([(D(2025, 9, 28), 60.0)], "e date, d double")
    row = df.select(*[v.alias(k) for k, v in C.next_range(F.col("e"), F.col("d")).items()]).first()
    assert row["next_start"] == D(2025, 9, 29) and row["next_end"] == D(2025, 9, 29) + dt.timedelta(735)
    assert row["next_id"].startswith("09292025_to_") and row["estimated_months"] == 25


def test_apply_changes(spark):
    r = ranges(spark, ("01012024_to_06302024", D(2024, 1, 1), D(2024, 6, 30)), ("keep", D(2023, 1, 1), D(2023, 6, 30)))
    ext = spark.createDataFrame([("g", "01012024_to_06302024", D(2024, 7, 7))], "g string, range_id string, new_end date")
    add = ranges(spark, ("new", D(2025, 1, 1), D(2025, 2, 1)))
    got = sorted((x["range_id"], x["end_date"]) for x in C.apply_changes(r, ext, add, ["g"]).collect())
    assert got == [("01012024_to_07072024", D(2024, 7, 7)), ("keep", D(2023, 6, 30)), ("new", D(2025, 2, 1))]


def test_split_ranges_is_greedy_and_exact(spark):
    import random

    rng = random.Random(3)
    days = [(D(2024, 1, 1) + dt.timedelta(i), rng.randrange(1, 60)) for i in range(0, 300, 2)] + [(D(2024, 12, 1), 500)]
    got = sorted((r["start_date"], r["end_date"], r["rows"], r["over_limit"]) for r in C.split_ranges(daily(spark, *days), 200, ["g"]).collect())
    want, start, total, last = [], None, 0, None
    for day, n in days:
        if start is not None and total + n > 200:
            want.append((start, last, total, total > 200))
            start, total = None, 0
        start, total, last = start or day, total + n, day
    want.append((start, last, total, total > 200))
    assert got == want and sum(r[2] for r in got) == sum(n for _, n in days)


def test_strategies_and_config(spark):
    text = spark.createDataFrame([("a", "01/31/2018", "06/30/2023"), ("b", "7/1/2023", "09/28/2025")], "id string, start_date string, end_date string")
    r = C.config_ranges(text).withColumn("g", F.lit("g"))
    assert G.ranges_to_fetch(r, "last", "start_date", ["g"]).first()["range_id"] == "b"
    assert G.ranges_to_fetch(r, "all").count() == 2
    assert C.range_texts(r).orderBy("range_id").first()["start_date"] == "01/31/2018"
    with pytest.raises(ValueError):
        G.ranges_to_fetch(r, "some")
    fall = C.with_fallback(spark.createDataFrame([(5, 1), (None, 2), (None, None)], "e int, b int"), F.col("e"), F.col("b"))
    assert [(x["rows"], x["count_source"]) for x in fall.collect()] == [(5, "external"), (2, "bronze_fallback"), (0, "no_data")]
