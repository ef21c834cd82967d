"""Top-k search and whitening against numpy."""

import math

import duckdb
import numpy as np
import pytest
from llm_cases import plain

from silverline.llm import bit_slices, queries, whitening
from silverline.llm.vectors import whole_vectors
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, row long, x string, score double, `a.b` string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "x", 0.5, "d") for i, v in rows], SCHEMA).repartition(4)


def vectors(count=400, size=12, seed=3):
    rng = np.random.default_rng(seed)
    base = np.float32(rng.standard_normal((count, size)) * np.linspace(0.2, 1, size))
    rows = [(k - 20, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[0][1]) for k in range(150)]  # a common vector
    rows += [(50, rows[70][1]), (50, rows[70][1])]  # a repeated row of a query
    rows += [(None, rows[9][1]), (2000, None), (2001, [1.0, None]), (2002, [math.nan]), (2003, [math.inf]), (2004, []), (2050, [0.5, -0.5]), (2100, [3.0] * (size + 2))]
    return rows


def brute_whole(rows, scale, shift=0):
    out = []
    for vec_id, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((vec_id, [math.floor(scale * float(np.float32(c))) + shift for c in v]))
    return out


def brute_top(rows, k=5):
    whole = [(i, x + [0] * (20 - len(x))) for i, x in brute_whole(rows, 256)]
    out = []
    for a, (query, x) in enumerate(whole):
        if query is not None and query % 50 == 0:
            scored = [(-sum(p * q for p, q in zip(x, y)), i is None, i or 0, i) for b, (i, y) in enumerate(whole) if a != b]
            out += [(query, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return out


def test_digits_add_up():
    for value in [*range(-300, 300), 10**12 + 7, -(10**12)]:
        found = list(bit_slices.digits(value))
        assert sum(sign << place for place, sign in found) == value
        assert all(b - a > 1 for (a, _), (b, _) in zip(found, found[1:]))


@pytest.mark.parametrize("count", [1, 63, 64, 65, 200])
def test_slices_give_exact_scores(count):
    rng = np.random.default_rng(count)
    x = rng.integers(-90, 100, (count, 7))
    x[:, 3] = 5
    slices = bit_slices.Slices.unpack(count, *bit_slices.Slices.pack(x))
    for query in ([0] * 7, [3, -4, 0, 9, 1, -1, 255], rng.integers(-300, 300, 7).tolist()):
        want = sorted(((-int(s), k) for k, s in enumerate(x @ np.array(query)) if k != 2))[:5]
        assert sorted(((-s, k) for k, s in slices.top(query, 5, 2))) == want


@pytest.mark.parametrize("how", [bit_slices.TopK(), bit_slices.TopK(rows=50, queries=3)])
def test_search_equals_brute_force(spark, how):
    rows = vectors()
    got = bit_slices.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, how)
    assert plain(got.select("query_id", "rank", "vec_id", "score").collect()) == plain(brute_top(rows))


def test_search_of_few_and_none(spark):
    ask = F.col("vec_id") % 50 == 0
    assert bit_slices.top_k(frame(spark, []), ask).collect() == []
    assert bit_slices.top_k(frame(spark, [(50, [1.0])]), ask).collect() == []
    assert plain(bit_slices.top_k(frame(spark, [(50, [1.0]), (51, [2.0])]), ask).collect()) == [(50, 1, 51, 256 * 512)]
    assert bit_slices.top_k(frame(spark, [(1, [1.0]), (51, [2.0])]), ask).collect() == []


def brute_whitening(rows):
    whole = brute_whole(rows, 64, 1_000_000)
    size = max(len(x) for _, x in whole)
    x = np.array([v + [1_000_000] * (size - len(v)) for _, v in whole], dtype=object)
    n = len(x)
    away = n * x - x.sum(axis=0)
    y = (away / n).astype(float)
    return [i for i, _ in whole], (away * away).sum(axis=1).tolist(), y, y.T @ y / n


def check_whitening(rows, got):
    ids, deviations, y, cov = brute_whitening(rows)
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1], directions[:, ::-1]
    count = min(32, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == count * len(ids)
    by = {}
    for row in got:
        by.setdefault(row["component"], []).append(row)
    assert sorted(by) == list(range(1, count + 1))
    for component, part in by.items():
        assert {r["n"] for r in part} == {len(ids)}
        assert plain([(r["vec_id"], r["deviation"]) for r in part]) == plain(zip(ids, deviations))
        assert all(abs(r["explained"] - values[component - 1] / np.trace(cov)) <= 1e-12 for r in part)
        assert all(r["identity_error"] < 1e-9 for r in part)
        gap = min(abs(values[component - 1] - values[k]) for k in (component - 2, component) if 0 <= k < len(values))
        if gap > 1e-3 * values[0]:
            want = y @ directions[:, component - 1] / values[component - 1] ** 0.5
            got_by = sorted((repr(r["vec_id"]), r["whitened"]) for r in part)
            want_by = sorted(zip(map(repr, ids), want)), sorted(zip(map(repr, ids), -want))
            assert min(max(abs(a[1] - b[1]) for a, b in zip(got_by, w)) for w in want_by) < 1e-9


def test_whitening_equals_numpy(spark):
    rows = [r for r in vectors(size=40, seed=5) if r[0] not in (50, 2100)]
    check_whitening(rows, whitening.whitened(frame(spark, rows)).collect())


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None)])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    rows = [(1, [1.0, 2.0]), (2, [1.5, 2.0]), (2, [1.5, 2.0]), (None, [2.0])]
    check_whitening(rows, whitening.whitened(frame(spark, rows)).collect())


@pytest.mark.parametrize("kind", ["decay", "clustered", "equal", "low rank", "wide"])
def test_leading_pairs_reach_double_precision(kind):
    rng = np.random.default_rng(1)
    size = 300 if kind == "wide" else 80
    q, _ = np.linalg.qr(rng.standard_normal((size, size)))
    values = {
        "decay": 0.8 ** np.arange(size), "clustered": 1 + 1e-4 * np.arange(size)[::-1], "equal": np.repeat([3.0, 2.0, 1.0, 0.5], size // 4),
        "low rank": np.r_[np.arange(5, 0, -1.0), np.zeros(size - 5)], "wide": np.linspace(5, 1, size),
    }[kind]
    a = (q * values) @ q.T
    products = []

    def product(b):
        products.append(b.shape[1])
        return a @ b

    how = whitening.Whitening(components=12)
    got, directions, residuals = whitening.leading_pairs(product, size, how)
    assert np.allclose(got, np.sort(values)[::-1][:12], atol=1e-12)
    assert np.abs(a @ directions - directions * got).max() < 1e-12
    assert np.abs(directions.T @ directions - np.eye(12)).max() < 1e-12 and (residuals < 1e-12).all()
    assert max(products) <= 12


def test_minres_solves_side_by_side():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    a = (q * np.linspace(-2, 5, 30)) @ q.T
    b = rng.standard_normal((30, 4))
    b[:, 2] = 0
    assert np.abs(a @ whitening.minres(lambda x: a @ x, b, 60, 1e-13) - b).max() < 1e-8


def test_queries_over_the_table(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    got = queries.QUERIES["op12_bit_sliced_search"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert plain(got) == plain(duckdb.sql(queries.OP12_SQL.replace("from embeddings", f"from '{SF}/embeddings.parquet'")).fetchall()) and got
    check_whitening(rows, queries.QUERIES["op13_whitening"](spark, SF).collect())


def test_whole_numbers_round_down(spark):
    got = whole_vectors(frame(spark, [(1, [-0.001, 0.0, 0.999])]), 256).collect()
    assert got[0]["x"] == [-1, 0, 255]
