"""Whitening of embeddings by Jacobi-Davidson on products with the covariance.

The covariance is never formed. A product with a block of directions is one pass over the stored,
centred vectors: every task multiplies its rows and adds up, partial sums are combined by Spark, and
the driver gets one row an entry of the block, which depends on the dimensions only. The driver keeps
bases of a few directions a component: Rayleigh-Ritz in the search space, locking of converged
directions, and correction equations, projected against locked and current directions and solved by
MINRES for all open components side by side, one distributed product a step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import pa_schema, stored
from silverline.llm.vectors import matrix, whole_vectors

if TYPE_CHECKING:
    import numpy as np


@dataclass(frozen=True)
class Whitening:
    """Quantisation and origin of the entries, components, and the solver: steps of MINRES, bases kept a component, residual in units of rounding."""

    scale: int = 64
    shift: int = 1_000_000
    components: int = 32
    inner: int = 8
    basis: int = 4
    residual: float = 64.0
    seed: int = 13
    rounds: int = 500


def _orthonormal(x: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the spaces given."""
    import numpy as np

    for _ in range(2):
        for space in against:
            x = x - space @ (space.T @ x)
        size = np.linalg.norm(x, axis=0)
        x = x[:, size > 0] / size[size > 0]
        if not x.shape[1]:
            return x
        u, s, _ = np.linalg.svd(x, full_matrices=False)
        x = u[:, s > 1e-10 * s[0]]
    return x


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, enough: float = 1e-3) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, side by side: apply() acts on all at once."""
    import numpy as np

    x, v_old, w, w_old = (np.zeros_like(b) for _ in range(4))
    first = beta = np.linalg.norm(b, axis=0)
    live = beta > 0
    v = np.where(live, b / np.where(live, beta, 1), 0)
    eta, c, c_old, s, s_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta, rho2, rho3 = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        rho1 = np.hypot(delta, beta_next)
        live = live & (rho1 > 0)
        safe = np.where(live, rho1, 1)
        c_old, s_old, c, s = c, s, np.where(live, delta / safe, c), np.where(live, beta_next / safe, s)
        w_old, w = w, np.where(live, (v - rho3 * w_old - rho2 * w) / safe, 0)
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live = live & (np.abs(eta) > enough * first) & (beta_next > 0)
        v_old, v, beta = v, np.where(live, p / np.where(beta_next > 0, beta_next, 1), 0), beta_next
    return x


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], size: int, how: Whitening) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residuals) of the largest eigenpairs of a symmetric operator that only product() knows.

    Ends when each residual is at the rounding of a product (`how.residual` units of it).
    """
    import numpy as np

    wanted = min(how.components, size)
    rng = np.random.default_rng(how.seed)
    locked, values, residuals = np.zeros((size, 0)), [], []
    v = _orthonormal(rng.standard_normal((size, wanted)))
    w = product(v)
    scale = 0.0
    for _ in range(how.rounds):
        h = v.T @ w
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        u, au = v @ turn, w @ turn
        scale = max(scale, float(np.abs(theta).max(initial=0)))
        r = au - u * theta
        sizes = np.linalg.norm(r, axis=0)
        good = 0
        while good < len(theta) and len(values) < wanted and sizes[good] <= how.residual * np.finfo(float).eps * scale:
            values.append(float(theta[good]))
            residuals.append(float(sizes[good]))
            good += 1
        locked = np.concatenate([locked, u[:, :good]], axis=1)
        v, w, u, r, theta = u[:, good:], au[:, good:], u[:, good:], r[:, good:], theta[good:]
        if len(values) == wanted:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order], np.array(residuals)[order]
        open_ = min(wanted - len(values), u.shape[1])
        if v.shape[1] + open_ > how.basis * wanted:
            v, w = v[:, : 2 * open_], w[:, : 2 * open_]
        seen = np.concatenate([locked, u[:, :open_]], axis=1)

        def outside(x: np.ndarray, seen: np.ndarray = seen) -> np.ndarray:
            return x - seen @ (seen.T @ x)

        def shifted(x: np.ndarray, theta: np.ndarray = theta[:open_]) -> np.ndarray:
            x = outside(x)
            return outside(product(x) - x * theta)

        step = minres(shifted, -outside(r[:, :open_]), how.inner)
        added = _orthonormal(step, locked, v)
        if not added.shape[1]:
            # Nothing new in these directions: look elsewhere, or stop where no direction is left.
            added = _orthonormal(rng.standard_normal((size, max(1, open_))), locked, v)
        if not added.shape[1]:
            added = np.zeros((size, 0))
            v = _orthonormal(v, locked)
            w = product(v)
            continue
        added = added[:, : size - locked.shape[1] - v.shape[1]]
        v, w = np.concatenate([v, added], axis=1), np.concatenate([w, product(added)], axis=1)
    raise ArithmeticError(f"residuals {sizes[:open_]} after {how.rounds} rounds")


def _added_up(rows: DataFrame, task: Callable[[dict], np.ndarray], columns: int) -> np.ndarray:
    """The sum of task(row) over all rows: each task adds up its own, Spark the entries of all tasks."""
    import numpy as np

    schema = "entry int, part double"
    out = pa_schema(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(batch.num_rows):
                part = task(batch.slice(at, 1).to_pylist()[0])
                total = part if total is None else total + part
        if total is not None:
            flat = np.ascontiguousarray(total, dtype=np.float64).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], schema=out)

    got = rows.mapInArrow(run, schema).groupBy("entry").agg(F.sum("part").alias("total")).toArrow()
    flat = np.zeros(got.num_rows)
    flat[got["entry"].to_numpy()] = got["total"].to_numpy()
    return flat.reshape(-1, columns) if columns else flat


def _totals(whole: DataFrame, shift: int) -> list[int]:
    """The sum of x - shift in each dimension, exactly: tasks add up whole numbers."""
    schema = "entry int, part long"
    out = pa_schema(whole.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            part = (matrix(batch["x"], missing=shift) - shift).sum(axis=0)
            longer, shorter = (part, total) if len(part) >= len(total) else (total, part)
            total = longer.copy()
            total[: len(shorter)] += shorter
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], schema=out)

    got = whole.select("x").mapInArrow(run, schema).groupBy("entry").agg(F.sum("part").alias("total")).orderBy("entry").collect()
    return [row["total"] for row in got]


def _centred(whole: DataFrame, n: int, sums: list[int], shift: int) -> DataFrame:
    """Blocks of vectors: ids, the exact sum of squares of n*x - S, and x - S/n as doubles, row after row."""
    kind = whole.schema["vec_id"].dataType.simpleString()
    schema = f"vec_ids array<{kind}>, deviations array<long>, rows binary"
    out = pa_schema(whole.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total = np.array(sums, dtype=np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                away = n * matrix(part["x"], len(sums), shift) - total
                most = int(np.abs(away).max(initial=0))
                exact = away if most * most * len(sums) < 1 << 63 else away.astype(object)
                row = {"vec_ids": part["vec_id"].to_pylist(), "deviations": [int(d) for d in (exact * exact).sum(axis=1)], "rows": (away / n).tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema=out)

    return whole.mapInArrow(run, schema)


@dataclass(frozen=True)
class Fitted:
    """What the fit found: vectors in the list, eigenvalues, directions (columns), residuals, trace, and the largest error of the identity."""

    n: int
    values: np.ndarray
    directions: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float
    blocks: DataFrame | None


def fit(vectors: DataFrame, how: Whitening | None = None) -> Fitted:
    """Principal components of all valid vectors of (vec_id, embedding).

    Components without variance, to rounding, have no unit scale and are left out.
    """
    import numpy as np

    how = how or Whitening()
    whole = stored(whole_vectors(vectors, how.scale, how.shift), "whole")
    n = whole.count()
    totals = _totals(whole, how.shift) if n else []
    size = len(totals)
    if not size:
        return Fitted(n, np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, None)
    blocks = stored(_centred(whole, n, [t + n * how.shift for t in totals], how.shift), "centred")

    def rows(row: dict) -> np.ndarray:
        return np.frombuffer(row["rows"]).reshape(-1, size)

    def product(b: np.ndarray) -> np.ndarray:
        if not b.shape[1]:
            return b
        return _added_up(blocks.select("rows"), lambda row: (y := rows(row)).T @ (y @ b), b.shape[1]) / n

    trace = float(_added_up(blocks.select("rows"), lambda row: (rows(row) ** 2).sum(axis=0), 0).sum()) / n
    values, directions, residuals = leading_pairs(product, size, how)
    kept = values > size * np.finfo(float).eps * max(values[0], 0)
    values, directions, residuals = values[kept], directions[:, kept], residuals[kept]
    error = 0.0
    if len(values):
        scaled = directions / np.sqrt(values)
        mean = _added_up(blocks.select("rows"), lambda row: (rows(row) @ scaled).sum(axis=0), 0) / n
        spread = _added_up(blocks.select("rows"), lambda row: (z := rows(row) @ scaled - mean).T @ z, len(values)) / n
        error = float(np.abs(spread - np.eye(len(values))).max())
    return Fitted(n, values, directions, residuals, trace, error, blocks)


def whitened(vectors: DataFrame, how: Whitening | None = None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every valid row and component.

    Rows whose vector is NULL or holds NULL or non-finite entries are dropped; missing entries of
    shorter vectors count as zero; repeated rows and NULL ids are rows like others; other columns are
    not read. Vectors that are all alike, a single one or none give no rows. A deviation must fit 64
    bits, which it does for some million vectors of common size; beyond that the query fails.
    """
    found = fit(vectors, how)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    if not len(found.values):
        return spark.createDataFrame([], schema)
    out = pa_schema(spark, schema)
    n, values, trace, error, scaled = found.n, found.values, found.trace, found.identity_error, found.directions / found.values**0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        m = len(values)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                z = np.frombuffer(row["rows"][0].as_py()).reshape(-1, scaled.shape[0]) @ scaled
                count = len(z)
                owner = pa.array(np.repeat(np.arange(count), m))
                yield pa.RecordBatch.from_arrays(
                    [
                        row["vec_ids"].flatten().take(owner), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * m, n)), row["deviations"].flatten().take(owner), pa.array(z.ravel()),
                        pa.array(np.tile(values / trace, count)), pa.array(np.full(count * m, error)),
                    ],
                    schema=out,
                )

    return found.blocks.mapInArrow(run, schema)
