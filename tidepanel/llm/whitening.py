"""Whitening of embeddings by the singular values of their centred rows.

Vectors become whole numbers on a grid. The fit list is each distinct one once. Tasks reduce blocks of its centred rows to
triangular factors (QR) that are merged in groups of FAN; the last factor, whose size is that of one vector squared, is
brought to bidiagonal form by Householder reflections on the driver. The dqds algorithm finds the singular values,
twisted factorisations the directions. Neighbours closer than CLOSE (relative) are made orthogonal one after the other.
No covariance of the vectors is formed on the way.

Defined results: vectors that are null, empty, hold null or non-finite entries or entries too large for the grid, or whose
length is not the most frequent one (the longer of equally frequent ones) take no part; repeated vectors count once in
the fit and are whitened each; rows without an id are kept; components end where singular values are at the level of rounding,
so equal vectors, a single one and an empty table give no rows; equal eigenvalues have any basis of their space; a
deviation beyond 64 bits is null; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import leanly, slices, written

#: Rows of a block, factors merged by one task, and the relative distance of neighbours that need care.
BLOCK, FAN, CLOSE = 2048, 16, 1e-3
EPS = float(np.finfo(float).eps)


def gridded(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(id, x) of the rows that take part; x = floor(scale * entry) + shift."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = own.where(F.forall("v", lambda c: F.coalesce(F.abs(c * scale) < float(1 << 62), F.lit(False))) & (F.size("v") > 0))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return good.where(F.size("v") == d).select("id", F.transform("v", lambda c: F.floor(c * scale) + shift).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _most(x: np.ndarray) -> int:
    """The largest absolute value, as a number of any size."""
    return max(int(x.max()), -int(x.min()))


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each place."""

    def run(batches):
        n, sums = 0, None
        for batch in slices(batches, BLOCK):
            if batch.num_rows:
                x = _matrix(batch.column(0))
                own = x.sum(0).tolist() if _most(x) * len(x) < 1 << 62 else x.astype(object).sum(0).tolist()
                n, sums = n + len(x), own if sums is None else [a + b for a, b in zip(sums, own)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(sums)), pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.decimal128(38, 0))], names=["n", "at", "s"])

    rows = fit.mapInArrow(leanly(run), "n long, at int, s decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit numbers where they do, else numbers of any size."""
    if n * _most(x) < 1 << 61 and max(abs(s) for s in sums) < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _scaled(x, n, sums).astype(float) / n


def _merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One state from those of all tasks, merged FAN at a time until one is left."""
    parts = written(parts.withColumn("at", F.monotonically_increasing_id()), "states")
    n = parts.count()
    order = "at"
    while n > 1:
        cells = -(-n // FAN)
        own = parts.select(F.pmod(F.xxhash64(order), F.lit(cells)).alias("cell") if cells > 1 else F.lit(0).cast("long").alias("cell"), "state")

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            state, waiting = None, pdf["state"].tolist()
            while waiting:
                some, waiting = waiting[:FAN], waiting[FAN:]
                state = merge([*([state] if state is not None else []), *some])
            return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "state": [state]})

        parts, order = written(own.groupBy("cell").applyInPandas(run, "cell long, state binary"), "states"), "cell"
        n = parts.count()
    row = parts.first()
    return bytes(row["state"]) if row else None


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _factor(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangular factor of the centred rows: blocks within tasks, then those of tasks."""
    d = len(sums)

    def run(batches):
        r = np.empty((0, d))
        for batch in slices(batches, BLOCK):
            if batch.num_rows:
                r = _triangle(np.vstack([r, _centred(_matrix(batch.column(0)), n, sums)]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["state"])

    unpacked = lambda s: np.frombuffer(s).reshape(-1, d)
    state = _merged(fit.mapInArrow(leanly(run), "state binary"), lambda states: _triangle(np.vstack([unpacked(s) for s in states])).tobytes())
    r = unpacked(state)
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of U' r V for orthogonal U and V, and V; by Householder reflections from either side."""
    r, d = r.copy(), r.shape[1]
    v = np.eye(d)
    for k in range(d):
        u = _reflector(r[k:, k])
        if u is not None:
            r[k:, k:] -= np.outer(2 * u, u @ r[k:, k:])
        if k < d - 2:
            u = _reflector(r[k, k + 1 :])
            if u is not None:
                r[k:, k + 1 :] -= np.outer(r[k:, k + 1 :] @ u, 2 * u)
                v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ u, 2 * u)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """A unit vector u for which x - 2 u (u'x) has only a first entry."""
    size = np.abs(x[1:]).max() if len(x) > 1 else 0.0
    if size == 0:
        return None
    u = x / max(size, abs(x[0]))
    u[0] += np.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """All eigenvalues, falling, of B'B for an upper bidiagonal B with squares q of its diagonal (above 0) and e beside it.

    A step without a shift gives the diagonal of the inverse; the reciprocal of its sum is a lower bound of the least
    eigenvalue, with which the next step is shifted, so all quantities stay positive and hold their relative accuracy.
    """
    found: list[float] = []
    todo = [(list(map(float, q)), list(map(float, e)), 0.0)]
    small = (10 * EPS) ** 2
    while todo:
        q, e, base = todo.pop()
        for _ in range(100 * (len(q) + 10)):
            while q and (len(q) == 1 or e[-1] <= small * (base + q[-1])):
                found.append(base + q.pop())
                if e:
                    e.pop()
            if not q:
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (base + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            q, e, inverse = _step(q, e, 0.0)
            shift = (1 - 8 * len(q) * EPS) / inverse if 0 < inverse < float("inf") else 0.0
            while shift > EPS * base * 1e-3:
                made = _step(q, e, shift)
                if made is not None:
                    q, e, base = made[0], made[1], base + shift
                    break
                shift /= 2  # rounding took the bound above the least eigenvalue
        else:
            raise RuntimeError("dqds did not settle")
    return np.sort(np.array(found))[::-1]


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One qd step; also the sum of the inverse's diagonal, which holds without a shift. None where a shift was too large."""
    d, out_q, out_e, inverse = q[0] - shift, [], [], 0.0
    for i, x in enumerate(e):
        if d < 0:
            return None
        inverse += 1 / d if d else float("inf")
        out_q.append(d + x)
        t = q[i + 1] / out_q[-1] if out_q[-1] else 0.0
        out_e.append(x * t)
        d = d * t - shift
    if d < 0:
        return None
    return [*out_q, d], out_e, inverse + (1 / d if d else float("inf"))


def twisted(a: np.ndarray, b: np.ndarray, value: float, rank: int = 0) -> np.ndarray:
    """A unit eigenvector of B'B for an eigenvalue: factorisations from both ends meet where the remainder is least (or next to least, by rank)."""
    n, tiny = len(a), EPS * EPS * max(value, 1e-300)
    square, slope = a * a, b / a[:-1]
    low, up, s, p = np.empty(n - 1), np.empty(n - 1), np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + square[i]
        low[i] = a[i] * b[i] / (pivot if pivot else tiny)
        s[i + 1] = low[i] * slope[i] * s[i] - value
    p[-1] = square[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = b[i] * b[i] + p[i + 1]
        t = square[i] / (pivot if pivot else tiny)
        up[i] = slope[i] * t
        p[i] = p[i + 1] * t - value
    at = int(np.argsort(np.abs(s + p + value), kind="stable")[min(rank, n - 1)])
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def _blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Parts between negligible entries beside the diagonal."""
    size = EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    cuts = [0, *(i + 1 for i in range(len(b)) if abs(b[i]) <= size), len(a)]
    return list(zip(cuts, cuts[1:]))


def directions(r: np.ndarray, most: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of r, falling, and the right directions as columns; none at the level of rounding."""
    size, d = float(np.abs(r).max(initial=0.0)), r.shape[1]
    if size == 0 or not np.isfinite(size):
        return np.empty(0), np.empty((d, 0))
    a, b, v = bidiagonal(r / size)
    floor = EPS * 1e-3 * max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    a = np.where(np.abs(a) < floor, floor, a)  # below rounding of r; keeps factors finite
    values = [(value, block) for block in _blocks(a, b) for value in dqds(a[slice(*block)] ** 2, b[block[0] : block[1] - 1] ** 2)]
    values.sort(key=lambda x: (-x[0], x[1]))
    least = (8 * d * EPS) ** 2 * values[0][0]
    kept, columns = [], []
    for value, (i, j) in values[:most]:
        if value <= least:
            break
        near = [z for (x, block), z in zip(kept, columns) if block == (i, j) and x - value <= CLOSE * x]
        for rank in range(j - i):
            z = np.zeros(d)
            z[i:j] = twisted(a[i:j], b[i : j - 1], value, rank) if j - i > 1 else 1.0
            for _ in range(2):
                for other in near:
                    z -= (other @ z) * other
            length = np.linalg.norm(z)
            if length > 1e-4:  # else it lies in the space of those before: meet elsewhere
                break
        columns.append(z / length)
        kept.append((value, (i, j)))
    if not columns:
        return np.empty(0), np.empty((d, 0))
    made = v @ np.stack(columns, 1)
    made *= np.where(made[np.abs(made).argmax(0), np.arange(made.shape[1])] < 0, -1.0, 1.0)
    return np.array([x for x, _ in kept]) * size * size, made


def _covered(fit: DataFrame, n: int, sums: list[int], scaled: np.ndarray) -> np.ndarray:
    """Covariance of the whitened fit list; blocks are centred on their own means before multiplying, and merged with the means' distances."""
    k = scaled.shape[1]

    def joined(states: list[tuple[float, np.ndarray, np.ndarray]]) -> bytes:
        total = sum(s[0] for s in states)
        mean = sum(s[0] * s[1] for s in states) / total
        products = sum(s[2] + s[0] * np.outer(s[1] - mean, s[1] - mean) for s in states)
        return np.r_[total, mean, products.ravel()].tobytes()

    def unpacked(raw: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        x = np.frombuffer(raw)
        return x[0], x[1 : k + 1], x[k + 1 :].reshape(k, k)

    def run(batches):
        state = None
        for batch in slices(batches, BLOCK):
            if batch.num_rows:
                w = _centred(_matrix(batch.column(0)), n, sums) @ scaled
                mean = w.mean(0)
                own = (float(len(w)), mean, (w - mean).T @ (w - mean))
                state = joined([own] if state is None else [unpacked(state), own])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], names=["state"])

    return unpacked(_merged(fit.mapInArrow(leanly(run), "state binary"), lambda states: joined([unpacked(s) for s in states])))[2] / n


def whitened(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """id_col, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error: a row per vector and component.

    n: rows of the fit list. deviation: the sum of (n * x - S)^2 over all places, exact. explained: the component's share of the
    trace. identity_error: the largest entry of the whitened fit list's covariance less the identity, one value for all rows.
    """
    rows = gridded(vectors, id_col, vector_col, scale, shift)
    fit = written(rows.select("x").distinct(), "fit")
    n, sums = _totals(fit)
    d = len(sums)
    r = _factor(fit, n, sums) if n else np.zeros((0, 0))
    squares, made = directions(r, components)
    values, trace = squares / max(n, 1), float((r * r).sum()) / max(n, 1)
    k = len(values)
    scaled = made / np.sqrt(values)
    error = float(np.abs(_covered(fit, n, sums, scaled) - np.eye(k)).max()) if k else 0.0
    shares = values / trace if k else values

    def run(batches):
        for batch in slices(batches, BLOCK):
            if not (batch.num_rows and k):
                continue
            own = _scaled(_matrix(batch.column(1)), n, sums)
            if own.dtype == object or d * _most(own) ** 2 >= 1 << 63:
                own = own.astype(object)
            deviation = [int(x) if x < 1 << 63 else None for x in (own * own).sum(1).tolist()]
            w = (own.astype(float) / n) @ scaled
            at = np.repeat(np.arange(len(w)), k)
            columns = [
                batch.column(0).take(pa.array(at)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                pa.array(np.full(len(at), n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(at)),
                pa.array(w.ravel()),
                pa.array(np.tile(shares, len(w))),
                pa.array(np.full(len(at), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(leanly(run), f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)
