"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are turned by a random rotation, which spreads their length evenly over the dimensions, and dealt to the
lists of their nearest centroids (fitted on about SAMPLE vectors; all rows are indexed). The number of lists grows with the
square root of the rows, up to a quarter of the sample. A query probes the lists nearest to it until they hold a share of all
distinct vectors: the least of SHARES with which TRIED vectors of the sample find RECALL of their nearest in the sample,
so that clustered vectors need few lists and scattered ones many; this is so at every size.

Within a list, distances grow by blocks of COLUMNS rotated dimensions; after each block a hypothesis test drops
candidates whose partial distance, scaled to all dimensions, exceeds the query's k-th best so far by more than chance
allows (EPSILON), and the k that look nearest are measured, which tightens that limit. The nearest list of each query is scanned first;
its k-th distance is the limit with which the other lists begin. Survivors are measured exactly, on
original vectors in double precision. Lists are cut into blocks of about BLOCK vectors and queries into parts of QUERIES, so a list
that holds a large share of all vectors is spread over many tasks, and none grows with the input. Of rows of one
Arrow batch with equal vectors only the k + 1 smallest ids are indexed: more of them are in nobody's first k.

Defined results: vectors take part if they are not null, hold only finite numbers, are not zero and have the length that
most such vectors have (the shorter one if two are as frequent); rows with a null id take no part. An id is one candidate and one
query: repeated rows count once; of rows that share an id but not a vector the nearest counts as a candidate, the smallest vector asks.
Ties go to smaller ids. Without vectors that take part there are no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import leanly, written

SAMPLE = 20_000
SHARES, RECALL, TRIED = (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0), 0.98, 400
COLUMNS, EPSILON = 16, 2.1
#: Vectors of a block at most, their bytes, and queries that meet a block at a time: a query is sent once to each block of the lists that it probes.
BLOCK, BLOCK_BYTES, QUERIES = 16_384, 16 << 20, 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part, as a written table."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = "id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    rows = written(own.where(fine), "vectors")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows if size is None else rows.where(F.size("v") == size.n)


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, n: int, seed: int = 11, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from random distinct vectors of the sample."""
    own = np.unique(sample, axis=0)
    c = own[np.random.default_rng(seed).choice(len(own), min(n, len(own)), replace=False)]
    for _ in range(rounds):
        at = _nearest(own, c)
        order = np.argsort(at, kind="stable")
        there, first = np.unique(at[order], return_index=True)
        c[there] = np.add.reduceat(own[order], first) / np.diff(np.r_[first, len(own)])[:, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    own = (c * c).sum(1)
    return np.concatenate([np.argmin(own - 2 * x[i : i + 1024] @ c.T, 1) for i in range(0, len(x), 1024)]) if len(x) else np.empty(0, np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, k - 1)[k - 1]) if len(values) >= k else np.inf


def scanned(q: np.ndarray, turned_q: np.ndarray, x: np.ndarray, turned: np.ndarray, ids: np.ndarray, own: int, k: int, limit: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the (up to k) candidates nearest to q and no farther than limit, one for each id, by the adaptive scan.

    Distances are exact; limit must be no smaller than the k-th distance that is sought.
    """
    dim, slack = len(q), 1e-9 * np.sqrt((q * q).sum())  # what the rotation may round
    alive = np.flatnonzero(ids != own)
    part, known = np.zeros(len(alive)), np.full(len(x), np.nan)

    def exact(at):
        d = x[at] - q
        known[at] = np.sqrt((d * d).sum(1))

    for start in range(0, dim, COLUMNS):
        if not len(alive):
            break
        stop = min(dim, start + COLUMNS)
        d = turned[alive, start:stop] - turned_q[start:stop]
        part = part + (d * d).sum(1)
        near = alive[np.argpartition(part, k - 1)[:k]] if len(alive) > k else alive
        exact(near[np.isnan(known[near])])
        best: dict[int, float] = {}  # ids that have been measured, by their nearest row
        measured = np.flatnonzero(~np.isnan(known))
        for i, z in zip(ids[measured].tolist(), known[measured].tolist()):
            best[i] = min(z, best.get(i, np.inf))
        limit = min(limit, _kth(np.fromiter(best.values(), float, len(best)), k))
        if stop < dim:
            good = np.sqrt(part * (dim / stop)) <= (1 + EPSILON / np.sqrt(stop)) * limit + slack
            alive, part = alive[good], part[good]
    exact(alive[np.isnan(known[alive])])
    at = np.flatnonzero(known <= limit)
    at = at[np.lexsort((known[at], ids[at]))]
    at = at[np.r_[True, ids[at][1:] != ids[at][:-1]]] if len(at) else at  # the nearest row of each id
    at = at[np.lexsort((ids[at], known[at]))][:k]
    return at, known[at]


def _probed(queries: np.ndarray, c: np.ndarray, sizes: np.ndarray, least: float) -> list[np.ndarray]:
    """For each query the nearest lists that together hold at least least vectors."""
    out = []
    for i in range(0, len(queries), 256):
        order = np.argsort((c * c).sum(1) - 2 * queries[i : i + 256] @ c.T, 1, kind="stable")
        held = np.cumsum(sizes[order], 1)
        out += [o[: int(np.searchsorted(h, least)) + 1] for o, h in zip(order, held)]
    return out


def share_needed(x: np.ndarray, c: np.ndarray, k: int, seed: int = 13) -> float:
    """The least share of distinct vectors to probe, measured on the sample x."""
    own = np.unique(x, axis=0)
    at = _nearest(own, c)
    sizes = np.bincount(at, minlength=len(c))
    tried = np.random.default_rng(seed).choice(len(own), min(TRIED, len(own)), replace=False)
    true = []
    for i in tried:
        d = ((own - own[i]) ** 2).sum(1)
        d[i] = np.inf
        true.append(np.argsort(d)[: min(k, len(own) - 1)])
    for share in SHARES:
        lists = _probed(own[tried], c, sizes, share * len(own))
        hits = sum(np.isin(at[t], p).sum() for t, p in zip(true, lists))
        if hits >= RECALL * sum(map(len, true)):
            return share
    return 1.0


def _few_of_equal(ids: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Rows to keep, in order: of equal vectors those with the most smallest ids, each once."""
    h = x.view(np.uint64) @ (np.random.default_rng(5).integers(1, 1 << 62, x.shape[1], dtype=np.uint64) | np.uint64(1))
    order = np.lexsort((ids, h))
    g, i = h[order], ids[order]
    again = np.r_[False, (g[1:] == g[:-1]) & (i[1:] == i[:-1])]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    of = np.repeat(first, np.diff(np.r_[first, len(g)]))
    place = np.cumsum(~again) - np.cumsum(~again)[of]  # how many smaller ids share the hash
    same = (x[order] == x[order[of]]).all(1)  # hashes may meet by chance; such rows stay
    return np.sort(order[~same | (~again & (place < most))])


def _vectors(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.ascontiguousarray(np.asarray(batch.column(column).flatten()).reshape(batch.num_rows, -1))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", lists: int | None = None, probe: float | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each id that is divisible by every, its k nearest other ids."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part = int(1_000_000 * min(1.0, SAMPLE / n))
    near = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000)) < part).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").select("v").toArrow()
    if not near.num_rows:  # few ids, none of them in the sample
        near = rows.orderBy("id", "v").limit(1).select("v").toArrow()
    sample = np.asarray(near.column(0).combine_chunks().flatten()).reshape(near.num_rows, -1)
    turn = rotation(sample.shape[1])
    c = centroids(sample @ turn, lists or max(1, min(SAMPLE // 4, round(n**0.5 / 2))))
    probe = probe or share_needed(sample @ turn, c, k)
    shared = spark.sparkContext.broadcast((turn, c))  # at most SAMPLE / 4 centroids

    def placed(batches):
        turn, c = shared.value
        for batch in batches:
            if batch.num_rows:
                kept = batch.take(pa.array(_few_of_equal(batch.column(0).to_numpy(), _vectors(batch, 1), k + 1)))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(_nearest(_vectors(kept, 1) @ turn, c).astype(np.int32))], names=["id", "v", "list"])

    indexed = written(rows.mapInArrow(leanly(placed), "id long, v array<double>, list int"), "index")
    # how many vectors a list holds, which cuts it, and how many distinct ones, of which a query probes its share
    held = indexed.groupBy("list").agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("v"), 0.02).alias("different"))
    sizes, different = np.zeros(len(c), np.int64), np.zeros(len(c))
    for r in held.collect():  # a row a list
        sizes[r["list"]], different[r["list"]] = r["n"], r["different"]
    blocks = np.maximum(1, -(-sizes // max(1, min(BLOCK, BLOCK_BYTES // (8 * sample.shape[1])))))
    more = spark.sparkContext.broadcast(different)

    def asked(batches):
        turn, c = shared.value
        for batch in batches:
            if batch.num_rows:
                found = _probed(_vectors(batch, 1) @ turn, c, more.value, probe * more.value.sum())
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                first = np.concatenate([np.arange(len(f)) == 0 for f in found])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(found).astype(np.int32)), pa.array(first)], names=["id", "v", "list", "first"])

    askers = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = written(askers.mapInArrow(leanly(asked), "id long, v array<double>, list int, first boolean"), "queries")
    stored = indexed.withColumn("block", F.pmod(F.xxhash64("id", F.lit(4)), F.get(F.lit(blocks.tolist()), F.col("list"))).cast("int"))

    def scan(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if len(q) and len(x):
            turn, _ = shared.value
            a, b, ids = np.stack(q["v"]), np.stack(x["v"]), x["id"].to_numpy()
            turned_a, turned_b = a @ turn, b @ turn
            for i, (own, limit) in enumerate(zip(q["id"].tolist(), q["limit"].tolist())):
                at, d = scanned(a[i], turned_a[i], b, turned_b, ids, own, k, limit)
                for column, values in zip(out, (np.full(len(at), own), ids[at], d, np.full(len(at), d[-1] if len(d) == k else np.inf))):
                    column.append(values)
        kinds = (np.int64, np.int64, float, float)
        return pd.DataFrame({n: np.concatenate(v) if v else np.empty(0, t) for n, v, t in zip(("query_id", "vec_id", "score", "kth"), out, kinds)})

    def met(asks: DataFrame, name: str) -> DataFrame:
        """Each query beside each block of its lists; a list with many queries is read once for each part of them."""
        per = {r["list"]: -(-r["n"] // QUERIES) for r in asks.groupBy("list").agg(F.count("*").alias("n")).collect()}  # a row a list
        parts = F.get(F.lit([per.get(i, 0) for i in range(len(c))]), F.col("list"))
        there = stored.withColumn("parts", parts).where("parts > 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        own = asks.withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), parts).cast("int"))
        own = own.withColumn("block", F.explode(F.sequence(F.lit(0), F.get(F.lit((blocks - 1).tolist()), F.col("list")).cast("int"))))
        keys = ["list", "block", "part"]
        cells = own.select(*keys, "id", "v", "limit").groupBy(*keys).cogroup(there.select(*keys, "id", "v").groupBy(*keys))
        return written(cells.applyInPandas(scan, "query_id long, vec_id long, score double, kth double"), name)

    first = met(queries.where("first").withColumn("limit", F.lit(float("inf"))), "nearest-list")
    limits = first.groupBy(F.col("query_id").alias("id")).agg(F.min("kth").alias("limit"))
    rest = queries.where("not first").join(limits, "id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    found = first.union(met(rest, "other-lists")).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
