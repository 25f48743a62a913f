"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals make scores and offsets.

Labels mark documents, so tokens are labelled first: a word, or one of its beginnings of 3 to 5 letters, marks toxic
tokens if the labelled texts that hold it are toxic far more often than chance allows: binomial tails are bounded
(Chernoff) and a share of at most FALSE of the features taken is expected to be there by chance (Benjamini and Hochberg), at any
number of labels. The field has two states, weights for such features of a token and of its two neighbours, a bias,
and transitions; it is trained by gradient ascent on windows of tokens. The step from marginals to a text's score is
calibrated on texts that their field was not trained on: FOLDS fields each leave out one part of the labelled texts and
score it. The field that scores all texts is then trained on all of them. Nothing depends on how many labels there are.

At most SAMPLE labelled documents, FEATURES features and WINDOWS different windows a fold (arguments of fit) take part in
training; these bounds are parameters. Scoring covers all tokens of all texts. Tokens that neither have a feature nor
stand beside one are alike, so a run of k of them is the k-th power of one matrix, which keeps forward-backward exact and short.

Only texts are inputs of a score. Defined results: null and empty texts get the score of a text without features;
ties and repeated rows get equal scores; without labels of both kinds every text gets the smoothed share of toxic ones;
an empty table gives no rows; other columns, whatever their names, are ignored, or kept by clean().
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE_BYTES, Cache, id_bitmap, leanly, may_hold, slices, written

SAMPLE, FEATURES, WINDOWS, SPAN = 12_000, 40_000, 20_000, 15
FALSE, FOLDS, STEPS, PENALTY = 0.1, 5, 60, 0.02
#: Where a feature may stand: at the token, before it, after it.
PLACES = (0, -1, 1)
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


def features_of(chunk: str) -> set[str]:
    """Words of a white-space chunk (lower case) and their beginnings, marked by ^."""
    found = set()
    for w in _WORD.findall(chunk):
        found.add(w)
        found.update("^" + w[:n] for n in (3, 4, 5) if len(w) > n)
    return found


@dataclass
class Field:
    """Weights by feature (for the toxic state; at the token, before it, after it), bias, transitions [from][to] in logs,
    and the calibration."""

    weights: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    bias: float = -4.0
    moves: tuple = ((0.0, 0.0), (0.0, 0.0))
    scale: tuple = (0.0, 0.0, -2.0)

    def __post_init__(self) -> None:
        self.chunks = Cache(self.emission, CACHE_BYTES)
        self.begins = {f[1:] for f in self.weights if f[0] == "^"}
        (a, b), (c, d) = ((exp(x) for x in row) for row in self.moves)
        q = exp(self.bias)
        self.t = (a, b, c, d)
        m = (a, b * q, c, d * q)  # a move and then a token without features
        half, det = (m[0] + m[3]) / 2, m[0] * m[3] - m[1] * m[2]
        root = max(1e-12, (half * half - det)) ** 0.5
        self.one, self.two, self.m = half + root, half - root, m
        self.powers: dict[int, tuple] = {}

    def emission(self, chunk: str) -> tuple[float, float, float] | None:
        """What the chunk adds to the log weight of the toxic state: to its own, and to those after and before it."""
        weights, begins, known = self.weights, self.begins, set()
        for w in _WORD.findall(chunk):
            if w in weights:
                known.add(w)
            known.update("^" + w[:n] for n in (3, 4, 5) if len(w) > n and w[:n] in begins)
        return tuple(map(sum, zip(*(weights[f] for f in sorted(known))))) if known else None

    def run(self, k: int) -> tuple:
        """The k-th power of m, divided by the k-th power of its larger eigenvalue."""
        if (p := self.powers.get(k)) is None:
            r, gap, (a, b, c, d) = (self.two / self.one) ** k, self.one - self.two, self.m
            x, y = self.two, self.one
            p = ((a - x) - r * (a - y)) / gap, (b - r * b) / gap, (c - r * c) / gap, ((d - x) - r * (d - y)) / gap
            if len(self.powers) < 100_000:
                self.powers[k] = p
        return p

    def marginals(self, n: int, at: list[int], emitted: list[float]) -> list[float]:
        """Probability of the toxic state at each token with features: forward-backward over n tokens."""
        a, b, c, d = self.t
        q = exp(self.bias)
        ahead, x, y, last = [], 1.0, 1.0, -1  # before the first token both states weigh the same
        for i, e in zip(at, emitted):
            if last < 0:
                if i > 0:
                    x, y = 1.0, q
                    p = self.run(i - 1)
                    x, y = x * p[0] + y * p[2], x * p[1] + y * p[3]
                    x, y = x * a + y * c, (x * b + y * d) * e
                else:
                    y = e
            else:
                p = self.run(i - last - 1)
                x, y = x * p[0] + y * p[2], x * p[1] + y * p[3]
                x, y = x * a + y * c, (x * b + y * d) * e
            s = x + y
            x, y, last = x / s, y / s, i
            ahead.append((x, y))
        out, u, v, nxt = [0.0] * len(at), 1.0, 1.0, n
        for k in range(len(at) - 1, -1, -1):
            i = at[k]
            gap = nxt - i - 1
            if k == len(at) - 1:
                p = self.run(gap)
                u, v = p[0] + p[1], p[2] + p[3]
            else:
                e = emitted[k + 1]
                u, v = a * u + b * e * v, c * u + d * e * v
                p = self.run(gap)
                u, v = p[0] * u + p[1] * v, p[2] * u + p[3] * v
            x, y = ahead[k]
            out[k] = y * v / (x * u + y * v)
            s = u + v
            u, v, nxt = u / s, v / s, i
        return out

    def tagged(self, text: str | None) -> tuple[list[int], list[float]]:
        """Places (in white-space chunks) of tokens with features or beside them, and their marginals."""
        chunks = (text or "").lower().split()
        known = self.chunks
        marked = {w: x for w in set(chunks) if (x := known[w]) is not None}
        if not marked:
            return [], []
        hits = [(i, marked[w]) for i, w in enumerate(chunks) if w in marked]
        total: dict[int, float] = {}
        for i, x in hits:
            for step, add in zip((0, 1, -1), x):
                if 0 <= i + step < len(chunks):
                    total[i + step] = total.get(i + step, 0.0) + add
        at = sorted(total)
        return at, self.marginals(len(chunks), at, [exp(max(-60.0, min(60.0, self.bias + total[i]))) for i in at])

    def score(self, marginals: list[float]) -> float:
        a, b, c = self.scale
        z = c + (a * max(marginals) + b * log1p(sum(marginals)) if marginals else 0.0)
        return 1 / (1 + exp(-min(60.0, max(-60.0, z))))


def labelled(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """id, text, y, fold of at most about sample documents whose labels may be learnt: crc32(id) mod 5 is not 0."""
    own = (
        labels.where(f"`{label_col}` in (0, 1)").groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("y"))
        .where("id is not null and crc32(cast(cast(id as string) as binary)) % 5 <> 0")
    )
    n = own.count()
    part = min(1.0, sample / max(1, n))
    own = written(own.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1_000_000)) < int(part * 1_000_000)).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(10)), F.lit(FOLDS)).cast("int")), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(may_hold(texts, "id", id_bitmap(own, "id")).join(own, "id").select("id", "text", "y", "fold"), "labelled")


def _counts(rows: DataFrame) -> DataFrame:
    """(feature, fold, texts, toxic) over labelled texts."""

    def run(batches):
        for batch in slices(batches):
            texts, ys, folds = (batch.column(i).to_pylist() for i in range(3))
            n, t = Counter(), Counter()
            for text, y, k in zip(texts, ys, folds):
                own = [(f, k) for f in set().union(*map(features_of, set((text or "").lower().split())))]
                n.update(own)
                if y:
                    t.update(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in n], pa.string()), pa.array([k for _, k in n], pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array([t[x] for x in n], pa.int64())], names=["feature", "fold", "texts", "toxic"]
            )

    return rows.select("text", "y", "fold").mapInArrow(leanly(run), "feature string, fold int, texts long, toxic long")


def _chosen(counts: DataFrame, sizes: list[tuple[int, int]], most: int = FEATURES) -> list[list[str]]:
    """For each fold the features that mark toxic texts outside it, and at last those of all texts; sizes: (texts, toxic) by fold.

    No more than most, the strongest ones, come to the driver.
    """
    n, t = (sum(x) for x in zip(*sizes))
    sums = [F.sum(c).alias(c) for c in ("texts", "toxic")]
    less = [F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in range(FOLDS) for c in ("texts", "toxic")]
    table = written(counts.groupBy("feature").agg(*sums, *less), "features")
    out = []
    for k in (*range(FOLDS), None):
        share = (t - (sizes[k][1] if k is not None else 0)) / max(1, n - (sizes[k][0] if k is not None else 0))
        if not 0 < share < 1:
            out.append([])
            continue
        own = table.select("feature", (F.col("texts") - (F.col(f"texts{k}") if k is not None else 0)).alias("n"), (F.col("toxic") - (F.col(f"toxic{k}") if k is not None else 0)).alias("t")).where("n > 2")
        rate = F.col("t") / F.col("n")
        term = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
        strength = F.col("n") * (term(rate, F.lit(share)) + term(1 - rate, F.lit(1 - share)))  # -log of a bound on the chance
        found = own.select("feature", rate.alias("rate"), strength.alias("s"))
        tested = found.count()
        best = found.where((F.col("rate") > share) & (F.col("s") > -log(FALSE))).orderBy(F.desc("s"), "feature").limit(most).collect()
        taken = max((i + 1 for i, r in enumerate(best) if -r.s <= log(FALSE * (i + 1) / tested)), default=0)
        out.append(distinctive({r.feature: r.s for r in best[:taken]}))
    return out


def distinctive(strength: dict[str, float]) -> list[str]:
    """The features in order, without beginnings that say no more than what they begin."""
    best: dict[str, float] = {}
    for f, x in strength.items():
        w = f.lstrip("^")
        for n in (3, 4, 5):
            if len(w) > n:
                best["^" + w[:n]] = max(x, best.get("^" + w[:n], 0.0))
    return sorted(f for f, x in strength.items() if x > best.get(f, 0.0))


def windows_of(chunks: list[str], known: dict[str, list[int]], y: int, kept: Callable[[int], bool] = lambda start: True) -> list[tuple[list[int], list[int], list[int]]]:
    """(feature numbers, their tokens, states) of windows of SPAN tokens that together cover all tokens with features of a
    text, and of two more at fixed places, if their first token is kept. known: the numbers, from 0, of each chunk's features; a
    feature before or after a token counts apart."""
    starts, end = {0, len(chunks) // 2} if chunks else set(), -1
    for i, w in enumerate(chunks):
        if i >= end and known[w]:
            starts.add(max(0, i - SPAN // 2))
            end = max(0, i - SPAN // 2) + SPAN
    out = []
    for s in sorted(starts):
        if kept(s):
            e, x, at = min(len(chunks), s + SPAN), [], []
            for i in range(s, e):
                for k, step in enumerate(PLACES):
                    if 0 <= i + step < len(chunks) and (own := known[chunks[i + step]]):
                        x += sorted(3 * f + k for f in own)
                        at += [i - s] * len(own)
            out.append((x, at, [int(bool(y and known[chunks[i]])) for i in range(s, e)] + [-1] * (SPAN - e + s)))
    return out


def _windows(rows: DataFrame, names: list[list[str]], most: int) -> list[tuple[np.ndarray, ...]]:
    """By fold (the last: all texts): feature numbers, their places (window * SPAN + token), states of the windows, and how
    many windows each one stands for: those without features are alike if they are of one length.

    All windows are made and counted where the texts are. No more than most different ones of each fold come to the driver: a priority
    sample, in which one that many texts have counts as often as it is there, and others stand for those left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast([{f: i for i, f in enumerate(own)} for own in names])

    def made(of: DataFrame) -> DataFrame:
        def run(batches):
            numbers = shared.value
            every = set().union(*numbers)
            for batch in slices(batches):
                out = []
                for text, y, fold in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    chunks = (text or "").lower().split()
                    found = {w: features_of(w) & every for w in set(chunks)}
                    for k, number in enumerate(numbers):
                        if number and k != fold:
                            known = {w: [number[f] for f in own if f in number] for w, own in found.items()}
                            out += [(k, *w) for w in windows_of(chunks, known, y)]
                columns = list(zip(*out)) or [[]] * 4
                kinds = [pa.int32(), *[pa.list_(pa.int32())] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["k", "x", "at", "y"])

        return of.select("text", "y", "fold").mapInArrow(leanly(run), "k int, x array<int>, at array<int>, y array<int>")

    table = written(made(rows).groupBy("k", "x", "at", "y").agg(F.count("*").alias("n")), "windows")
    out = []
    for k in range(len(names)):
        chance = (F.shiftrightunsigned(F.xxhash64("x", "at", "y"), 11) + 1) / float(1 << 53)
        first = table.where(F.col("k") == k).withColumn("p", F.col("n") / chance).orderBy(F.desc("p"), "x", "at", "y").limit(most + 1)
        got = first.select("x", "at", "y", "n", "p").toArrow()
        least = got.column("p")[most].as_py() if got.num_rows > most else 0.0
        got = got.slice(0, most)
        x, at, y, n = (got.column(i).combine_chunks() for i in range(4))
        first = np.repeat(np.arange(got.num_rows) * SPAN, np.diff(np.asarray(at.offsets)))
        out.append((np.asarray(x.flatten()), np.asarray(at.flatten()) + first, np.asarray(y.flatten()).reshape(-1, SPAN), np.maximum(np.asarray(n).astype(float), least)))
    return out


def trained(x: np.ndarray, at: np.ndarray, y: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions: gradient ascent (Adam) on the penalised log likelihood of the windows."""
    theta = np.r_[np.zeros(n), -3.0, np.zeros(4)]  # weights, bias, moves
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    real = (y >= 0).astype(float)
    gold = np.clip(y, 0, 1).astype(float)
    rows, span = y.shape
    size = times.sum()
    inside = real[:, 1:] * times[:, None]
    pair = np.stack([((gold[:, :-1] == i) & (gold[:, 1:] == j)) * inside for i in (0, 1) for j in (0, 1)], -1).sum((0, 1))
    for step in range(1, STEPS + 1):
        w, bias, moves = theta[:n], theta[n], np.exp(theta[n + 1 :].reshape(2, 2))
        own = np.bincount(at, w[x], rows * span).reshape(rows, span)
        e = np.stack([np.ones_like(gold), np.where(real > 0, np.exp(np.clip(bias + own, -40, 40)), 0.0)], -1)
        f = np.empty((rows, span, 2))
        g = np.ones((rows, span, 2))
        f[:, 0] = e[:, 0] / e[:, 0].sum(-1, keepdims=True)
        for t in range(1, span):
            new = (f[:, t - 1] @ moves) * e[:, t]
            new = np.where(real[:, t, None] > 0, new, f[:, t - 1])
            f[:, t] = new / new.sum(-1, keepdims=True)
        for t in range(span - 2, -1, -1):
            new = (g[:, t + 1] * e[:, t + 1]) @ moves.T
            new = np.where(real[:, t + 1, None] > 0, new, g[:, t + 1])
            g[:, t] = new / new.sum(-1, keepdims=True)
        p = f * g
        p = (p / p.sum(-1, keepdims=True))[..., 1] * real
        both = f[:, :-1, :, None] * moves * (e[:, 1:] * g[:, 1:])[:, :, None, :]
        both = both / np.maximum(both.sum((-1, -2), keepdims=True), 1e-300) * inside[..., None, None]
        off = (gold * real - p) * times[:, None] / size
        grad = np.r_[np.bincount(x, off.reshape(-1)[at], n), off.sum(), (pair - both.sum((0, 1)).reshape(-1)) / size]
        grad[:n] -= PENALTY * theta[:n] / size
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:n], float(theta[n]), theta[n + 1 :].reshape(2, 2)


def calibrated(a: np.ndarray, b: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on the largest marginal and the log of their sum, by Newton steps with a small penalty."""
    x = np.stack([a, b, np.ones(len(a))], 1)
    t = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        h = (x * (times * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag([0.1, 0.1, 0.01])
        t = t + np.linalg.solve(h, x.T @ (times * (y - p)) - np.array([0.1, 0.1, 0.01]) * t)
    return tuple(map(float, t))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, features: int = FEATURES, windows: int = WINDOWS) -> Field:
    """The field trained on at most so many labelled texts, features and different windows of each fold; what goes beyond is left
    out of the fit (the weakest features, windows outside of a sample), never of a score.
    """
    rows = labelled(docs, labels, sample, id_col, text_col, label_col)
    by = {r.fold: (r.n, r.t) for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("t")).collect()}
    sizes = [by.get(k, (0, 0)) for k in range(FOLDS)]
    n, t = (sum(x) for x in zip(*sizes))
    share = (t + 1) / (n + 2)
    plain = Field(scale=(0.0, 0.0, log(share / (1 - share))))
    if not 0 < t < n:
        return plain
    names = _chosen(_counts(rows), sizes, features)
    if not names[-1]:
        return plain
    models = []
    for own, taken in zip(names, _windows(rows, names, windows)):
        w, bias, moves = trained(*taken, 3 * len(own)) if own else (np.zeros(0), -4.0, np.zeros((2, 2)))
        models.append(Field({f: tuple(map(float, w[3 * i : 3 * i + 3])) for i, f in enumerate(own)}, bias, tuple(map(tuple, moves.tolist()))))
    a, b, truth, times = _left_out(rows, models)
    return Field(models[-1].weights, models[-1].bias, models[-1].moves, calibrated(a, np.log1p(b), truth, times))


def _left_out(rows: DataFrame, models: list[Field]) -> tuple[np.ndarray, ...]:
    """Largest and total marginals of labelled texts by the field of their fold, their labels, and how many texts have these."""
    shared = rows.sparkSession.sparkContext.broadcast([(m.weights, m.bias, m.moves, m.scale) for m in models])

    def run(batches):
        own = [Field(*x) for x in shared.value]
        for batch in slices(batches):
            p = [own[k].tagged(t)[1] for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([max(x, default=0.0) for x in p], pa.float64()), pa.array([float(sum(x)) for x in p], pa.float64()), batch.column(2)], names=["largest", "total", "y"])

    own = rows.select("text", "fold", "y").mapInArrow(leanly(run), "largest double, total double, y int")
    got = own.groupBy("largest", "total", "y").agg(F.count("*").alias("n")).orderBy("largest", "total", "y").toArrow()
    return tuple(np.asarray(got.column(i).combine_chunks()).astype(float) for i in range(4))


def scored(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score, largest and total marginal, and spans (start, end, marginal) of tokens that are likelier toxic than not."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.moves, model.scale))

    def run(batches):
        own = Field(*shared.value)
        for batch in slices(batches):
            score, largest, total, spans = [], [], [], []
            for text in batch.column(1).to_pylist():
                at, p = own.tagged(text)
                score.append(own.score(p))
                largest.append(max(p, default=0.0))
                total.append(float(sum(p)))
                spans.append(_spans(text, at, p) if largest[-1] >= 0.5 else [])
            kinds = [pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (score, largest, total, spans), kinds)], names=["id", "score", "largest", "total", "spans"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        leanly(run), f"id {kind}, score double, largest double, total double, spans array<struct<start: long, end: long, marginal: double>>"
    )
    return out.withColumnRenamed("id", id_col)


def _spans(text: str, at: list[int], p: list[float]) -> list[dict]:
    wanted = {i: x for i, x in zip(at, p) if x >= 0.5}
    out, place, n = [], 0, 0
    for chunk in text.split():
        place = text.index(chunk, place)
        if n in wanted:
            out.append({"start": place, "end": place + len(chunk), "marginal": wanted[n]})
        place += len(chunk)
        n += 1
    return out


def clean(docs: DataFrame, model: Field, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose score is below least."""
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.moves, model.scale))

    def run(batches):
        own = Field(*shared.value)
        for batch in slices(batches):
            yield batch.filter(pa.array([own.score(own.tagged(t)[1]) < least for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(leanly(run), docs.schema)
