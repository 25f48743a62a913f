"""Correlations, clusters of columns, splits of rows and of columns, and the evidence tables about them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cut_left_closed, cut_right_closed, divided
from ..sources.stored import stored
from . import metrics, ranks
from .features import average_rank
from .profile import numeric_columns, profiled


def correlation(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """(col_a, col_b, r) for a < b in the order given: over the rows where both are present; null for constants.

    Sums of products of all pairs are products of matrices, which no built-in aggregate has: each task adds up its Arrow batches and
    sends one row a pair. Spearman's ranks are places among a column's values; they are taken per pair, by windows, only if a first look
    finds a missing cell.
    """
    names = list(columns or numeric_columns(df))
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")
    number = {c: F.col(c).cast("double") for c in names}
    rows = df.select(F.array(*number.values()).alias("v"))
    if method == "spearman":
        if not rows.where(F.exists("v", lambda x: x.isNull())).isEmpty():
            return _named(_ranked_pairs(rows, len(names)), names)
        cells = rows.withColumn("row", F.monotonically_increasing_id()).select("row", F.posexplode("v").alias("i", "x"))
        values = ranks.placed(cells.groupBy("i", "x").agg(F.count("*").alias("k")), ["i"], "x", "k")
        own = cells.join(values.select("i", "x", (F.col("_begin") + (F.col("k") + 1) / 2).alias("rank")), ["i", "x"])
        rows = own.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("i", "rank"))).alias("v")).select(F.col("v.rank").alias("v"))
    middle = df.agg(*(F.avg(x).alias(f"m{i}") for i, x in enumerate(number.values()))).select(F.array(*(F.coalesce(f"m{i}", F.lit(0.0)) for i in range(len(names)))).alias("m"))
    if method == "spearman":
        middle = rows.agg((F.count("*") / 2).alias("n")).select(F.array_repeat("n", len(names)).alias("m"))
    centred = rows.crossJoin(F.broadcast(middle)).select(F.zip_with("v", "m", lambda x, m: x - m).alias("v"))
    return _named(_products(centred, len(names)), names)


def _products(rows: DataFrame, width: int) -> DataFrame:
    """(i, j, r) from sums over rows (v: an array of width numbers, or nulls) of both present cells."""
    i, j = np.triu_indices(width, 1)
    names = ["n", "x", "y", "xx", "yy", "xy"]

    def run(batches):
        total = np.zeros((6, len(i)))
        for batch in batches:
            v = np.asarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)
            there = ~np.isnan(v)
            x, m = np.where(there, v, 0.0), there.astype(float)
            n, s, q, p = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            total += [n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, total)], names=["i", "j", *names])

    sums = rows.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in names)).groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in names))
    n, x, y, xx, yy, xy = map(F.col, names)
    a, b = n * xx - x * x, n * yy - y * y
    varies = (a > 1e-13 * n * xx) & (b > 1e-13 * n * yy)
    return sums.select("i", "j", F.when(varies, (n * xy - x * y) / F.sqrt(a) / F.sqrt(b)).alias("r"))


def _ranked_pairs(rows: DataFrame, width: int) -> DataFrame:
    """(i, j, r) of ranks among the rows where both cells are present; ranks are places of distinct values, so no task holds all rows of a pair."""
    left = rows.select("v", F.explode(F.sequence(F.lit(0), F.lit(width - 2))).alias("i"))
    pairs = left.select("v", "i", F.explode(F.sequence(F.col("i") + 1, F.lit(width - 1))).alias("j"))
    long = pairs.select("i", "j", F.get("v", F.col("i")).alias("x"), F.get("v", F.col("j")).alias("y")).where("x is not null and y is not null")
    by = ["i", "j"]

    def ranked(side: str) -> DataFrame:
        counts = stored(long.groupBy(*by, side).agg(F.count("*").alias("k")), "values")
        return ranks.placed(counts, by, side, "k", counts.count()).select(*by, side, (F.col("_begin") + (F.col("k") + 1) / 2).alias(f"r{side}"))

    ranked = long.join(ranked("x"), [*by, "x"]).join(ranked("y"), [*by, "y"]).select(*by, F.col("rx").alias("x"), F.col("ry").alias("y"))
    return ranked.groupBy(*by).agg(F.when((F.stddev_pop("x") > 0) & (F.stddev_pop("y") > 0), F.corr("x", "y")).alias("r"))


def _named(r: DataFrame, names: Sequence[str]) -> DataFrame:
    named = F.array(*map(F.lit, names))
    return r.select(F.get(named, F.col("i")).alias("col_a"), F.get(named, F.col("j")).alias("col_b"), "r")


def correlation_clusters(r: DataFrame, columns: Sequence[str], n_clusters: int = 6, absolute: bool = True, linkage: str = "complete") -> dict[str, list[str]]:
    """Agglomerative clusters from a correlation table: at most a few hundred columns, whose table is brought here.

    Distances between clusters are kept up to date as clusters merge, so that no linkage is computed from its members
    again. The closest pair that comes first merges; a missing correlation counts as distance 1; the largest cluster comes first.
    """
    at, p = {c: i for i, c in enumerate(columns)}, len(columns)
    d = np.full((2 * p, 2 * p), np.inf)  # a new cluster takes the next row
    d[:p, :p][np.triu_indices(p, 1)] = 1.0
    for x in r.collect():  # p * (p - 1) / 2 rows
        if x.col_a in at and x.col_b in at:
            i, j = sorted((at[x.col_a], at[x.col_b]))
            d[i, j] = 1.0 - (0.0 if x.r is None else abs(x.r) if absolute else x.r)
    groups: list[list[str]] = [[c] for c in columns]
    alive = list(range(p))
    while len(alive) > max(1, min(n_clusters, p)):
        new = len(groups)
        a, b = divmod(int(d[:new, :new].argmin()), new)
        groups.append(groups[a] + groups[b])
        alive = [k for k in alive if k not in (a, b)]
        for k in alive:
            x, y = d[min(k, a), max(k, a)], d[min(k, b), max(k, b)]
            na, nb = len(groups[a]), len(groups[b])
            d[k, new] = max(x, y) if linkage == "complete" else min(x, y) if linkage == "single" else (na * x + nb * y) / (na + nb)
        for gone in (a, b):
            d[gone, :] = d[:, gone] = np.inf
        alive.append(new)
    order = sorted((groups[k] for k in alive), key=len, reverse=True)
    return {f"cluster_{i + 1}": g for i, g in enumerate(order)}


def redundancy(r: DataFrame, limits: Sequence[float] = (0.9, 0.95, 0.99)) -> DataFrame:
    """(threshold, n_pairs): pairs whose absolute correlation is above each threshold."""
    counts = r.agg(*(F.count_if(F.abs("r") > t).alias(f"t{i}") for i, t in enumerate(limits)))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("n_pairs")) for i, t in enumerate(limits)))).alias("x")).select("x.*")


def strongest(r: DataFrame, k: int = 8) -> DataFrame:
    return r.orderBy(F.abs("r").desc_nulls_last(), "col_a", "col_b").limit(k)


def terciles(df: DataFrame, score: Column, labels: Sequence[str]) -> DataFrame:
    """df with score and label: equal-count thirds, right-closed; null scores stay without a label. Equal edges are an error."""
    scored = stored(df.withColumn("score", score), "scored")
    shares = {"_0": 0.0, "_1": 1 / 3, "_2": 2 / 3, "_3": 1.0}
    points = ranks.quantiles(scored.select(F.col("score").cast("double").alias("x"), F.lit(1).alias("k")), [], "x", shares, "k", scored.count())
    edges = points.groupBy().agg(*(F.max(n).alias(n) for n in shares)).select(F.when(F.col("_0").isNotNull(), F.array(*shares)).alias("_e"))
    edges = edges.withColumn("_e", F.when(F.size(F.array_distinct("_e")) == 4, F.col("_e")).when(F.col("_e").isNull(), F.lit(None)).otherwise(F.raise_error(F.lit("tercile edges must differ")).cast("array<double>")))
    return scored.crossJoin(F.broadcast(edges)).withColumn("label", cut_right_closed("score", [F.col("_e")[1], F.col("_e")[2]], labels)).drop("_e")


def by_volatility(df: DataFrame, flow: str, window: int = 12, order: str = "time_bucket") -> DataFrame:
    long = df.withColumns({"series": F.lit(0), "ord": F.col(order), "x": F.col(flow)})
    rolled = metrics.rolling_volatility(long, window).drop("series", "ord", "x")
    return terciles(rolled, F.col("volatility"), ("calm", "normal", "turbulent")).drop("volatility")


def by_activity(df: DataFrame, activity: str) -> DataFrame:
    return terciles(df, F.col(activity).cast("double"), ("quiet", "active", "peak"))


def by_whales(df: DataFrame, volume: str, count: str) -> DataFrame:
    return terciles(df, divided(volume, count), ("retail", "mixed", "whale"))


def tail_scores(long: DataFrame) -> DataFrame:
    """(series, score): mean percent rank of kurtosis, quartile spread and heaviness of the tail, over those that exist."""
    s = metrics.shape(long).select("series", "excess_kurtosis", "robust_cv_iqr", (-F.col("hill_tail_index")).alias("tail"))
    s = s.withColumn("_all", F.lit(0))
    ranks = [average_rank(c, ("_all",)) / F.count(c).over(Window.partitionBy("_all")) for c in ("excess_kurtosis", "robust_cv_iqr", "tail")]
    total = sum((F.coalesce(r, F.lit(0.0)) for r in ranks), F.lit(0.0))
    return s.select("series", divided(total, sum((F.when(r.isNotNull(), 1).otherwise(0) for r in ranks), F.lit(0))).alias("score"))


def by_tail_risk(long: DataFrame) -> DataFrame:
    """(series, score, label) of columns."""
    own = tail_scores(long).withColumnRenamed("score", "_s")
    return terciles(own, F.col("_s"), ("stable", "moderate", "wild")).drop("_s")


def column_stat(df: DataFrame, stat: str | Mapping[str, float] | Callable[[DataFrame], DataFrame], columns: Sequence[str], order: str | None = None) -> DataFrame:
    """(column, value) of a statistic: a mapping, a function of the frame, a column of the profile, or a metric's name."""
    if isinstance(stat, Mapping):
        return df.sparkSession.createDataFrame(list(stat.items()), "column string, value double")
    if callable(stat):
        return stat(df)
    profile = profiled(df, columns)
    if stat in profile.columns:
        return profile.select("column", F.col(stat).cast("double").alias("value"))
    long = df.unpivot([order] if order else [], list(columns), "series", "x").select("series", F.col(order).alias("ord") if order else F.lit(0).alias("ord"), F.col("x").cast("double").alias("x"))
    return metrics.financial_metrics(long).where(F.col("metric") == stat).select(F.col("series").alias("column"), "value")


def columns_by_stat(df: DataFrame, stats: DataFrame, threshold: float, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """df cut into columns whose value is at most threshold, and above; columns without a value are in neither."""
    got = {r["column"]: r["value"] for r in stats.where("value is not null").collect()}  # one row a column
    return (df.select(*keep, *(c for c in df.columns if c in got and got[c] <= threshold)), df.select(*keep, *(c for c in df.columns if c in got and got[c] > threshold)))


def band_matrix(stats: DataFrame, names: Sequence[str], thresholds: Mapping[str, tuple[float, float]] | None = None, labels: Sequence[str] = ("low", "moderate", "high")) -> DataFrame:
    """(column, one band per statistic): fixed thresholds, or thirds of the columns; null where the edges are equal."""
    out = stats.select("column", *names)
    edges = out.agg(*(F.percentile(n, F.array(F.lit(0.0), F.lit(1 / 3), F.lit(2 / 3), F.lit(1.0))).alias(f"_{n}") for n in names))
    out = out.crossJoin(F.broadcast(edges))
    bands = {}
    for n in names:
        if thresholds and n in thresholds:
            bands[n] = cut_left_closed(n, thresholds[n], labels)
        else:
            e = F.col(f"_{n}")
            bands[n] = F.when(F.size(F.array_distinct(e)) == 4, cut_right_closed(n, [e[1], e[2]], labels))
    return out.select("column", *(b.alias(f"{n}_band") for n, b in bands.items()))


def balance(df: DataFrame, label: str = "label") -> DataFrame:
    n = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def group_stats(df: DataFrame, columns: Sequence[str], agg: str = "median", label: str = "label") -> DataFrame:
    """(column, group, value): an aggregate of each column over each group and over ALL rows."""
    how = {"std": "stddev_samp", "mean": "avg"}.get(agg, agg)
    own = df.select(F.explode(F.array(F.col(label), F.lit("ALL"))).alias("group"), *columns).where("group is not null")
    if agg == "median":  # from counts of distinct values, in order by ranges
        long = own.select("group", *(F.col(c).cast("double").alias(c) for c in columns)).unpivot("group", list(columns), "column", "x")
        counts = stored(long.groupBy("group", "column", "x").agg(F.count("*").alias("k")), "values")
        middle = ranks.quantiles(counts, ["group", "column"], "x", {"value": 0.5}, "k", counts.count())
        return counts.select("group", "column").distinct().join(middle, ["group", "column"], "left").select("column", "group", "value")
    wide = own.groupBy("group").agg(*(getattr(F, how)(F.col(c).cast("double")).alias(c) for c in columns))
    return wide.unpivot("group", list(columns), "column", "value")


def coherence(r: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """(cluster, mean_r): mean correlation within each cluster, and over all pairs."""
    of = r.sparkSession.createDataFrame([(c, g) for g, cs in groups.items() for c in cs], "column string, cluster string")
    a, b = of.select(F.col("column").alias("col_a"), F.col("cluster")), of.select(F.col("column").alias("col_b"), F.col("cluster").alias("other"))
    inner = r.join(F.broadcast(a), "col_a").join(F.broadcast(b), "col_b").where("cluster = other").groupBy("cluster").agg(F.avg("r").alias("mean_r"))
    return inner.union(r.agg(F.lit("overall").alias("cluster"), F.avg("r").alias("mean_r")))


def robust_profile(df: DataFrame, columns: Sequence[str], label: str = "label", stats: Sequence[str] = ("median", "iqr", "mad")) -> DataFrame:
    return profiled(df.where(F.col(label).isNotNull()), columns, by=(label,)).select(label, "column", *stats)


def group_means(groups: DataFrame, scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(label, means) of columns' metrics over the groups that the columns (series) are in."""
    return groups.select("series", "label").join(scores, "series").groupBy("label").agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in columns))
