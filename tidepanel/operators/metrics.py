"""Risk, shape, concentration and dependence metrics of many series at once.

Input is long: (series, ord, x), x finite or null. Metrics of values start from counts of distinct values, placed in order by ranges;
metrics of order work on parts of a series (ranks.Parts), whose beginnings carry sums or peaks of the parts before. So no task holds
a long series whole. A metric whose guard fails is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import divided
from ..sources.stored import stored
from . import ranks

KEY = ["series"]


def cleaned(long: DataFrame) -> DataFrame:
    return long.where((F.abs("x") < float("inf")) & ~F.isnan("x"))


def returns(long: DataFrame, kind: str = "simple") -> DataFrame:
    """Changes between neighbours by ord; what is not finite drops out."""
    parts = ranks.Parts(cleaned(long), KEY, "ord", 1)
    return _returns(parts, F.col("x"), kind)


def _returns(parts: ranks.Parts, x: Column, kind: str = "simple") -> DataFrame:
    last = F.lag(x).over(parts.window())
    change = divided(x, last) - 1 if kind == "simple" else F.when((x > 0) & (last > 0), F.ln(x) - F.ln(last))
    return cleaned(parts.rows.withColumn("_change", change).where("_own").select("series", "ord", F.col("_change").alias("x")))


def drawdowns(long: DataFrame, as_returns: bool = True) -> DataFrame:
    """(series, ord, dd): wealth over its running peak, less 1. Wealth is the level, or the product of 1 + returns.

    The product is kept as log, sign and zeros, so that it neither overflows nor loses factors of 0 or below.
    """
    return _drawdowns(ranks.Parts(cleaned(long), KEY, "ord"), as_returns)


def _drawdowns(parts: ranks.Parts, as_returns: bool) -> DataFrame:
    rows, window = parts.rows.where("_own"), parts.window()
    if as_returns:
        f = 1 + F.col("x")
        terms = {"size": F.when(f != 0, F.ln(F.abs(f))).otherwise(0.0), "flips": F.when(f < 0, 1).otherwise(0), "zeros": F.when(f == 0, 1).otherwise(0)}
        rows = parts.carried(rows, {f"_{n}": (x, "sum") for n, x in terms.items()})
        so_far = {n: F.coalesce(f"_{n}", F.lit(0)) + F.sum(x).over(window) for n, x in terms.items()}
        rows = rows.select("series", "ord", "_i", "_part", *(x.alias(n) for n, x in so_far.items()))
        wealth = F.when(F.col("zeros") > 0, 0.0).otherwise(F.exp("size") * F.when(F.col("flips") % 2 == 1, -1.0).otherwise(1.0))
    else:
        wealth = F.col("x")
    paths = parts.carried(rows.select("series", "ord", "_i", "_part", wealth.alias("w")), {"_peak": (F.col("w"), "max")})
    peak = F.greatest("_peak", F.max("w").over(window))
    return paths.withColumn("_top", peak).select("series", "ord", (divided("w", "_top") - 1).alias("dd"))


LEVEL = 0.95


def shape(long: DataFrame, threshold: float = 0.0, bins: int = 20, top: float = 0.01, level: float = LEVEL) -> DataFrame:
    """A row per series: all metrics that need no order but that of values.

    Concentration metrics are over values of 0 or more (the Theil index and the Hill index: above 0); others are left out.
    """
    x, k = F.col("x"), F.col("k")
    counts = stored(cleaned(long).groupBy("series", "x").agg(F.count("*").alias("k")), "values")
    distinct = counts.count()
    not_negative, positive = x >= 0, x > 0
    weigh = lambda v, cond=None: F.sum(v * k) if cond is None else F.sum(F.when(cond, v * k))
    placed = ranks.placed(counts, KEY, "x", "k", distinct)
    one = ranks.points(
        placed, KEY, "x", {"median": 0.5, "q_low": 1 - level, "q_high": level, "q25": 0.25, "q75": 0.75, "q10": 0.1, "q90": 0.9, **ranks.QUARTERS}, "k",
        [
            F.sum("k").alias("n"), weigh(x).alias("sum"), F.min("x").alias("lo"), F.max("x").alias("hi"),
            F.coalesce(F.sum(F.when(not_negative, k)), F.lit(0)).alias("n0"), weigh(x, not_negative).alias("sum0"), weigh(x * x, not_negative).alias("squares0"),
            F.coalesce(F.sum(F.when(positive, k)), F.lit(0)).alias("n1"), weigh(x, positive).alias("sum1"),
        ],
    ).withColumn("mean", F.col("sum") / F.col("n")).drop("_n")
    near = stored(placed.join(one, "series"), "values-placed")
    one = near.groupBy("series").agg(*(F.first(c).alias(c) for c in one.columns if c != "series"))
    dev = x - F.col("mean")
    down, up = F.least(x - threshold, F.lit(0.0)), F.greatest(x - threshold, F.lit(0.0))
    place = F.col("_begin") - (F.col("n") - F.col("n0"))  # among the values that are not negative
    above = F.col("n") - F.col("_begin") - k  # how many values are larger
    most = F.greatest(F.lit(1), F.ceil(F.lit(top) * F.col("n0")))
    tail = F.least(F.greatest(F.lit(10), F.floor(F.col("n1") / 10)), F.col("n1") - 1)
    taken = lambda m: F.least(k, F.greatest(F.lit(0), m - above))
    r = x / (F.col("sum1") / F.col("n1"))
    sums = near.groupBy("series").agg(
        (weigh(x, x <= F.col("q_low")) / F.sum(F.when(x <= F.col("q_low"), k))).alias("tail_mean"),
        F.sqrt(weigh(down * down) / F.max("n")).alias("downside_deviation"),
        F.sqrt(weigh(up * up) / F.max("n")).alias("upside_deviation"),
        F.when(F.max("n") > 1, F.coalesce(divided(weigh(dev * dev, dev < 0), F.sum(F.when(dev < 0, k))), F.lit(0.0))).alias("semivariance"),
        (weigh(F.abs(dev)) / F.max("n")).alias("mean_abs_deviation"),
        *((weigh(F.pow(dev, F.lit(p)))).alias(f"m{p}") for p in (2, 3, 4)),
        (weigh(r * F.ln(r), positive) / F.max("n1")).alias("theil_index"),
        divided(weigh(up), -weigh(down)).alias("omega_ratio"),
        F.sum(F.when(not_negative, x * (k * (place + 1) + k * (k - 1) / 2))).alias("ranked"),
        F.sum(F.when(not_negative, x * taken(most))).alias("top_sum"),
        F.when(F.max("n1") >= 10, F.sum(F.when(positive, F.ln(x) * taken(tail))) / F.max(tail) - F.max(F.when(positive & (above <= tail) & (tail < above + k), F.ln(x)))).alias("hill"),
    )
    mad = ranks.median_distance(near, KEY, "x", "k", "median", distinct)
    s = F.col
    out = one.join(sums, "series").join(mad, "series").join(entropy(near, bins), "series", "left")
    n = s("n").cast("double")
    var = s("m2") / n
    g1 = F.when((s("n") > 3) & (var > 0), s("m3") / n / F.pow(var, F.lit(1.5)) * F.sqrt(n * (n - 1)) / F.try_subtract(n, F.lit(2.0)))
    g2 = F.when((s("n") > 3) & (var > 0), F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * (s("m4") / n / (var * var) - 3) + 6))
    out = out.withColumns({"std": F.sqrt(F.try_divide(s("m2"), n - 1)), "moment_skewness": g1, "excess_kurtosis": g2})
    iqr, wide = s("q75") - s("q25"), s("q90") - s("q10")
    bias = 3 * F.pow(n - 1, F.lit(2)) / F.when(s("n") > 3, (n - 2) * (n - 3))
    return out.select(
        "series", "n", "mean", "std", "median", "moment_skewness", "excess_kurtosis", "downside_deviation", "upside_deviation", "semivariance", "mean_abs_deviation", "theil_index", "omega_ratio",
        F.when(s("sum0") > 0, 2 * s("ranked") / (s("n0") * s("sum0")) - (s("n0") + 1) / s("n0")).alias("gini_coefficient"),
        F.when(s("sum0") > 0, s("top_sum") / s("sum0")).alias("top_concentration"),
        divided(F.lit(1.0), "hill").alias("hill_tail_index"),
        "shannon_entropy",
        (-s("q_low")).alias("value_at_risk"),
        (-s("tail_mean")).alias("conditional_var"),
        divided(F.abs(s("q_high")), F.abs(s("q_low"))).alias("tail_ratio"),
        divided("mad", F.abs("median")).alias("robust_cv_mad"),
        divided(iqr, F.abs("median")).alias("robust_cv_iqr"),
        divided(iqr, s("q75") + s("q25")).alias("quartile_coeff_dispersion"),
        divided("std", F.abs("mean")).alias("coefficient_of_variation"),
        divided(s("q75") + s("q25") - 2 * s("median"), iqr).alias("bowley_skewness"),
        divided(s("q90") + s("q10") - 2 * s("median"), wide).alias("kelly_skewness"),
        divided(s("mean") - s("median"), "std").alias("nonparametric_skew"),
        divided(s("moment_skewness") * s("moment_skewness") + 1, s("excess_kurtosis") + bias).alias("bimodality_coefficient"),
        (n / 6 * (s("moment_skewness") * s("moment_skewness") + s("excess_kurtosis") * s("excess_kurtosis") / 4)).alias("jarque_bera"),
        F.when(s("sum0") > 0, s("squares0") / (s("sum0") * s("sum0"))).alias("herfindahl_index"),
    )


def entropy(near: DataFrame, bins: int = 20, normalized: bool = True) -> DataFrame:
    """Entropy of a histogram of equal bins from lo to hi (the last one closed; half a unit around a constant); k rows have the value x."""
    flat = F.col("lo") == F.col("hi")
    lo, width = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), F.when(flat, 1.0).otherwise(F.col("hi") - F.col("lo"))
    at = F.least(F.floor((F.col("x") - lo) / width * bins), F.lit(bins - 1))
    counts = near.groupBy("series", at.alias("bin")).agg(F.sum("k").alias("c"), F.max("n").alias("n"))
    p = F.col("c") / F.col("n")
    h = -F.sum(p * F.ln(p))
    return counts.groupBy("series").agg((F.coalesce(divided(h, F.ln(F.count("*"))), F.lit(0.0)) if normalized else h).alias("shannon_entropy"))


def drawdown_metrics(long: DataFrame, as_returns: bool = True) -> DataFrame:
    """Largest and mean drawdown and the ulcer index, of two values at least."""
    d, enough = F.col("dd"), F.count("*") > 1
    return drawdowns(long, as_returns).groupBy("series").agg(F.when(enough, -F.min(d)).alias("max_drawdown"), F.when(enough, -F.avg(d)).alias("average_drawdown"), F.when(enough, F.sqrt(F.avg(10_000 * d * d))).alias("ulcer_index"))


def performance(long: DataFrame, rf: float = 0.0, periods: float = 1.0, as_returns: bool = True) -> DataFrame:
    """Realised volatility, Sharpe, Sortino and Calmar ratios; annualised by periods a year."""
    x = cleaned(long)
    r = x if as_returns else returns(x)
    low = F.least(F.col("x") - rf, F.lit(0.0))
    own = r.groupBy("series").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"), F.when(F.count("x") > 1, F.sqrt(F.avg(low * low))).alias("d"))
    level = x.groupBy("series").agg(F.avg("x").alias("level"))
    root = periods**0.5
    out = level.join(own, "series", "left").join(drawdown_metrics(x, as_returns), "series", "left")
    return out.select("series", (F.col("s") * root).alias("realized_volatility"), (divided(F.col("m") - rf, "s") * root).alias("sharpe_ratio"), (divided(F.col("m") - rf, "d") * root).alias("sortino_ratio"), divided(F.col("level") * periods, "max_drawdown").alias("calmar_ratio"))


def rolling_volatility(long: DataFrame, window: int = 12, least: int | None = None, as_returns: bool = True) -> DataFrame:
    """Each row with the sample deviation of the last window rows (of returns), null below least values. Rows without ord drop out."""
    parts = ranks.Parts(long, KEY, "ord", window)
    rows = parts.rows.withColumn("_r", F.col("x") if as_returns else divided("x", F.lag("x").over(parts.window())) - 1)
    w = parts.window().rowsBetween(1 - window, 0)
    rolled = F.when(F.count("_r").over(w) >= (least or max(2, window // 3)), F.stddev_samp("_r").over(w))
    return rows.withColumn("volatility", rolled).where("_own").drop("_r", "_i", "_n", "_part", "_own")


def autocorrelation(long: DataFrame, lag: int = 1) -> DataFrame:
    return _autocorrelation(ranks.Parts(cleaned(long), KEY, "ord", lag), lag)


def _autocorrelation(parts: ranks.Parts, lag: int) -> DataFrame:
    rows = parts.rows.withColumn("y", F.lag("x", lag).over(parts.window())).where("_own and y is not null")
    varies = (F.stddev_pop("x") > 0) & (F.stddev_pop("y") > 0)
    return rows.groupBy("series").agg(F.when(varies, F.corr("x", "y")).alias("autocorrelation"))


def hurst(long: DataFrame, points: int = 20) -> DataFrame:
    """Hurst exponent by rescaled ranges over at most points window lengths from 4 to n/2, spaced by logs (n >= 20).

    Each part of a series gives, for every length, the ranges of the segments that lie within it, and a summary of those that it shares
    with its neighbours: count, mean, squares and the convex hull of the running sums. The largest and least deviation from any mean are at corners of the hull,
    so the segment's mean, known when all its parts are, needs no second look at rows. No row is copied for a length.
    """
    return _hurst(ranks.Parts(cleaned(long), KEY, "ord"), long.schema["series"].dataType.simpleString(), points)


def window_lengths(n: int, points: int) -> list[int]:
    """Window lengths from 4 to n/2, spaced by logs, each once."""
    top, low = np.log10(float(n // 2)), np.log10(4.0)
    step = (top - low) / (points - 1)
    return list(dict.fromkeys(n // 2 if k == points - 1 else int(np.floor(10.0 ** (low + k * step) + 1e-9)) for k in range(points)))


def corners(s: np.ndarray) -> np.ndarray:
    """Places of the corners of the convex hull of (i, s[i]), a few others among them.

    A point on or below the line between its neighbours is no upper corner, and all such points may go at once; so with lower ones.
    """
    kept = []
    for sign in (1.0, -1.0):
        at = np.arange(len(s))
        while len(at) > 2:
            y = sign * s[at]
            left, right = np.diff(y[:-1]) * np.diff(at)[1:], np.diff(y[1:]) * np.diff(at)[:-1]
            stays = np.r_[True, left > right, True]
            if stays.all():
                break
            at = at[stays]
        kept.append(at)
    return np.union1d(*kept)


def _ranges(x: np.ndarray, first: int, n: int, points: int) -> Iterator[tuple]:
    """For the rows of a part, which begin at place first of n: (length, k, sum of k whole segments' ranges) and (length, segment, place of the piece, size, mean, squares, corners' places and sums)."""
    hulls: dict[tuple[int, int], tuple] = {}
    for size in window_lengths(n, points):
        stop = min(first + len(x), n // size * size)
        begin, end = -(-first // size) * size, stop // size * size
        if begin < end:
            own = x[begin - first : end - first].reshape(-1, size)
            dev = own - own.mean(1, keepdims=True)
            sd = np.sqrt((dev * dev).mean(1))
            run = dev.cumsum(1)
            good = sd > 0
            yield size, int(good.sum()), float(((run.max(1) - run.min(1))[good] / sd[good]).sum()), None, None, None, None, None, None, None
        for a, b in ((first, min(begin, stop)), (max(end, begin), stop)):
            if a < b:
                if (a, b) not in hulls:
                    own = x[a - first : b - first]
                    run, mean = own.cumsum(), own.mean()
                    at = corners(run)
                    hulls[a, b] = b - a, float(mean), float(((own - mean) ** 2).sum()), (at + 1).tolist(), run[at].tolist()
                yield size, None, None, a // size, a % size, *hulls[a, b]


_PIECE = "len long, k long, total double, seg long, start long, size long, mean double, squares double, at array<long>, sums array<double>"


def _hurst(parts: ranks.Parts, kind: str, points: int) -> DataFrame:
    names = [f.split()[0] for f in _PIECE.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i")
        rows = list(_ranges(pdf["x"].to_numpy(float), int(pdf["_i"].iloc[0]), int(pdf["_n"].iloc[0]), points))
        return pd.DataFrame({"series": pd.Series([pdf["series"].iloc[0]] * len(rows), dtype=object), **{c: pd.Series(list(v), dtype=object) for c, v in zip(names, zip(*rows) if rows else [[]] * len(names))}})

    rows = parts.rows.where("_own and _n >= 20").select("series", "_part", "_i", "_n", F.col("x").cast("double").alias("x"))
    made = rows.groupBy("series", "_part").applyInPandas(run, f"series {kind}, {_PIECE}")
    sums = made.where("seg is null").groupBy("series", "len").agg(F.sum("k").alias("k"), F.sum("total").alias("total"))
    if not parts.single:
        made = stored(made, "pieces")
        sums = made.where("seg is null").groupBy("series", "len").agg(F.sum("k").alias("k"), F.sum("total").alias("total"))
        segment = ["series", "len", "seg"]
        pieces = made.where("seg is not null")
        means = pieces.groupBy(*segment).agg((F.sum(F.col("mean") * F.col("size")) / F.sum("size")).alias("m"))
        before = Window.partitionBy(*segment).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        own = pieces.withColumn("base", F.coalesce(F.sum(F.col("mean") * F.col("size")).over(before), F.lit(0.0))).join(means, segment)
        dev = F.transform(F.arrays_zip("at", "sums"), lambda p: F.col("base") + p["sums"] - (F.col("start") + p["at"]) * F.col("m"))
        off = F.col("mean") - F.col("m")
        spread = own.select(*segment, F.array_max(dev).alias("hi"), F.array_min(dev).alias("lo"), (F.col("squares") + F.col("size") * off * off).alias("sq"), "size").groupBy(*segment)
        shared = spread.agg(divided(F.max("hi") - F.min("lo"), F.sqrt(F.sum("sq") / F.sum("size"))).alias("rs"))
        sums = sums.union(shared.groupBy("series", "len").agg(F.count("rs").alias("k"), F.sum("rs").alias("total"))).groupBy("series", "len").agg(F.sum("k").alias("k"), F.sum("total").alias("total"))
    mean = sums.select("series", "len", divided("total", F.col("k")).alias("rs")).where("rs > 0")
    return mean.groupBy("series").agg(F.when(F.count("*") >= 3, F.regr_slope(F.ln("rs"), F.ln("len"))).alias("hurst_exponent"))


def financial_metrics(long: DataFrame, periods: float = 1.0, as_returns: bool = True) -> DataFrame:
    """(series, metric, value): all metrics of all series; return-based ones use returns, the others the values given."""
    r = cleaned(long) if as_returns else returns(long)
    from_returns = ("value_at_risk", "conditional_var", "downside_deviation", "upside_deviation", "omega_ratio")
    values = shape(long).drop("n", "mean", "std", "median", *from_returns)
    wide = values
    for more in (shape(r).select("series", *from_returns), drawdown_metrics(long, as_returns), performance(long, 0.0, periods, as_returns), autocorrelation(long), hurst(long)):
        wide = wide.join(more, "series", "left")
    return wide.unpivot("series", [c for c in wide.columns if c != "series"], "metric", "value")
