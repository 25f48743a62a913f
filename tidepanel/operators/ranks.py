"""Places of rows in the order of a column, and series cut into parts, so that no task sorts a whole group.

Up to WHOLE rows, groups are put in order by one window each. More rows are dealt to ranges of about PART rows (their edges are
sampled by Spark, and their number grows with the rows); rows of equal order are told apart by a number of their own, so a value that all
rows share is cut like any other. Places within a range come from a window over group and range, and start at the sum of the
group's ranges before, of which there is one row each. Rows whose order is null take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..sources.stored import stored

#: Rows that a range or a part holds, and the most rows that are put in order without ranges.
PART, WHOLE = 100_000, 200_000


def _group(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


_BEFORE = Window.unboundedPreceding, -1


def placed(df: DataFrame, keys: Sequence[str], order: str, weight: str | None = None, most: int | None = None) -> DataFrame:
    """df with _begin, how many rows (or how much weight) of its group come before a row, and _n, those of the group. Ties get any order.

    df is stored, unless it is known to have at most so many rows and they are few.
    """
    k = F.col(weight) if weight else F.lit(1)
    there = df.where(F.col(order).isNotNull())
    if most is None or most > WHOLE:
        there = stored(there, "placed")
        most = there.count()
    if most <= WHOLE:
        return _windowed(there, keys, [order], k)
    at, starts = _ranges(there, keys, order, k, most, PART)
    own = _windowed(joined(at, starts.drop("_sum"), [*keys, "_range"]).withColumnRenamed("_n", "_all"), [*keys, "_range"], [order, "_tie"], k)
    return own.withColumns({"_begin": F.col("_start") + F.col("_begin"), "_n": F.col("_all")}).drop("_range", "_start", "_tie", "_all")


def _windowed(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: Column) -> DataFrame:
    group = _group(keys)
    return df.withColumns({"_begin": F.coalesce(F.sum(k).over(group.orderBy(*order).rowsBetween(*_BEFORE)), F.lit(0)), "_n": F.sum(k).over(group)})


def _ranges(there: DataFrame, keys: Sequence[str], order: str, k: Column, most: int, part: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows with _tie and _range; and of each group and range _sum, what is before it (_start), and the group's _n."""
    own = there.withColumn("_tie", F.monotonically_increasing_id())
    at = stored(own.repartitionByRange(-(-most // part), *keys, order, "_tie").withColumn("_range", F.spark_partition_id()), "ranges")
    sums = at.groupBy(*keys, "_range").agg(F.sum(k).alias("_sum"))
    before = _group(keys).orderBy("_range").rowsBetween(*_BEFORE)
    return at, sums.withColumns({"_start": F.coalesce(F.sum("_sum").over(before), F.lit(0)), "_n": F.sum("_sum").over(_group(keys))})


def joined(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by keys that may be null; without keys b has one row."""
    if not keys:
        return a.crossJoin(F.broadcast(b))
    right = b.withColumnsRenamed({c: f"_k_{c}" for c in keys})
    both = F.lit(True)
    for c in keys:
        both = both & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return a.join(right, both, how).drop(*(f"_k_{c}" for c in keys))


def points(rows: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], weight: str, more: Sequence[Column] = ()) -> DataFrame:
    """A row per group of placed() rows: exact quantiles by name, with linear interpolation between places, and more aggregates.

    A group keeps the rows that hold a place asked for, two a share at most.
    """
    stop = F.col("_begin") + F.col(weight)
    kept = F.collect_list(F.when(_held(shares, F.col("_begin"), stop), F.struct(F.col("_begin").alias("begin"), stop.alias("stop"), F.col(value).alias("value"))))
    own = rows.groupBy(*keys).agg(kept.alias("_held"), F.max("_n").alias("_n"), *more)
    there = lambda i: F.get(F.filter("_held", lambda h: (h["begin"] <= i) & (i < h["stop"])), F.lit(0))["value"]

    def between(x: Column) -> Column:
        part = x - F.floor(x)
        return F.when(part == 0, there(F.floor(x))).otherwise((1 - part) * there(F.floor(x)) + part * there(F.ceil(x)))

    return own.withColumns({n: between((F.col("_n") - 1) * s) for n, s in shares.items()}).drop("_held")


def _held(shares: dict[str, float], begin: Column, stop: Column) -> Column:
    """Whether a place asked for, or its neighbour, lies in begin..stop."""
    out = F.lit(False)
    for s in shares.values():
        x = (F.col("_n") - 1) * s
        out = out | ((begin < x + 1) & (x - 1 < stop))
    return out


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], weight: str, most: int) -> DataFrame:
    """(keys, _n, quantiles by name) of a stored df of at most so many rows; only ranges that hold a place asked for are put in order."""
    there = df.where(F.col(value).isNotNull())
    if most <= WHOLE:
        return points(_windowed(there, keys, [value], F.col(weight)), keys, value, shares, weight)
    at, starts = _ranges(there, keys, value, F.col(weight), most, PART // 8)
    asked = starts.where(_held(shares, F.col("_start"), F.col("_start") + F.col("_sum"))).drop("_sum").withColumnRenamed("_n", "_all")
    own = _windowed(joined(at, asked, [*keys, "_range"]), [*keys, "_range"], [value, "_tie"], F.col(weight))
    rows = own.withColumns({"_begin": F.col("_start") + F.col("_begin"), "_n": F.col("_all")})
    return points(rows, keys, value, shares, weight)


class Parts:
    """Rows of groups in order with _i (place from 0) and _n, cut into parts of PART rows (_part) where there are many; a group of few rows is one part.

    Each part also has, with _own false, the halo rows before it, so a window() that looks back at most so many rows sees what one
    over the whole group would.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: str, halo: int = 0) -> None:
        if halo > PART:
            raise ValueError("a part must hold the rows that are looked back at")
        there = stored(df.where(F.col(order).isNotNull()), "series")
        most = there.count()
        self.keys, self.single = list(keys), most <= WHOLE
        rows = placed(there, keys, order, most=most).withColumnRenamed("_begin", "_i")
        if self.single:
            self.rows = rows.withColumns({"_part": F.lit(0).cast("long"), "_own": F.lit(True)})
            return
        twice = F.explode(F.when(F.col("_i") % PART >= PART - halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))) if halo else F.lit(0)
        rows = rows.withColumn("_later", twice).withColumns({"_part": F.expr(f"_i div {PART}") + F.col("_later"), "_own": F.col("_later") == 0}).drop("_later")
        self.rows = stored(rows, "parts")

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "_part").orderBy("_i")

    def carried(self, rows: DataFrame, what: dict[str, tuple[Column, str]]) -> DataFrame:
        """rows, which have _part, with, by name, the aggregate of a column (its values, and the name of a function) over all parts before; null in the first one."""
        if self.single:
            return rows.select("*", *(F.when(F.lit(False), x).alias(n) for n, (x, _) in what.items()))
        by = rows.groupBy(*self.keys, "_part").agg(*(getattr(F, how)(x).alias(n) for n, (x, how) in what.items()))
        before = _group(self.keys).orderBy("_part").rowsBetween(*_BEFORE)
        return joined(rows, by.select(*self.keys, "_part", *(getattr(F, how)(n).over(before).alias(n) for n, (_, how) in what.items())), [*self.keys, "_part"])


#: Shares of a group below and above which values are surely nearer to, and farther from, the median than half of them; from so many rows on.
NEARER, FARTHER, SURE = (0.3, 0.7), (0.2, 0.8), 40
QUARTERS = {"_q20": FARTHER[0], "_q30": NEARER[0], "_q70": NEARER[1], "_q80": FARTHER[1]}


def median_distance(near: DataFrame, keys: Sequence[str], value: str, weight: str, median: str, most: int) -> DataFrame:
    """(keys, mad): the exact median of distances from the median, where near has QUARTERS of its values, _n and at most so many rows.

    Only distances that the quantiles leave open are put in order: the weight of all nearer ones is a sum.
    """
    sure, far, k = F.col("_n") >= SURE, F.abs(F.col(value) - F.col(median)), F.col(weight)
    low = F.when(sure, F.least(F.col(median) - F.col("_q30"), F.col("_q70") - F.col(median))).otherwise(F.lit(-1.0))
    high = F.when(sure, F.greatest(F.col(median) - F.col("_q20"), F.col("_q80") - F.col(median))).otherwise(F.lit(float("inf")))
    sums = near.groupBy(*keys).agg(F.coalesce(F.sum(F.when(far < low, k)), F.lit(0)).alias("_below"), F.max("_n").alias("_of"))
    open_ = near.where((far >= low) & (far <= high)).groupBy(*keys, far.alias("_far")).agg(F.sum(k).alias("_w"))
    rows = joined(placed(open_, keys, "_far", "_w", most).drop("_n"), sums, keys).withColumn("_begin", F.col("_begin") + F.col("_below")).withColumnRenamed("_of", "_n")
    return points(rows, keys, "_far", {"mad": 0.5}, "_w").drop("_n")
