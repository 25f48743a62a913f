"""Statistical profile of numeric columns from counts of distinct values, for all columns together.

Cells are counted by (column, state, value) once, and the counts stored; moments, quantiles and outliers are weighted by them. Quantiles are
exact: values are placed in order by ranges (ranks.placed), so no aggregator and no task holds a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NO_DEBT, divided, percent
from ..sources.stored import stored
from . import ranks

NULL_WARN, ZERO_WARN, QUASI_CONSTANT = 0.20, 0.50, 0.95
HEAVY_KURTOSIS, HEAVY_SKEWNESS, FENCE, MODIFIED_Z, NUMERIC = 3.0, 2.0, 1.5, 3.5, 0.80
POINTS = {"p01": 0.01, "p05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "p95": 0.95, "p99": 0.99}


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


def melted(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, raw, value): a row per cell; value is null for what is no finite number."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("raw"), F.col(f"`{c}`").try_cast("double").alias("d")) for c in columns))
    long = df.select(*keep, F.explode(cells).alias("x")).select(*keep, "x.*")
    return long.select(*keep, "column", "raw", F.when(F.abs("d") < float("inf"), F.col("d")).alias("value"))


def _states(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., column, state, value): a row per cell, which is null, a number, the sentinel, or text; only text columns are read as text."""
    numbers = set(numeric_columns(df))

    def cell(c: str) -> Column:
        x = F.col(f"`{c}`")
        value = x.cast("double") if c in numbers else x.cast("string").try_cast("double")
        value = F.when(F.abs(value) < float("inf"), value)
        state = F.when(x.isNull(), "null").when(value.isNull(), "text")
        if c not in numbers:
            state = state.when(x.cast("string") == NO_DEBT, "sentinel")
        state = state.otherwise("number")
        return F.struct(F.lit(c).alias("column"), state.alias("state"), F.when(state == "number", value).alias("value"))

    return df.select(*by, F.explode(F.array(*map(cell, columns))).alias("x")).select(*by, "x.*")


def profiled(df: DataFrame, columns: Sequence[str] | None = None, table: str = "", by: Sequence[str] = ()) -> DataFrame:
    """A row per column (and group of by): counts, moments, quantiles, outliers, flags.

    Columns of which fewer than NUMERIC of the present cells are numbers, and columns without cells, are left out.
    """
    keys = [*by, "column"]
    counts = stored(_states(df, list(columns or numeric_columns(df)), by).groupBy(*keys, "state", "value").agg(F.count("*").alias("k")), "values")
    k, x = F.col("k"), F.col("value")
    held = lambda cond: F.coalesce(F.sum(F.when(cond, k)), F.lit(0))
    is_ = lambda *states: F.col("state").isin(*states)
    whole = counts.groupBy(*keys).agg(
        F.sum("k").alias("n"), held(is_("number")).alias("n_checked"), held(is_("null")).alias("n_null"), held(x == 0).alias("n_zero"), held(x < 0).alias("n_negative"), held(is_("sentinel")).alias("n_sentinel"),
        held(~is_("null")).alias("present"), held(is_("number", "sentinel")).alias("parsed"), F.max(F.when(is_("number"), k)).alias("top"), F.count("value").alias("n_unique"),
    ).where((F.col("present") > 0) & (F.col("parsed") >= NUMERIC * F.col("present")))
    most = counts.count()
    numbers = counts.where(is_("number")).drop("state")
    one = ranks.quantiles(numbers, keys, "value", {**POINTS, **ranks.QUARTERS}, "k", most)
    ends = numbers.groupBy(*keys).agg((F.sum(x * k) / F.sum("k")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    one = stored(ranks.joined(one, ends, keys), "quantiles")
    near = ranks.joined(numbers, one.select(*keys, "_n", *ranks.QUARTERS, F.col("mean").alias("_mean"), F.col("median").alias("_m"), F.col("q25").alias("_a"), F.col("q75").alias("_b")), keys)
    far, dev, width = F.abs(x - F.col("_m")), x - F.col("_mean"), F.col("_b") - F.col("_a")
    out_iqr = (width > 0) & ((x < F.col("_a") - FENCE * width) | (x > F.col("_b") + FENCE * width))
    two = near.groupBy(*keys).agg(*(F.sum(F.pow(dev, F.lit(p)) * k).alias(f"m{p}") for p in (2, 3, 4)), held(out_iqr).alias("n_outliers_iqr"))
    mad = stored(ranks.median_distance(near, keys, "value", "k", "_m", most), "distances")
    score = 0.6745 * far / F.when(F.col("_mad") > 0, F.col("_mad"))
    three = ranks.joined(near, mad.select(*keys, F.col("mad").alias("_mad")), keys).groupBy(*keys).agg(held(score > MODIFIED_Z).alias("n_outliers_mad"))
    out = whole
    for part in (one.drop("_n", *ranks.QUARTERS), two, mad, three):
        out = ranks.joined(out, part, keys, "left")
    n = F.col("n_checked").cast("double")
    var = F.try_divide(F.col("m2"), n)
    out = out.withColumns(
        {
            "std": F.coalesce(F.sqrt(F.try_divide(F.col("m2"), n - 1)), F.lit(0.0)),
            "iqr": F.col("q75") - F.col("q25"),
            "skewness": F.when((n > 2) & (var > 0), F.col("m3") / n / F.pow(var, F.lit(1.5)) * F.sqrt(n * (n - 1)) / F.try_subtract(n, F.lit(2.0))),
            "excess_kurtosis": F.when((n > 3) & (var > 0), F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * (F.col("m4") / n / (var * var) - 3) + 6)),
        }
    )
    varies = (F.col("n_checked") > 0) & (F.col("n_unique") > 1)
    measured = ["mean", "std", "min", *POINTS, "max", "iqr", "mad", "skewness", "excess_kurtosis", "n_outliers_iqr", "n_outliers_mad"]
    out = out.withColumns({c: F.when(varies, F.col(c)) for c in measured}).withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
    out = out.withColumns(
        {
            "is_constant": (F.col("n_checked") > 0) & (F.col("n_unique") <= 1),
            "is_quasi_constant": F.coalesce(F.col("top") > QUASI_CONSTANT * F.col("n_checked"), F.lit(False)),
            "heavy_tailed": F.when(varies, F.coalesce(F.col("excess_kurtosis") > HEAVY_KURTOSIS, F.lit(False)) | F.coalesce(F.abs("skewness") > HEAVY_SKEWNESS, F.lit(False))),
            "cv": divided("std", F.abs("mean")),
            **{f"{k}_pct": percent(f"n_{k}", "n" if k == "null" else "n_checked") for k in ("null", "zero", "negative", "unique")},
            "outlier_iqr_pct": percent("n_outliers_iqr", "n_checked"),
            "outlier_mad_pct": percent("n_outliers_mad", "n_checked"),
        }
    )
    flag = {
        "high_null": F.col("null_pct") > 100 * NULL_WARN,
        "zero_inflated": F.col("n_zero") > ZERO_WARN * F.col("n_checked"),
        "constant": F.col("is_constant"),
        "quasi_constant": F.col("is_quasi_constant") & ~F.col("is_constant"),
        "no_debt_sentinel": F.col("n_sentinel") > 0,
        "heavy_tailed": F.col("heavy_tailed"),
        "iqr_outliers": F.col("n_outliers_iqr") > 0,
    }
    return out.select(
        *by, F.lit(table).alias("table"), "column", "n", "n_checked", "n_null", "null_pct", "n_zero", "zero_pct", "n_negative", "negative_pct", "n_unique", "unique_pct", "n_sentinel",
        "is_constant", "is_quasi_constant", "mean", "std", "cv", "min", "p01", "p05", "q25", "median", "q75", "p95", "p99", "max", "iqr", "mad", "skewness", "excess_kurtosis",
        "n_outliers_iqr", "outlier_iqr_pct", "n_outliers_mad", "outlier_mad_pct", "heavy_tailed", F.concat_ws(";", *(F.when(x, F.lit(n)) for n, x in flag.items())).alias("flags"), varies.alias("success"),
    )


def ratios(profile: DataFrame) -> DataFrame:
    """Tail and spread ratios of a profile."""
    c = F.col
    return profile.select(
        "column",
        divided("p95", "p05").alias("p95_p05"),
        divided(c("mean") - c("median"), "std").alias("mean_median_gap"),
        divided("std", F.sqrt("n_checked")).alias("sem"),
        divided("mad", "median").alias("mad_median"),
        divided("iqr", "median").alias("iqr_median"),
        divided("iqr", c("q75") + c("q25")).alias("qcd"),
        divided(c("p95") - c("median"), c("median") - c("p05")).alias("tail_95_05"),
        divided(c("p99") - c("median"), c("median") - c("p01")).alias("tail_99_01"),
        divided("p99", "p95").alias("tail_99_95"),
        divided(c("p99") - c("p95"), "p99").alias("top_share"),
        divided(c("p99") - c("p95"), c("p99") + c("p95")).alias("top_dispersion"),
    )
