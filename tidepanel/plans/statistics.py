"""Queries of profiles, metrics, correlations and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, profile, splits
from ..sources import roles
from .base import EVENTS, PROTOCOL, SERIES, query, rounded

_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LONG = "v AS (" + " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS x FROM lineitem" for c in _COLUMNS) + ")"
_PROFILE = f"""{_LONG}, q AS (SELECT col, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b, median(x) AS m, mad(x) AS d FROM v GROUP BY 1), t AS (SELECT col, max(k) AS top FROM (SELECT col, x, count(*) AS k FROM v GROUP BY 1, 2) GROUP BY 1),
pf AS (SELECT v.col, count(*) AS n, count(x) AS n_checked, count(*) - count(x) AS n_null, count(CASE WHEN x = 0 THEN 1 END) AS n_zero, count(CASE WHEN x < 0 THEN 1 END) AS n_negative, count(DISTINCT x) AS n_unique, max(top) > 0.95 * count(x) AS is_quasi_constant,
avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, max(x) AS max, quantile_cont(x, 0.01) AS p01, quantile_cont(x, 0.05) AS p05, any_value(a) AS q25, any_value(m) AS median, any_value(b) AS q75, quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.99) AS p99, any_value(d) AS mad, skewness(x) AS skewness, kurtosis(x) AS excess_kurtosis,
count(CASE WHEN b > a AND (x < a - 1.5 * (b - a) OR x > b + 1.5 * (b - a)) THEN 1 END) AS n_outliers_iqr, count(CASE WHEN d > 0 AND 0.6745 * abs(x - m) / d > 3.5 THEN 1 END) AS n_outliers_mad FROM v JOIN q USING (col) JOIN t USING (col) GROUP BY 1)"""


def _profile(spark, sf_dir):
    return profile.profiled(roles.table(spark, sf_dir, "lineitem"), _COLUMNS, "lineitem")


@query(f"""WITH {_PROFILE} SELECT 'lineitem' AS "table", col AS "column", n, n_checked, n_null, round(100.0 * n_null / n, 4) AS null_pct, n_zero, round(100.0 * n_zero / n_checked, 4) AS zero_pct, n_negative, round(100.0 * n_negative / n_checked, 4) AS negative_pct, n_unique, round(100.0 * n_unique / n_checked, 4) AS unique_pct,
0 AS n_sentinel, n_unique <= 1 AS is_constant, is_quasi_constant, round(mean, 3) AS mean, round(std, 3) AS std, round(std / abs(mean), 3) AS cv, round(min, 3) AS min, round(p01, 3) AS p01, round(p05, 3) AS p05, round(q25, 3) AS q25, round(median, 3) AS median, round(q75, 3) AS q75, round(p95, 3) AS p95, round(p99, 3) AS p99, round(max, 3) AS max,
round(q75 - q25, 3) AS iqr, round(mad, 3) AS mad, round(skewness, 3) AS skewness, round(excess_kurtosis, 3) AS excess_kurtosis, n_outliers_iqr, round(100.0 * n_outliers_iqr / n_checked, 3) AS outlier_iqr_pct, n_outliers_mad, round(100.0 * n_outliers_mad / n_checked, 3) AS outlier_mad_pct,
excess_kurtosis > 3 OR abs(skewness) > 2 AS heavy_tailed, concat_ws(';', CASE WHEN n_zero > 0.5 * n_checked THEN 'zero_inflated' END, CASE WHEN is_quasi_constant THEN 'quasi_constant' END, CASE WHEN excess_kurtosis > 3 OR abs(skewness) > 2 THEN 'heavy_tailed' END, CASE WHEN n_outliers_iqr > 0 THEN 'iqr_outliers' END) AS flags, true AS success FROM pf""")
def m01_statistical_profile(spark, sf_dir):
    exact = ("null_pct", "zero_pct", "negative_pct", "unique_pct")
    out = _profile(spark, sf_dir)
    return out.select(*(F.round(c, 3).alias(c) if t == "double" and c not in exact else F.col(c) for c, t in out.dtypes))


@query(f"""WITH {_PROFILE} SELECT col AS "column", round(p95 / nullif(p05, 0), 3) AS p95_p05, round((mean - median) / nullif(std, 0), 3) AS mean_median_gap, round(std / sqrt(n_checked), 3) AS sem, round(mad / nullif(median, 0), 3) AS mad_median, round((q75 - q25) / nullif(median, 0), 3) AS iqr_median, round((q75 - q25) / nullif(q75 + q25, 0), 3) AS qcd,
round((p95 - median) / nullif(median - p05, 0), 3) AS tail_95_05, round((p99 - median) / nullif(median - p01, 0), 3) AS tail_99_01, round(p99 / nullif(p95, 0), 3) AS tail_99_95, round((p99 - p95) / nullif(p99, 0), 3) AS top_share, round((p99 - p95) / nullif(p99 + p95, 0), 3) AS top_dispersion FROM pf""")
def m11_profile_ratios(spark, sf_dir):
    return rounded(profile.ratios(_profile(spark, sf_dir)), 3)


def _shape_sql(s: str) -> str:
    """SQL of metrics.shape over a relation (series, x)."""
    return f"""(WITH g AS (SELECT series, count(*) AS n, avg(x) AS mu, stddev_samp(x) AS sd, median(x) AS med, min(x) AS lo, max(x) AS hi, skewness(x) AS g1, kurtosis(x) AS g2, mad(x) AS md, quantile_cont(x, 0.05) AS p05, quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, quantile_cont(x, 0.1) AS p10, quantile_cont(x, 0.9) AS p90 FROM {s} GROUP BY 1),
z AS (SELECT series, x, row_number() OVER (PARTITION BY series ORDER BY x) AS i, row_number() OVER (PARTITION BY series ORDER BY x DESC) AS j, count(*) OVER (PARTITION BY series) AS m, sum(x) OVER (PARTITION BY series) AS tot FROM {s} WHERE x >= 0),
zz AS (SELECT series, 2 * sum(i * x) / nullif(any_value(m) * any_value(tot), 0) - (any_value(m) + 1.0) / any_value(m) AS gini, sum(CASE WHEN j <= greatest(1, ceil(0.01 * m)) THEN x END) / nullif(any_value(tot), 0) AS topc, sum(x * x) / nullif(any_value(tot) ** 2, 0) AS herf FROM z GROUP BY 1),
th AS (SELECT series, avg(x / m * ln(x / m)) AS theil FROM (SELECT series, x, avg(x) OVER (PARTITION BY series) AS m FROM {s} WHERE x > 0) GROUP BY 1),
hl AS (SELECT *, least(greatest(10, m // 10), m - 1) AS kk FROM (SELECT series, x, row_number() OVER (PARTITION BY series ORDER BY x DESC) AS j, count(*) OVER (PARTITION BY series) AS m FROM {s} WHERE x > 0)),
hi AS (SELECT series, 1.0 / (avg(CASE WHEN j <= kk THEN ln(x) END) - max(CASE WHEN j = kk + 1 THEN ln(x) END)) AS hill FROM hl WHERE m >= 10 GROUP BY 1),
k AS (SELECT v.series, v.x, g.* EXCLUDE (series) FROM {s} v JOIN g USING (series)),
en AS (SELECT series, -sum(c / n * ln(c / n)) / nullif(ln(count(*)), 0) AS h FROM (SELECT series, least(floor((x - lo) / (hi - lo) * 20), 19) AS bin, count(*)::DOUBLE AS c, any_value(n) AS n FROM k GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT series, any_value(n) AS n, any_value(mu) AS mean, any_value(sd) AS std, any_value(med) AS median, any_value(g1) AS moment_skewness, any_value(g2) AS excess_kurtosis, sqrt(avg(least(x, 0) ** 2)) AS downside_deviation, sqrt(avg(greatest(x, 0) ** 2)) AS upside_deviation, coalesce(avg(CASE WHEN x < mu THEN (x - mu) ** 2 END), 0) AS semivariance,
avg(abs(x - mu)) AS mean_abs_deviation, sum(greatest(x, 0)) / nullif(-sum(least(x, 0)), 0) AS omega_ratio, -any_value(p05) AS value_at_risk, -avg(CASE WHEN x <= p05 THEN x END) AS conditional_var, abs(any_value(p95)) / nullif(abs(any_value(p05)), 0) AS tail_ratio, any_value(md) / nullif(abs(any_value(med)), 0) AS robust_cv_mad, (any_value(q3) - any_value(q1)) / nullif(abs(any_value(med)), 0) AS robust_cv_iqr,
(any_value(q3) - any_value(q1)) / nullif(any_value(q3) + any_value(q1), 0) AS quartile_coeff_dispersion, any_value(sd) / nullif(abs(any_value(mu)), 0) AS coefficient_of_variation, (any_value(q3) + any_value(q1) - 2 * any_value(med)) / nullif(any_value(q3) - any_value(q1), 0) AS bowley_skewness, (any_value(p90) + any_value(p10) - 2 * any_value(med)) / nullif(any_value(p90) - any_value(p10), 0) AS kelly_skewness,
(any_value(mu) - any_value(med)) / any_value(sd) AS nonparametric_skew, (any_value(g1) ** 2 + 1) / (any_value(g2) + 3.0 * (any_value(n) - 1) ** 2 / ((any_value(n) - 2.0) * (any_value(n) - 3.0))) AS bimodality_coefficient, any_value(n) / 6.0 * (any_value(g1) ** 2 + any_value(g2) ** 2 / 4) AS jarque_bera FROM k GROUP BY 1)
SELECT a.*, theil AS theil_index, gini AS gini_coefficient, topc AS top_concentration, hill AS hill_tail_index, h AS shannon_entropy, herf AS herfindahl_index FROM a LEFT JOIN zz USING (series) LEFT JOIN th USING (series) LEFT JOIN hi USING (series) LEFT JOIN en USING (series))"""


_SHAPED = (
    "mean", "std", "median", "moment_skewness", "excess_kurtosis", "downside_deviation", "upside_deviation", "semivariance", "mean_abs_deviation", "theil_index", "omega_ratio", "gini_coefficient", "top_concentration", "hill_tail_index", "shannon_entropy", "value_at_risk", "conditional_var", "tail_ratio",
    "robust_cv_mad", "robust_cv_iqr", "quartile_coeff_dispersion", "coefficient_of_variation", "bowley_skewness", "kelly_skewness", "nonparametric_skew", "bimodality_coefficient", "jarque_bera", "herfindahl_index",
)
_DIGITS = {"semivariance": 2, "jarque_bera": 3, "herfindahl_index": 6}


@query(f"WITH {SERIES} SELECT series, n, {', '.join(f'round({c}, {_DIGITS.get(c, 4)}) AS {c}' for c in _SHAPED)} FROM {_shape_sql('s')}")
def e01_shape_metrics(spark, sf_dir):
    out = metrics.shape(roles.series(spark, sf_dir))
    return out.select(*(F.round(c, _DIGITS.get(c, 4)).alias(c) if t == "double" else c for c, t in out.dtypes))


@query(f"""WITH {SERIES}, d AS (SELECT series, ord, x / nullif(max(x) OVER (PARTITION BY series ORDER BY ord), 0) - 1 AS dd FROM s)
SELECT series, round(-min(dd), 5) AS max_drawdown, round(-avg(dd), 5) AS average_drawdown, round(sqrt(avg((100 * dd) ** 2)), 4) AS ulcer_index FROM d GROUP BY 1""")
def e08_drawdowns_of_levels(spark, sf_dir):
    """Drawdowns of all series; below a peak of 0 or less they are what the formula gives, not shares lost."""
    out = metrics.drawdown_metrics(roles.series(spark, sf_dir), as_returns=False)
    return out.select("series", F.round("max_drawdown", 5).alias("max_drawdown"), F.round("average_drawdown", 5).alias("average_drawdown"), F.round("ulcer_index", 4).alias("ulcer_index"))


@query("""WITH r AS (SELECT event_type AS series, event_id AS ord, (value - 60) / 5000 AS x FROM events), w AS (SELECT series, ord, exp(sum(ln(1 + x)) OVER (PARTITION BY series ORDER BY ord)) AS w FROM r), d AS (SELECT series, w / max(w) OVER (PARTITION BY series ORDER BY ord) - 1 AS dd FROM w),
a AS (SELECT series, -min(dd) AS mdd, -avg(dd) AS add, sqrt(avg((100 * dd) ** 2)) AS ulcer FROM d GROUP BY 1), b AS (SELECT series, avg(x) AS m, stddev_samp(x) AS s, sqrt(avg(least(x, 0) ** 2)) AS dn FROM r GROUP BY 1)
SELECT series, round(mdd, 5) AS max_drawdown, round(add, 5) AS average_drawdown, round(ulcer, 4) AS ulcer_index, round(s * sqrt(12), 6) AS realized_volatility, round(m / s * sqrt(12), 5) AS sharpe_ratio, round(m / nullif(dn, 0) * sqrt(12), 5) AS sortino_ratio, round(m * 12 / nullif(mdd, 0), 4) AS calmar_ratio FROM a JOIN b USING (series)""")
def e11_performance_of_returns(spark, sf_dir):
    r = roles.table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), F.col("event_id").alias("ord"), ((F.col("value") - 60) / 5000).alias("x"))
    out = metrics.drawdown_metrics(r).join(metrics.performance(r, periods=12.0), "series")
    digits = {"ulcer_index": 4, "realized_volatility": 6, "calmar_ratio": 4}
    return out.select("series", *(F.round(c, digits.get(c, 5)).alias(c) for c in out.columns[1:]))


@query(f"""WITH {SERIES}, r AS (SELECT series, ord, x, lag(x) OVER (PARTITION BY series ORDER BY ord) AS y FROM s) SELECT series, count(CASE WHEN y <> 0 THEN 1 END) AS n, round(avg(x / nullif(y, 0) - 1), 3) AS mean_simple, round(avg(CASE WHEN x > 0 AND y > 0 THEN ln(x) - ln(y) END), 5) AS mean_log, round(corr(x, y), 5) AS autocorrelation FROM r GROUP BY 1""")
def e33_returns_autocorrelation(spark, sf_dir):
    s = roles.series(spark, sf_dir)
    simple = metrics.returns(s).groupBy("series").agg(F.count("*").alias("n"), F.round(F.avg("x"), 3).alias("mean_simple"))
    log = metrics.returns(s, "log").groupBy("series").agg(F.round(F.avg("x"), 5).alias("mean_log"))
    return simple.join(log, "series").join(metrics.autocorrelation(s).withColumn("autocorrelation", F.round("autocorrelation", 5)), "series")


@query(f"""WITH {SERIES}, r AS (SELECT series, ord, x, x / nullif(lag(x) OVER (PARTITION BY series ORDER BY ord), 0) - 1 AS y FROM s)
SELECT series, ord, x, round(CASE WHEN count(y) OVER w >= 4 THEN stddev_samp(y) OVER w END, 3) AS volatility FROM r WINDOW w AS (PARTITION BY series ORDER BY ord ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def e12_rolling_volatility(spark, sf_dir):
    return metrics.rolling_volatility(roles.series(spark, sf_dir), as_returns=False).withColumn("volatility", F.round("volatility", 3))


_HURST = """(WITH o AS (SELECT series, x, row_number() OVER (PARTITION BY series ORDER BY ord) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM s), l AS (SELECT DISTINCT series, n, CASE WHEN k = 19 THEN n // 2 ELSE CAST(floor(pow(10, log10(4) + k * (log10(n // 2) - log10(4)) / 19) + 1e-9) AS BIGINT) END AS len FROM (SELECT DISTINCT series, n FROM o WHERE n >= 20), (SELECT unnest(generate_series(0, 19)) AS k)),
c AS (SELECT series, len, i // len AS w, x, i FROM o JOIN l USING (series, n) WHERE i // len < n // len), m AS (SELECT *, avg(x) OVER (PARTITION BY series, len, w) AS mu FROM c), u AS (SELECT series, len, w, x, sum(x - mu) OVER (PARTITION BY series, len, w ORDER BY i) AS dev FROM m),
rs AS (SELECT series, len, (max(dev) - min(dev)) / nullif(stddev_pop(x), 0) AS r FROM u GROUP BY series, len, w), a AS (SELECT series, len, avg(r) AS r FROM rs GROUP BY 1, 2) SELECT series, regr_slope(ln(r), ln(len)) AS hurst_exponent FROM a WHERE r > 0 GROUP BY 1 HAVING count(*) >= 3)"""


@query(f"WITH {SERIES} SELECT series, round(hurst_exponent, 5) AS hurst_exponent FROM {_HURST}")
def e34_hurst_exponent(spark, sf_dir):
    return rounded(metrics.hurst(roles.series(spark, sf_dir)), 5)


_FROM_RETURNS = ("value_at_risk", "conditional_var", "downside_deviation", "upside_deviation", "omega_ratio")
_FROM_VALUES = [c for c in _SHAPED if c not in (*_FROM_RETURNS, "mean", "std", "median")]
_LATER = ["max_drawdown", "average_drawdown", "ulcer_index", "realized_volatility", "sharpe_ratio", "sortino_ratio", "calmar_ratio", "autocorrelation", "hurst_exponent"]


@query(f"""WITH {SERIES}, t AS (SELECT series, ord, x, lag(x) OVER (PARTITION BY series ORDER BY ord) AS y FROM s), r AS (SELECT series, ord, x / nullif(y, 0) - 1 AS x FROM t WHERE y <> 0), v AS (SELECT * FROM {_shape_sql('s')}), w AS (SELECT * FROM {_shape_sql('r')}),
d AS (SELECT series, -min(dd) AS max_drawdown, -avg(dd) AS average_drawdown, sqrt(avg((100 * dd) ** 2)) AS ulcer_index FROM (SELECT series, x / nullif(max(x) OVER (PARTITION BY series ORDER BY ord), 0) - 1 AS dd FROM s) GROUP BY 1), b AS (SELECT series, avg(x) AS level FROM s GROUP BY 1), c AS (SELECT series, corr(x, y) AS autocorrelation FROM t GROUP BY 1),
m AS (SELECT v.series, {", ".join(f"v.{c}" for c in _FROM_VALUES)}, {", ".join(f"w.{c}" for c in _FROM_RETURNS)}, max_drawdown, average_drawdown, ulcer_index, w.std * sqrt(12) AS realized_volatility, w.mean / nullif(w.std, 0) * sqrt(12) AS sharpe_ratio, w.mean / nullif(w.downside_deviation, 0) * sqrt(12) AS sortino_ratio, level * 12 / nullif(max_drawdown, 0) AS calmar_ratio, autocorrelation, hurst_exponent
FROM v JOIN w USING (series) JOIN d USING (series) JOIN b USING (series) JOIN c USING (series) LEFT JOIN {_HURST} h USING (series))
""" + " UNION ALL ".join(f"SELECT series, '{c}' AS metric, round({c}, 2) AS value FROM m" for c in [*_FROM_VALUES, *_FROM_RETURNS, *_LATER]))
def e36_financial_metrics(spark, sf_dir):
    return rounded(metrics.financial_metrics(roles.series(spark, sf_dir), 12.0, as_returns=False), 2)


#: All components of the embeddings, as given.
_ALL = [f"e{i}" for i in range(64)]
_CELLS = "v AS (SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS x FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i))"
_ALL_CORR = "c AS (SELECT 'e' || a.i AS col_a, 'e' || b.i AS col_b, corr(a.x, b.x) AS r FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY 1, 2)"


def _all_correlations(spark, sf_dir, method="pearson"):
    return splits.correlation(roles.components(spark, sf_dir), _ALL, method)


@query(f"WITH {_CELLS}, {_ALL_CORR} SELECT col_a, col_b, round(r, 6) AS r FROM c")
def c01_correlation(spark, sf_dir):
    return rounded(_all_correlations(spark, sf_dir))


@query(f"WITH v0 AS (WITH {_CELLS} SELECT * FROM v), v AS (SELECT vec_id, i, rank() OVER (PARTITION BY i ORDER BY x) + (count(*) OVER (PARTITION BY i, x) - 1) / 2.0 AS x FROM v0 WHERE x IS NOT NULL), {_ALL_CORR} SELECT col_a, col_b, round(r, 6) AS r FROM c")
def c01_spearman(spark, sf_dir):
    return rounded(_all_correlations(spark, sf_dir, "spearman"))


@query(f"WITH {_CELLS}, {_ALL_CORR} SELECT t AS threshold, count(CASE WHEN abs(r) > t THEN 1 END) AS n_pairs FROM c, (SELECT unnest([0.1::DOUBLE, 0.2::DOUBLE, 0.9::DOUBLE]) AS t) GROUP BY 1")
def c03_redundancy(spark, sf_dir):
    return splits.redundancy(_all_correlations(spark, sf_dir), (0.1, 0.2, 0.9))


@query(f"WITH {_CELLS}, {_ALL_CORR} SELECT col_a, col_b, round(r, 6) AS r FROM c ORDER BY abs(r) DESC, col_a, col_b LIMIT 8")
def o04_strongest_pairs(spark, sf_dir):
    return rounded(splits.strongest(_all_correlations(spark, sf_dir)))


@query(f"WITH {_CELLS} SELECT 'e' || i AS \"column\", CASE WHEN median(x) <= 0 THEN 'low' ELSE 'high' END AS side FROM v GROUP BY i")
def r07_columns_by_stat(spark, sf_dir):
    df = roles.components(spark, sf_dir)
    low, high = splits.columns_by_stat(df, splits.column_stat(df, "median", _ALL), 0.0)
    return spark.createDataFrame([(c, "low") for c in low.columns] + [(c, "high") for c in high.columns], "column string, side string")


@query(f"WITH {_CELLS}, m AS (SELECT 'e' || i AS c, stddev_samp(x) AS s, median(x) AS v FROM v GROUP BY i)" + """, e AS (SELECT quantile_cont(s, 1/3::DOUBLE) AS a, quantile_cont(s, 2/3::DOUBLE) AS b FROM m)
SELECT c AS "column", CASE WHEN s <= a THEN 'low' WHEN s <= b THEN 'moderate' ELSE 'high' END AS std_band, CASE WHEN v < -0.01 THEN 'low' WHEN v < 0.01 THEN 'moderate' ELSE 'high' END AS median_band FROM m, e""")
def r09_band_matrix(spark, sf_dir):
    return splits.band_matrix(profile.profiled(roles.components(spark, sf_dir), _ALL), ("std", "median"), {"median": (-0.01, 0.01)})


@query()
def c02_correlation_clusters(spark, sf_dir):
    r = _all_correlations(spark, sf_dir)
    groups = splits.correlation_clusters(r, _ALL, 5)
    return spark.createDataFrame([(g, c) for g, cs in groups.items() for c in cs], "cluster string, column string")


def _tercile_sql(score: str, labels: tuple[str, str, str], digits: int = 5) -> str:
    return f"""WITH {PROTOCOL}, x AS (SELECT time_bucket, {score} AS score FROM p), e AS (SELECT quantile_cont(score, 1/3::DOUBLE) AS a, quantile_cont(score, 2/3::DOUBLE) AS b FROM x)
SELECT time_bucket, round(score, {digits}) AS score, CASE WHEN score IS NULL THEN NULL WHEN score <= a THEN '{labels[0]}' WHEN score <= b THEN '{labels[1]}' ELSE '{labels[2]}' END AS label FROM x, e"""


_ROLL = "CASE WHEN count(supply_amount_value_usd) OVER w >= 4 THEN stddev_samp(supply_amount_value_usd) OVER w END"


@query(f"""WITH {PROTOCOL}, x AS (SELECT time_bucket, {_ROLL} AS score FROM p WINDOW w AS (ORDER BY time_bucket ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)), e AS (SELECT quantile_cont(score, 1/3::DOUBLE) AS a, quantile_cont(score, 2/3::DOUBLE) AS b FROM x)
SELECT time_bucket, round(score, 4) AS score, CASE WHEN score IS NULL THEN NULL WHEN score <= a THEN 'calm' WHEN score <= b THEN 'normal' ELSE 'turbulent' END AS label FROM x, e""")
def r01_volatility_regimes(spark, sf_dir):
    return rounded(splits.by_volatility(roles.protocol(spark, sf_dir), "supply_amount_value_usd").select("time_bucket", "score", "label"), 4)


@query(_tercile_sql("(supply_amount_value_usd + avg_ltv)", ("quiet", "active", "peak")))
def r02_activity_regimes(spark, sf_dir):
    df = roles.protocol(spark, sf_dir).withColumn("a", F.col("supply_amount_value_usd") + F.col("avg_ltv"))
    return rounded(splits.by_activity(df, "a").select("time_bucket", "score", "label"), 5)


@query(_tercile_sql("supply_amount_value_usd / nullif(supply_tx_count, 0)", ("retail", "mixed", "whale")))
def r03_whale_regimes(spark, sf_dir):
    return rounded(splits.by_whales(roles.protocol(spark, sf_dir), "supply_amount_value_usd", "supply_tx_count").select("time_bucket", "score", "label"), 5)


def _embedding_series(spark, sf_dir):
    return roles.components(spark, sf_dir).unpivot("vec_id", _ALL, "series", "x").select("series", F.col("vec_id").alias("ord"), "x")


@query()
def r04_columns_by_correlation(spark, sf_dir):
    r = _all_correlations(spark, sf_dir)
    return rounded(splits.coherence(r, splits.correlation_clusters(r, _ALL, 4, absolute=False)))


_RANKED = ", ".join(f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE) / count({c}) OVER () AS r{i}" for i, c in enumerate(("excess_kurtosis", "robust_cv_iqr", "-hill_tail_index")))
_TAILS = f"WITH {_CELLS}, es AS (SELECT 'e' || i AS series, x FROM v), sh AS (SELECT * FROM {_shape_sql('es')}), rk AS (SELECT series, {_RANKED} FROM sh), sc AS (SELECT series, (r0 + r1 + r2) / 3 AS score FROM rk), e AS (SELECT quantile_cont(score, 1/3::DOUBLE) AS a, quantile_cont(score, 2/3::DOUBLE) AS b FROM sc), lb AS (SELECT series, score, CASE WHEN score <= a THEN 'stable' WHEN score <= b THEN 'moderate' ELSE 'wild' END AS label FROM sc, e)"


@query(_TAILS + " SELECT series, round(score, 6) AS score, label FROM lb")
def r06_columns_by_tail_risk(spark, sf_dir):
    return rounded(splits.by_tail_risk(_embedding_series(spark, sf_dir)))


@query(f"WITH {EVENTS} SELECT kind AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM ev GROUP BY 1")
def b01_split_balance(spark, sf_dir):
    return splits.balance(roles.events(spark, sf_dir).withColumnRenamed("kind", "label"))


@query(f"""WITH {EVENTS}, x AS (SELECT kind, amount, mode FROM ev UNION ALL SELECT 'ALL', amount, mode FROM ev), a AS (SELECT kind AS "group", median(amount) AS amount, median(mode) AS mode FROM x GROUP BY 1)
SELECT "group", 'amount' AS "column", amount::DOUBLE AS value FROM a UNION ALL SELECT "group", 'mode', mode::DOUBLE FROM a""")
def b02_group_statistics(spark, sf_dir):
    return splits.group_stats(roles.events(spark, sf_dir).withColumnRenamed("kind", "label"), ("amount", "mode"))


@query(f"""WITH {EVENTS} SELECT kind AS label, 'amount' AS "column", round(median(amount)::DOUBLE, 4) AS median, round(quantile_cont(amount, 0.75) - quantile_cont(amount, 0.25), 4) AS iqr, round(mad(amount)::DOUBLE, 4) AS mad FROM ev GROUP BY 1""")
def b04_robust_profile(spark, sf_dir):
    return rounded(splits.robust_profile(roles.events(spark, sf_dir).withColumnRenamed("kind", "label"), ("amount",)), 4)


@query(_TAILS + " SELECT label, count(*) AS n, round(avg(excess_kurtosis), 6) AS excess_kurtosis, round(avg(robust_cv_iqr), 4) AS robust_cv_iqr, round(avg(hill_tail_index), 6) AS hill_tail_index FROM lb JOIN sh USING (series) GROUP BY 1")
def b05_group_means(spark, sf_dir):
    long = _embedding_series(spark, sf_dir)
    scores = metrics.shape(long).select("series", "excess_kurtosis", "robust_cv_iqr", "hill_tail_index")
    out = splits.group_means(splits.by_tail_risk(long), scores, ("excess_kurtosis", "robust_cv_iqr", "hill_tail_index"))
    return rounded(out).withColumn("robust_cv_iqr", F.round("robust_cv_iqr", 4))
