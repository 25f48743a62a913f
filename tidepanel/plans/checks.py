"""Queries of the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import extract, quality, ranks
from ..sources import roles
from .base import EVENTS, PROTOCOL, RESERVE, TOKENS, query, rounded


def _counts(df):
    return df.select("check", "columns", "n_checked", "n_pass", "n_fail", "pass_rate_pct", "success")


def _sql(source: str, rows: list[tuple[str, str, str, str, float]]) -> str:
    """SQL of check rows over a relation: (check, columns, looked at, bad, mostly)."""
    one = """SELECT '{n}' AS "check", '{c}' AS columns, count(CASE WHEN {l} THEN 1 END) AS n, count(CASE WHEN ({l}) AND ({b}) THEN 1 END) AS k, {m} AS m FROM {s}"""
    union = " UNION ALL ".join(one.format(n=n, c=c, l=look, b=b, m=m, s=source) for n, c, look, b, m in rows)
    return f'SELECT "check", columns, n AS n_checked, n - k AS n_pass, k AS n_fail, round(100.0 * (n - k) / nullif(n, 0), 4) AS pass_rate_pct, k <= (1 - m) * n + 1e-12 AS success FROM ({union})'


@query("""WITH c AS (SELECT c_mktsegment AS v, 'c_mktsegment' AS "column" FROM customer UNION ALL SELECT c_custkey::VARCHAR, 'c_custkey' FROM customer UNION ALL SELECT c_name, 'c_name' FROM customer UNION ALL SELECT c_nationkey::VARCHAR, 'c_nationkey' FROM customer UNION ALL SELECT c_acctbal::VARCHAR, 'c_acctbal' FROM customer)
SELECT "column", count(*) - count(v) AS n_null, round(100.0 * (count(*) - count(v)) / count(*), 4) AS null_pct, count(DISTINCT v) AS n_unique FROM c GROUP BY 1""")
def v02_column_report(spark, sf_dir):
    return quality.column_report(roles.table(spark, sf_dir, "customer"))


@query("""SELECT (SELECT count(*) FROM l) AS n_rows, (SELECT count(*) FROM l) - (SELECT count(*) FROM (SELECT DISTINCT * FROM l)) AS duplicate_rows, (SELECT count(*) FROM l) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM l)) AS duplicate_keys, (SELECT count(*) FROM l WHERE v IS NULL) AS null_cells, 4 AS n_columns
FROM (SELECT 1) WHERE true""".replace("FROM l", "FROM (SELECT l_orderkey, l_linenumber, l_partkey % 5 AS p, CASE WHEN l_discount > 0 THEN l_quantity END AS v FROM lineitem)"))
def v02_table_report(spark, sf_dir):
    df = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 5).alias("p"), F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("v"))
    return quality.table_report(df, ["l_orderkey", "l_linenumber"])


@query(f"""WITH {RESERVE} SELECT c AS "column", t AS type, e AS expected, f AS fits, CASE c WHEN 'time_bucket' THEN count(time_bucket) WHEN 'asset' THEN count(asset) WHEN 'liquidity_rate' THEN count(liquidity_rate) ELSE count(update_count) END AS n_values
FROM r, (VALUES ('time_bucket', 'timestamp_ntz', 'time', true), ('asset', 'bigint', 'text', false), ('liquidity_rate', 'double', 'number', true), ('update_count', 'bigint', 'number', true)) AS t(c, t, e, f) GROUP BY 1, 2, 3, 4""")
def v03_type_report(spark, sf_dir):
    return quality.observed_types(roles.reserve(spark, sf_dir).select("time_bucket", "asset", "liquidity_rate", "update_count"))


@query(f"""WITH {PROTOCOL}, {RESERVE}, {TOKENS} SELECT 'protocol' AS "table", 'time_bucket' AS key, count(*) AS n_rows, count(DISTINCT time_bucket) AS n_keys FROM p UNION ALL SELECT 'reserve', 'time_bucket,asset', count(*), count(DISTINCT (time_bucket, asset)) FROM r
UNION ALL SELECT 'units', 'asset,metric', count(*), count(DISTINCT (asset, metric)) FROM (SELECT p_brand AS asset, p_type AS metric FROM part)""".replace(f", {TOKENS}", ""))
def v01_key_report(spark, sf_dir):
    units = roles.table(spark, sf_dir, "part").select(F.col("p_brand").alias("asset"), F.col("p_type").alias("metric"))
    return quality.key_report({"protocol": roles.protocol(spark, sf_dir), "reserve": roles.reserve(spark, sf_dir), "units": units})


@query(_sql(f"""(WITH {TOKENS} SELECT asset, decimals, asset_symbol, count(*) OVER (PARTITION BY asset) AS same, asset % 7 - 1 AS n FROM tok)""", [
    ("asset is not null", "asset", "true", "asset IS NULL", 1.0), ("key is unique", "asset", "true", "same > 1", 1.0), ("not negative", "seen_count", "n IS NOT NULL", "n < 0", 1.0), ("decimals in 0..36", "decimals", "decimals IS NOT NULL", "decimals NOT BETWEEN 0 AND 36", 1.0),
]).replace("'asset is not null'", "'asset is not null'"))
def v04_structure(spark, sf_dir):
    df = quality.with_key_counts(roles.tokens(spark, sf_dir).withColumn("seen_count", F.col("asset") % 7 - 1), ["asset"])
    return _counts(quality.run(df, quality.structural(df.drop("_same"), ["asset"])))


_PANEL = f"""(WITH {EVENTS} SELECT time_bucket, asset, CAST(sum(CASE WHEN kind = 'purchase' THEN amount END) AS BIGINT) AS a, CAST(sum(CASE WHEN kind = 'click' THEN amount END) AS BIGINT) AS b, CAST(sum(CASE WHEN kind = 'purchase' THEN amount ELSE -amount END) AS BIGINT) AS net, count(CASE WHEN kind = 'purchase' THEN 1 END) AS n, count(CASE WHEN kind = 'click' THEN 1 END) AS m,
count(DISTINCT CASE WHEN kind = 'purchase' THEN usr % 3 END) AS u, count(DISTINCT CASE WHEN kind = 'click' THEN usr END) AS w FROM ev WHERE kind IN ('purchase', 'click') GROUP BY 1, 2)"""


@query(_sql(_PANEL, [
    ("at least 0", "supply_amount_raw", "a IS NOT NULL", "a < 0", 1.0), ("at least 0", "withdrawal_amount_raw", "b IS NOT NULL", "b < 0", 1.0), ("net flow is supply less withdrawals", "net_supply_flow_raw", "net IS NOT NULL", "net <> coalesce(a, 0) - coalesce(b, 0)", 1.0),
    ("unique_suppliers <= supply_tx_count", "unique_suppliers,supply_tx_count", "true", "u > n", 0.99), ("unique_withdraw_users <= withdrawal_tx_count", "unique_withdraw_users,withdrawal_tx_count", "true", "w > m", 0.99),
]))
def v07_supply_withdraw_suite(spark, sf_dir):
    supply = roles.events(spark, sf_dir, "supply").withColumn("user", F.col("user") % 3)
    df = extract.supply_withdraw(supply, roles.events(spark, sf_dir, "withdraw"), roles.tokens(spark, sf_dir), exact=True)
    return _counts(quality.run(df, quality.SUITES[quality.suite_of(df)](df)))


_BORROW = f"""(WITH {EVENTS} SELECT time_bucket, asset, CAST(sum(CASE WHEN kind = 'signup' THEN amount END) AS BIGINT) AS a, CAST(sum(CASE WHEN kind = 'view' THEN amount END) AS BIGINT) AS b, CAST(sum(CASE WHEN kind = 'signup' THEN amount ELSE -amount END) AS BIGINT) AS net, count(CASE WHEN kind = 'signup' THEN 1 END) AS n, count(CASE WHEN kind = 'view' THEN 1 END) AS m, arg_max(rate, CASE WHEN kind = 'signup' THEN block END) AS rate,
count(CASE WHEN kind = 'signup' AND mode = 1 THEN 1 END) AS s, count(CASE WHEN kind = 'signup' AND mode = 2 THEN 1 END) AS v, count(DISTINCT CASE WHEN kind = 'signup' THEN usr END) AS u, count(DISTINCT CASE WHEN kind = 'view' THEN usr END) AS w FROM ev WHERE kind IN ('signup', 'view') GROUP BY 1, 2)"""


@query(_sql(_BORROW, [
    ("at least 0", "borrow_amount_raw", "a IS NOT NULL", "a < 0", 1.0), ("at least 0", "repay_amount_raw", "b IS NOT NULL", "b < 0", 1.0), ("net debt is borrowed less repaid", "net_debt_flow_raw", "net IS NOT NULL", "net <> coalesce(a, 0) - coalesce(b, 0)", 1.0), ("in [0, 100]", "last_borrow_rate", "rate IS NOT NULL", "rate NOT BETWEEN 0 AND 100", 1.0),
    ("stable and variable make all", "stable_borrow_count,variable_borrow_count", "true", "s + v <> n", 1.0), ("no stable borrowing", "stable_borrow_count", "true", "s <> 0", 1.0), ("unique_borrowers <= borrow_tx_count", "unique_borrowers,borrow_tx_count", "true", "u > n", 0.99), ("unique_repayers <= repay_tx_count", "unique_repayers,repay_tx_count", "true", "w > m", 0.99),
]))
def v08_borrow_repay_suite(spark, sf_dir):
    df = extract.borrow_repay(roles.events(spark, sf_dir, "borrow"), roles.events(spark, sf_dir, "repay"), roles.tokens(spark, sf_dir), exact=True)
    return _counts(quality.run(df, quality.borrow_repay(df, 20.0)))


_PREV = f"""(WITH {RESERVE} SELECT *, last_value(liquidity_index IGNORE NULLS) OVER w AS bl, last_value(variable_borrow_index IGNORE NULLS) OVER w AS bv FROM r WINDOW w AS (PARTITION BY asset ORDER BY time_bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(_sql(_PREV, [
    ("at least 0", "liquidity_rate", "true", "liquidity_rate < 0", 1.0), ("at least 0", "variable_borrow_rate", "true", "variable_borrow_rate < 0", 1.0), ("at least 10", "liquidity_index", "true", "liquidity_index < 10", 1.0), ("at least 10", "variable_borrow_index", "true", "variable_borrow_index < 10", 1.0),
    ("does not fall within an asset", "liquidity_index", "bl IS NOT NULL", "liquidity_index < bl", 1.0), ("does not fall within an asset", "variable_borrow_index", "bv IS NOT NULL", "variable_borrow_index < bv", 1.0),
]))
def v09_reserve_state_suite(spark, sf_dir):
    df = quality.with_previous(roles.reserve(spark, sf_dir), ("liquidity_index", "variable_borrow_index"))
    return _counts(quality.run(df, quality.reserve_state(df, 10.0)))


@query(_sql("(SELECT p_size * 250 AS ltv, p_size * 240 + 300 AS lt, p_size * 250 AS lb, p_size % 9 AS rf, p_retailprice - 905 AS cap FROM part)", [
    ("at least 0", "supply_cap", "true", "cap < 0", 1.0), ("at least 0", "borrow_cap", "true", "cap < 0", 1.0), ("at least 0", "debt_ceiling", "true", "cap < 0", 1.0), ("in [0, 10000]", "ltv", "true", "ltv > 10000", 1.0), ("in [0, 10000]", "liquidation_threshold", "true", "lt > 10000", 1.0), ("in [0, 10000]", "reserve_factor", "true", "rf > 10000", 1.0),
    ("0 or in [10000, 12000]", "liquidation_bonus", "true", "NOT (lb = 0 OR lb BETWEEN 10000 AND 12000)", 1.0), ("ltv <= liquidation_threshold", "ltv,liquidation_threshold", "true", "ltv > lt", 1.0),
]))
def v10_reserve_config_suite(spark, sf_dir):
    s, cap = F.col("p_size"), F.col("p_retailprice") - 905
    df = roles.table(spark, sf_dir, "part").select((s * 250).alias("ltv"), (s * 240 + 300).alias("liquidation_threshold"), (s * 250).alias("liquidation_bonus"), (s % 9).alias("reserve_factor"), *(cap.alias(n) for n in ("supply_cap", "borrow_cap", "debt_ceiling")))
    return _counts(quality.run(df, quality.reserve_config(df)))


_EVENT_PANEL = f"""WITH {EVENTS}, {TOKENS}, a AS (SELECT time_bucket, asset, CAST(sum(CASE WHEN kind = 'purchase' THEN amount END) AS BIGINT) AS supply_amount_raw, count(CASE WHEN kind = 'purchase' THEN 1 END) AS supply_tx_count, max(CASE WHEN kind = 'purchase' THEN block END) AS latest_supply_block FROM ev WHERE kind IN ('purchase', 'click') GROUP BY 1, 2),
s AS (SELECT a.time_bucket, a.asset, CASE WHEN date_part('day', a.time_bucket) = 7 THEN 'other symbol' ELSE asset_symbol END AS asset_symbol, supply_amount_raw, supply_tx_count, latest_supply_block FROM a LEFT JOIN tok USING (asset)),
n AS (SELECT asset, CASE WHEN min(asset_symbol) <> max(asset_symbol) THEN 2 ELSE 1 END AS symbols FROM s WHERE asset_symbol IS NOT NULL GROUP BY 1)
SELECT s.*, symbols, row_number() OVER (PARTITION BY s.asset ORDER BY time_bucket) = 1 AND symbols IS NOT NULL AS one FROM s LEFT JOIN n USING (asset)"""


@query(_sql(f"({_EVENT_PANEL})", [
    ("time_bucket is not null", "time_bucket", "true", "time_bucket IS NULL", 1.0), ("asset is not null", "asset", "true", "asset IS NULL", 1.0), ("key is unique", "time_bucket,asset", "true", "false", 1.0), ("not negative", "supply_tx_count", "supply_tx_count IS NOT NULL", "supply_tx_count < 0", 1.0), ("not negative", "latest_supply_block", "latest_supply_block IS NOT NULL", "latest_supply_block < 0", 1.0),
    ("bucket is in the window", "time_bucket", "true", "time_bucket >= TIMESTAMP '2024-01-30'", 1.0), ("bucket is on the grid", "time_bucket", "true", "false", 1.0), ("symbol is well formed", "asset_symbol", "asset_symbol IS NOT NULL", "NOT regexp_full_match(asset_symbol, '\\S.{0,31}')", 1.0),
    ("one symbol per asset", "asset,asset_symbol", "one", "symbols > 1", 1.0), ("in [0, 5e+07]", "latest_supply_block", "latest_supply_block IS NOT NULL", "latest_supply_block NOT BETWEEN 0 AND 50000000", 1.0), ("big integer is well formed", "supply_amount_raw", "supply_amount_raw IS NOT NULL", "false", 1.0),
]))
def v06_common_suite(spark, sf_dir):
    panel = extract.supply_withdraw(roles.events(spark, sf_dir, "supply"), roles.events(spark, sf_dir, "withdraw"), roles.tokens(spark, sf_dir)).select("time_bucket", "asset", "asset_symbol", "supply_amount_raw", "supply_tx_count", "latest_supply_block")
    panel = panel.withColumn("asset_symbol", F.when(F.dayofmonth("time_bucket") == 7, F.lit("other symbol")).otherwise(F.col("asset_symbol")))
    key = ["time_bucket", "asset"]
    df = quality.with_symbols(quality.with_key_counts(panel, key))
    return _counts(quality.run(df, quality.common(df, key, "2024-01-01", "2024-01-30", "2 hours")))


def _legs_sql(more: str = "") -> str:
    return f"""(WITH {EVENTS}, leg AS (SELECT time_bucket, 'c' AS leg, asset, amount, usr, usr % 7 AS liq, flag FROM ev WHERE kind = 'error' UNION ALL SELECT time_bucket, 'd', (asset + mode) % 10, amount // 2, usr, usr % 7, flag FROM ev WHERE kind = 'error')
SELECT time_bucket, asset, coalesce(sum(CASE WHEN leg = 'c' THEN amount END), 0) - 100 AS a, coalesce(sum(CASE WHEN leg = 'd' THEN amount END), 0) AS b, count(CASE WHEN leg = 'c' AND flag THEN 1 END) AS r, count(*) AS n, count(DISTINCT usr) AS u, count(DISTINCT liq) + 1 AS l FROM leg GROUP BY 1, 2)"""


@query(_sql(_legs_sql(), [
    ("at least 0", "collateral_amount_raw", "true", "a < 0", 1.0), ("at least 0", "debt_covered_raw", "true", "b < 0", 1.0), ("receive_token_count <= liquidation_tx_count", "receive_token_count,liquidation_tx_count", "true", "r > n", 1.0),
    ("unique_liquidated_users <= liquidation_tx_count", "unique_liquidated_users,liquidation_tx_count", "true", "u > n", 0.99), ("unique_liquidators <= liquidation_tx_count", "unique_liquidators,liquidation_tx_count", "true", "l > n", 0.99),
]))
def v11_liquidation_suite(spark, sf_dir):
    df = extract.liquidation(roles.event_legs(spark, sf_dir), roles.tokens(spark, sf_dir), exact=True)
    df = df.withColumns({"collateral_amount_raw": F.col("collateral_amount_raw") - 100, "unique_liquidators": F.col("unique_liquidators") + 1})
    return _counts(quality.run(df, quality.SUITES[quality.suite_of(df)](df)))


@query(_sql(f"(WITH {EVENTS} SELECT time_bucket, asset, sum(amount) AS a, sum(CASE WHEN block % 50 = 0 THEN amount * 9 ELSE amount // 1000 END) AS p, count(*) AS n, count(CASE WHEN mode <= 1 THEN 1 END) + count(CASE WHEN mode = 2 THEN 1 END) AS m, count(DISTINCT usr) AS u FROM ev WHERE kind = 'click' GROUP BY 1, 2)", [
    ("at least 0", "flashloan_amount_raw", "true", "a < 0", 1.0), ("at least 0", "flashloan_premium_raw", "true", "p < 0", 1.0), ("flashloan_premium_raw <= flashloan_amount_raw", "flashloan_premium_raw,flashloan_amount_raw", "true", "p > a", 1.0), ("modes make all", "mode0_count,mode1_count,mode2_count", "true", "m <> n", 1.0),
    ("unique_initiators <= flashloan_tx_count", "unique_initiators,flashloan_tx_count", "true", "u > n", 0.99),
]))
def v12_flashloan_suite(spark, sf_dir):
    loans = roles.events(spark, sf_dir, "withdraw").withColumn("premium", F.expr("if(block % 50 = 0, amount * 9, amount div 1000)"))
    df = extract.flashloan(loans, roles.tokens(spark, sf_dir), exact=True)
    return _counts(quality.run(df, quality.SUITES[quality.suite_of(df)](df)))


_ACCOUNTS = f"""(WITH {PROTOCOL}, t AS (SELECT *, row_number() OVER (ORDER BY time_bucket) % 6 AS k FROM p) SELECT *, CASE k WHEN 0 THEN '{2**256 - 1}' WHEN 1 THEN NULL WHEN 2 THEN '1' || repeat('0', 35) ELSE '12' || repeat('0', 17) END AS hi FROM t)"""


@query(_sql(_ACCOUNTS, [
    *[("at least 0", c, f"{c} IS NOT NULL", f"{c} < 0", 1.0) for c in ("avg_total_collateral_base", "avg_total_debt_base", "avg_available_borrows_base")], *[("in [0, 10000]", c, f"{c} IS NOT NULL", f"{c} NOT BETWEEN 0 AND 10000", 1.0) for c in ("avg_ltv", "avg_current_liquidation_threshold")],
    ("avg_ltv <= avg_current_liquidation_threshold", "avg_ltv,avg_current_liquidation_threshold", "true", "avg_ltv > avg_current_liquidation_threshold", 1.0), ("avg_total_debt_base <= avg_total_collateral_base", "avg_total_debt_base,avg_total_collateral_base", "true", "avg_total_debt_base > avg_total_collateral_base", 0.9),
    ("min health factor <= max", "min_health_factor,max_health_factor", "hi IS NOT NULL", "k >= 3 AND false", 1.0), ("health factor below 1e30 or none", "min_health_factor", "true", "false", 1.0), ("health factor below 1e30 or none", "max_health_factor", "hi IS NOT NULL", "k = 2", 1.0),
    ("sampled_users <= call_count", "sampled_users,call_count", "true", "sampled_user_count > supply_tx_count + 20", 1.0),
]))
def v13_user_account_suite(spark, sf_dir):
    own = ranks.placed(roles.protocol(spark, sf_dir), [], "time_bucket").withColumn("k", (F.col("_begin") + 1) % 6)
    hi = F.when(F.col("k") == 0, F.lit(str(2**256 - 1))).when(F.col("k") == 2, F.lit("1" + "0" * 35)).when(F.col("k") != 1, F.lit("12" + "0" * 17))
    df = own.select(*(c for c in own.columns if c.startswith("avg_")), F.lit("9" + "0" * 17).alias("min_health_factor"), hi.alias("max_health_factor"), F.col("sampled_user_count").alias("sampled_users"), (F.col("supply_tx_count") + 20).alias("call_count"))
    return _counts(quality.run(df, quality.SUITES[quality.suite_of(df)](df)))


@query(_sql(f"(WITH {EVENTS} SELECT time_bucket, asset, count(CASE WHEN kind = 'view' THEN 1 END) AS e, count(CASE WHEN kind = 'signup' THEN 1 END) AS d, count(DISTINCT CASE WHEN kind = 'view' THEN usr END) + CASE WHEN asset = 3 THEN 1 ELSE 0 END AS ue, count(DISTINCT CASE WHEN kind = 'signup' THEN usr END) AS ud FROM ev WHERE kind IN ('view', 'signup') GROUP BY 1, 2)", [
    ("unique_enable_users <= enabled_count", "unique_enable_users,enabled_count", "true", "ue > e", 0.99), ("unique_disable_users <= disabled_count", "unique_disable_users,disabled_count", "true", "ud > d", 0.99),
]))
def v14_collateral_toggle_suite(spark, sf_dir):
    df = extract.collateral_toggle(roles.events(spark, sf_dir, "repay"), roles.events(spark, sf_dir, "borrow"), roles.tokens(spark, sf_dir), exact=True)
    df = df.withColumn("unique_enable_users", F.col("unique_enable_users") + F.when(F.col("asset") == 3, 1).otherwise(0))
    return _counts(quality.run(df, quality.SUITES[quality.suite_of(df)](df)))


@query(_sql("(SELECT p_partkey, p_size % 40 AS decimals, CASE WHEN p_size > 3 THEN p_retailprice END AS usd, p_size - 1.0 AS eth, p_size - CASE WHEN p_size = 9 THEN 2.0 ELSE 1.0 END AS weth, p_size % 8 AS points FROM part)", [
    ("in [0, 36]", "decimals", "true", "decimals NOT BETWEEN 0 AND 36", 1.0), ("above 0", "avg_price_usd", "usd IS NOT NULL", "usd <= 0", 1.0), ("above 0", "avg_price_eth", "true", "eth <= 0", 1.0), ("above 0", "avg_price_weth", "true", "weth <= 0", 1.0), ("below 1e7", "avg_price_usd", "usd IS NOT NULL", "usd >= 1e7", 1.0),
    ("both names agree", "avg_price_eth,avg_price_weth", "true", "eth <> weth", 1.0), ("in [1, 6]", "price_points", "true", "points NOT BETWEEN 1 AND 6", 1.0),
]))
def v15_oracle_price_suite(spark, sf_dir):
    s = F.col("p_size")
    df = roles.table(spark, sf_dir, "part").select((s % 40).alias("decimals"), F.when(s > 3, F.col("p_retailprice")).alias("avg_price_usd"), (s - 1.0).alias("avg_price_eth"), (s - F.when(s == 9, 2.0).otherwise(1.0)).alias("avg_price_weth"), (s % 8).alias("price_points"))
    return _counts(quality.run(df, quality.SUITES[quality.suite_of(df)](df)))


def _first_cells(bad: str) -> str:
    return f"(SELECT coalesce(string_agg(c_custkey || '=' || c_acctbal, ';' ORDER BY c_custkey), '') FROM (SELECT * FROM customer WHERE {bad} ORDER BY c_custkey LIMIT 10)) AS examples"


@query(f"""SELECT count(TRY_CAST(c_acctbal AS DOUBLE)) AS n_checked, count(CASE WHEN c_acctbal < 0 THEN 1 END) AS n_negative, round(100.0 * count(CASE WHEN c_acctbal < 0 THEN 1 END) / count(*), 4) AS negative_pct, min(c_acctbal) AS min, count(CASE WHEN c_acctbal < 0 THEN 1 END) = 0 AS success, {_first_cells("c_acctbal < 0")} FROM customer""")
def v16_negative_values(spark, sf_dir):
    return quality.negatives(roles.table(spark, sf_dir, "customer"), "c_acctbal", "c_custkey")


@query(f"""SELECT count(c_acctbal) AS n_checked, min(c_acctbal) AS min, max(c_acctbal) AS max, count(CASE WHEN c_acctbal < 0 THEN 1 END) AS n_below, count(CASE WHEN c_acctbal > 9000 THEN 1 END) AS n_above, count(CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN 1 END) AS n_within, round(100.0 * count(CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN 1 END) / count(*), 4) AS within_pct, false AS success, {_first_cells("c_acctbal NOT BETWEEN 0 AND 9000")} FROM customer""")
def v17_range(spark, sf_dir):
    return quality.in_range(roles.table(spark, sf_dir, "customer"), "c_acctbal", 0.0, 9000.0, "c_custkey")


@query("SELECT c_custkey, round(2 * (c_acctbal - lo) / (hi - lo) - 1, 6) AS score FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)")
def v18_deviation_score(spark, sf_dir):
    return quality.deviation_score(roles.table(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", F.round("score", 6).alias("score"))


_VALUES = [f"{n}_value_{d}" for d in ("usd", "eth") for n in ("supply_amount", "withdrawal_amount", "borrow_amount", "repay_amount", "liquidated_collateral", "liquidation_debt_covered", "flashloan_amount", "flashloan_premium")]
_COUNTED = [
    "supply_tx_count", "withdrawal_tx_count", "borrow_tx_count", "repay_tx_count", "variable_borrow_tx_count", "liquidation_tx_count", "flashloan_tx_count", "variable_flashloan_tx_count", "no_open_debt_flashloan_tx_count", "collateral_enabled_count", "collateral_disabled_count", "unique_suppliers", "unique_withdraw_users", "unique_borrowers",
    "unique_repayers", "unique_liquidated_users", "unique_flashloan_initiators", "unique_collateral_enable_users", "unique_collateral_disable_users", "unique_liquidators", "sampled_user_count",
]


def _cells(name: str, tier: str, columns: list[str], bad: str, looked: str = "{x} IS NOT NULL") -> str:
    per = " UNION ALL ".join(f"SELECT '{c}' AS c, count(CASE WHEN {looked.format(x=c)} THEN 1 END) AS n, count(CASE WHEN ({looked.format(x=c)}) AND ({bad.format(x=c)}) THEN 1 END) AS k FROM p" for c in columns)
    return f"SELECT '{tier}' AS tier, '{name}' AS \"check\", 'hard' AS severity, CAST(sum(n) AS BIGINT) AS n_checked, CAST(sum(n) - sum(k) AS BIGINT) AS n_pass, CAST(sum(k) AS BIGINT) AS n_fail, round(100.0 * (sum(n) - sum(k)) / sum(n), 4) AS pass_rate_pct, coalesce(string_agg(CASE WHEN k > 0 THEN c END, ';' ORDER BY c), '') AS anomaly_columns FROM ({per})"


_BPS = ["avg_ltv", "avg_current_liquidation_threshold"]
_AVG = ["avg_total_collateral_base", "avg_total_debt_base", "avg_available_borrows_base", *_BPS]


@query(f"WITH {PROTOCOL} " + " UNION ALL ".join([_cells("bucket is a UTC timestamp", "T0", ["time_bucket"], "hour({x}) = 4", "true"), _cells("counts are whole", "T0", _COUNTED, "{x} <> floor({x})"), _cells("counts are complete", "T0", _COUNTED, "{x} IS NULL", "true"), _cells("values are numbers", "T0", _VALUES + _AVG, "false")]))
def v_t0_schema(spark, sf_dir):
    df = roles.protocol(spark, sf_dir)
    return quality.tier0(df.withColumn("time_bucket", F.when(F.hour("time_bucket") == 4, F.date_format("time_bucket", "yyyy-MM-dd HH:mm:ss")).otherwise(fc.canonical_time("time_bucket"))))


@query(f"WITH {PROTOCOL} " + " UNION ALL ".join([_cells("not negative", "T1", _COUNTED + _VALUES, "{x} < 0"), _cells("basis points in 0..10000", "T1", _BPS, "{x} NOT BETWEEN 0 AND 10000"), _cells("basis points are not fractions", "T1", _BPS, "{x} > 0 AND {x} <= 1"), _cells("no sentinel, no unscaled value", "T1", _VALUES, "{x} IN (-1, 1e18, 999999999) OR abs({x}) >= 1e15")]))
def v_t1_domain(spark, sf_dir):
    return quality.tier1(roles.protocol(spark, sf_dir))


def _t2() -> list[tuple[str, str, str, str, float]]:
    rows = [(f"{a} <= {b}", f"{a},{b}", f"{a} IS NOT NULL AND {b} IS NOT NULL", f"{a} > {b}", 1.0) for a, b in quality.UNIQUE_PAIRS + quality.SUBSET_PAIRS]
    for f, (a, m, u) in quality.FAMILIES.items():
        every = lambda cond, own=(*m, *u): " AND ".join(f"coalesce({x} {cond}, false)" for x in own)
        none = " AND ".join(f"{x} IS NULL" for x in (*m, *u))
        rows.append((f"{f}: count, amounts and users agree", a, f"NOT ({a} IS NULL AND {none})", f"NOT (CASE WHEN {a} = 0 THEN {every('= 0')} WHEN {a} > 0 THEN {every('> 0')} ELSE false END)", 1.0))
    for a, b in (("liquidation_debt_covered_value_usd", "liquidated_collateral_value_usd"), ("avg_ltv", "avg_current_liquidation_threshold"), ("avg_total_debt_base", "avg_total_collateral_base")):
        rows.append((f"{a} <= {b}", f"{a},{b}", f"{a} IS NOT NULL AND {b} IS NOT NULL", f"{a} > {b}", 1.0))
    rows.append(("at least two users sampled", "sampled_user_count", "true", "sampled_user_count < 2", 1.0))
    return rows + [("no mean without users", a, "sampled_user_count = 0", f"{a} IS NOT NULL", 1.0) for a in _AVG]


@query(_sql("p", _t2()).replace("SELECT \"check\", columns, n AS", f"WITH {PROTOCOL} SELECT \"check\", columns, n AS", 1))
def v_t2_invariants(spark, sf_dir):
    df = roles.protocol(spark, sf_dir)
    return _counts(quality.run(df, quality.tier2(df)))


def _states(family: str) -> str:
    a, m, u = quality.FAMILIES[family]
    every = lambda cond: " AND ".join(f"coalesce({x} {cond}, false)" for x in (*m, *u))
    none = " AND ".join(f"{x} IS NULL" for x in (a, *m, *u))
    return f"SELECT '{family}' AS family, count(CASE WHEN {none} THEN 1 END) AS all_null, count(CASE WHEN {a} = 0 AND {every('= 0')} THEN 1 END) AS structural_zero, count(CASE WHEN {a} > 0 THEN 1 END) AS active FROM p"


@query(f"WITH {PROTOCOL} " + " UNION ALL ".join(map(_states, quality.FAMILIES)))
def v_t2_states(spark, sf_dir):
    return quality.coupling(roles.protocol(spark, sf_dir))


_SEVERITY = {"liquidation_debt_covered_value_usd <= liquidated_collateral_value_usd": "soft", "avg_total_debt_base <= avg_total_collateral_base": "soft", "at least two users sampled": "soft"}


def _examples(source: str, rows: list[tuple[str, str, str, str, float]]) -> str:
    """SQL of failing rows' buckets, at most ten a check: (check, columns, severity, n_fail, examples)."""
    one = """SELECT '{n}' AS "check", '{c}' AS columns, '{v}' AS severity, (SELECT count(*) FROM {s} WHERE ({l}) AND ({b})) AS n_fail, (SELECT coalesce(string_agg(t, ',' ORDER BY t), '') FROM (SELECT strftime(time_bucket, '%Y-%m-%d %H:%M:%S') AS t FROM {s} WHERE ({l}) AND ({b}) ORDER BY 1 LIMIT 10)) AS examples"""
    return " UNION ALL ".join(one.format(n=n, c=c, v=_SEVERITY.get(n, "hard"), l=look, b=b, s=source) for n, c, look, b, _ in rows)


@query(f"WITH {PROTOCOL} " + _examples("p", _t2()))
def v_t2_failing_examples(spark, sf_dir):
    df = roles.protocol(spark, sf_dir)
    return quality.run(df, quality.tier2(df), "protocol", ("time_bucket",)).select("check", "columns", "severity", "n_fail", F.array_join("examples", ",").alias("examples"))


_PAIRS = [(f"{n}_value_usd", f"{n}_value_eth") for n in ("supply_amount", "withdrawal_amount", "borrow_amount", "repay_amount", "liquidated_collateral", "liquidation_debt_covered", "flashloan_amount", "flashloan_premium")]
_IMPLIED = ", ".join(f"CASE WHEN {u} > 0 AND {e} > 0 THEN {u} / {e} END" for u, e in _PAIRS if "premium" not in u)
#: The protocol series with the spread of the prices that its families imply.
SPREAD = f"{PROTOCOL}, sp0 AS (SELECT *, list_sort(list_filter([{_IMPLIED}], lambda x: x IS NOT NULL)) AS ps FROM p), sp AS (SELECT *, CASE WHEN len(ps) >= 2 THEN (ps[len(ps)] - ps[1]) / nullif(ps[len(ps) // 2 + 1], 0) END AS spread FROM sp0)"
_T3 = [("both denominations are there", f"{u},{e}", f"{u} IS NOT NULL OR {e} IS NOT NULL", f"(coalesce({u}, 0) = 0) <> (coalesce({e}, 0) = 0)", 1.0) for u, e in _PAIRS] + [("families imply one price", "usd/eth", "spread IS NOT NULL", "spread > 0.05", 1.0)]


@query(_sql("sp", _T3).replace("SELECT \"check\", columns, n AS", f"WITH {SPREAD} SELECT \"check\", columns, n AS", 1))
def v_t3_consistency(spark, sf_dir):
    df, checks = quality.tier3(roles.protocol(spark, sf_dir))
    return _counts(quality.run(df, checks))


@query(f"WITH {SPREAD}, o AS (SELECT spread, row_number() OVER (ORDER BY spread) - 1 AS i, count(*) OVER () AS n FROM sp WHERE spread IS NOT NULL) SELECT round(max(CASE WHEN i = n // 2 THEN spread END), 9) AS median_spread, round(max(CASE WHEN i = floor(0.95 * (n - 1)) THEN spread END), 9) AS p95, round(max(spread), 9) AS max FROM o")
def v_t3_spread_summary(spark, sf_dir):
    df, _ = quality.tier3(roles.protocol(spark, sf_dir))
    return rounded(quality.spread_summary(df), 9)


_SHIFT = """SELECT '{c}' AS "column", max(n) AS n, round(median(CASE WHEN i < n // 2 THEN v END), 6) AS first_half, round(median(CASE WHEN i >= n // 2 THEN v END), 6) AS second_half, max(n) >= 4 AND abs(median(CASE WHEN i >= n // 2 THEN v END) - median(CASE WHEN i < n // 2 THEN v END)) >= 1 AS shifted FROM (SELECT time_bucket, log10({c}) AS v, row_number() OVER (ORDER BY time_bucket) - 1 AS i, count(*) OVER () AS n FROM p WHERE {c} > 0)"""
_BASES = _AVG[:3]


@query(f"WITH {PROTOCOL} " + " UNION ALL ".join(_SHIFT.format(c=c) for c in _BASES))
def v_t3_level_shift(spark, sf_dir):
    out = quality.level_shift(roles.protocol(spark, sf_dir), _BASES)
    return out.withColumns({c: F.round(c, 6) for c in ("first_half", "second_half")})


@query(f"WITH {PROTOCOL}, o AS (SELECT DISTINCT time_bucket FROM p WHERE supply_tx_count > 0), g AS (SELECT unnest(generate_series(min(time_bucket), max(time_bucket), INTERVAL '2 hours')) AS time_bucket FROM o) SELECT time_bucket FROM g WHERE time_bucket NOT IN (SELECT time_bucket FROM o)")
def v_t4_gaps(spark, sf_dir):
    return quality.gaps(roles.protocol(spark, sf_dir).where("supply_tx_count > 0"), "2 hours")


@query(_sql("(SELECT ts, lag(ts) OVER (ORDER BY event_id) AS last, count(*) OVER (PARTITION BY ts) AS same FROM (SELECT event_id, date_trunc('hour', ts) + INTERVAL '1 minute' * (event_id % 2) AS ts FROM events))", [
    ("bucket is unique", "time_bucket", "true", "same > 1", 1.0), ("bucket is on the grid", "time_bucket", "true", "ts <> date_trunc('hour', ts)", 1.0), ("buckets increase", "time_bucket", "last IS NOT NULL", "ts <= last", 1.0),
]))
def v_t4_temporal(spark, sf_dir):
    ev = roles.table(spark, sf_dir, "events").select("event_id", (F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("event_id") % 2).cast("int"))).alias("time_bucket"))
    df, checks = quality.temporal(ev, "1 hour", "event_id")
    return _counts(quality.run(df, checks))


def _records(tier: str, rows: list[tuple[str, str, str, str, float]], source: str, text: str, key: str = "strftime(time_bucket, '%Y-%m-%d %H:%M:%S')") -> str:
    """SQL of checks in the shape of whole_frame, with the keys of at most ten failing rows."""
    one = """SELECT '{t}' AS tier, '{n}' AS "check", '{c}' AS columns, '{v}' AS severity, (SELECT count(*) FROM {s} WHERE {l}) AS n_checked, (SELECT count(*) FROM {s} WHERE ({l}) AND ({b})) AS n_fail, (SELECT coalesce(string_agg(k, ';' ORDER BY k), '') FROM (SELECT {k} AS k FROM {s} WHERE ({l}) AND ({b}) ORDER BY 1 LIMIT 10)) AS anomalies"""
    soft = _SEVERITY | {"families imply one price": "soft"}
    return " UNION ALL ".join(one.format(t=tier, n=n, c=c, v=soft.get(n, "hard"), l=look, b=b, s=source, k=key) for n, c, look, b, _ in rows)


def _finished(sql: str) -> str:
    return f'SELECT tier, "check", columns, severity, n_checked, n_checked - n_fail AS n_pass, n_fail, round(100.0 * (n_checked - n_fail) / nullif(n_checked, 0), 4) AS pass_rate_pct, anomalies FROM ({sql})'


_CELLED = " UNION ALL ".join(
    f"SELECT tier, \"check\", '' AS columns, severity, n_checked, n_fail, anomaly_columns AS anomalies FROM ({x})"
    for x in (
        _cells("counts are whole", "T0", _COUNTED, "{x} <> floor({x})"), _cells("counts are complete", "T0", _COUNTED, "{x} IS NULL", "true"), _cells("values are numbers", "T0", _VALUES + _AVG, "false"), _cells("not negative", "T1", _COUNTED + _VALUES, "{x} < 0"), _cells("basis points in 0..10000", "T1", _BPS, "{x} NOT BETWEEN 0 AND 10000"),
        _cells("basis points are not fractions", "T1", _BPS, "{x} > 0 AND {x} <= 1"), _cells("no sentinel, no unscaled value", "T1", _VALUES, "{x} IN (-1, 1e18, 999999999) OR abs({x}) >= 1e15"),
    )
)
_T4 = [("bucket is unique", "time_bucket", "true", "same > 1", 1.0), ("bucket is on the grid", "time_bucket", "true", "false", 1.0), ("buckets increase", "time_bucket", "last IS NOT NULL", "time_bucket <= last", 1.0)]


@query(
    f"WITH {SPREAD}, o4 AS (SELECT time_bucket, lag(time_bucket) OVER (ORDER BY CAST(epoch(time_bucket) AS BIGINT) // 7200 * 7919 % 1000003) AS last, count(*) OVER (PARTITION BY time_bucket) AS same FROM p), g4 AS (SELECT unnest(generate_series(min(time_bucket), max(time_bucket), INTERVAL '2 hours')) AS time_bucket FROM p), sh AS ("
    + " UNION ALL ".join(_SHIFT.format(c=c) for c in _BASES) + ") "
    + _finished(" UNION ALL ".join([
        _CELLED, _records("T2", _t2(), "p", ""), _records("T3", _T3, "sp", ""), _records("T4", _T4, "o4", ""),
        "SELECT 'T3', 'level is stable', 'avg_*_base', 'soft', count(CASE WHEN n >= 4 THEN 1 END), count(CASE WHEN shifted THEN 1 END), coalesce(string_agg(CASE WHEN shifted THEN \"column\" END, ';' ORDER BY \"column\"), '') FROM sh",
        "SELECT 'T4', 'no bucket is missing', 'time_bucket', 'hard', (SELECT count(*) FROM g4), (SELECT count(*) FROM g4 WHERE time_bucket NOT IN (SELECT time_bucket FROM p)), (SELECT coalesce(string_agg(t, ';' ORDER BY t), '') FROM (SELECT strftime(time_bucket, '%Y-%m-%d %H:%M:%S') AS t FROM g4 WHERE time_bucket NOT IN (SELECT time_bucket FROM p) ORDER BY 1 LIMIT 10))",
    ]))
)
def v_e1_protocol_frame(spark, sf_dir):
    """All tiers of the protocol series; its rows are taken in an order other than that of time, so that some fail."""
    df = roles.protocol(spark, sf_dir).withColumn("ordinal", F.expr("unix_seconds(cast(time_bucket as timestamp)) div 7200 * 7919 % 1000003"))
    return quality.whole_frame(df, "2 hours", "ordinal")


_E2 = [
    ("key is unique", "time_bucket,asset", "true", "false", 1.0), ("bucket is a UTC timestamp", "time_bucket", "true", "asset = 3", 1.0), ("bucket is on the grid", "time_bucket", "true", "false", 1.0),
    *[("at least 0", c, f"{c} IS NOT NULL", f"{c} < 0", 1.0) for c in ("last_borrow_rate", "liquidity_rate", "variable_borrow_rate")], *[("at least 1", c, f"{c} IS NOT NULL", f"{c} < 1", 1.0) for c in ("liquidity_index", "variable_borrow_index")],
    ("does not fall within an asset", "liquidity_index", "bl IS NOT NULL", "liquidity_index < bl", 1.0), ("does not fall within an asset", "variable_borrow_index", "bv IS NOT NULL", "variable_borrow_index < bv", 1.0),
]
_E2_TIERS = {"key is unique": "T0", "bucket is a UTC timestamp": "T0", "bucket is on the grid": "T4", "at least 0": "T1", "at least 1": "T1", "does not fall within an asset": "T2"}


@query(f"WITH rp AS {_PREV.replace('(WITH', '(WITH', 1)} " + _finished(" UNION ALL ".join(_records(_E2_TIERS[row[0]], [row], "rp", "", "strftime(time_bucket, '%Y-%m-%d %H:%M:%S') || ' ' || asset") for row in _E2)))
def v_e2_reserve_panel(spark, sf_dir):
    stamp = F.when(F.col("asset") == 3, F.date_format("time_bucket", "yyyy-MM-dd HH:mm:ss")).otherwise(fc.canonical_time("time_bucket"))
    return quality.reserve_frame(roles.reserve(spark, sf_dir).withColumn("time_bucket", stamp), "1 day")


@query("SELECT 'protocol' AS \"table\", 'T2' AS tier, severity, count(*) AS n_checks, CAST(sum(CASE WHEN n_fail > 0 THEN 1 ELSE 0 END) AS INTEGER) AS n_failing FROM (" + f"WITH {PROTOCOL} " + _examples("p", _t2()) + ") GROUP BY 3")
def a17_check_overview(spark, sf_dir):
    df = roles.protocol(spark, sf_dir)
    out = quality.overview(quality.run(df, quality.tier2(df), "protocol"))
    return out.withColumn("n_failing", F.col("n_failing").cast("int"))


@query(f"""WITH a AS ({_sql(_legs_sql(), [("receive", "r", "true", "r > n", 1.0), ("users", "u", "true", "u > n", 0.99)])}), b AS ({_sql(_BORROW, [("net", "net", "true", "net <> coalesce(a, 0) - coalesce(b, 0)", 1.0), ("stable", "s", "true", "s <> 0", 1.0)])})
SELECT 'borrow' AS "table", 2 AS n_checks, count(CASE WHEN NOT success THEN 1 END) AS n_failing, CASE WHEN count(CASE WHEN NOT success THEN 1 END) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM b UNION ALL SELECT 'liquidation', 2, count(CASE WHEN NOT success THEN 1 END), CASE WHEN count(CASE WHEN NOT success THEN 1 END) > 0 THEN 'FAIL' ELSE 'PASS' END FROM a""")
def v05_batch(spark, sf_dir):
    """Two tables with some of their checks each: how many fail, and whether the table passes."""
    borrow = extract.borrow_repay(roles.events(spark, sf_dir, "borrow"), roles.events(spark, sf_dir, "repay"), roles.tokens(spark, sf_dir), exact=True)
    legs = extract.liquidation(roles.event_legs(spark, sf_dir), roles.tokens(spark, sf_dir), exact=True)
    named = {"net debt is borrowed less repaid", "no stable borrowing", "receive_token_count <= liquidation_tx_count", "unique_liquidated_users <= liquidation_tx_count"}
    some = lambda df, t: quality.run(df, [k for k in quality.SUITES[quality.suite_of(df)](df) if k.name in named], t)
    return quality.batch([some(borrow, "borrow"), some(legs, "liquidation")]).withColumn("n_checks", F.col("n_checks").cast("int"))


@query("SELECT o_orderkey, date_trunc('second', TRY_CAST(replace(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S UTC'), ' UTC', '') AS TIMESTAMP)) AS t FROM orders")
def f04_parsed_times(spark, sf_dir):
    return roles.table(spark, sf_dir, "orders").select("o_orderkey", fc.parsed_time(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss 'UTC'")).alias("t"))
