"""Queries over panels: valuation, assembly, derived features and windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import extract, features, panels
from ..sources import roles
from ..sources.stored import stored
from .base import EVENTS, PROTOCOL, RESERVE, TOKENS, query, rounded

#: Prices of the events' assets by bucket: mean value, and that over the mean of asset 0.
EV_PRICES = """pr AS (SELECT time_bucket, asset, sum(amount)::DOUBLE / count(*) / 100 AS usd FROM ev WHERE kind <> 'error' GROUP BY 1, 2),
pe AS (SELECT time_bucket, asset, usd AS avg_price_usd, usd / base AS avg_price_eth FROM pr JOIN (SELECT time_bucket, usd AS base FROM pr WHERE asset = 0) USING (time_bucket))"""


def _prices(spark, sf_dir):
    ev = roles.events(spark, sf_dir).where("kind <> 'error'").withColumn("time_bucket", fc.bucket("time"))
    own = ev.groupBy("time_bucket", "asset").agg((F.sum(F.col("amount").cast("long")) / F.count("*") / 100).alias("avg_price_usd"))
    base = own.where("asset = 0").select("time_bucket", F.col("avg_price_usd").alias("base"))
    return own.join(base, "time_bucket").withColumn("avg_price_eth", F.col("avg_price_usd") / F.col("base")).drop("base")


def _given(prices, spark, sf_dir):
    return _prices(spark, sf_dir) if prices is None else prices


def _valued(kinds: dict[str, str], counts: str) -> str:
    """SQL of flows(): amounts per asset, scaled, priced, and summed per bucket."""
    sums = ", ".join(f"CAST(sum(CASE WHEN {cond} THEN amount END) AS BIGINT) AS {n}" for n, cond in kinds.items())
    out = ", ".join(f"round(coalesce(sum({n}::DOUBLE / pow(10.0, decimals) * avg_price_{d}), 0), 5) AS {n}_value_{d}" for n in kinds for d in ("usd", "eth"))
    names = [c.split(" AS ")[-1].strip() for c in counts.split(";")]
    return f"""WITH {EVENTS}, {TOKENS}, {EV_PRICES}, a AS (SELECT time_bucket, asset, {sums}, {counts.replace(";", ",")} FROM ev WHERE {" OR ".join(f"({c})" for c in kinds.values())} GROUP BY 1, 2)
SELECT time_bucket, {out}, {", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)} FROM a LEFT JOIN tok USING (asset) LEFT JOIN pe USING (time_bucket, asset) GROUP BY 1"""


def _users(**kinds: str) -> str:
    return "; ".join(f"count(DISTINCT CASE WHEN {cond} THEN usr END) AS {n}" for n, cond in kinds.items())


def _numbers(**kinds: str) -> str:
    return "; ".join(f"count(CASE WHEN {cond} THEN 1 END) AS {n}" for n, cond in kinds.items())


_SUPPLY, _WITHDRAW, _BORROW, _REPAY = ("kind = 'purchase'", "kind = 'click'", "kind = 'signup'", "kind = 'view'")
X01 = _valued({"supply_amount": _SUPPLY, "withdrawal_amount": _WITHDRAW}, _numbers(supply_tx_count=_SUPPLY, withdrawal_tx_count=_WITHDRAW) + "; " + _users(unique_suppliers=_SUPPLY, unique_withdraw_users=_WITHDRAW))
X02 = _valued({"borrow_amount": _BORROW, "repay_amount": _REPAY}, _numbers(borrow_tx_count=_BORROW, repay_tx_count=_REPAY, variable_borrow_count=_BORROW + " AND mode = 2") + "; " + _users(unique_borrowers=_BORROW, unique_repayers=_REPAY))


@query(X01)
def x01_supply_withdraw_flows(spark, sf_dir, prices=None):
    panel = extract.supply_withdraw(roles.events(spark, sf_dir, "supply"), roles.events(spark, sf_dir, "withdraw"), roles.tokens(spark, sf_dir), exact=True)
    return rounded(panels.flows(panel, roles.tokens(spark, sf_dir), _given(prices, spark, sf_dir), ["supply_amount_raw", "withdrawal_amount_raw"], ["supply_tx_count", "withdrawal_tx_count", "unique_suppliers", "unique_withdraw_users"]), 5)


def _borrow_panel(spark, sf_dir):
    return extract.borrow_repay(roles.events(spark, sf_dir, "borrow"), roles.events(spark, sf_dir, "repay"), roles.tokens(spark, sf_dir), exact=True)


@query(X02)
def x02_borrow_repay_flows(spark, sf_dir, prices=None):
    counts = ["borrow_tx_count", "repay_tx_count", "variable_borrow_count", "unique_borrowers", "unique_repayers"]
    return rounded(panels.flows(_borrow_panel(spark, sf_dir), roles.tokens(spark, sf_dir), _given(prices, spark, sf_dir), ["borrow_amount_raw", "repay_amount_raw"], counts), 5)


#: Borrow rates (b) beside reserve rates (u), by bucket and asset.
RATES = f"""b AS (SELECT time_bucket, asset, asset_symbol, round(rate / 100.0::DOUBLE, 6) AS last_borrow_rate FROM (SELECT time_bucket, asset, arg_max(rate, CASE WHEN {_BORROW} THEN block END) AS rate FROM ev WHERE {_BORROW} OR {_REPAY} GROUP BY 1, 2) LEFT JOIN tok USING (asset)),
u AS (SELECT time_bucket, asset, round(arg_max(rate, block) / 100.0::DOUBLE, 6) AS liquidity_rate, round(arg_max(rate + mode, block) / 100.0::DOUBLE, 6) AS variable_borrow_rate, round(max(block) / 100.0::DOUBLE, 6) AS liquidity_index, round(max(block) * 2 / 100.0::DOUBLE, 6) AS variable_borrow_index, count(*) AS update_count FROM ev WHERE {_REPAY} GROUP BY 1, 2)"""
_RATE_FIELDS = ("liquidity_rate", "variable_borrow_rate", "stable_borrow_rate", "liquidity_index", "variable_borrow_index")


def _reserve_panel(spark, sf_dir, config=None):
    borrow = _borrow_panel(spark, sf_dir).withColumn("last_borrow_rate", F.col("last_borrow_rate") / 100.0)
    return panels.reserve_panel(borrow, extract.reserve_state(roles.rate_updates(spark, sf_dir), _RATE_FIELDS, "2 hours", 100.0), config)


@query(f"WITH {EVENTS}, {TOKENS}, {RATES} SELECT b.*, u.* EXCLUDE (time_bucket, asset), strftime(b.time_bucket, '%Y-%m-%d %H:%M:%S.000 UTC') AS stamp FROM b LEFT JOIN u ON b.time_bucket = u.time_bucket AND b.asset = u.asset")
def x03_reserve_panel(spark, sf_dir):
    return rounded(_reserve_panel(spark, sf_dir).withColumn("stamp", fc.canonical_time("time_bucket")))


@query("""SELECT date_trunc('day', o_orderdate) AS time_bucket, round(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) / 100.0::DOUBLE, 2) AS ceiling, count(*) AS changes FROM orders GROUP BY 1""")
def x04_config_sums(spark, sf_dir):
    ch = roles.config_changes(spark, sf_dir).withColumn("changes", F.lit(1)).withColumn("time_bucket", fc.bucket("time", "1 day"))
    out = panels.aggregate_by_time_bucket(ch, ["value", "changes"])
    return rounded(panels.scale_by_decimals(out, {"value": 2}).withColumnRenamed("value_scaled", "ceiling"), 2)


#: Caps by bucket and asset (g), valued in both denominations; the ceiling has two decimals.
CAPS = f"""l AS (SELECT time_bucket AS f, asset, mode, arg_max(amount, block) AS v FROM ev WHERE kind = 'error' GROUP BY 1, 2, 3), iv AS (SELECT *, lead(f) OVER (PARTITION BY asset, mode ORDER BY f) AS e FROM l),
t AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL '2 hours')) AS time_bucket),
st AS (SELECT time_bucket, asset, coalesce(max(CASE WHEN mode = 0 THEN v END), 0) AS supply_cap, coalesce(max(CASE WHEN mode = 1 THEN v END), 0) AS borrow_cap, coalesce(max(CASE WHEN mode = 2 THEN v END), 0) / 100.0::DOUBLE AS debt_ceiling FROM t JOIN iv ON time_bucket >= f AND (e IS NULL OR time_bucket < e) GROUP BY 1, 2),
g AS (SELECT st.time_bucket, st.asset, {", ".join(f"{c} * avg_price_{d} AS {c}_value_{d}" for c in roles.PARAMETERS for d in ("usd", "eth"))} FROM st LEFT JOIN pe ON st.time_bucket = pe.time_bucket AND st.asset = pe.asset)"""
_CAP_VALUES = [f"{c}_value_{d}" for c in roles.PARAMETERS for d in ("usd", "eth")]


def _valued_caps(spark, sf_dir):
    state = extract.reserve_config(roles.cap_changes(spark, sf_dir), roles.tokens(spark, sf_dir), roles.PARAMETERS, "2024-01-01", "2024-01-31")
    state = state.withColumn("debt_ceiling", F.col("debt_ceiling") / 100.0)
    return panels.multiply_by_price(state, _prices(spark, sf_dir), roles.PARAMETERS).select("time_bucket", "asset", *_CAP_VALUES)


@query(f"WITH {EVENTS}, {EV_PRICES}, {CAPS} SELECT time_bucket, {', '.join(f'floor(coalesce(sum({c}), 0) * 1e4 + 0.123) / 1e4 AS {c}' for c in _CAP_VALUES)} FROM g GROUP BY 1")
def x04_config_values(spark, sf_dir):
    """Sums are cut to four digits at a place where no short decimal stands, as their last bits depend on the order of rows."""
    out = panels.aggregate_by_time_bucket(_valued_caps(spark, sf_dir), _CAP_VALUES)
    return out.select("time_bucket", *((F.floor(F.col(c) * 1e4 + 0.123) / 1e4).alias(c) for c in _CAP_VALUES))


@query(f"WITH {EVENTS}, {TOKENS}, {EV_PRICES}, {RATES}, {CAPS} SELECT b.time_bucket, b.asset, b.asset_symbol, last_borrow_rate, liquidity_rate, liquidity_index, {', '.join(f'floor({c} * 1e4 + 0.5) / 1e4 AS {c}' for c in _CAP_VALUES)} FROM b LEFT JOIN u ON b.time_bucket = u.time_bucket AND b.asset = u.asset LEFT JOIN g ON b.time_bucket = g.time_bucket AND b.asset = g.asset")
def x04_config_on_panel(spark, sf_dir):
    out = _reserve_panel(spark, sf_dir, _valued_caps(spark, sf_dir))
    return out.select("time_bucket", "asset", "asset_symbol", *(F.round(c, 6).alias(c) for c in ("last_borrow_rate", "liquidity_rate", "liquidity_index")), *((F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c) for c in _CAP_VALUES))


_EVENT_LEGS = """leg AS (SELECT time_bucket, 'c' AS leg, asset, amount, usr, usr % 7 AS liq, block FROM ev WHERE kind = 'error' UNION ALL SELECT time_bucket, 'd', (asset + mode) % 10, amount // 2, usr, usr % 7, block FROM ev WHERE kind = 'error'),
la AS (SELECT time_bucket, asset, coalesce(sum(CASE WHEN leg = 'c' THEN amount END), 0) AS collateral_amount, coalesce(sum(CASE WHEN leg = 'd' THEN amount END), 0) AS debt_covered, count(CASE WHEN leg = 'c' THEN 1 END) AS collateral_tx_count, count(CASE WHEN leg = 'd' THEN 1 END) AS debt_tx_count, count(*) AS liquidation_tx_count, count(DISTINCT usr) AS unique_liquidated_users, count(DISTINCT liq) AS unique_liquidators FROM leg GROUP BY 1, 2)"""
_LEG_COUNTS = ["collateral_tx_count", "debt_tx_count", "liquidation_tx_count", "unique_liquidated_users", "unique_liquidators"]
X05 = f"""WITH {EVENTS}, {TOKENS}, {EV_PRICES}, {_EVENT_LEGS} SELECT time_bucket, {", ".join(f"round(coalesce(sum({n}::DOUBLE / pow(10.0, decimals) * avg_price_{d}), 0), 5) AS {n}_value_{d}" for n in ("collateral_amount", "debt_covered") for d in ("usd", "eth"))},
{", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in _LEG_COUNTS)} FROM la LEFT JOIN tok USING (asset) LEFT JOIN pe USING (time_bucket, asset) GROUP BY 1"""


@query(X05)
def x05_liquidation_flows(spark, sf_dir, prices=None):
    """Both legs of each liquidation, valued."""
    own = extract.liquidation(roles.event_legs(spark, sf_dir), roles.tokens(spark, sf_dir), exact=True)
    return rounded(panels.flows(own, roles.tokens(spark, sf_dir), _given(prices, spark, sf_dir), ["collateral_amount_raw", "debt_covered_raw"], _LEG_COUNTS), 5)


_TOGGLES = ["enabled_count", "disabled_count", "unique_enable_users", "unique_disable_users"]
_TOGGLED = f"""ct AS (SELECT time_bucket, asset, count(CASE WHEN {_REPAY} THEN 1 END) AS enabled_count, count(CASE WHEN {_BORROW} THEN 1 END) AS disabled_count, count(DISTINCT CASE WHEN {_REPAY} THEN usr END) AS unique_enable_users, count(DISTINCT CASE WHEN {_BORROW} THEN usr END) AS unique_disable_users FROM ev WHERE {_REPAY} OR {_BORROW} GROUP BY 1, 2)"""
X06 = f"WITH {EVENTS}, {_TOGGLED} SELECT time_bucket, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _TOGGLES)} FROM ct GROUP BY 1"


def _toggles(spark, sf_dir):
    return extract.collateral_toggle(roles.events(spark, sf_dir, "repay"), roles.events(spark, sf_dir, "borrow"), roles.tokens(spark, sf_dir), exact=True)


@query(f"""WITH {EVENTS}, {_TOGGLED}, a AS (SELECT time_bucket(INTERVAL '6 hours', time_bucket) AS time_bucket, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _TOGGLES)} FROM ct GROUP BY 1),
g AS (SELECT unnest(generate_series(min(time_bucket), max(time_bucket), INTERVAL '6 hours')) AS time_bucket FROM a) SELECT time_bucket, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _TOGGLES)} FROM g LEFT JOIN a USING (time_bucket)""")
def x06_collateral_sums(spark, sf_dir):
    return panels.aggregate_by_time_bucket(_toggles(spark, sf_dir), _TOGGLES, freq="6 hours")


_LOAN_COUNTS = ["flashloan_tx_count", "unique_initiators", "mode0_count", "mode1_count"]
_LOANS = """fl AS (SELECT time_bucket, asset, sum(amount) AS flashloan_amount, sum(amount // 1000) AS flashloan_premium, count(*) AS flashloan_tx_count, count(DISTINCT usr) AS unique_initiators, count(CASE WHEN mode = 0 THEN 1 END) AS mode0_count, count(CASE WHEN mode = 1 THEN 1 END) AS mode1_count FROM ev WHERE kind = 'click' GROUP BY 1, 2)"""
X07 = f"""WITH {EVENTS}, {TOKENS}, {EV_PRICES}, {_LOANS} SELECT time_bucket, {", ".join(f"round(coalesce(sum({n}::DOUBLE / pow(10.0, decimals) * avg_price_{d}), 0), 5) AS {n}_value_{d}" for n in ("flashloan_amount", "flashloan_premium") for d in ("usd", "eth"))},
{", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in _LOAN_COUNTS)} FROM fl LEFT JOIN tok USING (asset) LEFT JOIN pe USING (time_bucket, asset) GROUP BY 1"""


@query(X07)
def x07_flashloan_flows(spark, sf_dir, prices=None):
    """Values of amounts and premiums, joined to the sums of counts."""
    loans = roles.events(spark, sf_dir, "withdraw").withColumn("premium", F.expr("amount div 1000"))
    panel = extract.flashloan(loans, roles.tokens(spark, sf_dir), exact=True)
    values = panels.flows(panel, roles.tokens(spark, sf_dir), _given(prices, spark, sf_dir), ["flashloan_amount_raw", "flashloan_premium_raw"], [])
    return rounded(panels.assembled(values, panels.aggregate_by_time_bucket(panel, _LOAN_COUNTS)), 5)


#: Decimals of the account means, as the metric dictionary has them.
_ACCOUNT = {"avg_total_collateral_base": 8, "avg_total_debt_base": 8, "avg_available_borrows_base": 8, "avg_ltv": 4, "avg_current_liquidation_threshold": 4}
X08 = f"WITH {PROTOCOL}, cc AS (SELECT time_bucket, count(*) AS account_data_call_count FROM ev GROUP BY 1) SELECT time_bucket, account_data_call_count, {', '.join(f'round({c} / 1e{d}, 10) AS {c}_scaled' for c, d in _ACCOUNT.items())}, sampled_user_count FROM p JOIN cc USING (time_bucket)"


@query(X08)
def x08_column_decimals(spark, sf_dir):
    """Each column over the decimals that the dictionary gives its metric."""
    book = extract.metric_dictionary(spark, [(c, d, "base") for c, d in _ACCOUNT.items()])
    decimals = {r.metric: r.decimals for r in book.select("metric", "decimals").collect()}  # a row a metric
    calls = roles.events(spark, sf_dir).groupBy(fc.bucket("time").alias("time_bucket")).agg(F.count("*").alias("account_data_call_count"))
    own = roles.protocol(spark, sf_dir).select("time_bucket", *_ACCOUNT, "sampled_user_count").join(calls, "time_bucket")
    return rounded(panels.scale_by_decimals(own, decimals), 10)


_ALL_SQL = [X01, X02, X05, X06, X07, X08]


@query("SELECT * FROM " + " LEFT JOIN ".join(f"({q}) AS x{i}" + (" USING (time_bucket)" if i else "") for i, q in enumerate(_ALL_SQL)))
def x09_protocol_panel(spark, sf_dir):
    """All protocol series side by side, from supply and withdrawals on: 45 numbers a bucket."""
    prices = stored(_prices(spark, sf_dir), "prices")  # all panels value by them
    toggles = panels.aggregate_by_time_bucket(_toggles(spark, sf_dir), _TOGGLES)
    own = [f(spark, sf_dir, prices) for f in (x01_supply_withdraw_flows, x02_borrow_repay_flows, x05_liquidation_flows)]
    return panels.assembled(*own, toggles, x07_flashloan_flows(spark, sf_dir, prices), x08_column_decimals(spark, sf_dir))


@query(f"""WITH {EVENTS}, a AS (SELECT time_bucket, count(*) AS n, max(amount) AS top FROM ev WHERE kind = 'purchase' GROUP BY 1), b AS (SELECT time_bucket, count(*) AS n, max(amount) AS high FROM ev WHERE kind = 'error' GROUP BY 1), c AS (SELECT time_bucket, min(amount) AS low FROM ev WHERE kind = 'view' GROUP BY 1)
SELECT a.time_bucket, a.n, a.top, b.n AS n_right, b.high, c.low FROM a LEFT JOIN b USING (time_bucket) LEFT JOIN c USING (time_bucket)""")
def x09_assembled_panel(spark, sf_dir):
    ev = roles.events(spark, sf_dir).withColumn("time_bucket", fc.bucket("time"))
    part = lambda k, **aggs: ev.where(F.col("kind") == roles.KINDS[k]).groupBy("time_bucket").agg(*(x.alias(n) for n, x in aggs.items()))
    base = part("supply", n=F.count("*"), top=F.max("amount"))
    return rounded(panels.assembled(base, part("liquidation", n=F.count("*"), high=F.max("amount")), part("repay", low=F.min("amount"))))


@query(f"WITH {PROTOCOL}, f AS (SELECT *, supply_amount_value_usd / nullif(supply_tx_count, 0) AS avg_supply_size_usd, withdrawal_amount_value_usd / nullif(withdrawal_tx_count, 0) AS avg_withdrawal_size_usd, supply_amount_value_usd / nullif(withdrawal_amount_value_usd, 0) AS supply_withdrawal_ratio, supply_amount_value_usd - withdrawal_amount_value_usd AS net_liquidity_flow_usd, supply_amount_value_eth - withdrawal_amount_value_eth AS net_liquidity_flow_eth FROM p), l AS (SELECT *, (net_liquidity_flow_usd - lag(net_liquidity_flow_usd) OVER w) / nullif(abs(lag(net_liquidity_flow_usd) OVER w), 0) AS liquidity_growth_rate FROM f WINDOW w AS (ORDER BY time_bucket)) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n_values FROM l" for c in ("net_liquidity_flow_usd", "net_liquidity_flow_eth", "supply_withdrawal_ratio", "liquidity_growth_rate", "avg_supply_size_usd", "avg_withdrawal_size_usd")))
def p14_new_columns(spark, sf_dir):
    """The columns that a step added, and how many values each has."""
    before = roles.protocol(spark, sf_dir)
    after = features.liquidity(before)
    counts = extract.covered(spark.createDataFrame([(c,) for c in panels.new_columns(before, after)], "metric string"), after)
    return counts.withColumnRenamed("metric", "column")


@query("SELECT asset, CAST(min(decimals) AS INTEGER) AS decimals FROM (SELECT p_brand AS asset, p_size % 19 AS decimals, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part WHERE p_type = 'SMALL') WHERE rn = 1 GROUP BY 1")
def j09_decimals_map(spark, sf_dir):
    parts = roles.table(spark, sf_dir, "part").select(F.col("p_brand").alias("asset"), F.pmod("p_size", F.lit(19)).cast("int").alias("decimals"), F.when(F.col("p_type") == "SMALL", "raw_token_amount").otherwise("block_number").alias("unit"), "p_partkey")
    return panels.decimals_of(parts, "p_partkey")


@query("""SELECT l_suppkey % 20 AS asset, date_trunc('day', l_shipdate) AS time_bucket, arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) AS price FROM lineitem GROUP BY 1, 2""")
def j08_first_price(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("asset"), F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("time_bucket"), F.col("l_extendedprice").alias("price"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("ord"))
    return panels.first_prices(rows, "ord")


@query(f"""WITH {EVENTS}, g AS (SELECT asset, unnest(generate_series(min(time_bucket(INTERVAL '6 hours', ts)), max(time_bucket(INTERVAL '6 hours', ts)), INTERVAL '6 hours')) AS time_bucket FROM ev WHERE kind = 'signup' GROUP BY 1),
a AS (SELECT time_bucket(INTERVAL '6 hours', ts) AS time_bucket, asset, sum(amount) AS amount, count(*) AS n FROM ev WHERE kind = 'signup' GROUP BY 1, 2) SELECT time_bucket, asset, CAST(coalesce(amount, 0) AS BIGINT) AS amount, coalesce(n, 0) AS n FROM g LEFT JOIN a USING (time_bucket, asset)""")
def a13_resampled(spark, sf_dir):
    ev = roles.events(spark, sf_dir, "borrow").select(F.col("time").alias("time_bucket"), "asset", "amount", F.lit(1).alias("n"))
    return rounded(panels.aggregate_by_time_bucket(ev, ["amount", "n"], keys=("time_bucket", "asset"), freq="6 hours"))


@query(f"""WITH {EVENTS} SELECT kind, round(sum(amount)::DOUBLE / count(*), 4) AS mean, round(median(amount), 4) AS median, round(stddev_samp(amount), 3) AS std, round(var_samp(amount), 0) AS var, round(stddev_samp(amount) / (sum(amount)::DOUBLE / count(*)), 6) AS cv, round(quantile_cont(amount, 0.9), 4) AS p90 FROM ev GROUP BY 1""")
def a14_moments(spark, sf_dir):
    x = F.col("amount").cast("double")
    return roles.events(spark, sf_dir).groupBy("kind").agg(F.round(F.sum(F.col("amount").cast("long")) / F.count("*"), 4).alias("mean"), F.round(F.median(x), 4).alias("median"), F.round(F.stddev_samp(x), 3).alias("std"), F.round(F.var_samp(x), 0).alias("var"), F.round(F.stddev_samp(x) / F.avg(x), 6).alias("cv"), F.round(F.percentile(x, F.lit(0.9)), 4).alias("p90"))


GROUPS = {"flows": ["supply_amount_value_usd", "borrow_amount_value_usd", "missing_column"], "counts": ["supply_tx_count", "repay_tx_count"]}


@query(f"WITH {PROTOCOL} SELECT time_bucket, round(supply_amount_value_usd, 4) AS supply_amount_value_usd, round(borrow_amount_value_usd, 4) AS borrow_amount_value_usd, 'missing_column' AS missing FROM p")
def p13_column_groups(spark, sf_dir):
    frames, missing = panels.column_groups(roles.protocol(spark, sf_dir), GROUPS)
    return rounded(frames["flows"].withColumn("missing", F.lit(",".join(missing["flows"]))), 4)


def _r(x: str, y: str) -> str:
    return f"({x})::DOUBLE / nullif(({y})::DOUBLE, 0)"


_LAG = "lag({x}) OVER (ORDER BY time_bucket)"
_FLOW = "(supply_amount_value_usd - withdrawal_amount_value_usd)"
FORMULAS = {
    "g01_liquidity": {
        "net_liquidity_flow_usd": _FLOW, "net_liquidity_flow_eth": "supply_amount_value_eth - withdrawal_amount_value_eth", "supply_withdrawal_ratio": _r("supply_amount_value_usd", "withdrawal_amount_value_usd"),
        "liquidity_growth_rate": _r(f"{_FLOW} - {_LAG.format(x=_FLOW)}", f"abs({_LAG.format(x=_FLOW)})"), "avg_supply_size_usd": _r("supply_amount_value_usd", "supply_tx_count"), "avg_withdrawal_size_usd": _r("withdrawal_amount_value_usd", "withdrawal_tx_count"),
    },
    "g02_borrowing": {
        "net_borrow_demand_usd": "borrow_amount_value_usd - repay_amount_value_usd", "net_borrow_demand_eth": "borrow_amount_value_eth - repay_amount_value_eth", "borrow_repay_ratio": _r("borrow_amount_value_usd", "repay_amount_value_usd"),
        **{f"avg_{k}_size_{d}": _r(f"{k}_amount_value_{d}", f"{k}_tx_count") for k in ("borrow", "repay") for d in ("usd", "eth")},
        "borrow_growth": _r(f"borrow_amount_value_usd - {_LAG.format(x='borrow_amount_value_usd')}", _LAG.format(x="borrow_amount_value_usd")), "debt_expansion_ratio": _r("avg_total_debt_base", "avg_total_collateral_base"),
    },
    "g03_risk": {
        "collateralization_ratio": _r("avg_total_collateral_base", "avg_total_debt_base"), "borrow_capacity_utilization": _r("avg_total_debt_base", "avg_total_debt_base + avg_available_borrows_base"), "remaining_borrow_capacity": _r("avg_available_borrows_base", "avg_total_collateral_base"),
        "risk_buffer": "avg_current_liquidation_threshold - avg_ltv", "ltv_utilization": _r("avg_ltv", "avg_current_liquidation_threshold"), "distance_to_liquidation": "1 - " + _r("avg_ltv", "avg_current_liquidation_threshold"),
    },
    "g04_liquidations": {
        "liquidation_rate": _r("liquidation_tx_count", "borrow_tx_count"), "liquidation_volume_ratio_eth": _r("liquidation_debt_covered_value_eth", "borrow_amount_value_eth"),
        **{f"liquidation_severity_{d}": _r(f"liquidated_collateral_value_{d}", "liquidation_tx_count") for d in ("usd", "eth")}, **{f"avg_liquidation_debt_{d}": _r(f"liquidation_debt_covered_value_{d}", "liquidation_tx_count") for d in ("usd", "eth")},
        "liquidator_concentration": _r("unique_liquidators", "liquidation_tx_count"), "liquidation_user_ratio": _r("unique_liquidated_users", "unique_borrowers"),
    },
    "g05_users": {
        "borrower_participation_rate": _r("unique_borrowers", "unique_borrowers + unique_suppliers"), "repayment_discipline": _r("unique_repayers", "unique_borrowers"), "supplier_activity": _r("supply_tx_count", "unique_suppliers"), "borrower_activity": _r("borrow_tx_count", "unique_borrowers"),
        "collateral_usage_rate": _r("collateral_enabled_count", "collateral_enabled_count + collateral_disabled_count"), "collateral_adoption_rate": _r("unique_collateral_enable_users", "unique_suppliers"),
    },
    "g06_flashloans": {
        **{f"avg_flashloan_size_{d}": _r(f"flashloan_amount_value_{d}", "flashloan_tx_count") for d in ("usd", "eth")}, "flashloan_fee_rate": _r("flashloan_premium_value_usd", "flashloan_amount_value_usd"), "flashloan_usage_intensity": _r("flashloan_tx_count", "borrow_tx_count + supply_tx_count"),
        "flashloan_user_activity": _r("flashloan_tx_count", "unique_flashloan_initiators"), "variable_debt_flashloan_ratio": _r("variable_flashloan_tx_count", "flashloan_tx_count"), "no_debt_flashloan_ratio": _r("no_open_debt_flashloan_tx_count", "flashloan_tx_count"),
    },
    "g07_market": {
        "total_activity": "(supply_tx_count + withdrawal_tx_count + borrow_tx_count + repay_tx_count + flashloan_tx_count + liquidation_tx_count)::DOUBLE", "user_activity": "(unique_suppliers + unique_borrowers + unique_flashloan_initiators)::DOUBLE",
        **{f"protocol_turnover_{d}": " + ".join(f"coalesce({k}_amount_value_{d}, 0)" for k in ("supply", "withdrawal", "borrow", "repay")) for d in ("usd", "eth")}, "leverage_indicator": _r("borrow_amount_value_usd", "supply_amount_value_usd"),
        **{f"market_stress_index_{d}": _r(f"liquidation_tx_count * liquidation_debt_covered_value_{d}", f"borrow_amount_value_{d}") for d in ("usd", "eth")}, "capital_efficiency": _r("borrow_amount_value_usd", "avg_total_collateral_base"),
    },
}


def _protocol_feature(name: str, formulas: dict[str, str]):
    def run(spark, sf_dir):
        return rounded(features.PROTOCOL[name[:3]](roles.protocol(spark, sf_dir)).select("time_bucket", *formulas), 5)

    run.__name__ = name
    query(f"WITH {PROTOCOL} SELECT time_bucket, {', '.join(f'round({x}, 5) AS {n}' for n, x in formulas.items())} FROM p")(run)


for _n, _f in FORMULAS.items():
    _protocol_feature(_n, _f)

_W = "(PARTITION BY asset ORDER BY time_bucket)"


def _dynamics(w: str) -> dict[str, str]:
    return {
        "borrow_supply_spread": "last_borrow_rate - liquidity_rate", "variable_supply_spread": "variable_borrow_rate - liquidity_rate", "borrow_rate_premium": _r("last_borrow_rate", "liquidity_rate"), "variable_rate_premium": _r("variable_borrow_rate", "liquidity_rate"),
        "rate_change": _r(f"last_borrow_rate - lag(last_borrow_rate) OVER {w}", "last_borrow_rate"), "liquidity_rate_change": _r(f"liquidity_rate - lag(liquidity_rate) OVER {w}", "liquidity_rate"), "variable_borrow_rate_change": f"variable_borrow_rate - lag(variable_borrow_rate) OVER {w}",
    }


def _rolled(x: str) -> str:
    w = "(PARTITION BY asset ORDER BY time_bucket ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {w} >= 2 THEN stddev_samp({x}) OVER {w} END"


def _ranked(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN rank() OVER (PARTITION BY time_bucket ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY time_bucket, {x}) - 1) / 2.0::DOUBLE END"


RESERVE_FORMULAS = {
    "g08_rate_dynamics": _dynamics(_W),
    "g08_rate_dynamics_across_assets": _dynamics("(ORDER BY time_bucket, asset)"),
    "g09_growth": {
        **{f"{x}_growth": _r(f"{x} - lag({x}) OVER {_W}", f"lag({x}) OVER {_W}") for x in ("liquidity_index", "variable_borrow_index")},
        "interest_accrual_velocity": f"liquidity_index - lag(liquidity_index) OVER {_W}", "debt_accrual_velocity": f"variable_borrow_index - lag(variable_borrow_index) OVER {_W}",
    },
    "g10_rate_risk": {"borrow_pressure": _r("variable_borrow_rate", "liquidity_rate"), "lending_attractiveness": _r("liquidity_rate", "last_borrow_rate"), "reserve_stress_score": _r("variable_borrow_rate - liquidity_rate", "liquidity_rate")},
    "g11_volatility": {"rate_volatility": _rolled("last_borrow_rate"), "liquidity_volatility": _rolled("liquidity_rate"), "borrow_volatility": _rolled("variable_borrow_rate")},
    "g12_momentum": {"momentum": _r("last_borrow_rate", f"lag(last_borrow_rate) OVER {_W}"), **{n: _r(x, f"lag({x}, 4) OVER {_W}") for n, x in (("borrow_momentum_24h", "last_borrow_rate"), ("liquidity_momentum_24h", "liquidity_rate"), ("index_momentum_24h", "liquidity_index"))}},
    "g13_cross_asset": {"rank_by_borrow_rate": _ranked("last_borrow_rate"), "rank_by_liquidity_rate": _ranked("liquidity_rate"), "asset_share_of_updates": _r("update_count", "sum(update_count) OVER (PARTITION BY time_bucket)")},
}


def _reserve_feature(name: str, formulas: dict[str, str]):
    def run(spark, sf_dir):
        own = features.RESERVE[name[:3]]
        df = roles.reserve(spark, sf_dir)
        out = own(df, per_asset=False) if name.endswith("across_assets") else own(df)
        return rounded(out.select("time_bucket", "asset", *formulas), 6)

    run.__name__ = name
    query(f"WITH {RESERVE} SELECT time_bucket, asset, {', '.join(f'round({x}, 6) AS {n}' for n, x in formulas.items())} FROM r")(run)


for _n, _f in RESERVE_FORMULAS.items():
    _reserve_feature(_n, _f)


@query("SELECT p_brand, p_partkey, round(CASE WHEN p_retailprice IS NOT NULL THEN (rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0) / count(*) OVER (PARTITION BY p_brand) END, 6) AS pct_rank FROM part")
def w07_percent_rank(spark, sf_dir):
    n = F.count("p_size").over(Window.partitionBy("p_brand"))
    return rounded(roles.table(spark, sf_dir, "part").select("p_brand", "p_partkey", (features.average_rank("p_size", ("p_brand",)) / n).alias("pct_rank")))
