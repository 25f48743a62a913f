"""Registration of queries with the SQL that must give the same rows, and SQL of the role frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, decimals as whole numbers."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes))


#: Role frames of sources.roles, in SQL.
EVENTS = """ev AS (SELECT ts, event_id AS block, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10 AS asset, user_id AS usr,
  CAST(round(value * 100) AS BIGINT) AS amount, value AS rate, event_id % 3 AS mode, event_id % 2 = 0 AS flag, event_type AS kind,
  time_bucket(INTERVAL '2 hours', ts) AS time_bucket FROM events)"""
TOKENS = "tok AS (SELECT p_partkey AS asset, p_name AS asset_symbol, p_size % 19 AS decimals FROM part WHERE p_type <> 'ECONOMY')"

_KIND = {"supply": "kind = 'purchase'", "withdraw": "kind = 'click'", "borrow": "kind = 'signup'", "repay": "kind = 'view'", "liquidation": "kind = 'error'", "loan": "kind = 'click' AND flag"}
_AMOUNTS = {
    "supply_amount": ("supply", "amount"), "withdrawal_amount": ("withdraw", "amount"), "borrow_amount": ("borrow", "amount"), "repay_amount": ("repay", "amount"), "liquidated_collateral": ("liquidation", "amount"),
    "liquidation_debt_covered": ("liquidation", "amount // 2"), "flashloan_amount": ("loan", "amount"), "flashloan_premium": ("loan", "amount // 1000"),
}
_COUNTS = {
    "supply_tx_count": _KIND["supply"], "withdrawal_tx_count": _KIND["withdraw"], "borrow_tx_count": _KIND["borrow"], "repay_tx_count": _KIND["repay"], "variable_borrow_tx_count": _KIND["borrow"] + " AND mode = 2",
    "liquidation_tx_count": _KIND["liquidation"], "flashloan_tx_count": _KIND["loan"], "variable_flashloan_tx_count": _KIND["loan"] + " AND mode = 1", "no_open_debt_flashloan_tx_count": _KIND["loan"] + " AND mode = 0",
    "collateral_enabled_count": _KIND["repay"] + " AND flag", "collateral_disabled_count": _KIND["borrow"] + " AND flag",
}
_USERS = {
    "unique_suppliers": "supply_tx_count", "unique_withdraw_users": "withdrawal_tx_count", "unique_borrowers": "borrow_tx_count", "unique_repayers": "repay_tx_count", "unique_liquidated_users": "liquidation_tx_count",
    "unique_flashloan_initiators": "flashloan_tx_count", "unique_collateral_enable_users": "collateral_enabled_count", "unique_collateral_disable_users": "collateral_disabled_count",
}
#: The role frame sources.roles.protocol in SQL: p.
PROTOCOL = (
    EVENTS
    + ", p0 AS (SELECT time_bucket, "
    + ", ".join(
        [f"sum(CASE WHEN {_KIND[k]} THEN {x} END) / 100.0::DOUBLE AS {n}_value_usd" for n, (k, x) in _AMOUNTS.items()]
        + [f"count(CASE WHEN {cond} THEN 1 END) AS {n}" for n, cond in _COUNTS.items()]
        + [f"count(DISTINCT CASE WHEN {_COUNTS[k]} THEN usr END) AS {n}" for n, k in _USERS.items()]
        + ["count(DISTINCT CASE WHEN kind = 'error' THEN usr % 7 END) AS unique_liquidators", "sum(amount)::DOUBLE / count(*) AS avg_total_collateral_base", "sum(amount // 3)::DOUBLE / count(*) AS avg_total_debt_base", "sum(amount // 5)::DOUBLE / count(*) AS avg_available_borrows_base"]
        + ["sum(asset) * 700.0::DOUBLE / count(*) AS avg_ltv", "sum(asset) * 800.0::DOUBLE / count(*) + 100 AS avg_current_liquidation_threshold", "count(DISTINCT usr) AS sampled_user_count"]
    )
    + " FROM ev GROUP BY 1), p AS (SELECT *, "
    + ", ".join(f"{n}_value_usd * 100 / avg_total_collateral_base AS {n}_value_eth" for n in _AMOUNTS)
    + " FROM p0)"
)
#: sources.roles.reserve in SQL: r.
RESERVE = """r0 AS (SELECT time_bucket(INTERVAL '1 day', l_shipdate) AS time_bucket, l_partkey % 10 AS asset, *, row_number() OVER (PARTITION BY l_partkey % 10, time_bucket(INTERVAL '1 day', l_shipdate) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC) AS rn,
  count(*) OVER (PARTITION BY l_partkey % 10, time_bucket(INTERVAL '1 day', l_shipdate)) AS update_count FROM lineitem),
r AS (SELECT time_bucket, asset, l_discount / 100.0::DOUBLE AS liquidity_rate, l_tax / 100.0::DOUBLE AS variable_borrow_rate, l_quantity / 100.0::DOUBLE AS last_borrow_rate, l_extendedprice / 100.0::DOUBLE AS liquidity_index, l_linenumber / 100.0::DOUBLE AS variable_borrow_index, update_count FROM r0 WHERE rn = 1)"""
SERIES = "s AS (SELECT event_type AS series, event_id AS ord, value AS x FROM events UNION ALL SELECT c_mktsegment, c_custkey, c_acctbal FROM customer)"
