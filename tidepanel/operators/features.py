"""Derived columns of the protocol series and of the reserve panel. All ratios are null where the divisor is 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import divided as over
from ..functions.columns import row_sum

c = F.col


def _before(x: Column, k: int = 1, *, by: tuple[str, ...] = (), order: tuple[str, ...] = ("time_bucket",)) -> Column:
    """Value k rows earlier. Without by the window is one partition: for bucketed series only."""
    return F.lag(x, k).over(Window.partitionBy(*by).orderBy(*order))


def liquidity(df: DataFrame) -> DataFrame:
    flow = {d: c(f"supply_amount_value_{d}") - c(f"withdrawal_amount_value_{d}") for d in ("usd", "eth")}
    df = df.withColumns({f"net_liquidity_flow_{d}": x for d, x in flow.items()})
    last = _before(c("net_liquidity_flow_usd"))
    return df.withColumns(
        {
            "supply_withdrawal_ratio": over("supply_amount_value_usd", "withdrawal_amount_value_usd"),
            "liquidity_growth_rate": over(c("net_liquidity_flow_usd") - last, F.abs(last)),
            "avg_supply_size_usd": over("supply_amount_value_usd", "supply_tx_count"),
            "avg_withdrawal_size_usd": over("withdrawal_amount_value_usd", "withdrawal_tx_count"),
        }
    )


def borrowing(df: DataFrame) -> DataFrame:
    last = _before(c("borrow_amount_value_usd"))
    sizes = {f"avg_{k}_size_{d}": over(f"{k}_amount_value_{d}", f"{k}_tx_count") for k in ("borrow", "repay") for d in ("usd", "eth")}
    return df.withColumns(
        {
            **{f"net_borrow_demand_{d}": c(f"borrow_amount_value_{d}") - c(f"repay_amount_value_{d}") for d in ("usd", "eth")},
            "borrow_repay_ratio": over("borrow_amount_value_usd", "repay_amount_value_usd"),
            **sizes,
            "borrow_growth": over(c("borrow_amount_value_usd") - last, last),
            "debt_expansion_ratio": over("avg_total_debt_base", "avg_total_collateral_base"),
        }
    )


def risk(df: DataFrame) -> DataFrame:
    debt, collateral, free = c("avg_total_debt_base"), c("avg_total_collateral_base"), c("avg_available_borrows_base")
    used = over("avg_ltv", "avg_current_liquidation_threshold")
    return df.withColumns(
        {
            "collateralization_ratio": over(collateral, debt),
            "borrow_capacity_utilization": over(debt, debt + free),
            "remaining_borrow_capacity": over(free, collateral),
            "risk_buffer": c("avg_current_liquidation_threshold") - c("avg_ltv"),
            "ltv_utilization": used,
            "distance_to_liquidation": 1 - used,
        }
    )


def liquidations(df: DataFrame) -> DataFrame:
    n = "liquidation_tx_count"
    return df.withColumns(
        {
            "liquidation_rate": over(n, "borrow_tx_count"),
            "liquidation_volume_ratio_eth": over("liquidation_debt_covered_value_eth", "borrow_amount_value_eth"),
            **{f"liquidation_severity_{d}": over(f"liquidated_collateral_value_{d}", n) for d in ("usd", "eth")},
            **{f"avg_liquidation_debt_{d}": over(f"liquidation_debt_covered_value_{d}", n) for d in ("usd", "eth")},
            "liquidator_concentration": over("unique_liquidators", n),
            "liquidation_user_ratio": over("unique_liquidated_users", "unique_borrowers"),
        }
    )


def users(df: DataFrame) -> DataFrame:
    on, off = c("collateral_enabled_count"), c("collateral_disabled_count")
    return df.withColumns(
        {
            "borrower_participation_rate": over("unique_borrowers", c("unique_borrowers") + c("unique_suppliers")),
            "repayment_discipline": over("unique_repayers", "unique_borrowers"),
            "supplier_activity": over("supply_tx_count", "unique_suppliers"),
            "borrower_activity": over("borrow_tx_count", "unique_borrowers"),
            "collateral_usage_rate": over(on, on + off),
            "collateral_adoption_rate": over("unique_collateral_enable_users", "unique_suppliers"),
        }
    )


def flashloans(df: DataFrame) -> DataFrame:
    n = "flashloan_tx_count"
    return df.withColumns(
        {
            **{f"avg_flashloan_size_{d}": over(f"flashloan_amount_value_{d}", n) for d in ("usd", "eth")},
            "flashloan_fee_rate": over("flashloan_premium_value_usd", "flashloan_amount_value_usd"),
            "flashloan_usage_intensity": over(n, c("borrow_tx_count") + c("supply_tx_count")),
            "flashloan_user_activity": over(n, "unique_flashloan_initiators"),
            "variable_debt_flashloan_ratio": over("variable_flashloan_tx_count", n),
            "no_debt_flashloan_ratio": over("no_open_debt_flashloan_tx_count", n),
        }
    )


def market(df: DataFrame) -> DataFrame:
    kinds = ("supply", "withdrawal", "borrow", "repay")
    return df.withColumns(
        {
            "total_activity": row_sum([f"{k}_tx_count" for k in (*kinds, "flashloan", "liquidation")]),
            "user_activity": row_sum(["unique_suppliers", "unique_borrowers", "unique_flashloan_initiators"]),
            **{f"protocol_turnover_{d}": row_sum([f"{k}_amount_value_{d}" for k in kinds]) for d in ("usd", "eth")},
            "leverage_indicator": over("borrow_amount_value_usd", "supply_amount_value_usd"),
            **{f"market_stress_index_{d}": over(c("liquidation_tx_count") * c(f"liquidation_debt_covered_value_{d}"), f"borrow_amount_value_{d}") for d in ("usd", "eth")},
            "capital_efficiency": over("borrow_amount_value_usd", "avg_total_collateral_base"),
        }
    )


PROTOCOL = {"g01": liquidity, "g02": borrowing, "g03": risk, "g04": liquidations, "g05": users, "g06": flashloans, "g07": market}


def rate_dynamics(df: DataFrame, per_asset: bool = True) -> DataFrame:
    """Spreads, premiums and changes of rates. With per_asset False changes run over rows by bucket, then asset, across assets."""
    where = {"by": ("asset",)} if per_asset else {"order": ("time_bucket", "asset")}
    last, supply, variable = c("last_borrow_rate"), c("liquidity_rate"), c("variable_borrow_rate")
    change = lambda x: x - _before(x, **where)
    return df.withColumns(
        {
            "borrow_supply_spread": last - supply,
            "variable_supply_spread": variable - supply,
            "borrow_rate_premium": over(last, supply),
            "variable_rate_premium": over(variable, supply),
            "rate_change": over(change(last), last),
            "liquidity_rate_change": over(change(supply), supply),
            "variable_borrow_rate_change": change(variable),
        }
    )


def growth(df: DataFrame) -> DataFrame:
    out = {}
    for x, n in (("liquidity_index", "interest_accrual_velocity"), ("variable_borrow_index", "debt_accrual_velocity")):
        last = _before(c(x), by=("asset",))
        out |= {f"{x}_growth": over(c(x) - last, last), n: c(x) - last}
    return df.withColumns(out)


def rate_risk(df: DataFrame) -> DataFrame:
    supply, variable = c("liquidity_rate"), c("variable_borrow_rate")
    return df.withColumns({"borrow_pressure": over(variable, supply), "lending_attractiveness": over(supply, "last_borrow_rate"), "reserve_stress_score": over(variable - supply, supply)})


def rolling_std(x: str, window: int, least: int, by: tuple[str, ...] = ("asset",), order: tuple[str, ...] = ("time_bucket",)) -> Column:
    """Sample deviation over the last window rows, null below least values; null values take a row's place but do not count."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - window, 0)
    return F.when(F.count(x).over(w) >= least, F.stddev_samp(x).over(w))


def volatility(df: DataFrame, window: int = 4, least: int = 2) -> DataFrame:
    names = {"rate_volatility": "last_borrow_rate", "liquidity_volatility": "liquidity_rate", "borrow_volatility": "variable_borrow_rate"}
    return df.withColumns({n: rolling_std(x, window, least) for n, x in names.items()})


def momentum(df: DataFrame, long: int = 4) -> DataFrame:
    names = {"borrow_momentum_24h": "last_borrow_rate", "liquidity_momentum_24h": "liquidity_rate", "index_momentum_24h": "liquidity_index"}
    out = {"momentum": over("last_borrow_rate", _before(c("last_borrow_rate"), by=("asset",)))}
    return df.withColumns(out | {n: over(x, _before(c(x), long, by=("asset",))) for n, x in names.items()})


def average_rank(x: str, by: tuple[str, ...]) -> Column:
    """Rank from 1 within by, ties sharing their mean rank; null for null."""
    rank = F.rank().over(Window.partitionBy(*by).orderBy(F.col(x).asc_nulls_last()))
    same = F.count(x).over(Window.partitionBy(*by, x))
    return F.when(F.col(x).isNotNull(), rank + (same - 1) / 2)


def cross_asset(df: DataFrame) -> DataFrame:
    share = over("update_count", F.sum("update_count").over(Window.partitionBy("time_bucket")))
    return df.withColumns({"rank_by_borrow_rate": average_rank("last_borrow_rate", ("time_bucket",)), "rank_by_liquidity_rate": average_rank("liquidity_rate", ("time_bucket",)), "asset_share_of_updates": share})


RESERVE = {"g08": rate_dynamics, "g09": growth, "g10": rate_risk, "g11": volatility, "g12": momentum, "g13": cross_asset}
