"""Role frames that the builders take, bound to the star-schema tables; and the scans of stored tables and files.

Event roles have time, block, idx, asset, user, amount; call roles a success flag; each builder names what else it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = {"supply": "purchase", "withdraw": "click", "borrow": "signup", "repay": "view", "liquidation": "error"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def between(df: DataFrame, column: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Rows with lo <= column < hi; a missing end is open. The scan prunes by it."""
    if lo is not None:
        df = df.where(F.col(column) >= F.lit(lo).cast(df.schema[column].dataType))
    return df if hi is None else df.where(F.col(column) < F.lit(hi).cast(df.schema[column].dataType))


def successful(calls: DataFrame, flag: str = "success") -> DataFrame:
    return calls.where(F.col(flag)).drop(flag)


def events(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    df = table(spark, sf_dir, "events")
    if kind:
        df = df.where(F.col("event_type") == KINDS[kind])
    return df.select(
        F.col("ts").alias("time"),
        F.col("event_id").alias("block"),
        F.col("event_id").alias("idx"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("long") % 10).alias("asset"),
        F.col("user_id").alias("user"),
        F.round(F.col("value") * 100).cast("long").alias("amount"),
        F.col("value").alias("rate"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("mode"),
        (F.pmod("event_id", F.lit(2)) == 0).alias("flag"),
        F.col("event_type").alias("kind"),
    )


def wide_events(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Events whose amounts are digit strings of 37 to 45 digits: cents, then the block in 36 places."""
    return events(spark, sf_dir, kind).withColumn("amount", F.concat(F.col("amount").cast("string"), F.lpad(F.col("block").cast("string"), 36, "0")))


def rate_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserve updates from events of one kind, on the dates of all events."""
    return events(spark, sf_dir, "repay").select("time", "asset", F.col("block").alias("seq"), F.col("rate").alias("liquidity_rate"), (F.col("rate") + F.col("mode")).alias("variable_borrow_rate"), F.lit(0.0).alias("stable_borrow_rate"), F.col("block").alias("liquidity_index"), (F.col("block") * 2).alias("variable_borrow_index"))


PARAMETERS = ("supply_cap", "borrow_cap", "debt_ceiling")


def cap_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of three caps from events of one kind, on the dates of all events."""
    name = F.get(F.array(*map(F.lit, PARAMETERS)), F.col("mode"))
    return events(spark, sf_dir, "liquidation").select("time", "block", "asset", name.alias("param"), F.col("amount").alias("value"))


def event_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liquidations from events of one kind: two assets and two amounts a row, on the dates of all events."""
    ev = events(spark, sf_dir, "liquidation")
    return ev.select("time", "block", F.col("asset").alias("collateral_asset"), ((F.col("asset") + F.col("mode")) % 10).alias("debt_asset"), F.col("amount").alias("collateral_amount"), F.expr("amount div 2").alias("debt_amount"), "user", (F.col("user") % 7).alias("liquidator"), F.col("flag").alias("receive_token"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token dimension; part of the assets are missing from it."""
    return table(spark, sf_dir, "part").where("p_type <> 'ECONOMY'").select(
        F.col("p_partkey").alias("asset"), F.col("p_name").alias("asset_symbol"), F.pmod("p_size", F.lit(19)).cast("int").alias("decimals")
    )


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liquidations: two assets and two amounts a row."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        F.pmod("l_partkey", F.lit(10)).alias("collateral_asset"),
        F.pmod("l_suppkey", F.lit(10)).alias("debt_asset"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("collateral_amount"),
        F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("long").alias("debt_amount"),
        F.col("l_orderkey").alias("block"),
        F.col("l_orderkey").alias("user"),
        F.col("l_suppkey").alias("liquidator"),
        (F.col("l_returnflag") == "R").alias("receive_token"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserve updates: five values a row; seq makes their order total."""
    key = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        F.pmod("l_partkey", F.lit(10)).alias("asset"),
        key.alias("seq"),
        *[F.col(c).alias(n) for c, n in zip(("l_discount", "l_tax", "l_quantity", "l_extendedprice", "l_linenumber"), ("liquidity_rate", "variable_borrow_rate", "stable_borrow_rate", "liquidity_index", "variable_borrow_index"))],
    )


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of parameters (time, block, asset, param, value)."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderdate").alias("time"),
        F.col("o_orderkey").alias("block"),
        F.col("c_nationkey").cast("long").alias("asset"),
        F.col("o_orderpriority").alias("param"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("value"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract calls with a success flag."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("time"),
        F.col("o_orderkey").alias("block"),
        F.col("o_orderkey").alias("idx"),
        F.pmod("o_custkey", F.lit(10)).alias("asset"),
        F.col("o_custkey").alias("user"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("output"),
        (F.col("o_orderstatus") != "P").alias("success"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price feed: (time, asset, price) by month and brand."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    # a mean of whole numbers, so that its sum does not depend on the order of rows
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("long")
    return joined.groupBy(F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("time"), F.col("p_brand").alias("asset")).agg(
        (F.sum(cents) / F.count(cents) / 100).alias("price")
    )


def protocol(spark: SparkSession, sf_dir: str, width: str = "2 hours") -> DataFrame:
    """Protocol series: one row a bucket, with values in two denominations, counts, users and account means."""
    ev = events(spark, sf_dir).withColumn("cents", F.col("amount").cast("long"))
    kind = lambda k: F.col("kind") == KINDS[k]
    loan = kind("withdraw") & F.col("flag")
    amounts = {
        "supply_amount": (kind("supply"), F.col("cents")),
        "withdrawal_amount": (kind("withdraw"), F.col("cents")),
        "borrow_amount": (kind("borrow"), F.col("cents")),
        "repay_amount": (kind("repay"), F.col("cents")),
        "liquidated_collateral": (kind("liquidation"), F.col("cents")),
        "liquidation_debt_covered": (kind("liquidation"), F.expr("cents div 2")),
        "flashloan_amount": (loan, F.col("cents")),
        "flashloan_premium": (loan, F.expr("cents div 1000")),
    }
    counts = {
        "supply_tx_count": kind("supply"),
        "withdrawal_tx_count": kind("withdraw"),
        "borrow_tx_count": kind("borrow"),
        "repay_tx_count": kind("repay"),
        "variable_borrow_tx_count": kind("borrow") & (F.col("mode") == 2),
        "liquidation_tx_count": kind("liquidation"),
        "flashloan_tx_count": loan,
        "variable_flashloan_tx_count": loan & (F.col("mode") == 1),
        "no_open_debt_flashloan_tx_count": loan & (F.col("mode") == 0),
        "collateral_enabled_count": kind("repay") & F.col("flag"),
        "collateral_disabled_count": kind("borrow") & F.col("flag"),
    }
    uniques = {
        "unique_suppliers": "supply_tx_count",
        "unique_withdraw_users": "withdrawal_tx_count",
        "unique_borrowers": "borrow_tx_count",
        "unique_repayers": "repay_tx_count",
        "unique_liquidated_users": "liquidation_tx_count",
        "unique_flashloan_initiators": "flashloan_tx_count",
        "unique_collateral_enable_users": "collateral_enabled_count",
        "unique_collateral_disable_users": "collateral_disabled_count",
    }
    sums = {**{k: F.when(cond, x) for k, (cond, x) in amounts.items()}, "cents": F.col("cents"), "third": F.expr("cents div 3"), "fifth": F.expr("cents div 5"), "assets": F.col("asset"), "n": F.lit(1), **{k: cond.cast("int") for k, cond in counts.items()}}
    flat = ev.select(F.window("time", width)["start"].alias("time_bucket"), "user", *(x.alias(k) for k, x in sums.items()))
    aggs = [F.sum(k).alias(k) for k in sums]
    by_user = flat.groupBy("time_bucket", "user").agg(*aggs)  # one row a user, so that users are counted without multiplying events
    own = by_user.groupBy("time_bucket").agg(
        *aggs,
        *(F.count_if(F.col(k) > 0).alias(u) for u, k in uniques.items()),
        F.bit_count(F.bit_or(F.when(F.col("liquidation_tx_count") > 0, F.expr("shiftleft(1, int(user % 7))")).otherwise(0))).cast("long").alias("unique_liquidators"),
        F.count("*").alias("sampled_user_count"),
    )
    out = own.select(
        "time_bucket",
        *((F.col(k) / 100.0).alias(f"{k}_value_usd") for k in amounts),
        *counts,
        *uniques,
        "unique_liquidators",
        (F.col("cents") / F.col("n")).alias("avg_total_collateral_base"),
        (F.col("third") / F.col("n")).alias("avg_total_debt_base"),
        (F.col("fifth") / F.col("n")).alias("avg_available_borrows_base"),
        (F.col("assets") * 700.0 / F.col("n")).alias("avg_ltv"),
        (F.col("assets") * 800.0 / F.col("n") + 100).alias("avg_current_liquidation_threshold"),
        "sampled_user_count",
    )
    return out.withColumns({f"{k}_value_eth": F.col(f"{k}_value_usd") * 100 / F.col("avg_total_collateral_base") for k in amounts})


def reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserve panel by day and asset."""
    from ..operators.extract import reserve_state

    fields = ("liquidity_rate", "variable_borrow_rate", "stable_borrow_rate", "liquidity_index", "variable_borrow_index")
    return reserve_state(states(spark, sf_dir), fields, "1 day", 100.0).withColumnRenamed("stable_borrow_rate", "last_borrow_rate")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series (series, ord, x): event values by type, and account balances by market segment."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("series"), F.col("event_id").alias("ord"), F.col("value").alias("x"))
    return ev.union(table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_acctbal"))


def components(spark: SparkSession, sf_dir: str, n: int = 64) -> DataFrame:
    """Embeddings as n columns e0, e1, ..., with all cells as given."""
    return table(spark, sf_dir, "embeddings").select("vec_id", *(F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(n)))
