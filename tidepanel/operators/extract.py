"""Event and call tables reduced to bucketed panels, and the metric dictionaries. Bucket width and window are parameters.

Amounts are integers, or digit strings for those of 256 bits, which stay exact (digit strings come out again). Exact counts of
actors take two aggregations, first by actor, then by bucket, so that no row is multiplied for them (liquidations count
each kind of actor on its own). Aggregates come before dimension
joins; these have no hint: Spark broadcasts a dimension whose size it knows to be small. Two-leg rows are exploded; forward-filled state comes from validity intervals that are exploded onto the grid, not from an inequality join.
Everything is lazy: no job runs while a panel is built.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DecimalType, StringType

from ..functions import bigint
from ..functions.columns import bucket, exactly_scaled


def with_symbol(panel: DataFrame, tokens: DataFrame, *columns: str) -> DataFrame:
    return panel.join(tokens.select("asset", *(columns or ("asset_symbol",))), "asset", "left")


def wide(df: DataFrame, column: str) -> bool:
    """Whether a column's sums may pass 38 digits: digit strings, and decimals of full width."""
    kind = df.schema[column].dataType
    return isinstance(kind, StringType) or isinstance(kind, DecimalType) and kind.precision == 38


def whole(df: DataFrame, column: str) -> Column:
    """An amount: canonical digits if it is wide."""
    return bigint.parsed(F.col(column).cast("string")) if wide(df, column) else F.col(column)


def tagged(**streams: DataFrame) -> DataFrame:
    """Event streams of one grain under each other, named by kind; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.drop("kind").withColumn("kind", F.lit(k)) for k, df in streams.items()))


def _total(column: str, big: bool) -> Column:
    return (bigint.total(column) if big else F.sum(column)).alias(column)


def by_actor(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, bool], counts: Sequence[str], maxima: Sequence[str], exact: bool, people: Mapping[str, str], more: Mapping[str, Column] | None = None) -> DataFrame:
    """Sums (name: whether digits), counts and maxima of rows by keys, and for each of people how many users have a count.

    rows has a row per event with a column user, numbers to be counted (0 or 1) and what is null where it does not apply.
    """
    aggs = [*(_total(c, big) for c, big in sums.items()), *(F.sum(c).alias(c) for c in counts), *(F.max(c).alias(c) for c in maxima)]
    if exact:
        rows = rows.groupBy(*keys, "user").agg(*aggs)
    there = F.col("user").isNotNull()
    seen = {n: there & (F.col(c) > 0) for n, c in people.items()}
    users = [(F.count_if(cond) if exact else F.approx_count_distinct(F.when(cond, F.col("user")))).alias(n) for n, cond in seen.items()]
    return rows.groupBy(*keys).agg(*aggs, *users, *(v.alias(k) for k, v in (more or {}).items()))


def two_kinds(a: DataFrame, b: DataFrame, names: tuple[str, str], width: str, exact: bool, counts: Mapping[str, Column] | None = None, maxima: Mapping[str, Column] | None = None) -> DataFrame:
    """Sums, counts, distinct users and latest blocks of two kinds of events by bucket and asset, side by side; more counts (conditions) and maxima."""
    rows, keys = tagged(**{names[0]: a, names[1]: b}), ["time_bucket", "asset"]
    big = wide(rows, "amount")
    amount, is_n = whole(rows, "amount"), {n: F.col("kind") == n for n in names}
    sums = {f"{n}_amount_raw": F.when(is_n[n], amount) for n in names}
    number = {f"{n}_tx_count": is_n[n] for n in names} | dict(counts or {})
    most = {f"latest_{n}_block": F.when(is_n[n], F.col("block")) for n in names} | dict(maxima or {})
    flat = rows.select(*_keys(width), "user", *(v.alias(k) for k, v in (sums | most).items()), *(F.coalesce(v, F.lit(False)).cast("int").alias(k) for k, v in number.items()))
    x, y = (f"{n}_amount_raw" for n in names)
    less = F.when(F.col(x).isNotNull() | F.col(y).isNotNull(), F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0)))
    net = {"net_amount_raw": bigint.signed_total(x, y) if big else F.sum(less)}
    return by_actor(flat, keys, dict.fromkeys(sums, big), list(number), list(most), exact, {f"unique_{n}_users": f"{n}_tx_count" for n in names}, net)


def _keys(width: str) -> list[Column]:
    return [bucket("time", width).alias("time_bucket"), F.col("asset")]


def supply_withdraw(supply: DataFrame, withdraw: DataFrame, tokens: DataFrame, width: str = "2 hours", exact: bool = False) -> DataFrame:
    out = two_kinds(supply, withdraw, ("supply", "withdrawal"), width, exact)
    names = {"net_amount_raw": "net_supply_flow_raw", "unique_supply_users": "unique_suppliers", "unique_withdrawal_users": "unique_withdraw_users", "latest_withdrawal_block": "latest_withdraw_block"}
    return with_symbol(out.withColumnsRenamed(names), tokens)


def borrow_repay(borrow: DataFrame, repay: DataFrame, tokens: DataFrame, width: str = "2 hours", exact: bool = False) -> DataFrame:
    is_borrow = F.col("kind") == "borrow"
    modes = {"stable_borrow_count": is_borrow & (F.col("mode") == 1), "variable_borrow_count": is_borrow & (F.col("mode") == 2)}
    last = {"last_borrow": F.when(is_borrow, F.struct("block", "idx", "rate"))}
    out = two_kinds(borrow, repay, ("borrow", "repay"), width, exact, modes, last)
    names = {"net_amount_raw": "net_debt_flow_raw", "unique_borrow_users": "unique_borrowers", "unique_repay_users": "unique_repayers"}
    return with_symbol(out.withColumnsRenamed(names).withColumn("last_borrow_rate", F.col("last_borrow.rate")).drop("last_borrow"), tokens)


def reserve_state(updates: DataFrame, fields: Sequence[str], width: str = "2 hours", scale: float = 1e27, order: str = "seq") -> DataFrame:
    """Last value of each field in a bucket, scaled, and the number of updates."""
    last = [(F.max_by(f, order).cast("double") / scale).alias(f) for f in fields]
    return updates.groupBy(*_keys(width)).agg(*last, F.count("*").alias("update_count"))


def intervals(changes: DataFrame, width: str) -> DataFrame:
    """(asset, param, value, valid_from, valid_to): the last change of each bucket holds until the next one."""
    last = changes.groupBy(bucket("time", width).alias("valid_from"), "asset", "param").agg(F.max_by("value", "block").alias("value"))
    return last.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("asset", "param").orderBy("valid_from")))


def on_grid(spans: DataFrame, lo: str, hi: str, width: str) -> DataFrame:
    """A row for each grid point lo <= t <= hi that a span [valid_from, valid_to) covers; open spans go on to hi."""
    step = F.expr(f"interval '{width}'")
    start, end = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    first, stop = F.greatest("valid_from", start), F.least(F.coalesce("valid_to", end + step), end + step)
    return spans.where(first < stop).withColumn("time_bucket", F.explode(F.sequence(first, stop - step, step))).drop("valid_from", "valid_to")


def grid(spark: SparkSession, lo: str, hi: str, width: str) -> DataFrame:
    """All bucket starts lo <= t <= hi."""
    return spark.range(1).select(F.explode(F.expr(f"sequence(timestamp_ntz'{lo}', timestamp_ntz'{hi}', interval '{width}')")).alias("time_bucket"))


def reserve_config(changes: DataFrame, tokens: DataFrame, params: Sequence[str], lo: str, hi: str, width: str = "2 hours") -> DataFrame:
    """State of each parameter at each grid point from the first change of the asset on, 0 where unset, and changes in the bucket."""
    state = on_grid(intervals(changes, width), lo, hi, width).groupBy("time_bucket", "asset").pivot("param", list(params)).agg(F.max("value"))
    state = state.select("time_bucket", "asset", *(F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(p) for p in params))
    counts = changes.groupBy(*_keys(width)).agg(F.count("*").alias("config_event_count"))
    out = state.join(counts, ["asset", "time_bucket"], "left").withColumn("config_event_count", F.coalesce("config_event_count", F.lit(0)))
    return with_symbol(out, tokens)


def liquidation(rows: DataFrame, tokens: DataFrame, width: str = "2 hours", exact: bool = False) -> DataFrame:
    """Both legs of each liquidation; users and liquidators count with the assets of both legs.

    Exact counts take a scan each, so that what is shuffled for them are the keys and an actor, and no amounts.
    """
    big = {leg: wide(rows, f"{leg}_amount") for leg in ("collateral", "debt")}
    sums = {"collateral": "collateral_amount_raw", "debt": "debt_covered_raw"}
    counts = ["collateral_tx_count", "debt_tx_count", "liquidation_tx_count", "receive_token_count"]
    people = {"unique_liquidated_users": "user", "unique_liquidators": "liquidator"}
    keys = ["time_bucket", "asset"]

    def side(leg: str) -> Column:
        """What one leg adds."""
        amounts = [(whole(rows, f"{k}_amount") if k == leg else F.lit(None).cast("string" if big[k] else rows.schema[f"{k}_amount"].dataType)).alias(n) for k, n in sums.items()]
        taken = F.coalesce(F.col("receive_token"), F.lit(False)).cast("int") if leg == "collateral" else F.lit(0)
        numbers = [F.lit(int(leg == "collateral")), F.lit(int(leg == "debt")), F.lit(1), taken]
        return F.struct(F.col(f"{leg}_asset").alias("asset"), *amounts, *(x.alias(c) for x, c in zip(numbers, counts)))

    flat = rows.select(bucket("time", width).alias("time_bucket"), "block", *({} if exact else people.values()), F.explode(F.array(*map(side, sums))).alias("x")).select("*", "x.*")
    aggs = [*(_total(n, big[leg]) for leg, n in sums.items()), *(F.sum(c).alias(c) for c in counts), F.max("block").alias("latest_liquidation_block")]
    if exact:
        assets = F.explode(F.array(*(f"{leg}_asset" for leg in sums))).alias("asset")
        seen = [rows.select(bucket("time", width).alias("time_bucket"), assets, role).groupBy(*keys).agg(F.count_distinct(role).alias(n)) for n, role in people.items()]
        parts = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [flat.groupBy(*keys).agg(*aggs), *seen])
        out = parts.groupBy(*keys).agg(*(F.max(c).alias(c) for c in parts.columns if c not in keys))  # one row of the parts has each number
    else:
        out = flat.groupBy(*keys).agg(*aggs, *(F.approx_count_distinct(role).alias(n) for n, role in people.items()))
    out = out.withColumns({n: F.coalesce(n, F.lit("0") if big[leg] else F.lit(0)) for leg, n in sums.items()})
    return with_symbol(out, tokens)


def flashloan(rows: DataFrame, tokens: DataFrame, width: str = "2 hours", exact: bool = False, scale: bool = False) -> DataFrame:
    """Amounts, premiums (rate), counts by mode; with scale, amounts are divided by the asset's decimals."""
    names = {"flashloan_amount_raw": "amount", "flashloan_premium_raw": "premium"}
    modes = {f"mode{m}_count": F.coalesce(F.col("mode") == m, F.lit(False)).cast("int") for m in (0, 1, 2)}
    flat = rows.select(*_keys(width), "user", F.col("block").alias("latest_block"), *(whole(rows, c).alias(n) for n, c in names.items()), F.lit(1).alias("flashloan_tx_count"), *(v.alias(k) for k, v in modes.items()))
    out = by_actor(flat, ["time_bucket", "asset"], {n: wide(rows, c) for n, c in names.items()}, ["flashloan_tx_count", *modes], ["latest_block"], exact, {"unique_initiators": "flashloan_tx_count"})
    out = with_symbol(out, tokens, "asset_symbol", "decimals")
    if not scale:
        return out.drop("decimals")
    for n in names:
        out = out.withColumn(n.removesuffix("_raw"), exactly_scaled(out, n, "decimals")).drop(n)
    return out.drop("decimals")


def last_price(calls: DataFrame, tokens: DataFrame, width: str = "1 hour") -> DataFrame:
    out = calls.groupBy(*_keys(width)).agg(F.max_by("output", F.struct("block", "idx")).alias("last_price"), F.max("block").alias("latest_block"), F.count("*").alias("call_count"))
    return with_symbol(out, tokens)


def user_account(calls: DataFrame, averages: Sequence[str], health: str, width: str = "2 hours", exact: bool = False) -> DataFrame:
    """Market-wide means per bucket, extremes of the health factor (as numbers, also of digit strings), users sampled and calls."""
    big = wide(calls, health)
    factor = bigint.order(whole(calls, health)) if big else F.col(health)
    factor = F.when(whole(calls, health).isNotNull(), factor)
    flat = calls.select(bucket("time", width).alias("time_bucket"), "user", factor.alias("least"), factor.alias("most"), F.lit(1).alias("n"), *(F.col(c).cast("double").alias(c) for c in averages))
    own = [F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")]
    if exact:  # means from sums and counts by user
        parts = [x for c in averages for x in (F.sum(c).alias(c), F.count(c).alias(f"n_{c}"))]
        flat = flat.groupBy("time_bucket", "user").agg(*own, *parts)
        means = [F.try_divide(F.sum(c), F.sum(f"n_{c}")) for c in averages]
    else:
        means = [F.avg(c) for c in averages]
    people = F.count("user") if exact else F.approx_count_distinct("user")
    ends = lambda c: F.col(c)["digits"] if big else F.col(c)
    out = flat.groupBy("time_bucket").agg(*own, *(m.alias(f"avg_{c}") for m, c in zip(means, averages)), people.alias("sampled_users"))
    return out.select("time_bucket", *(f"avg_{c}" for c in averages), ends("least").alias("min_health_factor"), ends("most").alias("max_health_factor"), "sampled_users", F.col("n").alias("call_count"))


def collateral_toggle(enabled: DataFrame, disabled: DataFrame, tokens: DataFrame, width: str = "2 hours", exact: bool = False) -> DataFrame:
    rows = tagged(enabled=enabled, disabled=disabled)
    flat = rows.select(*_keys(width), "user", F.col("block").alias("latest_block"), *((F.col("kind") == k).cast("int").alias(f"{k}_count") for k in ("enabled", "disabled")))
    people = {"unique_enable_users": "enabled_count", "unique_disable_users": "disabled_count"}
    return with_symbol(by_actor(flat, ["time_bucket", "asset"], {}, ["enabled_count", "disabled_count"], ["latest_block"], exact, people), tokens)


def two_denominations(feed: DataFrame, universe: DataFrame, numeraire: str, width: str, dims: DataFrame | None = None) -> DataFrame:
    """Mean price per bucket in the feed's unit and in units of the numeraire, for assets of the universe."""
    base = feed.where(F.col("asset") == numeraire).select("time", F.col("price").alias("base_price"))
    own = feed.join(universe.select("asset").distinct(), "asset", "left_semi").join(base, "time")
    out = own.groupBy(*_keys(width)).agg(F.avg("price").alias("avg_price_usd"), F.avg(F.col("price") / F.col("base_price")).alias("avg_price_eth"), F.count("price").alias("price_points"))
    return out if dims is None else out.join(dims, "asset", "left")


def metric_dictionary(spark: SparkSession, fixed: Iterable[tuple[str, int, str]], assets: Sequence[DataFrame] = (), metrics: Sequence[str] = (), tokens: DataFrame | None = None) -> DataFrame:
    """(asset, asset_symbol, metric, decimals, unit): raw-amount metrics for every asset seen, fixed ones without an asset."""
    kind = "asset long, asset_symbol string, metric string, decimals int, unit string"
    rows = spark.createDataFrame([(None, None, m, d, u) for m, d, u in fixed], kind)
    if assets:
        seen = reduce(lambda a, b: a.union(b), (a.select("asset") for a in assets)).distinct()
        names = spark.createDataFrame([(m,) for m in metrics], "metric string")
        own = with_symbol(seen.crossJoin(F.broadcast(names)), tokens, "asset_symbol", "decimals")
        rows = own.select(F.col("asset").cast("long"), "asset_symbol", "metric", "decimals", F.lit("raw_token_amount").alias("unit")).unionByName(rows)
    return rows


def covered(dictionary: DataFrame, panel: DataFrame) -> DataFrame:
    """A metric dictionary with n_values: in how many rows of the panel each metric has a value; null if the panel lacks it."""
    there = [c for c in panel.columns if c not in ("time_bucket", "asset", "asset_symbol")]
    counts = panel.agg(*(F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(there)))
    long = counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(f"n{i}").alias("n_values")) for i, c in enumerate(there)))).alias("x")).select("x.*")
    return dictionary.join(long, "metric", "left")
