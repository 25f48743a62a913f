"""From raw panels to valued ones: decimals, prices, sums per bucket, and panels joined side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bucket, exactly_scaled
from ..sources import versions


def raw_amounts(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_raw")]


def decimals_of(dictionary: DataFrame, order: str | None = None) -> DataFrame:
    """(asset, decimals) from a metric dictionary: rows of raw amounts, the first one of each asset by order."""
    rows = dictionary.where("unit = 'raw_token_amount' and asset is not null")
    first = F.min(F.struct(order, "decimals"))["decimals"] if order else F.min("decimals")
    return rows.groupBy("asset").agg(first.alias("decimals"))


def scale_by_decimals(df: DataFrame, decimals: int | Mapping[str, int] | DataFrame, columns: Sequence[str] | None = None, drop_raw: bool = True) -> DataFrame:
    """Raw amounts over 10^decimals of the asset, or of the column if decimals is a mapping of columns; the suffix _raw goes.

    Null where the amount or its decimals are missing.
    """
    names = list(columns or (decimals if isinstance(decimals, Mapping) else raw_amounts(df)))
    new = {c: c.removesuffix("_raw") if c.endswith("_raw") else f"{c}_scaled" for c in names}
    if isinstance(decimals, DataFrame):
        df = df.join(decimals.select("asset", F.col("decimals").alias("_d")), "asset", "left")
        out = df.withColumns({n: exactly_scaled(df, c, "_d") for c, n in new.items()}).drop("_d")
    else:
        by = dict.fromkeys(names, decimals) if isinstance(decimals, int) else decimals
        out = df.withColumns({n: exactly_scaled(df, c, int(by[c])) for c, n in new.items()})
    return out.drop(*names) if drop_raw else out


def first_prices(prices: DataFrame, order: str, keys: Sequence[str] = ("time_bucket", "asset")) -> DataFrame:
    """One price row a key: the first by order."""
    return prices.groupBy(*keys).agg(*(F.min_by(c, order).alias(c) for c in prices.columns if c not in (*keys, order)))


def multiply_by_price(df: DataFrame, prices: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("time_bucket", "asset"), usd: str = "avg_price_usd", eth: str = "avg_price_eth") -> DataFrame:
    """Each amount in two denominations; null unless amount and price are there. prices has one row a key."""
    priced = df.join(prices.select(*keys, F.col(usd).alias("_usd"), F.col(eth).alias("_eth")), list(keys), "left")
    new: dict[str, Column] = {}
    for c in columns:
        new |= {f"{c}_value_usd": F.col(c) * F.col("_usd"), f"{c}_value_eth": F.col(c) * F.col("_eth")}
    return priced.withColumns(new).drop("_usd", "_eth")


def aggregate_by_time_bucket(df: DataFrame, columns: Sequence[str], agg: str | Mapping[str, str] = "sum", keys: Sequence[str] = ("time_bucket",), freq: str | None = None, min_count: int = 0) -> DataFrame:
    """One row a bucket (and key). Sums of nothing are 0, or null with min_count 1; with freq, missing buckets are filled in."""
    by = dict.fromkeys(columns, agg) if isinstance(agg, str) else dict(agg)

    def one(c: str, how: str) -> Column:
        x = getattr(F, {"mean": "avg", "nunique": "count_distinct"}.get(how, how))(c)
        return (F.coalesce(x, F.lit(0)) if how == "sum" and not min_count else x).alias(c)

    time, rest = keys[0], list(keys[1:])
    if freq:
        df = df.withColumn(time, bucket(time, freq))
    out = df.groupBy(*keys).agg(*(one(c, h) for c, h in by.items()))
    if not freq:
        return out
    ends = out.groupBy(*rest).agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    grid = ends.select(*rest, F.explode(F.sequence("lo", "hi", F.expr(f"interval {freq}"))).alias(time))
    filled = grid.join(out, [*rest, time], "left")
    return filled.select(*keys, *((F.coalesce(c, F.lit(0)) if h == "sum" and not min_count else F.col(c)).alias(c) for c, h in by.items()))


def flows(panel: DataFrame, decimals: DataFrame | int, prices: DataFrame, amounts: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """An asset panel as a series: amounts scaled, valued in two denominations and summed with the counts per bucket."""
    own = scale_by_decimals(panel, decimals, amounts)
    names = [a.removesuffix("_raw") for a in amounts]
    valued = multiply_by_price(own, prices, names)
    return aggregate_by_time_bucket(valued, [*(f"{n}_value_{d}" for n in names for d in ("usd", "eth")), *counts])


def assembled(base: DataFrame, *others: DataFrame, keys: Sequence[str] = ("time_bucket",), suffix: str = "_right") -> DataFrame:
    """base with the columns of the others at equal keys; a name that is taken gets the suffix."""

    def put(left: DataFrame, right: DataFrame) -> DataFrame:
        taken = set(left.columns) - set(keys)
        return left.join(right.select(*keys, *(F.col(c).alias(c + suffix if c in taken else c) for c in right.columns if c not in keys)), list(keys), "left")

    return reduce(put, others, base)


def reserve_panel(borrow: DataFrame, rates: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """Reserve rates next to the last borrow rate (and, if given, the configuration), by bucket and asset."""
    keys = ("time_bucket", "asset")
    out = assembled(borrow.select(*keys, "asset_symbol", "last_borrow_rate"), rates.drop("stable_borrow_rate"), keys=keys)
    return out if config is None else assembled(out, config, keys=keys)


def column_groups(df: DataFrame, groups: Mapping[str, Sequence[str]], key: str = "time_bucket") -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """The panel cut by columns into named frames with the key, and the columns that each group lacks."""
    have = set(df.columns)
    return {n: df.select(key, *(c for c in cs if c in have)) for n, cs in groups.items()}, {n: [c for c in cs if c not in have] for n, cs in groups.items()}


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return [c for c in after.columns if c not in set(before.columns)]


def written_version(df: DataFrame, path: str, label: str, stamp: str, partition: str | None = None) -> str:
    """Commit a panel under its label and UTC stamp; an existing version is an error."""
    if not versions.write(df, path, label, stamp, partition=partition):
        raise FileExistsError(f"{label}_{stamp}")
    return f"{label}_{stamp}"


def exported(frames: Mapping[str, DataFrame], path: str, stamp: str) -> dict[str, str]:
    """Write the panels of a run, each under its label and the run's UTC stamp; where each went."""
    return {label: written_version(df, path, label, stamp) for label, df in frames.items()}
