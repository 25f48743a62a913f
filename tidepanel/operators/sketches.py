"""Distinct counts that roll up: sketches of users per bucket, stored, merged to any wider window, and compared as sets.

A theta sketch holds at most 2^lg hashes and is exact below that many users; beyond, its relative standard error is about 2^(-lg/2), and that
of an intersection grows as the union is larger than it. An HLL sketch is smaller and only counts. Neither reads events again.
Where exact numbers are asked for, members (each user once a bucket) are stored beside the sketches: groups whose sketch may be full are
counted from them, in two aggregations, all others from the sketch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bucket
from ..sources.stored import stored


def members(events: DataFrame, keys: Sequence[str] = ("asset",), user: str = "user", kind: str = "kind", width: str = "2 hours", time: str = "time") -> DataFrame:
    """(time_bucket, keys, kind, user): each user of each kind of event once a bucket; null users do not count. Sketches can be made from it (time="time_bucket")."""
    return events.where(F.col(user).isNotNull()).select(bucket(time, width).alias("time_bucket"), *keys, F.col(kind).alias("kind"), F.col(user).alias("user")).distinct()


def sketched(events: DataFrame, keys: Sequence[str] = ("asset",), user: str = "user", kind: str = "kind", width: str = "2 hours", time: str = "time", lg: int = 14, lg_hll: int = 14) -> DataFrame:
    """(time_bucket, keys, kind, users, register): a theta and an HLL sketch of the users of each kind of event. Null users do not count."""
    rows = events.where(F.col(user).isNotNull())
    return rows.groupBy(bucket(time, width).alias("time_bucket"), *keys, F.col(kind).alias("kind")).agg(F.theta_sketch_agg(user, lg).alias("users"), F.hll_sketch_agg(user, lg_hll).alias("register"))


def rolled(sketches: DataFrame, width: str | None, keys: Sequence[str] = ("asset",), lg: int = 14) -> DataFrame:
    """Sketches of wider buckets (None: of all time) and fewer keys, merged from narrower ones; lg as they were made with."""
    when = [bucket("time_bucket", width).alias("time_bucket")] if width else []
    return sketches.groupBy(*when, *keys, "kind").agg(F.theta_union_agg("users", lg).alias("users"), F.hll_union_agg("register").alias("register"))


def counted(sketches: DataFrame) -> DataFrame:
    """Sketches with n_users and n_users_hll, the estimates."""
    return sketches.withColumns({"n_users": F.theta_sketch_estimate("users"), "n_users_hll": F.hll_sketch_estimate("register")}).drop("users", "register")


def _within(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the groups named; null keys are equal."""
    own = groups.select(*(F.col(k).alias(f"_{k}") for k in by))
    return rows.join(own, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by)), "left_semi")


def _of(members: DataFrame, width: str | None) -> DataFrame:
    return members.withColumn("time_bucket", bucket("time_bucket", width)) if width else members


def counted_exactly(sketches: DataFrame, members: DataFrame, width: str | None, keys: Sequence[str] = ("asset",), lg: int = 14) -> DataFrame:
    """(time_bucket, keys, kind, n_users) of sketches rolled to width and keys, of any number of users."""
    by = [*(["time_bucket"] if width else []), *keys, "kind"]
    known = stored(sketches.select(*by, F.theta_sketch_estimate("users").alias("n_users")), "counts")
    full = F.col("n_users") >= 2**lg  # an estimate rounds, so a sketch that lacks a hash may give just 2^lg
    rest = _within(_of(members, width), known.where(full), by).select(*by, "user").distinct()
    return known.where(~full).unionByName(rest.groupBy(*by).agg(F.count("*").alias("n_users")))


def compared_exactly(sketches: DataFrame, members: DataFrame, a: str, b: str, width: str | None, keys: Sequence[str] = ("asset",), lg: int = 14) -> DataFrame:
    """What compared gives of sketches rolled to width and keys, of any number of users."""
    by = [*(["time_bucket"] if width else []), *keys]
    known = stored(compared(sketches, a, b, by, lg), "compared")
    full = (F.col("n_a") >= 2**lg) | (F.col("n_b") >= 2**lg)
    rest = _within(_of(members.where(F.col("kind").isin(a, b)), width), known.where(full), by)
    each = rest.groupBy(*by, "user").agg(F.bool_or(F.col("kind") == a).alias("_a"), F.bool_or(F.col("kind") == b).alias("_b"))
    n = {"n_a": F.col("_a"), "n_b": F.col("_b"), "n_both": F.col("_a") & F.col("_b"), "n_either": F.lit(True), "n_only_a": F.col("_a") & ~F.col("_b")}
    return known.where(~full).unionByName(each.groupBy(*by).agg(*(F.count_if(c).alias(k) for k, c in n.items())))


def compared(sketches: DataFrame, a: str, b: str, by: Sequence[str] = ("time_bucket", "asset"), lg: int = 14) -> DataFrame:
    """(by, n_a, n_b, n_both, n_either, n_only_a): users of two kinds of events as sets, by estimates of intersections and differences.

    Unions hold twice as many hashes (lg + 1), so they are exact where both sketches are.
    """
    side = lambda k: F.first(F.when(F.col("kind") == k, F.col("users")), ignorenulls=True)
    sets = sketches.where(F.col("kind").isin(a, b)).groupBy(*by).agg(side(a).alias("_a"), side(b).alias("_b"))
    size = lambda x: F.coalesce(F.theta_sketch_estimate(x), F.lit(0))
    two: Column = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    both = F.when(two, F.theta_sketch_estimate(F.theta_intersection("_a", "_b"))).otherwise(0)
    either = F.when(two, F.theta_sketch_estimate(F.theta_union("_a", "_b", min(lg + 1, 26)))).otherwise(size("_a") + size("_b"))
    only = F.when(two, F.theta_sketch_estimate(F.theta_difference("_a", "_b"))).otherwise(size("_a"))
    return sets.select(*by, size("_a").alias("n_a"), size("_b").alias("n_b"), both.alias("n_both"), either.alias("n_either"), only.alias("n_only_a"))
