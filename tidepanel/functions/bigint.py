"""Whole numbers of up to 90 digits, with a sign or without, in string columns: parsing, order, exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB, LIMBS = 18, 5


def parsed(x: Column | str) -> Column:
    """Canonical digits of a whole number in text: no blanks, no leading zeros; null for anything else ('nan', '1.5', '1e3')."""
    text = F.trim(F.col(x) if isinstance(x, str) else x)
    digits = F.regexp_replace(F.regexp_replace(text, "^-", ""), "^0+(?=[0-9])", "")
    minus = F.when(text.startswith("-") & (digits != "0"), F.lit("-")).otherwise(F.lit(""))
    return F.when(text.rlike("^-?[0-9]+$"), F.concat(minus, digits))


def order(x: Column | str) -> Column:
    """A struct by which canonical digits, with a sign or without, sort as numbers."""
    c = _c(x)
    minus = c.startswith("-")
    size = F.when(minus, -F.length(c)).otherwise(F.length(c))
    return F.struct(size.alias("n"), F.when(minus, F.translate(c, "0123456789", "9876543210")).otherwise(c).alias("key"), c.alias("digits"))


def largest(x: Column | str) -> Column:
    return F.max(F.when(_c(x).isNotNull(), order(x)))["digits"]


def smallest(x: Column | str) -> Column:
    return F.min(F.when(_c(x).isNotNull(), order(x)))["digits"]


def total(x: Column | str) -> Column:
    """Exact sum of canonical digits, as digits with a sign: limbs of 18 digits are summed apart, then carried.

    Null if there is nothing to sum. Numbers of more than 90 digits are an error; their sum may have more.
    """
    return F.when(F.count(_c(x)) > 0, _signed(_sums(x)))


def signed_total(positive: Column | str, negative: Column | str) -> Column:
    """Exact sum of positive less sum of negative, as digits with a sign; null if there is nothing to sum."""
    zero = F.lit(0).cast("decimal(28,0)")
    less = [F.coalesce(a, zero) - F.coalesce(b, zero) for a, b in zip(_sums(positive), _sums(negative))]
    return F.when(F.count(_c(positive)) + F.count(_c(negative)) > 0, _signed(less))


def _signed(limbs: list[Column]) -> Column:
    up, down = _carried(limbs), _carried([-x for x in limbs])
    return F.when(up["carry"] < 0, F.concat(F.lit("-"), _digits(down))).otherwise(_digits(up))


def _sums(x: Column | str) -> list[Column]:
    c = _c(x)
    minus = c.startswith("-")
    digits = F.when(minus, F.substring(c, 2, 2**31 - 1)).otherwise(c)
    most = LIMB * LIMBS
    padded = F.when(F.length(digits) > most, F.raise_error(F.concat(F.lit(f"a number of more than {most} digits: "), c)).cast("string")).otherwise(F.lpad(digits, most, "0"))
    parts = [F.substring(padded, 1 + LIMB * i, LIMB).cast("decimal(18,0)") for i in range(LIMBS)]
    return [F.sum(F.when(minus, -p).otherwise(p)) for p in parts]


def _carried(limbs: list[Column]) -> Column:
    """(carry beyond the first limb, digits of all limbs) of sums of limbs, the highest first; the carry has the sign of the whole."""
    base = F.lit(10**LIMB).cast("decimal(38,0)")

    def step(a: Column, limb: Column) -> Column:
        whole = limb + a["carry"]
        rest = F.pmod(whole, base)
        digits = F.lpad(rest.cast("decimal(18,0)").cast("string"), LIMB, "0")
        return F.struct(((whole - rest) / base).cast("decimal(38,0)").alias("carry"), F.concat(digits, a["digits"]).alias("digits"))

    start = F.struct(F.lit(0).cast("decimal(38,0)").alias("carry"), F.lit("").alias("digits"))
    return F.aggregate(F.array(*(x.cast("decimal(38,0)") for x in reversed(limbs))), start, step)


def _digits(carried: Column) -> Column:
    more = F.when(carried["carry"] > 0, carried["carry"].cast("string")).otherwise(F.lit(""))
    return F.regexp_replace(F.concat(more, carried["digits"]), "^0+(?=[0-9])", "")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
