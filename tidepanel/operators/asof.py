"""As-of joins: the state in force at each event, without a grid and without an inequality join.

Events and changes are put under each other and in one order by key; the last value that a change set is carried forward along it. Long
keys are cut into parts (ranks.Parts), whose beginnings take the last values of the parts before, so a key with most of the rows is
spread over tasks like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranks


def state_at(events: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], prefix: str = "", strict: bool = False) -> DataFrame:
    """events with, for each of values, what the latest change of the key at or before (strict: before) the event set it to.

    A change sets only values that are not null in it. Both frames have keys and order; changes that share both are applied by the order of
    their values. Events before the first change, and those whose key or order holds a null, have a null state; repeated events are kept each.
    """
    there = lambda df: F.forall(F.array(*(F.col(c).isNotNull() for c in (*keys, *order))), lambda x: x)
    names = [f"_v{i}" for i in range(len(values))]
    place = lambda late: F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.lit(late).alias("late")).alias("_order")
    own = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    given = changes.where(there(changes)).select(*own, place(1 if strict else 0), *(F.col(v).alias(n) for v, n in zip(values, names)))
    asked = events.where(there(events)).select(*own, place(0 if strict else 1), F.struct(*(events[c] for c in events.columns)).alias("_row"))
    both = given.unionByName(asked, allowMissingColumns=True)
    parts = ranks.Parts(both, [f"_key{i}" for i in range(len(keys))], "_order")
    set_ = {n: F.when(F.col("_row").isNull() & F.col(n).isNotNull(), F.struct("_order", F.col(n).alias("value"))) for n in names}
    rows = parts.carried(parts.rows.where("_own"), {f"{n}_before": (x, "max") for n, x in set_.items()})
    last = [F.coalesce(F.max(x).over(parts.window()), F.col(f"{n}_before"))["value"].alias(n) for n, x in set_.items()]
    found = rows.select("_row", *last).where("_row is not null")
    out = found.select(*(F.col("_row")[c].alias(c) for c in events.columns), *(F.col(n).alias(prefix + v) for n, v in zip(names, values)))
    lost = events.where(~there(events)).select("*", *(F.lit(None).cast(changes.schema[v].dataType).alias(prefix + v) for v in values))
    return out.union(lost)
