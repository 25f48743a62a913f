"""Forward-filled state as a stream: the last value of each key at every grid point, emitted once the watermark has passed it."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "next long, filled boolean, last double, waiting string"


def filled(stream: DataFrame, key: str = "asset", value: str = "value", order: str = "block", time: str = "time", width: str = "2 hours", late: str = "1 hour") -> DataFrame:
    """(key, time_bucket, value, fell): from a key's first change on, one row for each bucket that the watermark has passed.

    A bucket's value is that of its latest change by order, or else that of the bucket before; fell says whether it is below that. Changes may come in
    any order as long as they are not later than the watermark allows; those that are drop out, as do rows without a time or a value. State per key:
    the last value, and the changes of buckets that are still open. A timer lets buckets go out for keys without new changes.
    """
    step = int(pd.Timedelta(width).value // 1000)  # microseconds
    kind = stream.schema[key].dataType.simpleString()

    def advance(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, has, last, waiting = (*state.get[:3], json.loads(state.get[3])) if state.exists else (0, False, 0.0, {})
        for pdf in batches:
            for t, o, v in zip(pdf["t"].tolist(), pdf["o"].tolist(), pdf["v"].tolist()):
                b = t // step
                if has and b < at:
                    continue  # its bucket went out
                if str(b) not in waiting or waiting[str(b)][0] < o:
                    waiting[str(b)] = [o, v]
        mark = 1000 * state.getCurrentWatermarkMs()
        closed = mark // step  # buckets below are complete
        if not has and waiting:
            at = min(map(int, waiting))
        out = []
        while (has or waiting) and at < closed:
            change = waiting.pop(str(at), None)
            new = change[1] if change else last
            out.append((keys[0], at * step, new, bool(has and new < last)))
            at, last, has = at + 1, new, True
        state.update((at, has, last, json.dumps(waiting)))
        state.setTimeoutTimestamp(max(mark // 1000 + 1, (at + 1) * step // 1000))
        yield pd.DataFrame(out, columns=["key", "t", "value", "fell"])

    rows = stream.where(F.col(time).isNotNull() & F.col(value).isNotNull() & F.col(key).isNotNull()).withWatermark(time, late)
    own = rows.select(F.col(key).alias("key"), F.col(time).alias("time"), F.unix_micros(time).alias("t"), F.col(order).cast("long").alias("o"), F.col(value).cast("double").alias("v"))
    out = own.groupBy("key").applyInPandasWithState(advance, f"key {kind}, t long, value double, fell boolean", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("key").alias(key), F.timestamp_micros("t").alias("time_bucket"), "value", "fell")
