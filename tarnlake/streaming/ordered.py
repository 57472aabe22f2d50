"""Ordered change apply: one state per key decides which version of a row counts.

A change is passed on if it is newer than what its key has seen, by the order columns and, between
equal ones, a hash of the row; older and repeated versions go, whatever delivery brings them. A
deletion is a version like any other, so an older version cannot bring its row back. The first order
column is the event time: a version later than ``late`` behind the newest time is left out, and the
state of a key goes by a timer once no version that old can come any more.

``apply_ordered`` writes what passes into a ``KeyedLayer``, whose merge is idempotent, so a
repeated batch changes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tarnlake.operators.merge import check_keys, has_key
from tarnlake.session import ROCKSDB, STATE_STORE_CONF
from tarnlake.sources.keyed_layer import KeyedLayer
from tarnlake.streaming import events

_TIE = "_tie"

# Spark also starts the processor in a worker on the driver, which has none of the files that
# ``addPyFile`` gives to tasks: what is pickled from here carries its own code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _place(row) -> tuple:
    """An order that puts null first and compares what a column holds."""
    return tuple((not pd.isna(v), None if pd.isna(v) else v) for v in row)


class NewerOnly(StatefulProcessor):
    """Lets a key's rows through if they are newer than its newest so far."""

    def __init__(self, order: list[T.StructField], columns: list[str]) -> None:
        self.order, self.columns = order, columns
        self.inputs = [*columns, _TIE]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType(self.order))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [f.name for f in self.order]
        best = None
        for frame in rows:
            # The frames come with names that Python accepts in tuples, which columns need not have.
            frame.columns = self.inputs
            for place in frame[names].itertuples(index=True, name=None):
                if best is None or _place(place[1:]) > best[0]:
                    best = _place(place[1:]), frame.loc[[place[0]]]
        known = self.seen.get() if self.seen.exists() else None
        if known is not None and best[0] <= _place(known):
            return
        newest = best[1].iloc[0]
        self.seen.update(tuple(None if pd.isna(newest[n]) else _plain(newest[n]) for n in names))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not pd.isna(newest[names[0]]):
            self.handle.registerTimer(int(pd.Timestamp(newest[names[0]]).timestamp() * 1000) + 1)
        yield best[1][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())


def _plain(value):
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def newer_only(changes: DataFrame, keys: list[str], order: list[str], late: str) -> DataFrame:
    """The changes that are newer than all before them of their key; rows without a key go.

    ``order[0]`` is the event time, a timestamp. Of several versions in one batch the newest passes.
    """
    check_keys(changes, keys)
    tied = changes.where(has_key(keys)).withColumn(_TIE, F.xxhash64(*changes.columns))
    fields = [tied.schema[c] for c in (*order, _TIE)]
    processor = NewerOnly([T.StructField(f.name, f.dataType) for f in fields], changes.columns)
    return (
        tied.withWatermark(order[0], late)
        .groupBy(*keys)
        .transformWithStateInPandas(
            statefulProcessor=processor,
            outputStructType=changes.schema,
            outputMode="append",
            timeMode="EventTime",
        )
    )


def apply_ordered(
    layer: KeyedLayer, order: list[str], soft_delete: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch function that merges what ``newer_only`` lets through into a layer."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        layer.merge(batch, order, soft_delete)

    return apply


@contextmanager
def _state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB: the default store can't hold value state
    and timers. A stream takes the settings of the session over when it starts."""
    before = spark.conf.get(STATE_STORE_CONF, None)
    spark.conf.set(STATE_STORE_CONF, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE_CONF)
        else:
            spark.conf.set(STATE_STORE_CONF, before)


def run_available(
    newer: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """``events.apply_available`` for what ``newer_only`` lets through, in a session of any settings."""
    with _state_in_rocksdb(newer.sparkSession):
        return events.apply_available(newer, checkpoint, apply)
