"""Operators with state of their own per key or group of keys, by ``transformWithState``.

``current_changes``  STM-1 with deletes: newest version per key, a null value deletes the key,
``transitions``      WIN-9 on a stream: status changes in log order, across micro-batches.

State lives in RocksDB (``rocksdb`` sets the provider while a query is started; a restarted
query finds it in its checkpoint) and is bounded: deletes are forgotten after the compaction
lag, versions wait only until the watermark has passed them.  Both go by event time: with
processing time an ``availableNow`` run would never end.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Any, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.schemas import COMPACTION_LAG_MS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Groups of keys that ``transitions`` keeps together, and versions in a chunk of their buffer.
GROUPS, CHUNK = 4096, 10_000
LOWEST = -2**63
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as ``transformWithState`` needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class _Newest(StatefulProcessor):
    """Holds the order value of a key's newest version; of a deleted key only for the lag."""

    def __init__(self, columns: list[str], order: str, value: str, lag_ms: int):
        self.columns, self.order, self.value, self.lag_ms = columns, order, value, lag_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("newest", "at long, forget_ms long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = max(rows, key=lambda r: r[self.order])
        held = self.state.get()
        if held is not None and held[0] >= newest[self.order]:
            return
        out = {c: newest[c] for c in self.columns}
        forget = newest["_ms"] + self.lag_ms if newest[self.value] is None else None
        self.state.update((newest[self.order], forget))
        if forget is not None:
            self.handle.registerTimer(forget)
        yield Row(**out, deleted=forget is not None)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.state.get()
        if held is not None and held[1] == expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def current_changes(stream: DataFrame, key: str = "key", order: str = "offset", value: str = "value",
                    ts: str = "event_time", delay: str = "1 hour", lag_ms: int = COMPACTION_LAG_MS) -> DataFrame:
    """STM-1: the changes of the current table, one row for each key whose newest version is new.

    A version with a null ``value`` is a delete: its row has ``deleted`` set, and the key is
    remembered until the watermark (``delay`` behind the newest ``ts``) is ``lag_ms`` past it, so
    that an older version that arrives late does not bring the key back.  Keep the rows with
    ``upsert_current`` in update mode; ``read_live`` reads the table.
    """
    kept = [f for f in stream.schema.fields if f.name != ts]
    schema = T.StructType([*kept, T.StructField("deleted", T.BooleanType())])
    rows = stream.withColumn("_ms", F.unix_millis(ts)).withWatermark(ts, delay)
    return rows.groupBy(key).transformWithState(_Newest([f.name for f in kept], order, value, lag_ms), schema, "Update", "EventTime")


class _Transitions(StatefulProcessor):
    """Last status of each key of a group, in log order; versions wait in a buffer until the watermark has passed them.

    Both are kept as columns, and the buffer in chunks: a call to the state moves many versions."""

    def __init__(self, names: list[str]):
        self.names = names  # of the output: key, order, previous status, status

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "key array<string>, status array<string>")
        self.waiting = handle.getListState(
            "waiting", "key array<string>, at array<bigint>, status array<string>, ms array<bigint>")
        self.emptied: dict[Any, int] = {}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        oldest = []
        for pdf in rows:
            self.waiting.appendValue(tuple(pdf[c].tolist() for c in ("k", "at", "state", "ms")))
            oldest.append(int(pdf["ms"].min()))
        self.handle.registerTimer(min(oldest))
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs()
        if self.emptied.get(key) == upto:  # by another timer of the group
            return
        self.emptied[key] = upto
        held = [w for part in self.waiting.get() for w in zip(*part)]
        ready, rest = [w for w in held if w[3] <= upto], [w for w in held if w[3] > upto]
        if not ready:
            return
        ready.sort(key=lambda w: w[1])
        before = self.last.get()
        last = dict(zip(*before)) if before is not None else {}
        changes = []
        for k, at, status, _ in ready:
            if k not in last or last[k] != status:
                changes.append((k, at, last.get(k), status))
            last[k] = status
        self.last.update((list(last), list(last.values())))
        self.waiting.clear()
        for i in range(0, len(rest), CHUNK):
            self.waiting.appendValue(tuple(map(list, zip(*rest[i:i + CHUNK]))))
        if rest:
            self.handle.registerTimer(min(w[3] for w in rest))
        for i in range(0, len(changes), CHUNK):
            yield pd.DataFrame(changes[i:i + CHUNK], columns=self.names)

    def close(self) -> None:
        pass


def transitions(stream: DataFrame, key: str = "key", order: str = "offset", status: str = "status",
                ts: str = "event_time", delay: str = "1 hour", groups: int = GROUPS) -> DataFrame:
    """WIN-9 on a stream: versions whose status differs from the key's previous one in ``order``.

    Versions may arrive out of order by up to ``delay`` of event time, which has to grow along
    ``order``; a row comes out once the watermark has passed it.

    Keys share their state in ``groups`` by their hash: a Python call and a few calls to the state
    serve a group, not a key.  A group is read and written whole when some of it is ready, so take
    some hundreds of keys for one.  State is found by group: a checkpoint keeps its ``groups``.
    """
    fields = {f.name: f for f in stream.schema.fields}
    names = [key, order, "prev_" + status, status]
    text = [T.StructField(n, T.LongType() if n == order else T.StringType()) for n in names]
    # pandas would make floats of whole numbers beside nulls: keys go as text, no order as the lowest
    rows = stream.select(
        F.col(key).cast("string").alias("k"), F.coalesce(F.col(order).cast("long"), F.lit(LOWEST)).alias("at"),
        F.col(status).alias("state"), F.unix_millis(ts).alias("ms"), F.col(ts).alias("seen"),
        F.pmod(F.xxhash64(key), F.lit(groups)).alias("keys")).withWatermark("seen", delay)
    moved = rows.groupBy("keys").transformWithStateInPandas(_Transitions(names), T.StructType(text), "Append", "EventTime")
    return moved.select(F.col(key).cast(fields[key].dataType).alias(key),
                        F.nullif(order, F.lit(LOWEST)).cast(fields[order].dataType).alias(order), *names[2:])
