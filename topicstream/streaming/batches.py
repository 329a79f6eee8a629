"""Numbered batches of a fixed size within each shard of a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from topicstream.operators.batches import DEFAULT_BATCH_SIZE
from topicstream.schema import SHARD_ID

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_AT_ONCE = 1 << 16


def number_batches(stream: DataFrame, size: int = DEFAULT_BATCH_SIZE, *, order_by: str = "seq") -> DataFrame:
    """Add ``batch_no`` to a stream: the first ``size`` records of a shard are batch 0, the next batch 1, ...

    A shard's records follow one another in the order of triggers and within a trigger in that of ``order_by``, a numeric
    column. So the numbers are those of :func:`topicstream.assign_batches` if records arrive in that order. Two records of
    a shard in one trigger with the same value, or a null, fail the query; so does one that comes before the last
    of an earlier trigger. The state is a counter and the last value for each shard, in RocksDB, and moves with the
    checkpoint: a trigger that is replayed gives the same numbers. A shard's records of one trigger are sorted in one task, so
    limit what a trigger reads (see :func:`topicstream.read_topic`).
    """
    if not stream.isStreaming:
        raise ValueError("number_batches takes a stream; use assign_batches for a bounded DataFrame")
    if size < 1:
        raise ValueError(f"batch size must be positive, got {size}")
    if "batch_no" in stream.columns:
        raise ValueError("there is a column batch_no already")
    if order_by not in stream.columns:
        raise ValueError(f"there is no column {order_by}")
    # State with timers and several variables is kept by this provider only.
    stream.sparkSession.conf.set(_PROVIDER, _ROCKSDB)
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_no", T.LongType())])
    return stream.groupBy(SHARD_ID).transformWithStateInPandas(
        _Numbering(size, order_by, schema.fieldNames()), schema, outputMode="Append", timeMode="None"
    )


class _Numbering(StatefulProcessor):
    def __init__(self, size: int, order_by: str, columns: list[str]):
        self._size, self._order_by, self._columns = size, order_by, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "n long, last double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(rows, ignore_index=True)
        order = arrived[self._order_by]
        if order.isna().any():
            raise ValueError(f"{self._order_by} is null")
        arrived = arrived.iloc[np.argsort(order.to_numpy(), kind="stable")]
        order = arrived[self._order_by].to_numpy()
        n, last = self._seen.get() if self._seen.exists() else (0, float("-inf"))
        if (order[1:] == order[:-1]).any() or float(order[0]) <= last:
            raise ValueError(f"{self._order_by} of shard {key[0]} repeats or goes back")
        arrived["batch_no"] = (n + np.arange(len(arrived))) // self._size
        self._seen.update((n + len(arrived), float(order[-1])))
        for start in range(0, len(arrived), _AT_ONCE):
            yield arrived.iloc[start : start + _AT_ONCE][self._columns]

    def close(self) -> None:
        pass
