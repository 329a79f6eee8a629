"""Record counters and the lag gauge, observed while a query runs or reported over a bounded read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicstream.schema import SHARD_ID, SYSTEM_TIME

SOURCE = "source"
SINK = "sink"


def with_source_metrics(df: DataFrame, name: str = SOURCE) -> DataFrame:
    """Count records read and note the latest arrival, per trigger. Read them back with :func:`source_metrics`.

    Observing adds no stage and no shuffle: each task counts what passes it.
    """
    return df.observe(
        name,
        F.count(F.lit(1)).alias("records_in"),
        F.max(F.unix_millis(SYSTEM_TIME)).alias("last_system_millis"),
    )


def with_sink_metrics(df: DataFrame, name: str = SINK) -> DataFrame:
    """Count records handed to the sink, per trigger. Rows of a trigger that fails are counted when it is replayed."""
    return df.observe(name, F.count(F.lit(1)).alias("records_out"))


def source_metrics(progress: Mapping, name: str = SOURCE) -> dict[str, int | None]:
    """``records_in`` and ``delay`` (ms between the last record's arrival and the trigger) of one progress report."""
    seen = _observed(progress, name)
    last = seen.get("last_system_millis")
    now = dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    delay = None if last is None else int(now.timestamp() * 1000) - last
    return {"records_in": seen.get("records_in", 0), "delay": delay}


def sink_metrics(progress: Mapping, name: str = SINK) -> dict[str, int]:
    """``records_out`` of one progress report."""
    return {"records_out": _observed(progress, name).get("records_out", 0)}


class Totals:
    """Records in and out of one run of a query, over all its triggers.

    A query keeps only its last progress reports (``spark.sql.streaming.numRecentProgressUpdates``, 100 by default). So
    they are added up while it runs: call :meth:`update` now and then, or :meth:`follow` to do so until it ends. Reports
    are known by the number of their trigger, so none is added twice; if one was dropped before it was added,
    ``update`` raises, as the sums would be too small from then on. So it does at first if the query has as many reports as
    it keeps and they do not begin with trigger 0: a run that goes on from a checkpoint does not tell where it began.
    """

    def __init__(self, query: StreamingQuery, *, source: str = SOURCE, sink: str = SINK):
        self._query, self._source, self._sink = query, source, sink
        self._last: int | None = None
        self._sums = {"records_in": 0, "records_out": 0}
        self._latest = {"records_in": 0, "records_out": 0}
        self._arrival: int | None = None

    def update(self) -> Totals:
        reports = self._query.recentProgress
        for progress in reports:
            trigger = progress["batchId"]
            if self._last is None and trigger > 0 and len(reports) >= self._most():
                raise RuntimeError(f"reports of triggers before {trigger} may be gone: update earlier")
            if self._last is not None and trigger < self._last:
                continue
            if self._last is not None and trigger > self._last + 1:
                raise RuntimeError(f"reports of triggers {self._last + 1} to {trigger - 1} are gone: update more often")
            if self._last is not None and trigger > self._last:
                self._sums = self._with_latest()
            # A trigger that found nothing reports its number again once there is something.
            self._last = trigger
            self._latest = {
                "records_in": source_metrics(progress, self._source)["records_in"],
                "records_out": sink_metrics(progress, self._sink)["records_out"],
            }
            arrival = _observed(progress, self._source).get("last_system_millis")
            if arrival is not None:
                self._arrival = max(arrival, self._arrival or arrival)
        return self

    def _most(self) -> int:
        """Reports the query keeps at most: it drops old ones as soon as it has as many as the setting it started with."""
        settings = self._query._jsq.streamingQuery().sparkSessionForStream().conf()
        return max(1, int(settings.get("spark.sql.streaming.numRecentProgressUpdates")) - 1)

    def follow(self, every_seconds: float = 0.05) -> Totals:
        """Wait until the query ends, adding its reports up; raises what the query fails with."""
        while not self._query.awaitTermination(every_seconds):
            self.update()
        return self.update()

    @property
    def records_in(self) -> int:
        return self._with_latest()["records_in"]

    @property
    def records_out(self) -> int:
        return self._with_latest()["records_out"]

    @property
    def last_system_millis(self) -> int | None:
        """Arrival of the latest record read."""
        return self._arrival

    def _with_latest(self) -> dict[str, int]:
        return {name: self._sums[name] + self._latest[name] for name in self._sums}


def records_by_shard(df: DataFrame, name: str) -> DataFrame:
    """Record counter per shard over a bounded read."""
    return df.groupBy(SHARD_ID).agg(F.count(F.lit(1)).alias(name))


def delay_by_shard(df: DataFrame, as_of: Column, order_by: str) -> DataFrame:
    """Lag gauge per shard in ms: ``as_of`` minus the arrival of the shard's last record in ``order_by`` order.

    ``max_by`` keeps one value per task and shard before the shuffle, so a hot shard costs no more than others.
    """
    last = F.max_by(F.unix_millis(SYSTEM_TIME), order_by)
    return df.groupBy(SHARD_ID).agg((F.unix_millis(as_of) - last).alias("delay"))


def _observed(progress: Mapping, name: str) -> dict:
    row = (progress["observedMetrics"] or {}).get(name)
    return row.asDict() if hasattr(row, "asDict") else dict(row or {})
