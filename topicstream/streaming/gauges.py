"""Record counters and the lag gauge of each shard while a stream runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicstream import storage
from topicstream.schema import SHARD_ID, SYSTEM_TIME

_TRIGGER = "trigger"
_COLUMNS = f"{SHARD_ID} string, records long, last_system_millis long, {_TRIGGER} long"


def start_gauges(
    stream: DataFrame, path: str, *, checkpoint: str, order_by: str, available_now: bool = False, interval_seconds: float = 10
) -> StreamingQuery:
    """Count a stream's records by shard, and note the arrival of the last one in ``order_by`` order, into the table ``path``.

    It is a query of its own beside the one that moves the records, under a checkpoint of its own. The state is a row for each
    shard, whatever the stream's size, and a task adds its records up before the shuffle, so a hot shard costs no more
    than others. After every trigger the shards it changed are appended; a trigger that is replayed replaces its rows. Read
    the table with :func:`read_gauges` at any time, also from another session.
    """
    counted = stream.groupBy(SHARD_ID).agg(
        F.count(F.lit(1)).alias("records"),
        F.max_by(F.unix_millis(SYSTEM_TIME), order_by).alias("last_system_millis"),
    )

    def keep(changed: DataFrame, trigger: int) -> None:
        changed.coalesce(1).write.mode("overwrite").parquet(storage.join(path, f"{_TRIGGER}={trigger}"))

    writer = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{int(interval_seconds * 1000)} milliseconds").start()


def read_gauges(spark: SparkSession, path: str, as_of: Column | None = None) -> DataFrame:
    """One row for each shard: its records so far and the lag in ms of the last one at ``as_of``, by default now."""
    changes = spark.read.schema(_COLUMNS).parquet(path)
    latest = {c: F.max_by(c, _TRIGGER) for c in ("records", "last_system_millis")}
    now = F.unix_millis(F.current_timestamp() if as_of is None else as_of)
    return changes.groupBy(SHARD_ID).agg(
        latest["records"].alias("records"), (now - latest["last_system_millis"]).alias("delay")
    )
