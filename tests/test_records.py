"""The scan that admits an exact number of records in a trigger."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_streaming import BY_NAME, COPY, MESSAGE, append, copy_stream
from test_streaming import drain as drain_files
from topicstream import append_topic, create_topic, prepare_records, read_topic_batch
from topicstream.streaming import records
from topicstream.streaming.records import drain, read_topic_records


def start(spark, source, subscription, out, cap, **reading):
    slots = {"rate": cap, "interval_seconds": 1, "slots": 1}
    stream = read_topic_records(spark, source, subscription, **slots, **reading)
    running = stream.writeStream.format("parquet").option("path", out)
    return running.option("checkpointLocation", source.subscription_path(subscription)).start()


def inputs(query):
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_a_trigger_ends_inside_a_file(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    rows = spark.range(0, 100_000, 1, 1).selectExpr("id as seq", "concat('k', id) as name")
    append_topic(prepare_records(rows, source, lambda shards: F.lit("2")), source, compact=False)
    assert len(list(Path(source.producer_path("main")).rglob("*.parquet"))) == 1
    out = f"{root}/out"
    query = start(spark, source, "s", out, 5000)
    drain(query)
    assert inputs(query) == [5000] * 20
    found = spark.read.parquet(out)
    assert found.count() == found.select("seq").distinct().count() == 100_000
    expected = read_topic_batch(spark, source)
    assert found.columns == expected.columns
    same = found.select("seq", "name", F.to_json("attributes").alias("a"), "system_time", "arrival_date", "shard_id")
    assert same.exceptAll(expected.select("seq", "name", F.to_json("attributes"), "system_time", "arrival_date", "shard_id")).isEmpty()


def test_restarts_go_on_where_they_stopped(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, producers=("a", "b"), max_records_per_file=70)
    out = f"{root}/out"
    append(spark, source, 0, 500, "a")
    for first in (500, 900, 900):
        query = start(spark, source, "s", out, 130)
        drain(query)
        assert all(n <= 130 for n in inputs(query))
        if first < 900:
            append(spark, source, first, 900, "b")
    # A run that was cut off after some triggers.
    append(spark, source, 900, 1700, "a")
    stream = read_topic_records(spark, source, "s", rate=130, interval_seconds=1, slots=1)
    once = stream.writeStream.format("parquet").option("path", out).trigger(availableNow=True)
    once = once.option("checkpointLocation", source.subscription_path("s")).start()
    once.awaitTermination()
    assert inputs(once) == [130]
    query = start(spark, source, "s", out, 130)
    drain(query)
    assert sum(inputs(query)) == 670
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(1700))


def test_a_failed_trigger_is_read_again(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 400)

    def run(step):
        stream = read_topic_records(spark, source, "s", rate=90, interval_seconds=1, slots=1, columns=["seq", "name"])
        made = prepare_records(step(stream), sink, BY_NAME)
        from topicstream import write_topic

        return write_topic(made, sink, checkpoint=source.subscription_path("s"), interval_seconds=None)

    poison = F.when(F.col("seq") == 333, F.raise_error(F.lit("send failed")).cast("string")).otherwise(F.col("name"))
    with pytest.raises(Exception, match="send failed"):
        drain(run(lambda df: df.withColumn("name", poison)))
    drain(run(lambda df: df))
    assert sorted(r.seq for r in read_topic_batch(spark, sink).collect()) == list(range(400))


def test_only_wanted_shards_and_committed_files(spark, root):
    source, middle = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 300)
    drain_files(copy_stream(spark, source, middle), middle, f"{root}/c")
    committed = next(Path(middle.producer_path("main")).rglob("shard_id=1/*.parquet"))
    committed.with_name("part-stray.parquet").write_bytes(committed.read_bytes())
    for topic, name in ((source, "first"), (middle, "second")):
        out = f"{root}/{name}"
        query = start(spark, topic, "s", out, 40, shards=["1", 3], columns=["seq", "shard_id"])
        drain(query)
        expected = read_topic_batch(spark, topic, shards=["1", "3"]).select("seq", "shard_id")
        assert sorted(map(tuple, spark.read.schema("seq long, shard_id string").parquet(out).collect())) == sorted(map(tuple, expected.collect()))
        assert sum(inputs(query)) == expected.count()
    with pytest.raises(ValueError, match="no shards"):
        read_topic_records(spark, source, "s", rate=1, shards=["9"])


def test_the_list_of_files_is_joined_now_and_then(tmp_path, monkeypatch):
    monkeypatch.setattr(records, "_COMPACT_EVERY", 3)
    log = records._FileLog(str(tmp_path / "log"))
    for i in range(8):
        log.extend([f"f{j}" for j in range(i + 1)], 0)
        log.extend([f"f{j}" for j in range(i + 1)], 0)
        assert records._FileLog(str(tmp_path / "log")).paths == [f"f{j}" for j in range(i + 1)]
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["000000000005.all.json", "000000000006.json", "000000000007.json"]


def test_an_empty_topic_is_read_once_it_has_records(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    query = start(spark, source, "s", f"{root}/out", 10)
    query.processAllAvailable()
    append(spark, source, 0, 25)
    drain(query)
    assert [n for n in inputs(query)] == [10, 10, 5]
