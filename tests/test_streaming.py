import os
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from topicstream import (
    FieldDef,
    TopicDef,
    Totals,
    add_producer,
    append_topic,
    create_topic,
    key_hash_selector,
    prepare_records,
    read_topic,
    read_topic_batch,
    sink_metrics,
    source_metrics,
    with_sink_metrics,
    with_source_metrics,
    write_topic,
)
from topicstream.streaming.source import bytes_per_trigger, records_per_trigger, shortest_interval

MESSAGE = TopicDef("tp", 4, "", (FieldDef("seq", "BIGINT"), FieldDef("name", "STRING")))
COPY = TopicDef("copy", 4, "", MESSAGE.fields)
BY_NAME = key_hash_selector("name")


def append(spark, topic, start, end, producer="main"):
    rows = spark.range(start, end).selectExpr("id as seq", "concat('k', id) as name")
    append_topic(prepare_records(rows, topic, BY_NAME), topic, producer=producer)


def copy_stream(spark, source, sink, step=lambda df: df, **reading):
    rows = read_topic(spark, source, **reading).select("seq", "name")
    return prepare_records(step(rows), sink, BY_NAME)


def seqs(spark, topic):
    return sorted(r.seq for r in read_topic_batch(spark, topic).collect())


def drain(records, sink, checkpoint, **settings):
    query = write_topic(records, sink, checkpoint=checkpoint, available_now=True, **settings)
    query.awaitTermination()
    return query


def test_union_of_producers_and_resume(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, producers=("a", "b", "idle"))
    sink = create_topic(spark, root, "p", COPY)
    checkpoint = source.subscription_path("sub")
    assert checkpoint == f"{root}/_subscriptions/p/tp/sub"
    append(spark, source, 0, 400, "a")
    append(spark, source, 400, 700, "b")
    drain(copy_stream(spark, source, sink), sink, checkpoint)
    assert seqs(spark, sink) == list(range(700))
    again = drain(copy_stream(spark, source, sink), sink, checkpoint)
    assert sum(p["numInputRows"] for p in again.recentProgress) == 0
    append(spark, source, 700, 730, "b")
    # A producer that was idle when the subscription began is part of it all the same.
    append(spark, source, 730, 800, "idle")
    third = drain(copy_stream(spark, source, sink), sink, checkpoint)
    assert sum(p["numInputRows"] for p in third.recentProgress) == 100
    assert seqs(spark, sink) == list(range(800))


def test_streamed_topic_is_a_source(spark, root):
    first = create_topic(spark, root, "p", MESSAGE)
    second = create_topic(spark, root, "p", COPY)
    third = create_topic(spark, root, "q", COPY)
    append(spark, first, 0, 300)
    drain(copy_stream(spark, first, second), second, f"{root}/c1")
    drain(copy_stream(spark, second, third, shards=["1", "2"]), third, f"{root}/c2")
    expected = [r.seq for r in read_topic_batch(spark, first, shards=["1", "2"]).collect()]
    assert seqs(spark, third) == sorted(expected)


def test_uncommitted_files_are_not_read(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 100)
    drain(copy_stream(spark, source, sink), sink, f"{root}/c")
    committed = next(Path(sink.producer_path("main")).rglob("*.parquet"))
    committed.with_name("part-stray.parquet").write_bytes(committed.read_bytes())
    assert seqs(spark, sink) == list(range(100))


def test_a_failed_run_is_replayed_without_loss(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, max_records_per_file=50)
    sink = create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 600)
    poison = F.when(F.col("seq") == 333, F.raise_error(F.lit("send failed")).cast("string")).otherwise(F.col("name"))
    rate = {"rate": 200, "interval_seconds": 200 / (200 * spark.sparkContext.defaultParallelism)}
    broken = copy_stream(spark, source, sink, lambda df: df.withColumn("name", poison), **rate)
    with pytest.raises(StreamingQueryException):
        drain(broken, sink, f"{root}/c")
    before = seqs(spark, sink)
    assert 333 not in before and len(before) < 600
    drain(copy_stream(spark, source, sink, **rate), sink, f"{root}/c")
    assert seqs(spark, sink) == list(range(600))


def fail_first_attempt(df):
    """Fail every task's first attempt half-way through its rows."""

    def step(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch.head(len(batch) // 2)
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("executor lost")
            yield batch.tail(len(batch) - len(batch) // 2)

    return df.mapInPandas(step, df.schema)


def test_lost_tasks_neither_lose_nor_double_records(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    rows = spark.range(0, 5000, 1, 4).selectExpr("id as seq", "concat('k', id) as name")
    append_topic(prepare_records(fail_first_attempt(rows), source, BY_NAME), source)
    assert seqs(spark, source) == list(range(5000))
    sink = create_topic(spark, root, "p", COPY)
    drain(copy_stream(spark, source, sink, fail_first_attempt), sink, f"{root}/c")
    assert seqs(spark, sink) == list(range(5000))


def test_rate_limit(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, producers=("a", "b"), max_records_per_file=20)
    sink = create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 900, "a")
    append(spark, source, 900, 1000, "b")
    limit = records_per_trigger(spark, 25, 1)
    assert limit == 25 * spark.sparkContext.defaultParallelism
    query = drain(copy_stream(spark, source, sink, rate=25, interval_seconds=1), sink, f"{root}/c")
    read = [p["numInputRows"] for p in query.recentProgress]
    assert max(read) <= limit + 2 * 20 and sum(read) == 1000 and len(read) >= 4
    assert seqs(spark, sink) == list(range(1000))


def test_small_files_are_read_at_once_under_the_rate(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, producers=("busy", "idle"), max_records_per_file=25)
    sink = create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 4000, "busy")
    assert len(list(Path(source.producer_path("busy")).rglob("*.parquet"))) >= 160
    query = drain(copy_stream(spark, source, sink, rate=50000), sink, f"{root}/c")
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [4000]


def test_a_topic_of_many_producers_opens_at_the_default_rate(spark, root):
    names = tuple(f"p{i}" for i in range(40))
    source = create_topic(spark, root, "p", MESSAGE, producers=names)
    read_topic(spark, source, rate=50000, slots=4)
    limits = bytes_per_trigger(spark, source, 1000)
    assert set(limits) == set(names) and min(limits.values()) >= 1
    append(spark, source, 0, 2000, "p3")
    limits = bytes_per_trigger(spark, source, 1000)
    held = sum(f.stat().st_size for f in Path(source.producer_path("p3")).rglob("*.parquet"))
    assert limits["p3"] == pytest.approx(held / 2, rel=0.05) and limits["p4"] == 1


@pytest.mark.parametrize(("rate", "slots"), [(50000, 8), (50000, 8000), (7, 3), (333, 1), (1_000_000, 1)])
def test_shortest_interval_admits_a_file(spark, root, rate, slots):
    source = create_topic(spark, root, "p", MESSAGE, producers=("a", "b", "c"))
    seconds = shortest_interval(spark, source, rate, slots)
    assert seconds >= 1 and records_per_trigger(spark, rate, seconds, slots) >= source.max_records_per_file
    if seconds > 1:
        assert records_per_trigger(spark, rate, seconds - 1, slots) < source.max_records_per_file


@pytest.mark.parametrize("days", [8, 400])
def test_files_with_an_old_time_are_read(spark, root, days):
    """Copies and restores keep a file's time, and Spark leaves out files much older than the newest it has seen."""
    source = create_topic(spark, root, "p", MESSAGE)
    sink = create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 100)
    drain(copy_stream(spark, source, sink), sink, f"{root}/c")
    before = set(Path(source.producer_path("main")).rglob("*.parquet"))
    append(spark, source, 100, 150)
    old = time.time() - days * 86400
    for file in set(Path(source.producer_path("main")).rglob("*.parquet")) - before:
        os.utime(file, (old, old))
    drain(copy_stream(spark, source, sink), sink, f"{root}/c")
    assert seqs(spark, sink) == list(range(150))


def test_an_added_producer_needs_a_new_subscription(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    sink = create_topic(spark, root, "p", COPY, producers=("main", "second"))
    append(spark, source, 0, 10)
    drain(copy_stream(spark, source, sink), sink, f"{root}/c")
    more = add_producer(spark, source, "late")
    append(spark, more, 10, 30, "late")
    with pytest.raises(StreamingQueryException):
        drain(copy_stream(spark, more, sink), sink, f"{root}/c")
    drain(copy_stream(spark, more, sink), sink, f"{root}/c2", producer="second")
    assert seqs(spark, sink) == sorted([*range(10), *range(30)])


def test_metrics(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 250)
    rows = with_source_metrics(read_topic(spark, source)).select("seq", "name").where("seq >= 100")
    query = drain(with_sink_metrics(prepare_records(rows, sink, BY_NAME)), sink, f"{root}/c")
    reports = list(query.recentProgress)
    counted = Totals(query).update().update()
    assert (counted.records_in, counted.records_out) == (250, 150)
    assert counted.last_system_millis > 1_600_000_000_000
    delay = source_metrics(reports[0])["delay"]
    assert 0 <= delay < 600_000
    assert sink_metrics(reports[0])["records_out"] == 150


def report(trigger, n):
    return {"batchId": trigger, "observedMetrics": {"source": {"records_in": n}, "sink": {"records_out": n // 2}}, "timestamp": "2024-01-01T00:00:00Z"}


def test_totals_count_each_trigger_once_and_miss_none(spark):
    query = SimpleNamespace(recentProgress=[report(0, 10), report(1, 0)])
    counted = Totals(query).update()
    query.recentProgress = [report(1, 0), report(1, 4), report(2, 6)]
    counted.update()
    assert (counted.records_in, counted.records_out) == (20, 10)
    query.recentProgress = [report(4, 1)]
    with pytest.raises(RuntimeError, match="triggers 3 to 3 are gone"):
        counted.update()


def test_totals_over_more_triggers_than_reports_are_kept(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, max_records_per_file=1)
    sink = create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 120)
    rows = with_source_metrics(read_topic(spark, source, rate=1, interval_seconds=1e-6)).select("seq", "name")
    records = with_sink_metrics(prepare_records(rows, sink, BY_NAME))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "20")
    try:
        query = write_topic(records, sink, checkpoint=f"{root}/c", available_now=True)
        counted = Totals(query).follow()
    finally:
        spark.conf.unset(kept)
    assert len(query.recentProgress) <= 20 and query.lastProgress["batchId"] >= 100
    assert (counted.records_in, counted.records_out) == (120, 120)
    assert seqs(spark, sink) == list(range(120))


def test_totals_that_begin_too_late_raise(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, max_records_per_file=1)
    sink = create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 30)
    rows = with_source_metrics(read_topic(spark, source, rate=1, interval_seconds=1e-6)).select("seq", "name")
    records = with_sink_metrics(prepare_records(rows, sink, BY_NAME))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "10")
    try:
        query = write_topic(records, sink, checkpoint=f"{root}/c", available_now=True)
        query.awaitTermination()
    finally:
        spark.conf.unset(kept)
    assert query.recentProgress[0]["batchId"] > 0
    with pytest.raises(RuntimeError, match="may be gone"):
        Totals(query).update()
    append(spark, source, 30, 33)
    query = write_topic(records, sink, checkpoint=f"{root}/c", available_now=True)
    query.awaitTermination()
    assert query.recentProgress[0]["batchId"] > 0
    assert Totals(query).update().records_in == 3


def test_compacted_stream_has_few_files(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, max_records_per_file=10)
    append(spark, source, 0, 1000)
    many = TopicDef("many", 32, "", MESSAGE.fields)

    def files(project, **settings):
        sink = create_topic(spark, root, project, many)
        drain(copy_stream(spark, source, sink), sink, f"{root}/{project}-checkpoint", **settings)
        assert seqs(spark, sink) == list(range(1000))
        return len(list(Path(sink.producer_path("main")).rglob("part-*.parquet")))

    assert files("default") <= 32
    assert files("halved", max_records_per_file=5) >= 200
    assert files("off", compact=False) > 64


def test_a_hot_shard_is_compacted_by_several_tasks(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, max_records_per_file=5000)
    copies = spark.range(0, 60000, 1, 8).selectExpr("id as seq", "if(id % 3 = 0, concat('k', id), 'hot') as name")
    append_topic(prepare_records(copies, source, BY_NAME), source, compact=False)
    sink = create_topic(spark, root, "p", COPY)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        query = drain(copy_stream(spark, source, sink), sink, f"{root}/c")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert "skewed" in query._jsq.explainInternal(False)
    assert seqs(spark, sink) == list(range(60000))


def test_immediate_mode_runs_until_stopped(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 100)
    query = write_topic(copy_stream(spark, source, sink), sink, checkpoint=f"{root}/c", interval_seconds=None)
    try:
        query.processAllAvailable()
        append(spark, source, 100, 150)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert not query.isActive
    assert seqs(spark, sink) == list(range(150))


def test_expiry_is_by_the_lifecycle(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY, lifecycle_days=3)
    append(spark, source, 0, 50)
    drain(copy_stream(spark, source, sink), sink, f"{root}/c", expire=True)
    assert seqs(spark, sink) == list(range(50))


def test_sink_checks(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    sink = create_topic(spark, root, "p", COPY, producers=("main", "bounded"))
    append(spark, source, 0, 10)
    append(spark, sink, 0, 10, "bounded")
    records = copy_stream(spark, source, sink)
    for blank in ("", " ", None):
        with pytest.raises(ValueError, match="checkpoint"):
            write_topic(records, sink, checkpoint=blank)
    with pytest.raises(ValueError, match="holds bounded writes"):
        write_topic(records, sink, checkpoint=f"{root}/c", producer="bounded")
    with pytest.raises(ValueError, match="no producer"):
        write_topic(records, sink, checkpoint=f"{root}/c", producer="other")
    with pytest.raises(ValueError, match="takes a stream"):
        write_topic(read_topic_batch(spark, source), sink, checkpoint=f"{root}/c")
    drain(records, sink, f"{root}/c")
    with pytest.raises(ValueError, match="written by a stream"):
        append(spark, sink, 0, 10, "main")
    assert seqs(spark, sink) == sorted([*range(10), *range(10)])


def test_producer_and_checkpoint_belong_together(spark, root):
    """Spark takes a batch number the sink's log holds already for done and would drop its rows without a word."""
    source = create_topic(spark, root, "p", MESSAGE)
    sink = create_topic(spark, root, "p", COPY, producers=("main", "second"))
    append(spark, source, 0, 100)
    drain(copy_stream(spark, source, sink), sink, f"{root}/c1")
    with pytest.raises(ValueError, match="belongs to the stream"):
        drain(copy_stream(spark, source, sink), sink, f"{root}/c2")
    with pytest.raises(ValueError, match="belongs to another sink"):
        drain(copy_stream(spark, source, sink), sink, f"{root}/c1", producer="second")
    drain(copy_stream(spark, source, sink), sink, f"{root}/c1/")
    drain(copy_stream(spark, source, sink), sink, f"{root}/c2", producer="second")
    assert seqs(spark, sink) == sorted([*range(100), *range(100)])
    Path(root, "c1").rename(Path(root, "moved"))
    with pytest.raises(ValueError, match="is gone"):
        drain(copy_stream(spark, source, sink), sink, f"{root}/c1")


def test_watermark_is_the_callers_choice(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    assert "EventTimeWatermark" not in read_topic(spark, source)._jdf.queryExecution().analyzed().toString()
    read_topic(spark, source).withWatermark("system_time", "1 minute")
