import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import TESTDATA
from topicstream import (
    TopicDef,
    Totals,
    Transfer,
    create_topic,
    drain,
    event_time_from_millis,
    read_topic_batch,
    run_transfer,
    start_transfer,
)
from topicstream.plans import staging


@pytest.fixture
def job(spark):
    source = staging.stage_events(spark, TESTDATA)
    sink = create_topic(spark, source.root, staging.PROJECT, staging.EVENT_OUT, producers=("main", "backfill"))
    props = {
        "root": source.root,
        "default.project": staging.PROJECT,
        "source.topic": source.name,
        "source.subId": "s",
        "sink.topic": sink.name,
    }
    return source, sink, props


def content(spark, topic):
    return sorted(
        (r.seq, r.name, r.age, r.money, r.create_time, r.k, r.event_time, r.attributes["biz_key"], r.shard_id)
        for r in read_topic_batch(spark, topic).collect()
    )


def test_stream_and_bounded_run_agree(spark, job):
    _, sink, props = job
    query = start_transfer(spark, props, staging.checked_transfer(), available_now=True)
    query.awaitTermination()
    streamed = content(spark, sink)
    n_in = spark.read.parquet(f"{TESTDATA}/events.parquet").count()
    counted = Totals(query).update()
    assert (counted.records_in, counted.records_out) == (n_in, len(streamed))
    run_transfer(spark, {**props, "sink.producer": "backfill"}, staging.checked_transfer())
    assert content(spark, sink) == sorted([*streamed, *streamed])


def test_counters_hold_with_a_shuffle_before_the_sink(spark, job):
    source, _, props = job
    wide = TopicDef("wide", 16, "", staging.EVENT_OUT.fields)
    sink = create_topic(spark, source.root, staging.PROJECT, wide)
    transfer = Transfer(**{**vars(staging.checked_transfer()), "sink": wide})
    query = start_transfer(spark, {**props, "sink.topic": "wide"}, transfer, available_now=True)
    query.awaitTermination()
    assert "REBALANCE" in query._jsq.explainInternal(False)
    records_in = read_topic_batch(spark, source).count()
    counted = Totals(query).update()
    assert (counted.records_in, counted.records_out) == (records_in, read_topic_batch(spark, sink).count())


def test_without_batching_commits_follow_each_other(spark, job):
    """Triggers come as soon as the rate lets them, not with the commit interval of a batching sink."""
    source, sink, props = job
    expected = staging.checked_transfer().records(read_topic_batch(spark, source), sink).count()
    query = start_transfer(spark, {**props, "sink.batchEnable": "false"}, staging.checked_transfer())
    try:
        deadline = time.time() + 120
        while read_topic_batch(spark, sink).count() < expected and time.time() < deadline:
            time.sleep(0.5)
        assert query.isActive
        busy = [p for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert read_topic_batch(spark, sink).count() == expected
    assert busy


def test_a_transform_may_only_return_declared_columns(spark, job):
    _, _, props = job
    transfer = staging.checked_transfer()
    extra = Transfer(**{**vars(transfer), "transform": lambda df: transfer.transform(df).withColumn("more", F.lit(1))})
    with pytest.raises(ValueError, match="more"):
        start_transfer(spark, props, extra, available_now=True)


def test_rows_without_a_clock_fail_the_job(spark, job):
    _, sink, props = job
    transfer = staging.checked_transfer()

    def blank(df):
        return transfer.transform(df).withColumn("createTime", F.lit(None).cast("bigint"))

    clock = event_time_from_millis(F.col("createTime"))
    broken = Transfer(**{**vars(transfer), "transform": blank, "event_time": clock})
    with pytest.raises(StreamingQueryException, match="event time is null"):
        start_transfer(spark, props, broken, available_now=True).awaitTermination()
    assert read_topic_batch(spark, sink).count() == 0
    start_transfer(spark, props, transfer, available_now=True).awaitTermination()
    expected = transfer.records(read_topic_batch(spark, job[0]), sink)
    assert read_topic_batch(spark, sink).count() == expected.count() > 0


def test_own_decoding(spark, job):
    _, sink, props = job
    transfer = staging.checked_transfer()
    own = Transfer(
        **{
            **vars(transfer),
            "decode": lambda df: df.withColumn("createTime", F.col("create_time")).drop("create_time"),
        }
    )
    run_transfer(spark, props, own)
    expected = transfer.records(read_topic_batch(spark, job[0]), sink)
    assert read_topic_batch(spark, sink).count() == expected.count()


def test_the_lower_rate_counts(spark, job):
    """A sink that takes a tenth of the topic's records a second has them read in several triggers."""
    slots = spark.sparkContext.defaultParallelism
    query = start_transfer(
        spark,
        {**job[2], "sink.rate": str(100 // slots)},
        staging.checked_transfer(),
        interval_seconds=1,
        available_now=True,
    )
    counted = Totals(query).follow()
    assert counted.records_in == read_topic_batch(spark, job[0]).count()
    assert query.lastProgress["batchId"] >= 3


def test_missing_topic(spark, job):
    with pytest.raises(ValueError, match="does not exist"):
        start_transfer(spark, {**job[2], "sink.topic": "none"}, staging.checked_transfer())


def test_flagship_stays_one_narrow_pass(spark):
    from topicstream.plans import catalog

    plan = catalog.transfer_report(spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "value" not in plan.split("ReadSchema:")[1]


def test_a_table_that_changed_is_staged_again(spark, tmp_path):
    path = f"{tmp_path}/events.parquet"
    events = spark.read.parquet(f"{TESTDATA}/events.parquet").orderBy("event_id")
    events.limit(20).write.parquet(path)
    first = staging.staged_events(spark, str(tmp_path))
    assert staging.staged_events(spark, str(tmp_path)) is first
    events.limit(30).write.mode("overwrite").parquet(path)
    second = staging.staged_events(spark, str(tmp_path))
    assert (read_topic_batch(spark, first).count(), read_topic_batch(spark, second).count()) == (20, 30)


def test_a_job_can_keep_its_rate_to_the_record(spark, job):
    source, sink, props = job
    expected = staging.checked_transfer().records(read_topic_batch(spark, source), sink).count()
    running = start_transfer(
        spark, {**props, "source.rate": "400"}, staging.checked_transfer(), slots=1, interval_seconds=1, exact_rate=True
    )
    drain(running)
    read = [p["numInputRows"] for p in running.recentProgress if p["numInputRows"]]
    assert sum(read) == read_topic_batch(spark, source).count() and max(read) == 400
    assert read_topic_batch(spark, sink).count() == expected
