import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicstream import (
    FieldDef,
    TopicDef,
    add_producer,
    append_topic,
    create_topic,
    describe_topic,
    drop_expired,
    key_hash_selector,
    list_shards,
    open_topic,
    prepare_records,
    read_topic_batch,
    retained,
    shards_frame,
    storage,
)
from topicstream.schema import EVENT_TIME_COMMENT

MESSAGE = TopicDef(
    "tp_test", 4, "a topic", (FieldDef("name", "STRING", "who"), FieldDef("age", "BIGINT"), FieldDef("money", "DOUBLE"))
)


def rows(spark, n, start=0):
    return spark.range(start, start + n).selectExpr("concat('k', id) as name", "id as age", "0.5D as money")


def test_create_open_describe(spark, root):
    created = create_topic(spark, root, "p", MESSAGE, producers=("a", "b"), max_records_per_file=77)
    assert open_topic(spark, root, "p", "tp_test") == created
    assert created.lifecycle_days == 3
    assert [tuple(r) for r in describe_topic(spark, created).orderBy("position").collect()] == [
        (0, "name", "STRING", "who"),
        (1, "age", "BIGINT", ""),
        (2, "money", "DOUBLE", ""),
        (3, "event_time", "TIMESTAMP", EVENT_TIME_COMMENT),
    ]
    assert list_shards(created) == ["0", "1", "2", "3"]
    assert sorted(r.shard_id for r in shards_frame(spark, created).collect()) == list_shards(created)


def test_topic_names_are_taken_once(spark, root):
    create_topic(spark, root, "p", MESSAGE)
    create_topic(spark, root, "q", MESSAGE)
    with pytest.raises(ValueError, match="exists already"):
        create_topic(spark, root, "p", MESSAGE)
    with pytest.raises(ValueError, match="does not exist"):
        open_topic(spark, root, "p", "other")


@pytest.mark.parametrize("producers", [(), ("a", "a"), ("_a",), ("a/b",), ("a=b",), (" ",)])
def test_bad_producers(spark, root, producers):
    with pytest.raises(ValueError, match="producer"):
        create_topic(spark, root, "p", MESSAGE, producers=producers)


@pytest.mark.parametrize("name", ["_subscriptions", "a/b", " ", ".x"])
def test_bad_names(spark, root, name):
    with pytest.raises(ValueError, match="name"):
        create_topic(spark, root, name, MESSAGE)
    with pytest.raises(ValueError, match="name"):
        create_topic(spark, root, "p", TopicDef(name, 1, "", MESSAGE.fields))


@pytest.mark.parametrize("name", ["", " ", "a/b"])
def test_bad_subscription_names(spark, root, name):
    with pytest.raises(ValueError, match="subscription"):
        create_topic(spark, root, "p", MESSAGE).subscription_path(name)


def test_reserved_columns(spark, root):
    with pytest.raises(ValueError, match="reserved"):
        create_topic(spark, root, "p", TopicDef("t", 1, "", (FieldDef("shard_id", "STRING"),)))


def test_sink_needs_event_time(spark, root):
    created = create_topic(spark, root, "p", MESSAGE, need_event_time=False)
    with pytest.raises(ValueError, match="no event_time"):
        prepare_records(rows(spark, 1), created, key_hash_selector("name"))


def test_append_and_read_back(spark, root):
    created = create_topic(spark, root, "p", MESSAGE, producers=("a", "b"), max_records_per_file=40)
    for producer, start in (("a", 0), ("b", 500), ("a", 1000)):
        records = prepare_records(rows(spark, 500, start), created, key_hash_selector("name"))
        append_topic(records, created, producer=producer, max_records_per_file=None if start else 25)
    read = read_topic_batch(spark, created)
    assert read.columns == created.record_schema.fieldNames()
    assert sorted(r.age for r in read.collect()) == list(range(1500))
    per_file = read.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 40
    first = read.where("age < 500").groupBy(F.input_file_name()).count()
    assert first.agg(F.max("count")).first()[0] <= 25
    with pytest.raises(ValueError, match="positive"):
        append_topic(records, created, producer="a", max_records_per_file=0)
    subset = read_topic_batch(spark, created, shards=["0", "2"])
    assert {r.shard_id for r in subset.collect()} == {"0", "2"}
    assert "PartitionFilters: [shard_id" in subset._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no shards"):
        read_topic_batch(spark, created, shards=["9"])


def test_compacting_keeps_all_rows_of_a_hot_shard(spark, root):
    created = create_topic(spark, root, "p", MESSAGE)
    hot = rows(spark, 6000).withColumn("name", F.when(F.col("age") % 3 == 0, F.lit("hot")).otherwise(F.col("name")))
    append_topic(prepare_records(hot.repartition(8), created, key_hash_selector("name")), created)
    read = read_topic_batch(spark, created)
    assert sorted(r.age for r in read.collect()) == list(range(6000))


@pytest.mark.parametrize("shards", [4, 8, 9, 64])
def test_topics_are_compacted_unless_told_otherwise(spark, root, shards):
    many = TopicDef("many", shards, "", MESSAGE.fields)
    spread = rows(spark, 4000).repartition(8)

    def files(project, **settings):
        created = create_topic(spark, root, project, many)
        append_topic(prepare_records(spread, created, key_hash_selector("name")), created, **settings)
        read = read_topic_batch(spark, created)
        assert read.count() == 4000
        return read.select(F.input_file_name()).distinct().count()

    assert files("default") <= shards
    assert files("off", compact=False) > 6 * shards
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files("plain", compact=False) > 6 * shards
        with pytest.raises(ValueError, match="adaptive"):
            files("refused")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_days_are_pruned_and_dropped(spark, root):
    created = create_topic(spark, root, "p", MESSAGE, lifecycle_days=3, producers=("a", "streamed"))
    now = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)
    aged = rows(spark, 300).withColumn("at", F.lit(now) - F.make_dt_interval(hours=F.col("age").cast("int")))
    for producer in created.producers:
        written = prepare_records(aged, created, key_hash_selector("name"), system_time=F.col("at"), carry=("at",))
        append_topic(written, created, producer=producer)
    storage.create_text(spark, created.claim_path("streamed"), "c")
    young = retained(read_topic_batch(spark, created), 3, now)
    assert sorted(r.age for r in young.collect()) == sorted([*range(73), *range(73)])
    plan = young._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(arrival_date" in plan
    dropped = drop_expired(spark, created, now)
    assert len(dropped) == 9 and all("/a/arrival_date=2024-01-" in d for d in dropped)
    assert min(d[-10:] for d in dropped) == "2024-01-19" and max(d[-10:] for d in dropped) == "2024-01-27"
    left = read_topic_batch(spark, created).groupBy("age").count().collect()
    assert {r.age for r in left if r["count"] == 2} >= set(range(73))
    assert drop_expired(spark, created, now) == []


def test_records_are_checked_before_anything_is_written(spark, root):
    created = create_topic(spark, root, "p", MESSAGE)
    good = prepare_records(rows(spark, 3), created, key_hash_selector("name"))
    for bad in (
        good.withColumn("more", F.lit(1)),
        good.drop("event_time"),
        good.withColumn("age", F.lit("text")),
        good.select("*", F.col("age").alias("AGE")),
    ):
        with pytest.raises(ValueError, match="not records of topic tp_test"):
            append_topic(bad, created)
    for shard in ("9", None):
        with pytest.raises(PySparkException, match="not a shard of topic tp_test"):
            append_topic(good.withColumn("shard_id", F.lit(shard).cast("string")), created)
    assert read_topic_batch(spark, created).count() == 0
    append_topic(good.select(*reversed(good.columns)), created)
    assert sorted(r.age for r in read_topic_batch(spark, created).collect()) == [0, 1, 2]


def test_producers_can_be_added(spark, root):
    created = create_topic(spark, root, "p", MESSAGE, producers=("a",))
    more = add_producer(spark, created, "b-2")
    assert more.producers == ("a", "b-2") and more == open_topic(spark, root, "p", "tp_test")
    assert add_producer(spark, created, "aa").producers == ("a", "b-2", "aa")
    with pytest.raises(ValueError, match="already"):
        add_producer(spark, created, "b-2")
    with pytest.raises(ValueError, match="producer"):
        add_producer(spark, created, "x/y")
    append_topic(prepare_records(rows(spark, 5), more, key_hash_selector("name")), more, producer="b-2")
    assert read_topic_batch(spark, open_topic(spark, root, "p", "tp_test")).count() == 5


def test_time_filters_reach_the_statistics(spark, root):
    """Timestamps are stored in the form that has them, unlike Spark's default."""
    import pyarrow.parquet as pq
    from pathlib import Path

    created = create_topic(spark, root, "p", MESSAGE)
    append_topic(prepare_records(rows(spark, 3), created, key_hash_selector("name")), created)
    part = next(Path(created.producer_path("main")).rglob("*.parquet"))
    schema = pq.ParquetFile(part).schema
    column = next(schema.column(i) for i in range(len(schema.names)) if schema.column(i).path == "system_time")
    assert column.physical_type == "INT64"
