import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from topicstream import assign_batches, delay_by_shard, retained
from topicstream.operators.batches import _cuts, _range
from topicstream.operators.retention import utc_day

QUERY_FAILS = (PySparkException, Py4JJavaError)


def numbered(df, size, order_by="seq"):
    """The plain definition: one window over each whole shard."""
    place = F.row_number().over(Window.partitionBy("shard_id").orderBy(order_by))
    return df.withColumn("batch_no", F.floor((place - 1) / size))


def same(left, right):
    return sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))


def test_273_rows_in_batches_of_128(spark):
    df = spark.range(273).select(F.lit("0").alias("shard_id"), F.col("id").alias("seq"))
    sizes = {r.batch_no: r["count"] for r in assign_batches(df).groupBy("batch_no").count().collect()}
    assert sizes == {0: 128, 1: 128, 2: 17}


@pytest.mark.parametrize("ranges", [1, 3, 8, 64])
def test_batches_with_a_hot_shard(spark, ranges):
    shard = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.xxhash64("id") % 5).cast("string"))
    seq = (F.col("id") * 7919) % 20011
    df = spark.range(20000).repartition(7).select(shard.alias("shard_id"), seq.alias("seq"), "id")
    assert same(assign_batches(df, 100, ranges=ranges), numbered(df, 100))


def test_batches_of_numbers_a_double_cannot_tell_apart(spark):
    base = 1 << 60
    df = spark.range(3000).select(F.lit("0").alias("shard_id"), (F.lit(base) + F.col("id")).alias("seq"))
    assert same(assign_batches(df, 10, ranges=8), numbered(df, 10))


def test_sequences_that_start_over_in_each_shard(spark):
    df = spark.range(12000).selectExpr("cast(id % 3 as string) as shard_id", "id div 3 as seq")
    assert same(assign_batches(df, 128, ranges=8), numbered(df, 128))


def test_a_hot_shard_is_sorted_by_more_than_one_task(spark):
    df = spark.range(20000).select(F.lit("hot").alias("shard_id"), F.col("id").alias("seq"))
    located = df.withColumn("in", _range(df, "seq", _cuts(df, "seq", 16)))
    sizes = [r["count"] for r in located.groupBy("in").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20000 / 16


@pytest.mark.parametrize("shards", [500, 2000])
def test_short_sequences_in_many_shards(spark, shards):
    df = spark.range(shards * 5).selectExpr("cast(id div 5 as string) as shard_id", "id % 5 as seq")
    assert same(assign_batches(df, 2), numbered(df, 2))


def test_batches_leave_columns_alone_whatever_their_names(spark):
    names = ["range", "_range", "count", "before", "place", "_Place", "a.b"]
    df = spark.range(100).select(F.lit("0").alias("shard_id"), F.col("id").alias("my seq"), *[F.lit(i).alias(n) for i, n in enumerate(names)])
    found = assign_batches(df, 10, order_by="my seq")
    assert found.columns == [*df.columns, "batch_no"]
    assert {(r["my seq"] // 10, r["a.b"]) for r in found.collect()} == {(r.batch_no, 6) for r in found.collect()}
    with pytest.raises(ValueError, match="batch_no already"):
        assign_batches(found, 10, order_by="my seq")


@pytest.mark.parametrize("n", [10, 3000, 50000])
def test_batches_reject_ties_at_any_size(spark, n):
    tied = spark.range(n).selectExpr("'0' as shard_id", f"if(id = {n - 1}, {n - 2}, id) as seq")
    with pytest.raises(QUERY_FAILS, match="seq repeats in a shard"):
        assign_batches(tied).collect()


def test_batches_reject_what_gives_no_order(spark):
    same_value = spark.range(50000).selectExpr("'0' as shard_id", "if(id % 3 = 0, 5, id) as seq")
    with pytest.raises(QUERY_FAILS, match="seq repeats in a shard"):
        assign_batches(same_value, ranges=16).collect()
    nulls = spark.createDataFrame([("0", None), ("0", 1)], "shard_id string, seq bigint")
    with pytest.raises(QUERY_FAILS, match="seq is null"):
        assign_batches(nulls).collect()
    with pytest.raises(ValueError, match="positive"):
        assign_batches(same_value, 0)


def test_batches_of_nothing(spark):
    empty = spark.createDataFrame([], "shard_id string, seq bigint")
    assert assign_batches(empty).collect() == []


def test_batches_are_for_bounded_frames(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value as seq", "'0' as shard_id")
    with pytest.raises(ValueError, match="bounded"):
        assign_batches(stream)


def test_retention(spark):
    day = dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(i, day - dt.timedelta(days=i)) for i in range(6)], "i int, system_time timestamp")
    assert sorted(r.i for r in retained(df, 3, day).collect()) == [0, 1, 2, 3]
    assert sorted(r.i for r in retained(df, 3, day.replace(tzinfo=None)).collect()) == [0, 1, 2, 3]
    assert sorted(r.i for r in retained(df, 2, F.lit(day)).collect()) == [0, 1, 2]


def test_days_are_utc_in_any_zone(spark):
    df = spark.sql("select explode(array(timestamp_micros(-1), timestamp_micros(0), timestamp_micros(86399999999))) as t")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert [str(r.d) for r in df.select(utc_day(F.col("t")).alias("d")).collect()] == ["1969-12-31", "1970-01-01", "1970-01-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_delay_is_of_the_last_record(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("0", 1, at), ("0", 2, at - dt.timedelta(seconds=9)), ("1", 1, at - dt.timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "shard_id string, seq int, system_time timestamp")
    found = delay_by_shard(df, F.lit(at + dt.timedelta(seconds=1)), "seq").collect()
    assert {r.shard_id: r.delay for r in found} == {"0": 10000, "1": 2000}
