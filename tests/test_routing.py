import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicstream import java_string_hash, key_hash_selector, route, shard_counts, spread_selector

QUERY_FAILS = (PySparkException, Py4JJavaError)
FOUR = ["0", "1", "2", "3"]


def expected_hash(text: str) -> int:
    units = memoryview(text.encode("utf-16-le")).cast("H")
    total = 0
    for unit in units:
        total = (total * 31 + unit) & 0xFFFFFFFF
    return total - (1 << 32) if total >= 1 << 31 else total


@pytest.mark.parametrize(
    ("key", "hashed", "shard"),
    [
        ("", 0, "0"),
        ("a", 97, "1"),
        ("polygenelubricants", -2147483648, "0"),
        ("héllo", 103094734, "2"),
        ("数据总线", 798870114, "2"),
        ("😀x", 54959989, "1"),
        ("Customer#000000001", 478928364, "0"),
    ],
)
def test_hash_and_shard(spark, key, hashed, shard):
    df = route(spark.createDataFrame([(key,)], "name string"), FOUR, key_hash_selector("name"))
    row = df.withColumn("hash", java_string_hash(F.col("name"))).first()
    assert (row.hash, row.shard_id) == (hashed, shard)
    assert expected_hash(key) == hashed


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=30))
def test_hash_of_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hashes = df.select(java_string_hash(F.col("t")).alias("h")).collect()
    assert [r.h for r in hashes] == list(map(expected_hash, texts))


def test_hash_of_long_text(spark):
    text = "línea 数据 😀\n" * 20000
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(java_string_hash(F.col("t"))).first()[0] == expected_hash(text)


def test_index_is_never_negative(spark):
    names = [f"key-{i}" for i in range(2000)]
    keys = spark.createDataFrame([(n,) for n in names], "name string")
    df = route(keys, [f"s{i}" for i in range(7)], key_hash_selector("name"))
    for row in df.collect():
        h = expected_hash(row.name)
        assert row.shard_id == f"s{abs(h) % 7 if h != -(1 << 31) else (1 << 31) % 7}"


def test_null_key_fails(spark):
    df = route(spark.createDataFrame([("a",), (None,)], "name string"), FOUR, key_hash_selector("name"))
    with pytest.raises(QUERY_FAILS, match="routing key is null"):
        df.collect()


def test_no_shards():
    with pytest.raises(ValueError, match="empty"):
        spread_selector("name")([])


def test_own_selector(spark):
    df = spark.range(6).select((F.col("id") % 3).cast("string").alias("s"))
    named = route(df, ["0", "1", "2"], lambda shards: F.col("s"))
    assert sorted(r.shard_id for r in named.collect()) == ["0", "0", "1", "1", "2", "2"]
    by_number = route(df, ["0", "1", "2"], lambda shards: F.col("s").cast("int"))
    assert sorted(r.shard_id for r in by_number.collect()) == ["0", "0", "1", "1", "2", "2"]


@pytest.mark.parametrize("given", [lambda shards: F.col("s"), lambda shards: F.lit(None)])
def test_own_selector_must_give_a_listed_shard(spark, given):
    df = spark.createDataFrame([("0",), ("9",)], "s string")
    with pytest.raises(QUERY_FAILS, match="no shard of the topic"):
        route(df, FOUR, given).collect()


def test_counts_of_a_hot_key(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as name", "id")
    by_key = {r.shard_id: r.n for r in shard_counts(route(df, FOUR, key_hash_selector("name"))).collect()}
    assert sum(by_key.values()) == 9000
    assert by_key[str(abs(expected_hash("hot")) % 4)] > 4000
    spread = {r.shard_id: r.n for r in shard_counts(route(df, FOUR, spread_selector("name", "id"))).collect()}
    assert sum(spread.values()) == 9000 and max(spread.values()) < 2500


def test_routing_moves_no_rows(spark):
    df = route(spark.range(10).select(F.col("id").cast("string").alias("name")), FOUR, key_hash_selector("name"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
