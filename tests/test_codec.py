import datetime as dt
import json
from typing import Annotated

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicstream import (
    BIZ_KEY,
    Field,
    FieldDef,
    TopicDef,
    attribute,
    biz_key_attributes,
    decode_json,
    decode_map,
    decode_record,
    encode_alias,
    encode_json,
    encode_json_bytes,
    encode_record,
    event_time_from_millis,
    map_rows,
    topic,
    topic_def,
)

QUERY_FAILS = (PySparkException, Py4JJavaError)

MESSAGE = TopicDef(
    "tp_test",
    4,
    "test",
    (
        FieldDef("name", "STRING"),
        FieldDef("age", "BIGINT", value_type=T.IntegerType()),
        FieldDef("money", "DOUBLE"),
        FieldDef("create_time", "BIGINT", name="createTime"),
    ),
)


def test_decode_drops_unknown_and_fills_missing(spark):
    schema = "name string, age bigint, create_time bigint, zz string"
    records = spark.createDataFrame([("n", 7, 1704067207179, "x")], schema)
    typed = decode_record(records, MESSAGE)
    assert typed.dtypes == [("name", "string"), ("age", "int"), ("money", "double"), ("createTime", "bigint")]
    assert typed.first() == ("n", 7, None, 1704067207179)


def test_alias_binds_on_both_sides(spark):
    typed = spark.createDataFrame([("n", 7, 1.5, 12)], MESSAGE.value_struct())
    assert decode_record(encode_alias(typed, MESSAGE), MESSAGE).collect() == typed.collect()


@pytest.mark.parametrize("bad", [("n", 3000000000, "1"), ("n", 1, "12x")])
def test_decode_is_strict(spark, bad):
    records = spark.createDataFrame([bad], "name string, age bigint, create_time string")
    with pytest.raises(QUERY_FAILS):
        decode_record(records, MESSAGE).collect()


@pytest.mark.parametrize("bad", [("n", 3000000000, "1"), ("n", 1, "12x")])
def test_decode_is_strict_without_ansi_mode_too(spark, bad):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        schema = "name string, age bigint, create_time string"
        with pytest.raises(QUERY_FAILS):
            decode_record(spark.createDataFrame([bad], schema), MESSAGE).collect()
        good = decode_record(spark.createDataFrame([("n", 1, "12"), ("n", None, None)], schema), MESSAGE).collect()
        assert [tuple(r) for r in good] == [("n", 1, None, 12), ("n", None, None, None)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_all_null_row_decodes(spark):
    records = spark.createDataFrame([(None, None, None, None)], MESSAGE.to_struct())
    assert decode_record(records, MESSAGE).first() == (None, None, None, None)


def test_decode_json(spark):
    df = spark.createDataFrame([('{"a":1,"zz":2}',), (None,)], "j string")
    rows = df.select(decode_json(F.col("j"), "a int, b string").alias("v")).collect()
    assert rows[0].v == (1, None) and rows[1].v is None
    as_bytes = df.select(decode_json(F.encode("j", "UTF-8"), "map<string,int>").alias("v")).first()
    assert as_bytes.v == {"a": 1, "zz": 2}
    assert spark.range(1).select(decode_json(F.lit("[1,2]"), "array<int>")).first()[0] == [1, 2]


@pytest.mark.parametrize("bad", ["{bad", '{"a":', "", "  ", '{"a":"x"}', '{"a":3000000000}', '{"a":"1.5"}', '{"a":1.5}'])
def test_malformed_json_fails(spark, bad):
    with pytest.raises(QUERY_FAILS):
        spark.createDataFrame([(bad,)], "j string").select(decode_json(F.col("j"), "a int")).collect()


def test_json_scalars_may_be_quoted(spark):
    text = """{"i": "69", "n": "", "d": "1.5e3", "e": 2.25, "t": "true", "s": "", "x": 7, "l": ["1", 2, null],
        "m": {"k": {"v": "3"}}, "at": "2024-01-02 03:04:05"}"""
    schema = (
        "i int, n bigint, d double, e double, t boolean, s string, x string, l array<bigint>,"
        " m map<string,struct<v:int>>, at timestamp, o struct<v:int>"
    )
    found = spark.createDataFrame([(text,)], "j string").select(decode_json(F.col("j"), schema).alias("v")).select("v.*")
    assert found.schema["l"].dataType.elementType.simpleString() == "bigint"
    row = found.first()
    assert (row.i, row.n, row.d, row.e, row.t, row.s, row.x, row.l) == (69, None, 1500.0, 2.25, True, "", "7", [1, 2, None])
    assert row.m == {"k": (3,)} and row["at"].year == 2024 and row.o is None


def test_decode_map(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([({"a": "1", "zz": "2"},)], "m map<string,string>")
    assert df.select(decode_map(F.col("m"), schema).alias("v")).first().v == (1, None)
    empty = spark.createDataFrame([({"a": "", "b": ""},)], "m map<string,string>")
    assert empty.select(decode_map(F.col("m"), schema).alias("v")).first().v == (None, "")
    bad = spark.createDataFrame([({"a": "x"},)], "m map<string,string>")
    with pytest.raises(QUERY_FAILS):
        bad.select(decode_map(F.col("m"), schema)).collect()


def test_encode_alias_rejects_other_columns(spark):
    typed = spark.createDataFrame([("n", 7, 1.5, 12)], MESSAGE.value_struct())
    assert encode_alias(typed, MESSAGE).columns == ["name", "age", "money", "create_time"]
    with pytest.raises(ValueError, match="without a declaration"):
        encode_alias(typed.withColumn("extra", F.lit(1)), MESSAGE)
    with pytest.raises(ValueError, match="without a column"):
        encode_alias(typed.drop("age"), MESSAGE)


def test_encode_record(spark):
    schema = MESSAGE.to_struct(need_event_time=True)
    df = spark.createDataFrame([(12, "n", 1704067207179)], "age int, name string, millis bigint")
    records = encode_record(
        df,
        schema,
        event_time=event_time_from_millis(F.col("millis")),
        attributes=biz_key_attributes(F.col("name")),
        carry=["millis"],
    )
    assert records.columns == [*schema.fieldNames(), "attributes"]
    row = records.select("*", F.unix_micros("event_time").alias("us"), attribute(BIZ_KEY).alias("key")).first()
    assert (row.name, row.age, row.money, row.create_time) == ("n", 12, None, None)
    assert (row.us, row.key) == (1704067207179000, "n")
    with pytest.raises(ValueError, match="millis"):
        encode_record(df, schema)


@pytest.mark.parametrize("python_type", [int, dt.datetime])
def test_declared_event_time_in_micros_or_as_timestamp(spark, python_type):
    @topic(name="t", shard_num=1, comment="")
    class Clocked:
        at: int

    Clocked.__annotations__["at"] = Annotated[python_type, Field("event_time", "TIMESTAMP")]
    declared = topic_def(Clocked)
    value = {int: 1704067207179575, dt.datetime: dt.datetime(2024, 1, 1, 0, 0, 7, 179575)}[python_type]
    typed = spark.createDataFrame([(value,), (None,)], declared.value_struct())
    records = encode_record(encode_alias(typed, declared), declared.to_struct())
    assert [r.us for r in records.select(F.unix_micros("event_time").alias("us")).collect()] == [1704067207179575, None]
    assert decode_record(records, declared).collect() == typed.collect()


def test_event_time_hook_in_micros(spark):
    df = spark.createDataFrame([("n", 1704067207179)], "name string, create_time bigint")
    records = encode_record(df, MESSAGE.to_struct(True), event_time=F.col("create_time") * 1000)
    assert records.select(F.unix_micros("event_time")).first()[0] == 1704067207179000


def test_record_without_hooks_has_no_attributes_and_no_event_time(spark):
    row = encode_record(spark.createDataFrame([("n",)], "name string"), MESSAGE.to_struct(True)).first()
    assert row.attributes is None and row.event_time is None


@pytest.mark.parametrize("millis", [None, 1 << 62])
def test_bad_event_time_fails(spark, millis):
    df = spark.createDataFrame([(millis,)], "millis bigint")
    with pytest.raises(QUERY_FAILS):
        df.select(event_time_from_millis(F.col("millis"))).collect()


def test_encode_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, "é\n\"")], "a int, b string, c string")
    row = df.select(encode_json(F.struct("a", "b")).alias("j"), encode_json_bytes(F.struct("c")).alias("b")).first()
    assert row.j == '{"a":1,"b":null}'
    assert json.loads(bytes(row.b).decode()) == {"c": "é\n\""}


def test_map_rows_in_python_must_be_one_to_one(spark):
    df = spark.range(10)
    mapped = map_rows(df, lambda pdf: pdf.assign(id=pdf["id"] + 1), "id bigint")
    assert sorted(r.id for r in mapped.collect()) == list(range(1, 11))
    with pytest.raises(QUERY_FAILS, match="row map returned"):
        map_rows(df, lambda pdf: pdf.head(0), "id bigint").collect()


def test_json_that_fits_and_json_that_does_not_give_the_same_values(spark):
    """Values of the wanted type and quoted ones in one column, also where the schema uses the helper's own name."""
    rows = ['{"k": 5, "_misfit": "a"}', '{"k": "6", "_misfit": "b"}', '{"k": ""}', '{"_misfit": null, "x": [1]}', "{}", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string").orderBy("i")
    found = df.select(decode_json(F.col("v"), "k int, _misfit string").alias("d")).select("d", "d.*").collect()
    assert [(r.d is None, r.k, r["_misfit"]) for r in found] == [
        (False, 5, "a"), (False, 6, "b"), (False, None, None), (False, None, None), (False, None, None), (True, None, None),
    ]
    nested = decode_json(F.lit('{"a": [{"b": 1}, {"b": "2"}], "c": {"d": 3}}'), "a array<struct<b: int>>, c struct<d: bigint>")
    assert spark.range(1).select(nested.alias("n")).first().n.asDict(True) == {"a": [{"b": 1}, {"b": 2}], "c": {"d": 3}}
