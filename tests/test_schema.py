import datetime as dt
from typing import Annotated

import pytest
from pyspark.sql import types as T

from topicstream.schema import (
    BIGINT,
    DOUBLE,
    EVENT_TIME,
    EVENT_TIME_COMMENT,
    STRING,
    TIMESTAMP,
    Field,
    FieldDef,
    Int32,
    TopicDef,
    topic,
    topic_def,
)


@topic(name="tp_test", shard_num=4, comment="test topic")
class Message:
    name: Annotated[str, Field("name", STRING)]
    age: Annotated[Int32, Field("age", BIGINT, "years")]
    money: Annotated[float, Field("money", DOUBLE)]
    createTime: Annotated[str, Field("create_time", STRING)]


def test_declaration_keeps_order_aliases_and_comments():
    declared = topic_def(Message)
    assert (declared.name, declared.shard_num, declared.comment) == ("tp_test", 4, "test topic")
    struct = declared.to_struct(need_event_time=True)
    assert [(f.name, f.dataType) for f in struct] == [
        ("name", T.StringType()),
        ("age", T.LongType()),
        ("money", T.DoubleType()),
        ("create_time", T.StringType()),
        (EVENT_TIME, T.TimestampType()),
    ]
    assert struct["age"].metadata == {"comment": "years"}
    assert struct[EVENT_TIME].metadata == {"comment": EVENT_TIME_COMMENT}
    assert declared.to_struct().fieldNames() == ["name", "age", "money", "create_time"]


def test_typed_rows_use_field_names_and_class_types():
    struct = topic_def(Message).value_struct()
    assert struct.fieldNames() == ["name", "age", "money", "createTime"]
    assert struct["age"].dataType == T.IntegerType()


def test_declared_event_time_is_not_added_twice():
    @topic(name="t", shard_num=1, comment="")
    class Clocked:
        event_time: Annotated[dt.datetime, Field("event_time", TIMESTAMP, "mine")]
        micros: Annotated[int, Field("micros", BIGINT)]

    struct = topic_def(Clocked).to_struct(need_event_time=True)
    assert struct.fieldNames() == ["event_time", "micros"]
    assert struct["event_time"].metadata == {"comment": "mine"}


def test_inherited_fields_are_not_part_of_the_topic():
    @topic(name="child", shard_num=1, comment="")
    class Child(Message):
        extra: Annotated[str, Field("extra", STRING)]

    assert topic_def(Child).to_struct().fieldNames() == ["extra"]


def test_missing_topic_declaration():
    class Plain:
        name: Annotated[str, Field("name", STRING)]

    with pytest.raises(ValueError, match="no topic declaration"):
        topic_def(Plain)


def test_missing_field_declaration():
    @topic(name="t", shard_num=1, comment="")
    class Half:
        name: Annotated[str, Field("name", STRING)]
        other: str

    with pytest.raises(ValueError, match="other has no declaration"):
        topic_def(Half)


@pytest.mark.parametrize(
    ("python_type", "declared"),
    [(str, BIGINT), (int, STRING), (Int32, DOUBLE), (float, BIGINT), (bool, STRING), (bytes, STRING), (list, STRING)],
)
def test_type_disagreement(python_type, declared):
    @topic(name="t", shard_num=1, comment="")
    class Wrong:
        x: Annotated[python_type, Field("x", declared)]

    Wrong.__annotations__["x"] = Annotated[python_type, Field("x", declared)]
    with pytest.raises(TypeError):
        topic_def(Wrong)


@pytest.mark.parametrize(("alias", "declared"), [("event_time", BIGINT), ("event_time", STRING), ("other", TIMESTAMP)])
def test_timestamp_is_for_event_time_only(alias, declared):
    with pytest.raises(TypeError, match="is the type of event_time"):
        FieldDef(alias, declared)


def test_unsupported_topic_type():
    with pytest.raises(TypeError, match="no column of a topic can be"):
        FieldDef("flag", "BOOLEAN")


def test_bad_topics():
    with pytest.raises(ValueError, match="at least one shard"):
        TopicDef("t", 0, "", (FieldDef("a", STRING),))
    with pytest.raises(ValueError, match="more than once"):
        TopicDef("t", 1, "", (FieldDef("a", STRING), FieldDef("a", BIGINT, name="b")))
    with pytest.raises(ValueError, match="more than once"):
        TopicDef("t", 1, "", (FieldDef("a", STRING, name="x"), FieldDef("b", BIGINT, name="x")))
