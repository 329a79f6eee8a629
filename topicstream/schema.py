"""Topic declarations: which fields a topic has, under which names and types.

A topic is declared once, either as a :class:`TopicDef` or as an annotated class::

    @topic(name="orders", shard_num=4, comment="order feed")
    class OrderMessage:
        name: Annotated[str, Field("name", STRING)]
        age: Annotated[Int32, Field("age", BIGINT)]
        created: Annotated[str, Field("create_time", STRING, "epoch ms as text")]

Nothing is ever inferred from data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import NewType, TypeVar, get_args, get_origin, get_type_hints, Annotated

from pyspark.sql import types as T

STRING = "STRING"
BIGINT = "BIGINT"
DOUBLE = "DOUBLE"
TIMESTAMP = "TIMESTAMP"

# Column name and comment of the producer's clock, retention of a new topic.
EVENT_TIME = "event_time"
EVENT_TIME_COMMENT = "事件时间"
DEFAULT_LIFECYCLE_DAYS = 3

# What a stored record carries besides the topic's own fields.
ATTRIBUTES = "attributes"
SYSTEM_TIME = "system_time"
SHARD_ID = "shard_id"
# Folder level above the shards: the UTC day of a record's arrival.
ARRIVAL_DATE = "arrival_date"

Int32 = NewType("Int32", int)
"""Marks a BIGINT field whose typed value is a 32-bit integer; plain ``int`` is 64-bit."""

_TOPIC_TYPES: dict[str, T.DataType] = {
    STRING: T.StringType(),
    BIGINT: T.LongType(),
    DOUBLE: T.DoubleType(),
    TIMESTAMP: T.TimestampType(),
}
# Python type of the declared class -> (type it needs on the topic, Spark type of the typed value)
_VALUE_TYPES: dict[object, tuple[str, T.DataType]] = {
    str: (STRING, T.StringType()),
    int: (BIGINT, T.LongType()),
    Int32: (BIGINT, T.IntegerType()),
    float: (DOUBLE, T.DoubleType()),
}
# The same for the event time; a whole number is epoch microseconds.
_EVENT_TIME_VALUES: dict[object, T.DataType] = {int: T.LongType(), dt.datetime: T.TimestampType()}

C = TypeVar("C", bound=type)


@dataclass(frozen=True)
class Field:
    """Declaration of one topic column, placed in ``Annotated[...]``."""

    alias: str
    type: str
    comment: str = ""


@dataclass(frozen=True)
class FieldDef:
    """One field: its column on the topic (``alias``) and its name in the typed row (``name``)."""

    alias: str
    type: str
    comment: str = ""
    name: str | None = None
    value_type: T.DataType | None = None

    def __post_init__(self) -> None:
        if not self.alias.strip():
            raise ValueError("a field needs a column name")
        if self.type not in _TOPIC_TYPES:
            raise TypeError(f"field {self.alias} is declared as {self.type}, which no column of a topic can be")
        if (self.alias == EVENT_TIME) != (self.type == TIMESTAMP):
            raise TypeError(
                f"{TIMESTAMP} is the type of {EVENT_TIME} and of no other column, "
                f"got {self.alias} {self.type}"
            )
        if self.name is None:
            object.__setattr__(self, "name", self.alias)
        if self.value_type is None:
            object.__setattr__(self, "value_type", _TOPIC_TYPES[self.type])

    @property
    def topic_type(self) -> T.DataType:
        return _TOPIC_TYPES[self.type]


@dataclass(frozen=True)
class TopicDef:
    """A topic's name, shard count, comment and fields, in declaration order."""

    name: str
    shard_num: int
    comment: str
    fields: tuple[FieldDef, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "fields", tuple(self.fields))
        if not self.name.strip():
            raise ValueError("a topic needs a name")
        if self.shard_num < 1:
            raise ValueError(f"topic {self.name} needs at least one shard, got {self.shard_num}")
        for kind, names in (
            ("column", [f.alias for f in self.fields]),
            ("field", [f.name for f in self.fields]),
        ):
            doubled = sorted({n for n in names if names.count(n) > 1})
            if doubled:
                raise ValueError(f"topic {self.name} declares {kind} {doubled} more than once")

    def to_struct(self, need_event_time: bool = False) -> T.StructType:
        """Schema of the topic itself: columns under their aliases, comments in the metadata."""
        struct = T.StructType(
            [
                T.StructField(f.alias, f.topic_type, True, {"comment": f.comment})
                for f in self.fields
            ]
        )
        if need_event_time and EVENT_TIME not in struct.fieldNames():
            struct.add(EVENT_TIME, T.TimestampType(), True, {"comment": EVENT_TIME_COMMENT})
        return struct

    def value_struct(self) -> T.StructType:
        """Schema of the typed rows a reader gets: field names and value types."""
        return T.StructType([T.StructField(f.name, f.value_type, True) for f in self.fields])


def topic(name: str, shard_num: int, comment: str) -> Callable[[C], C]:
    """Class decorator that declares a topic; read it back with :func:`topic_def`."""

    def declare(cls: C) -> C:
        cls.__topic__ = (name, shard_num, comment)
        return cls

    return declare


def topic_def(cls: type) -> TopicDef:
    """The :class:`TopicDef` of an annotated class. Raises where a declaration is missing or wrong."""
    if "__topic__" not in vars(cls):
        raise ValueError(f"{cls.__name__} has no topic declaration")
    name, shard_num, comment = vars(cls)["__topic__"]
    hints = get_type_hints(cls, include_extras=True)
    own = [prop for prop in vars(cls).get("__annotations__", None) or hints if prop in hints]
    return TopicDef(name, shard_num, comment, tuple(_field_def(p, hints[p]) for p in own))


def _field_def(prop: str, hint: object) -> FieldDef:
    declared = [m for m in get_args(hint)[1:] if isinstance(m, Field)] if _annotated(hint) else []
    if not declared:
        raise ValueError(f"field {prop} has no declaration")
    field, python_type = declared[0], get_args(hint)[0]
    if field.alias == EVENT_TIME and python_type in _EVENT_TIME_VALUES:
        return FieldDef(field.alias, field.type, field.comment, prop, _EVENT_TIME_VALUES[python_type])
    if python_type not in _VALUE_TYPES:
        raise TypeError(f"field {prop} has the class {python_type}, for which topics have no column type")
    expected, value_type = _VALUE_TYPES[python_type]
    if field.type != expected:
        raise TypeError(f"field {prop} needs a column of {expected} but declares {field.type}")
    return FieldDef(field.alias, field.type, field.comment, prop, value_type)


def _annotated(hint: object) -> bool:
    return get_origin(hint) is Annotated


def type_name(data_type: T.DataType) -> str:
    """Declared name of a topic column's Spark type."""
    for name, known in _TOPIC_TYPES.items():
        if known == data_type:
            return name
    raise TypeError(f"topics have no column type for {data_type.simpleString()}")
