"""Records to typed columns and back. All of it is Catalyst expressions; nothing runs row by row in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicstream.schema import ATTRIBUTES, EVENT_TIME, TIMESTAMP, FieldDef, TopicDef

# Fixed value: attribute that carries the business key.
BIZ_KEY = "biz_key"


# --- records to typed columns ---


def decode_record(df: DataFrame, definition: TopicDef, keep: Iterable[str] = ()) -> DataFrame:
    """Typed rows from topic records: each declared column, cast to its value type, under its field name.

    Columns that are not declared are dropped, declared ones the records lack come out null, and a value that
    does not fit its type fails the query. ``keep`` names record columns to carry along, such as ``system_time``.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    cast = strict_cast()

    def typed(field: FieldDef) -> Column:
        if field.alias not in present:
            return F.lit(None).cast(field.value_type)
        column = F.col(quoted(field.alias))
        if field.type == TIMESTAMP and field.value_type == T.LongType():
            return F.unix_micros(column)
        return column if present[field.alias] == field.value_type else cast(column, field.value_type)

    return df.select(*(typed(f).alias(f.name) for f in definition.fields), *(F.col(quoted(c)) for c in keep))


def decode_json(payload: Column, schema: T.DataType | str) -> Column:
    """Typed value from JSON text or UTF-8 bytes; ``schema`` may be a struct, an array or a map.

    Unknown keys are ignored, missing ones are null. A number or truth value may stand in quotes, and empty text for
    one is null. Malformed or blank text, and a value that does not fit its type, fail the query; a fraction does not fit
    a whole number.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    text = payload.cast("string")
    blank = F.raise_error(F.lit("blank text is not JSON")).cast("string")
    checked = F.when(F.trim(text) == "", blank).otherwise(text)
    strict = _from_text(F.from_json(checked, _as_text(schema), {"mode": "FAILFAST"}), schema, strict_cast())
    if not isinstance(schema, T.StructType) or not _plain(schema):
        return strict
    # Most values have the type that is asked for and are parsed as it; only where one has not is all of it read as text.
    misfit = "_misfit"
    while misfit in schema.fieldNames():
        misfit = f"_{misfit}"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": misfit}
    typed = F.from_json(checked, T.StructType([*schema.fields, T.StructField(misfit, T.StringType())]), options)
    fits = typed.isNotNull() & typed[misfit].isNull()
    return F.when(fits, F.struct(*(typed[f.name].alias(f.name) for f in schema.fields))).otherwise(strict)


def _plain(schema: T.DataType) -> bool:
    """True where the parser's own rules for a value that fits are those of its text."""
    if isinstance(schema, T.StructType):
        return all(_plain(f.dataType) for f in schema.fields)
    if isinstance(schema, T.ArrayType):
        return _plain(schema.elementType)
    return isinstance(schema, (T.StringType, T.IntegerType, T.LongType))


def _as_text(schema: T.DataType) -> T.DataType:
    """The same shape with text in place of all scalars."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_as_text(schema.elementType))
    if isinstance(schema, T.MapType):
        return T.MapType(T.StringType(), _as_text(schema.valueType))
    return T.StringType()


def _from_text(value: Column, schema: T.DataType, cast: Callable[[Column, T.DataType], Column]) -> Column:
    if isinstance(schema, T.StructType):
        fields = [_from_text(value[f.name], f.dataType, cast).alias(f.name) for f in schema.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(schema, T.ArrayType):
        return F.transform(value, lambda x: _from_text(x, schema.elementType, cast))
    if isinstance(schema, T.MapType):
        return F.transform_values(value, lambda _, x: _from_text(x, schema.valueType, cast))
    return _scalar(value, schema, cast)


def _scalar(text: Column, target: T.DataType, cast: Callable[[Column, T.DataType], Column]) -> Column:
    """A value from its text; empty text is null for all but text itself."""
    if isinstance(target, (T.StringType, T.BinaryType)):
        return cast(text, target)
    return cast(F.when(F.trim(text) != "", text), target)


def decode_map(values: Column, schema: T.StructType) -> Column:
    """Typed struct from a map of text values, by key.

    Missing keys are null, and so is empty text for a number or truth value; bad values fail the query.
    """
    cast = strict_cast()
    return F.struct(
        *(_scalar(F.try_element_at(values, F.lit(f.name)), f.dataType, cast).alias(f.name) for f in schema.fields)
    )


def attribute(name: str) -> Column:
    """One attribute of a record, null where the record does not carry it."""
    return F.try_element_at(F.col(ATTRIBUTES), F.lit(name))


# --- typed columns to records ---


def encode_alias(df: DataFrame, definition: TopicDef) -> DataFrame:
    """Typed rows under the topic's column names. A column without a declaration raises, as does a missing one."""
    alias = field_aliases(df.columns, definition)
    return df.select(*(F.col(quoted(name)).alias(alias[name]) for name in alias))


def field_aliases(columns: Iterable[str], definition: TopicDef) -> dict[str, str]:
    """Topic column of each typed column, in declaration order. The columns must be exactly the declared fields."""
    declared = {f.name: f.alias for f in definition.fields}
    present = set(columns)
    if present - set(declared):
        raise ValueError(f"columns without a declaration: {sorted(present - set(declared))}")
    if set(declared) - present:
        raise ValueError(f"declared fields without a column: {sorted(set(declared) - present)}")
    return declared


def encode_payload(
    df: DataFrame, columns: Mapping[str, Column], schema: T.StructType, event_time: Column | None = None
) -> list[Column]:
    """The payload columns of a topic record over ``df``, in topic order and of topic type.

    ``columns`` holds the values by topic column. A name the topic does not have raises; a topic column without a
    value is null. ``event_time`` sets the producer's clock, after the other values; as a whole number it is epoch
    microseconds.
    """
    values = dict(columns)
    if event_time is not None:
        values[EVENT_TIME] = event_time
    unknown = [name for name in values if name not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"not columns of the topic: {unknown}, it has {schema.fieldNames()}")
    if EVENT_TIME in values and isinstance(df.select(values[EVENT_TIME]).schema[0].dataType, T.IntegralType):
        values[EVENT_TIME] = F.timestamp_micros(values[EVENT_TIME].cast("bigint"))
    cast = strict_cast()
    return [
        cast(values.get(f.name, F.lit(None)), f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields
    ]


def encode_record(
    df: DataFrame,
    schema: T.StructType,
    *,
    event_time: Column | None = None,
    attributes: Column | None = None,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Topic records from columns named as on the topic: its payload columns plus ``attributes``.

    ``event_time`` and ``attributes`` are expressions over ``df``; columns in ``carry`` are there for them only.
    """
    names = [c for c in df.columns if c not in set(carry)]
    payload = encode_payload(df, {c: F.col(quoted(c)) for c in names}, schema, event_time)
    return df.select(*payload, attributes_or_none(attributes))


def attributes_or_none(attributes: Column | None) -> Column:
    value = F.lit(None) if attributes is None else attributes
    return value.cast("map<string,string>").alias(ATTRIBUTES)


def biz_key_attributes(key: Column) -> Column:
    """Record attributes that carry the business key."""
    return F.create_map(F.lit(BIZ_KEY), key.cast("string")).alias(ATTRIBUTES)


def event_time_from_millis(millis: Column) -> Column:
    """Event time from epoch milliseconds. A null or a value past the microsecond range fails the query."""
    checked = F.when(millis.isNull(), F.raise_error(F.lit("event time is null")).cast("bigint")).otherwise(millis)
    return F.timestamp_millis(checked.cast("bigint")).alias(EVENT_TIME)


def encode_json(value: Column) -> Column:
    """JSON text of a struct, map or array; null fields are written, not left out."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def encode_json_bytes(value: Column) -> Column:
    """UTF-8 bytes of :func:`encode_json`."""
    return F.encode(encode_json(value), "UTF-8")


def strict_cast() -> Callable[[Column, T.DataType], Column]:
    """A cast that fails the query on a value that does not fit, also in a session without ANSI mode."""
    if SparkSession.active().conf.get("spark.sql.ansi.enabled") == "true":
        return Column.cast

    def checked(value: Column, target: T.DataType) -> Column:
        tried = value.try_cast(target)
        misfit = F.raise_error(F.concat(F.lit(f"not a {target.simpleString()}: "), value.cast("string")))
        return F.when(value.isNotNull() & tried.isNull(), misfit.cast(target)).otherwise(tried)

    return checked


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
