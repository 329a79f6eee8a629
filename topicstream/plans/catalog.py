"""The registered queries, each over whole tables, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicstream import storage
from topicstream.functions.codec import (
    BIZ_KEY,
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
)
from topicstream.functions.hashing import java_string_hash
from topicstream.operators.batches import assign_batches
from topicstream.operators.mapping import map_rows
from topicstream.operators.metrics import delay_by_shard, records_by_shard
from topicstream.operators.retention import retained
from topicstream.operators.routing import key_hash_selector, route, shard_counts
from topicstream.plans import staging
from topicstream.plans.staging import BY_NAME, EVENT_IN, checked_transfer, event_rows, staged_events, table
from topicstream.schema import BIGINT, DOUBLE, EVENT_TIME, SHARD_ID, STRING, SYSTEM_TIME, FieldDef, TopicDef
from topicstream.sources.bounded import append_topic, read_topic_batch
from topicstream.sources.records import prepare_records
from topicstream.sources.topics import Topic, alter_topic, create_topic, describe_topic, list_shards, shards_frame
from topicstream.streaming.batches import number_batches
from topicstream.streaming.gauges import read_gauges, start_gauges
from topicstream.streaming.records import drain, read_topic_records
from topicstream.streaming.sink import write_topic
from topicstream.streaming.source import read_topic, records_per_trigger

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register


# --- SQL building blocks ---


def _sql_hash(key: str) -> str:
    """The key hash in DuckDB: code points, those past the basic plane as their two UTF-16 units."""
    wrapped = f"""list_reduce(
        list_prepend(0::BIGINT, list_transform(regexp_extract_all({key}, '(?s).'), lambda c: unicode(c)::BIGINT)),
        lambda h, c: CASE WHEN c < 65536 THEN (h * 31 + c) % 4294967296
            ELSE (((h * 31 + 55296 + ((c - 65536) >> 10)) % 4294967296) * 31
                  + 56320 + ((c - 65536) & 1023)) % 4294967296 END)"""
    return f"(({wrapped} + 2147483648) % 4294967296 - 2147483648)"


_NAME = "'u' || user_id || '-' || event_type"
# One row per event as the input topic holds it, with the placement by name over the sample's shards.
_EVENTS = f"""e AS (
    SELECT event_id AS seq, {_NAME} AS name, user_id AS age, value AS money, event_type,
           epoch_us(ts) // 1000 AS create_ms, epoch_us(ts) AS system_us, props AS payload,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(abs({_sql_hash(_NAME)} % {staging.SHARDS}) AS INTEGER) AS shard
    FROM events)"""
_TYPED_ROW = "seq, name, age, money, CAST(create_ms AS VARCHAR) AS create_time, payload, system_us"


def _shard() -> F.Column:
    return F.col(SHARD_ID).cast("int").alias("shard")


def _system_us() -> F.Column:
    return F.unix_micros(SYSTEM_TIME).alias("system_us")


def _typed_rows(records: DataFrame) -> DataFrame:
    typed = decode_record(records, EVENT_IN, keep=(SYSTEM_TIME,))
    return typed.select(
        "seq", "name", "age", "money", F.col("createTime").alias("create_time"), "payload", _system_us()
    )


def _drain(stream: DataFrame, path: str, checkpoint: str, most: int | None = None) -> None:
    """Write what a stream has now to a folder. No trigger may read more than ``most`` records."""
    running = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    while True:
        over = running.awaitTermination(0.05)
        for progress in running.recentProgress:
            if most is not None and progress["numInputRows"] > most:
                raise AssertionError(f"a trigger read {progress['numInputRows']} records, allowed are {most}")
        if over:
            return


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    scratch = storage.scratch_dir(spark, "drain")
    out = storage.join(scratch, "out")
    _drain(stream, out, storage.join(scratch, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


# --- sources ---


@query(f"WITH {_EVENTS} SELECT {_TYPED_ROW} FROM e")
def topic_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbounded scan over every producer of a topic, drained."""
    return _drained(spark, _typed_rows(read_topic(spark, staged_events(spark, sf_dir))))


@query(f"WITH {_EVENTS} SELECT {_TYPED_ROW} FROM e")
def topic_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded scan of the same topic."""
    return _typed_rows(read_topic_batch(spark, staged_events(spark, sf_dir)))


@query(f"WITH {_EVENTS} SELECT seq, money, CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS drain FROM e")
def subscription_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drains under one subscription, with the error events arriving in between."""
    source = staging.new_input_topic(spark)
    rows = event_rows(spark, sf_dir)
    late = F.col("event_type") == "error"
    out = storage.join(source.root, "drained")
    checkpoint = source.subscription_path("resumed")
    for drain, arriving in enumerate((rows.where(~late), rows.where(late)), start=1):
        append_topic(staging.input_records(arriving, source), source)
        read = read_topic(spark, source).select("seq", "money", F.lit(drain).alias("drain"))
        _drain(read, out, checkpoint)
    return spark.read.schema("seq bigint, money double, drain int").parquet(out)


@query(f"WITH {_EVENTS} SELECT shard, {_TYPED_ROW} FROM e WHERE shard IN (1, 3)")
def shard_subset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reader's part of a topic: two of its shards, by folder pruning."""
    records = read_topic_batch(spark, staged_events(spark, sf_dir), shards=["1", "3"])
    typed = decode_record(records, EVENT_IN, keep=(SYSTEM_TIME, SHARD_ID))
    return typed.select(
        _shard(), "seq", "name", "age", "money", F.col("createTime").alias("create_time"), "payload", _system_us()
    )


@query(f"WITH {_EVENTS} SELECT seq, name, money FROM e")
def rate_limited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of which no trigger reads more records than its share, about a quarter of the table: files are cut."""
    source = staged_events(spark, sf_dir)
    slots = spark.sparkContext.defaultParallelism
    rate = read_topic_batch(spark, source).count() // (4 * slots) + 1
    limit = records_per_trigger(spark, rate, 1)
    subscription = f"limited-{uuid.uuid4().hex}"
    columns = ["seq", "name", "money"]
    stream = read_topic_records(spark, source, subscription, rate=rate, interval_seconds=1, columns=columns)
    out = storage.join(storage.scratch_dir(spark, "drain"), "out")
    writer = stream.writeStream.format("parquet").option("path", out)
    running = writer.option("checkpointLocation", source.subscription_path(subscription)).start()
    drain(running)
    for progress in running.recentProgress:
        if progress["numInputRows"] > limit:
            raise AssertionError(f"a trigger read {progress['numInputRows']} records, allowed are {limit}")
    return spark.read.schema(stream.schema).parquet(out)


@query(f"WITH {_EVENTS} SELECT seq, name, money FROM e")
def rate_by_bytes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with whole files, admitted by their bytes."""
    rows = event_rows(spark, sf_dir)
    total = rows.count()
    slots = spark.sparkContext.defaultParallelism
    rate = total // (4 * slots) + 1
    limit = records_per_trigger(spark, rate, 1)
    source = staging.new_input_topic(spark, max_records_per_file=limit // 4 + 1)
    append_topic(staging.input_records(rows, source), source)
    scratch = storage.scratch_dir(spark, "drain")
    out = storage.join(scratch, "out")
    stream = read_topic(spark, source, rate=rate, interval_seconds=1).select("seq", "name", "money")
    _drain(stream, out, storage.join(scratch, "checkpoint"), limit + source.max_records_per_file)
    return spark.read.schema(stream.schema).parquet(out)


@query(f"WITH {_EVENTS} SELECT seq, system_us // 1000 AS system_ms FROM e")
def stream_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's clock: each record's arrival, under a watermark the caller sets."""
    stream = read_topic(spark, staged_events(spark, sf_dir)).withWatermark(SYSTEM_TIME, "1 hour")
    return _drained(spark, stream.select("seq", F.unix_millis(SYSTEM_TIME).alias("system_ms")))


# --- records to typed columns ---


@query(f"WITH {_EVENTS} SELECT seq AS id, name, CAST(k AS INTEGER) AS k, money, create_ms, "
       "CAST(NULL AS VARCHAR) AS note FROM e")
def decode_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records to declared types: an unknown column is dropped, a missing one is null."""
    declared = TopicDef(
        "typed", 1, "",
        (
            FieldDef("seq", BIGINT, name="id"),
            FieldDef("name", STRING),
            FieldDef("k", BIGINT, value_type=T.IntegerType()),
            FieldDef("money", DOUBLE),
            FieldDef("create_time", BIGINT, name="create_ms"),
            FieldDef("note", STRING),
        ),
    )
    text = event_rows(spark, sf_dir).select(
        F.col("seq").cast("string"),
        "name",
        F.get_json_object("payload", "$.k").alias("k"),
        F.col("money").cast("string"),
        F.col("createTime").alias("create_time"),
        F.col("event_type").alias("unknown"),
    )
    return decode_record(text, declared)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS absent, "
       "CAST(json_extract(props, '$.k') AS BIGINT) AS k_of_map FROM events", name="decode_json")
def decode_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to a struct, and to a map as the generic form."""
    props = F.col("props")
    as_struct = decode_json(props, "k int, absent string")
    as_map = decode_json(F.encode(props, "UTF-8"), T.MapType(T.StringType(), T.LongType()))
    return table(spark, sf_dir, "events").select(
        "event_id",
        as_struct["k"].alias("k"),
        as_struct["absent"].alias("absent"),
        F.try_element_at(as_map, F.lit("k")).alias("k_of_map"),
    )


@query(f"WITH {_EVENTS} SELECT seq, name, age, money, CAST(NULL AS VARCHAR) AS absent FROM e", name="decode_map")
def decode_map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of text values to typed columns."""
    named = [F.lit(n) for n in ("seq", "name", "age", "money", "other")]
    columns = [F.col(c).cast("string") for c in ("seq", "name", "age", "money", "event_type")]
    values = F.create_map(*(x for pair in zip(named, columns) for x in pair))
    schema = T.StructType.fromDDL("seq bigint, name string, age bigint, money double, absent string")
    return event_rows(spark, sf_dir).select(decode_map(values, schema).alias("row")).select("row.*")


@query(f"WITH {_EVENTS} SELECT seq, name AS biz_key, CAST(NULL AS VARCHAR) AS absent FROM e")
def read_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record attributes, read from a topic."""
    records = read_topic_batch(spark, staged_events(spark, sf_dir))
    return records.select("seq", attribute(BIZ_KEY).alias("biz_key"), attribute("absent").alias("absent"))


@query(f"""WITH {_EVENTS} SELECT seq, name, CASE WHEN event_type = 'error' THEN k END AS k FROM e""")
def decode_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two versions of a topic, read as one: error events were written after it got a column."""
    fields = (FieldDef("seq", BIGINT), FieldDef("name", STRING))
    first = TopicDef("versions", 4, "events", fields)
    second = TopicDef("versions", 4, "events", (*fields, FieldDef("k", BIGINT, "since the second version")))
    created = create_topic(spark, storage.scratch_dir(spark, "topics"), staging.PROJECT, first)
    rows = event_rows(spark, sf_dir)
    late = F.col("event_type") == "error"
    append_topic(prepare_records(rows.where(~late).select("seq", "name"), created, BY_NAME), created)
    altered = alter_topic(spark, created, second)
    k = decode_json(F.col("payload"), "k bigint")["k"].alias("k")
    append_topic(prepare_records(rows.where(late).select("seq", "name", k), altered, BY_NAME), altered)
    return _drained(spark, decode_record(read_topic(spark, altered), second))


# --- user map and the whole job ---


@query(f"WITH {_EVENTS} SELECT seq, name, age, money, create_ms AS create_time, k FROM e "
       "WHERE event_type <> 'error'", name="map_rows")
def map_rows_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample row map, with expressions."""
    mapped = map_rows(event_rows(spark, sf_dir).drop("event_type"), staging.checked_rows)
    return mapped.withColumnRenamed("createTime", "create_time").drop(SYSTEM_TIME)


@query(f"WITH {_EVENTS} SELECT seq, upper(name) AS name, money * 2 AS money, create_ms + 1 AS create_time FROM e")
def map_rows_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row map in Python, over Arrow batches."""

    def change(batch):
        return batch.assign(
            name=batch["name"].str.upper(),
            money=batch["money"] * 2,
            create_time=batch["create_time"].astype("int64") + 1,
        )

    rows = event_rows(spark, sf_dir).select("seq", "name", "money", F.col("createTime").alias("create_time"))
    return map_rows(rows, change, "seq bigint, name string, money double, create_time bigint")


@query(f"WITH {_EVENTS} SELECT seq, money * 3 AS money FROM e")
def map_rows_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row map with something that each task opens once."""
    rows = event_rows(spark, sf_dir).select("seq", "money")
    triple = lambda rates, batch: batch.assign(money=batch["money"] * rates["money"])
    return map_rows(rows, triple, "seq bigint, money double", open=lambda: {"money": 3}, close=dict.clear)


_REPORT_SQL = f"""WITH {_EVENTS}
    SELECT shard, count(*) AS n, max(create_ms) * 1000 AS max_event_us, CAST(sum(k) AS BIGINT) AS sum_k
    FROM e WHERE event_type <> 'error' GROUP BY shard"""


def _report(records: DataFrame) -> DataFrame:
    return records.groupBy(_shard()).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.unix_micros(EVENT_TIME)).alias("max_event_us"),
        F.sum("k").alias("sum_k"),
    )


@query(_REPORT_SQL)
def transfer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample job in bounded form, source rows to sink records, reported per shard."""
    source = Topic.of("", staging.PROJECT, EVENT_IN)
    sink = Topic.of("", staging.PROJECT, staging.EVENT_OUT)
    return _report(checked_transfer().records(staging.input_records(event_rows(spark, sf_dir), source), sink))


@query(_REPORT_SQL)
def transfer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample job as a stream from topic to topic, reported from the topic it wrote."""
    sink, _ = staging.transfer_events(spark, sf_dir)
    return _report(read_topic_batch(spark, sink))


# --- typed columns to records ---


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total_price, "
       "o_orderpriority AS priority FROM orders", name="encode_alias")
def encode_alias_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows under the column names of their topic."""
    declared = TopicDef(
        "orders", 8, "orders",
        (
            FieldDef("order_id", BIGINT, name="o_orderkey"),
            FieldDef("status", STRING, name="o_orderstatus"),
            FieldDef("total_price", DOUBLE, name="o_totalprice"),
            FieldDef("priority", STRING, name="o_orderpriority"),
        ),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return encode_alias(orders, declared)


@query(f"WITH {_EVENTS} SELECT seq, name, age, money, CAST(NULL AS VARCHAR) AS create_time, payload, "
       "create_ms * 1000 AS event_us, name AS biz_key FROM e", name="encode_record")
def encode_record_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to topic records: topic order and types, a value that is not there, event time, attributes."""
    rows = event_rows(spark, sf_dir)
    records = encode_record(
        rows.select("payload", "money", F.col("age").cast("int").alias("age"), "name", "seq", "createTime"),
        EVENT_IN.to_struct(True),
        event_time=event_time_from_millis(F.col("createTime").cast("bigint")),
        attributes=biz_key_attributes(F.col("name")),
        carry=("createTime",),
    )
    return records.select(
        "seq", "name", "age", "money", "create_time", "payload",
        F.unix_micros(EVENT_TIME).alias("event_us"), attribute(BIZ_KEY).alias("biz_key"),
    )


@query("SELECT c_custkey, c_name AS biz_key FROM customer")
def biz_key_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business key as a record attribute."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", biz_key_attributes(F.col("c_name")))
    return customers.select("c_custkey", attribute(BIZ_KEY).alias(BIZ_KEY))


@query("SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) // 1000 * 1000 AS event_us FROM lineitem")
def event_time_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time in microseconds from a clock in milliseconds."""
    millis = F.unix_millis(staging.in_utc(F.col("l_shipdate")))
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", F.unix_micros(event_time_from_millis(millis)).alias("event_us")
    )


@query("""SELECT doc_id, json_object('doc_id', doc_id, 'text', text, 'lang', lang, 'absent', NULL)::VARCHAR AS json,
    CAST(octet_length(encode(json_object('doc_id', doc_id, 'text', text, 'lang', lang, 'absent', NULL)::VARCHAR))
         AS INTEGER) AS n_bytes
    FROM documents""", name="encode_json")
def encode_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as JSON text and bytes, null fields written."""
    value = F.struct("doc_id", "text", "lang", F.lit(None).cast("string").alias("absent"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", encode_json(value).alias("json"), F.octet_length(encode_json_bytes(value)).alias("n_bytes")
    )


# --- placement and sinks ---

_ORDER_KEY = "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"


@query(f"SELECT o_orderkey, CAST({_sql_hash(_ORDER_KEY)} AS INTEGER) AS hash, "
       f"CAST(abs({_sql_hash(_ORDER_KEY)} % 16) AS INTEGER) AS shard FROM orders")
def shard_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed by customer over 16 shards."""
    key = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("key"))
    hashed = orders.withColumn("hash", java_string_hash(F.col("key")))
    # The hash is computed once: the selector takes it from its column.
    by_hash = lambda shards: F.element_at(F.array(*map(F.lit, shards)), F.abs(F.col("hash") % len(shards)) + 1)
    return route(hashed, [str(s) for s in range(16)], by_hash).select("o_orderkey", "hash", _shard())


@query(f"SELECT doc_id, CAST({_sql_hash('text')} AS INTEGER) AS hash, "
       f"CAST(abs({_sql_hash('text')} % 7) AS INTEGER) AS shard FROM documents")
def shard_route_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents placed by their whole text, in four languages."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    routed = route(documents, [str(s) for s in range(7)], key_hash_selector("text"))
    return routed.select("doc_id", java_string_hash(F.col("text")).alias("hash"), _shard())


@query("SELECT event_id, 'shard-' || (user_id % 5) AS shard FROM events")
def custom_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own placement over named shards."""
    shards = [f"shard-{i}" for i in range(5)]

    def by_user(names: list[str]) -> F.Column:
        index = F.pmod(F.col("user_id"), F.lit(len(names))).cast("int")
        return F.element_at(F.array(*map(F.lit, names)), index + 1)

    routed = route(table(spark, sf_dir, "events"), shards, by_user)
    return routed.select("event_id", F.col(SHARD_ID).alias("shard"))


_LINE_KEY = "'Order#' || l_orderkey"


@query(
    f"SELECT CAST(abs({_sql_hash(_LINE_KEY)} % 64) AS INTEGER) AS shard, count(*) AS n FROM lineitem GROUP BY 1",
    name="shard_counts",
)
def shard_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per shard when order lines are placed by order."""
    key = F.concat(F.lit("Order#"), F.col("l_orderkey").cast("string"))
    lines = table(spark, sf_dir, "lineitem").select(key.alias("key"))
    return shard_counts(route(lines, [str(s) for s in range(64)], key_hash_selector("key"))).select(
        _shard(), "n"
    )


@query(f"WITH {_EVENTS} SELECT shard, seq, name, money, create_ms * 1000 AS event_us, system_us, name AS biz_key "
       "FROM e")
def topic_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream from one topic into another, read back from the second."""
    source = staged_events(spark, sf_dir)
    sink = staging.new_input_topic(spark)
    rows = decode_record(read_topic(spark, source), EVENT_IN, keep=(SYSTEM_TIME,))
    records = prepare_records(
        rows,
        sink,
        BY_NAME,
        definition=EVENT_IN,
        attributes=biz_key_attributes(F.col("name")),
        event_time=event_time_from_millis(F.col("createTime").cast("bigint")),
        system_time=F.col(SYSTEM_TIME),
        carry=(SYSTEM_TIME,),
    )
    checkpoint = storage.join(sink.root, "_checkpoint")
    write_topic(records, sink, checkpoint=checkpoint, available_now=True).awaitTermination()
    return read_topic_batch(spark, sink).select(
        _shard(), "seq", "name", "money", F.unix_micros(EVENT_TIME).alias("event_us"), _system_us(),
        attribute(BIZ_KEY).alias("biz_key"),
    )


@query(f"WITH {_EVENTS} SELECT shard, seq, name, age FROM e")
def topic_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded copy of a topic with its files evened out."""
    source = staged_events(spark, sf_dir)
    copy = staging.new_input_topic(spark)
    append_topic(read_topic_batch(spark, source), copy)
    return read_topic_batch(spark, copy).select(_shard(), "seq", "name", "age")


@query(f"SELECT CAST(abs({_sql_hash(_NAME)} % 32) AS INTEGER) AS shard, event_id AS seq, {_NAME} AS name FROM events")
def topic_many_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream placed anew over many more shards."""
    declared = TopicDef("wide", 32, "more shards", (FieldDef("seq", BIGINT), FieldDef("name", STRING)))
    sink = create_topic(spark, storage.scratch_dir(spark, "topics"), staging.PROJECT, declared)
    rows = read_topic(spark, staged_events(spark, sf_dir)).select("seq", "name")
    records = prepare_records(rows, sink, BY_NAME)
    checkpoint = storage.join(sink.root, "_checkpoint")
    write_topic(records, sink, checkpoint=checkpoint, available_now=True).awaitTermination()
    return read_topic_batch(spark, sink).select(_shard(), "seq", "name")


@query(f"""SELECT CAST(abs({_sql_hash("source")} % 4) AS INTEGER) AS shard, doc_id, lang,
    length(text) AS n_chars, md5(text) AS digest FROM documents""")
def topic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through a topic, placed by their source."""
    declared = TopicDef(
        "documents", 4, "documents",
        (FieldDef("doc_id", BIGINT), FieldDef("source", STRING), FieldDef("lang", STRING), FieldDef("text", STRING)),
    )
    created = create_topic(spark, storage.scratch_dir(spark, "topics"), staging.PROJECT, declared)
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    append_topic(prepare_records(documents, created, key_hash_selector("source")), created)
    n_chars = F.length("text").cast("bigint").alias("n_chars")
    return read_topic_batch(spark, created).select(_shard(), "doc_id", "lang", n_chars, F.md5("text").alias("digest"))


@query(f"""WITH {_EVENTS}, b AS (
        SELECT shard, seq, (row_number() OVER (PARTITION BY shard ORDER BY seq) - 1) // 128 AS batch_no FROM e)
    SELECT shard, batch_no, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
    FROM b GROUP BY shard, batch_no""")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sends of 128 records per shard in arrival order."""
    rows = event_rows(spark, sf_dir).select("seq", "name")
    routed = route(rows, [str(s) for s in range(staging.SHARDS)], BY_NAME).select("seq", SHARD_ID)
    return assign_batches(routed, 128, order_by="seq").groupBy(_shard(), "batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


@query("""SELECT o_custkey, o_orderkey,
        (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 2 AS batch_no
    FROM orders""")
def batch_chunks_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sends of two orders, with every customer a shard and the orders' own numbers as their arrival."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    sharded = orders.withColumn(SHARD_ID, F.col("o_custkey").cast("string"))
    return assign_batches(sharded, 2, order_by="o_orderkey").drop(SHARD_ID)


@query(f"""WITH {_EVENTS} SELECT shard, seq, (row_number() OVER (PARTITION BY shard ORDER BY seq) - 1) // 128 AS batch_no FROM e""")
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sends of a stream: events arrive in three parts, each numbered by a run of its own that goes on from the last."""
    source = staging.new_input_topic(spark)
    rows = event_rows(spark, sf_dir)
    cuts = rows.agg(F.percentile_approx("seq", [1 / 3, 2 / 3])).first()[0] or [0, 0]
    late = (F.col("seq") > cuts[0]).cast("int") + (F.col("seq") > cuts[1]).cast("int")
    out, checkpoint = storage.join(source.root, "numbered"), storage.join(source.root, "_numbering")
    for part in range(3):
        append_topic(staging.input_records(rows.where(late == part), source), source)
        _drain(number_batches(read_topic(spark, source).select("seq", SHARD_ID), 128), out, checkpoint)
    numbered = spark.read.schema(f"seq bigint, {SHARD_ID} string, batch_no bigint").parquet(out)
    return numbered.select(_shard(), "seq", "batch_no")


@query("""SELECT l_orderkey, l_linenumber,
        (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1) // 2 AS batch_no
    FROM lineitem""")
def batch_chunks_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sends with every row of the table: lines that repeat an order's number follow each other.

    Such lines are alike in what is sent, so a sequence that numbers them in any order makes the arrival order unique.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    arrival = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))
    sharded = lines.select("*", arrival.cast("bigint").alias("seq"), F.col("l_orderkey").cast("string").alias(SHARD_ID))
    return assign_batches(sharded, 2, order_by="seq").drop(SHARD_ID, "seq")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def decode_json_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text in which the number stands in quotes."""
    quoted = F.concat(F.lit('{"k": "'), F.get_json_object("props", "$.k"), F.lit('"}'))
    return table(spark, sf_dir, "events").select("event_id", decode_json(quoted, "k int")["k"].alias("k"))


# --- topic definition ---


@query("""SELECT * FROM (
        SELECT 0 AS position, 'seq' AS field, 'BIGINT' AS type, 'arrival order' AS comment,
            count(event_id) AS n_values FROM events
        UNION ALL SELECT 1, 'name', 'STRING', 'routing key', count(user_id) FROM events
        UNION ALL SELECT 2, 'age', 'BIGINT', '', count(user_id) FROM events
        UNION ALL SELECT 3, 'money', 'DOUBLE', '', count(value) FROM events
        UNION ALL SELECT 4, 'create_time', 'STRING', 'epoch ms as text', count(ts) FROM events
        UNION ALL SELECT 5, 'payload', 'STRING', 'JSON', count(props) FROM events
        UNION ALL SELECT 6, 'event_time', 'TIMESTAMP', '事件时间', count(ts) FROM events)""")
def topic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of a created topic, with the number of values its records hold for each."""
    source = staged_events(spark, sf_dir)
    names = source.schema.fieldNames()
    counts = read_topic_batch(spark, source).agg(*(F.count(F.col(n)).alias(n) for n in names))
    values = counts.unpivot([], names, "field", "n_values")
    fields = describe_topic(spark, source).join(values, "field")
    return fields.select("position", "field", "type", "comment", "n_values")


@query(f"""SELECT CAST(s.shard AS INTEGER) AS shard, coalesce(d.n, 0) AS n
    FROM (SELECT unnest(generate_series(0, 31)) AS shard) s
    LEFT JOIN (SELECT abs({_sql_hash('source')} % 32) AS shard, count(*) AS n FROM documents GROUP BY 1) d
    ON s.shard = d.shard""")
def topic_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shard of a topic of documents placed by source, with its records; unused shards too."""
    declared = TopicDef("documents", 32, "documents", (FieldDef("doc_id", BIGINT), FieldDef("source", STRING)))
    created = create_topic(spark, storage.scratch_dir(spark, "topics"), staging.PROJECT, declared)
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    counts = shard_counts(route(documents, list_shards(created), key_hash_selector("source")))
    return (
        shards_frame(spark, created)
        .join(counts, SHARD_ID, "left")
        .select(_shard(), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    )


@query(f"""WITH {_EVENTS} SELECT seq, system_us FROM e
    WHERE system_us >= epoch_us(TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 3 DAY)""")
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records within the topic's lifecycle of 3 days."""
    source = staged_events(spark, sf_dir)
    return retained(read_topic_batch(spark, source), source.lifecycle_days, AS_OF).select("seq", _system_us())


# --- metrics ---


@query(f"WITH {_EVENTS} SELECT shard, count(*) AS records_in FROM e GROUP BY shard")
def records_in_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records-in counter per shard of the source topic."""
    counted = records_by_shard(read_topic_batch(spark, staged_events(spark, sf_dir)), "records_in")
    return counted.select(_shard(), "records_in")


@query(f"WITH {_EVENTS} SELECT shard, count(*) AS records_out FROM e WHERE event_type <> 'error' GROUP BY shard")
def records_out_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records-out counter per shard of the topic the streaming job wrote."""
    sink, _ = staging.transfer_events(spark, sf_dir)
    return records_by_shard(read_topic_batch(spark, sink), "records_out").select(_shard(), "records_out")


@query(f"""WITH {_EVENTS} SELECT shard,
        epoch_ms(TIMESTAMP '2024-01-31 00:00:00') - max_by(system_us // 1000, seq) AS delay
    FROM e GROUP BY shard""", name="delay_by_shard")
def delay_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of each shard's last record at a given time."""
    records = read_topic_batch(spark, staged_events(spark, sf_dir))
    as_of = F.timestamp_millis(F.lit(int(AS_OF.timestamp() * 1000)))
    return delay_by_shard(records, as_of, "seq").select(_shard(), "delay")


@query(f"""WITH {_EVENTS} SELECT shard, count(*) AS records,
        epoch_ms(TIMESTAMP '2024-01-31 00:00:00') - max_by(system_us // 1000, seq) AS delay
    FROM e GROUP BY shard""")
def stream_metrics_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter and lag of each shard as a running query keeps them, over three runs of several triggers."""
    source = staging.new_input_topic(spark)
    rows = event_rows(spark, sf_dir)
    path, checkpoint = storage.join(source.root, "gauges"), storage.join(source.root, "_gauges")
    for kinds in (["click"], ["view", "purchase"], None):
        seen = F.col("event_type").isin("click", "view", "purchase")
        part = rows.where(F.col("event_type").isin(kinds) if kinds else ~seen)
        append_topic(staging.input_records(part, source), source)
        stream = read_topic(spark, source)
        start_gauges(stream, path, checkpoint=checkpoint, order_by="seq", available_now=True).awaitTermination()
    as_of = F.timestamp_millis(F.lit(int(AS_OF.timestamp() * 1000)))
    return read_gauges(spark, path, as_of).select(_shard(), "records", "delay")


@query(f"""WITH {_EVENTS} SELECT count(*) AS records_in, max(system_us // 1000) AS last_system_ms,
    count(*) FILTER (event_type <> 'error') AS records_out FROM e""")
def transfer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streaming job's own counters and gauge said while it ran."""
    _, counted = staging.transfer_events(spark, sf_dir)
    row = (counted.records_in, counted.last_system_millis, counted.records_out)
    return spark.createDataFrame([row], "records_in bigint, last_system_ms bigint, records_out bigint")
