"""Sharded, typed message topics as Spark DataFrames."""

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
    encode_payload,
    encode_record,
    event_time_from_millis,
)
from topicstream.functions.hashing import java_string_hash
from topicstream.operators.batches import assign_batches
from topicstream.operators.mapping import map_rows
from topicstream.operators.metrics import (
    Totals,
    delay_by_shard,
    records_by_shard,
    sink_metrics,
    source_metrics,
    with_sink_metrics,
    with_source_metrics,
)
from topicstream.operators.retention import retained
from topicstream.operators.routing import Selector, key_hash_selector, route, shard_counts, spread_selector
from topicstream.options import SinkOptions, SourceOptions, sink_options, source_options, with_prefix
from topicstream.plans.transfer import Transfer, run_transfer, start_transfer
from topicstream.schema import BIGINT, DOUBLE, STRING, TIMESTAMP, Field, FieldDef, Int32, TopicDef, topic, topic_def
from topicstream.sources.bounded import append_topic, drop_expired, read_topic_batch
from topicstream.sources.records import prepare_records
from topicstream.sources.topics import (
    Topic,
    add_producer,
    alter_topic,
    create_topic,
    describe_topic,
    list_shards,
    open_topic,
    shards_frame,
    topic_versions,
)
from topicstream.streaming.batches import number_batches
from topicstream.streaming.gauges import read_gauges, start_gauges
from topicstream.streaming.records import drain, read_topic_records
from topicstream.streaming.sink import write_topic
from topicstream.streaming.source import read_topic
from topicstream.streaming.vacuum import vacuum_topic
