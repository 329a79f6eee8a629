"""Which shard a record goes to."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakSet

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.functions.hashing import java_string_hash
from topicstream.schema import SHARD_ID

Selector = Callable[[list[str]], Column]
"""Given the topic's shard ids, the column that picks one of them for a row."""

_own_selectors: WeakSet[Selector] = WeakSet()


def key_hash_selector(key: Column | str) -> Selector:
    """Default placement: ``shards[abs(hash(key) % n)]`` with the JVM's string hash. A null key fails the query.

    All rows of a key share a shard, so a hot key makes a hot shard; :func:`shard_counts` shows it. Writing does
    not suffer: shards are folders, and every task writes its own files into them.
    """

    def select(shards: list[str]) -> Column:
        value = F.col(key) if isinstance(key, str) else key
        null_key = F.raise_error(F.lit("routing key is null")).cast("string")
        checked = F.when(value.isNull(), null_key).otherwise(value.cast("string"))
        return _pick(shards, F.abs(java_string_hash(checked) % F.lit(len(shards))))

    _own_selectors.add(select)
    return select


def spread_selector(*columns: Column | str) -> Selector:
    """Even placement by a 64-bit hash, for callers who need no agreement with other writers.

    Given enough columns to tell rows apart, it spreads a hot key over all shards.
    """

    def select(shards: list[str]) -> Column:
        return _pick(shards, F.pmod(F.xxhash64(*columns), F.lit(len(shards))).cast("int"))

    _own_selectors.add(select)
    return select


def place(shards: list[str], selector: Selector) -> Column:
    """The shard of a row. A user's selector that gives null or no shard of the list fails the query."""
    shard = selector(shards).cast("string")
    if selector in _own_selectors:
        return shard
    listed = F.array(*(F.lit(s) for s in shards))
    found = F.get(listed, F.array_position(listed, shard).cast("int") - 1)
    return F.coalesce(found, F.raise_error(F.lit("the selector gave no shard of the topic")).cast("string"))


def route(df: DataFrame, shards: list[str], selector: Selector) -> DataFrame:
    """Add ``shard_id``. A narrow step: no row moves."""
    return df.withColumn(SHARD_ID, place(shards, selector))


def shard_counts(df: DataFrame) -> DataFrame:
    """Rows per shard, to spot skew. Counts are combined before the shuffle, which carries one row per shard."""
    return df.groupBy(SHARD_ID).agg(F.count(F.lit(1)).alias("n"))


def _pick(shards: list[str], index: Column) -> Column:
    if not shards:
        raise ValueError("the shard list is empty")
    return F.element_at(F.array(*(F.lit(s) for s in shards)), index + F.lit(1)).cast("string")
