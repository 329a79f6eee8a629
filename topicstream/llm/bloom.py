"""Bloom filters of a bounded size, built on the executors and broadcast."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 3
BITS_PER_KEY = 16
MAX_BYTES = 32 << 20
_BLOCK = 1 << 13


def repeated_in(keys: DataFrame, max_bytes: int = MAX_BYTES):
    """A function of a long column that is true for every key that ``keys`` holds more than once, and for few others.

    A task keeps two filters: bits set by one key, and bits set by more than one. Pairs merge in any order, as a bit that
    two tasks have set is set twice. ``keys`` has one long column without nulls.
    """
    return _test(keys, "more", max_bytes)


def contained_in(keys: DataFrame, max_bytes: int = MAX_BYTES):
    """A function of a long column that is true for every key in ``keys``, and for few others."""
    return _test(keys, "once", max_bytes)


def tester(keys: DataFrame, max_bytes: int = MAX_BYTES):
    """What :func:`contained_in` tells of a column, for an array of keys inside a task."""
    (shared,), size = _shared_bits(keys, ("once",), max_bytes)
    return _array_test(shared, size)


def tester_and_repeated_in(keys: DataFrame, max_bytes: int = MAX_BYTES):
    """:func:`tester` and :func:`repeated_in` of the same keys, which are read once."""
    (once, more), size = _shared_bits(keys, ("once", "more"), max_bytes)
    return _array_test(once, size), _column_test(more, size)


def _test(keys: DataFrame, which: str, max_bytes: int):
    (shared,), size = _shared_bits(keys, (which,), max_bytes)
    return _column_test(shared, size)


def _array_test(shared, size: int):
    def passes(keys: np.ndarray) -> np.ndarray:
        places, bits = _places(keys, size), shared.value
        return ((bits[places >> 3] >> (places & 7)) & 1).all(axis=0).astype(bool)

    return passes


def _column_test(shared, size: int):
    @F.pandas_udf("boolean")
    def passes(keys: pd.Series) -> pd.Series:
        places, bits = _places(keys.to_numpy(np.int64), size), shared.value
        return pd.Series(((bits[places >> 3] >> (places & 7)) & 1).all(axis=0).astype(bool))

    return passes


def _shared_bits(keys: DataFrame, which: tuple[str, ...], max_bytes: int):
    """The bits of each filter asked for, broadcast, and how many bytes they are."""
    spark = keys.sparkSession
    n = max(1, keys.count())
    # A power of two bytes with 16 bits a key, up to the bound. Past the bound more keys pass than need to.
    size = min(1 << (max_bytes.bit_length() - 1), max(_BLOCK, 1 << (n * BITS_PER_KEY // 8 - 1).bit_length()))
    # Every task emits its filters, so there are few: as many as run at once, or one for each four million keys.
    tasks = max(n // 4_000_000, spark.sparkContext.defaultParallelism)
    blocks = keys.coalesce(tasks).mapInArrow(lambda b: _filters(b, size), "block int, once binary, more binary")
    schema = ", ".join(["block int", *(f"{name} binary" for name in which)])
    merged = blocks.groupBy("block").applyInPandas(lambda pdf: _merge(pdf, which), schema)
    bits = {name: np.zeros(size, np.uint8) for name in which}
    for row in merged.collect():  # as many bytes as the filters
        for name in which:
            bits[name][row.block * _BLOCK : (row.block + 1) * _BLOCK] = np.frombuffer(row[name], np.uint8)
    return [spark.sparkContext.broadcast(bits[name]) for name in which], size


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key: PROBES rows."""
    x = keys.view(np.uint64)
    found = []
    for _ in range(PROBES):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        found.append((x >> np.uint64(20)) % np.uint64(size * 8))
    return np.array(found, np.int64).reshape(PROBES, len(keys))


def _filters(batches, size: int):
    once, more = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
    for batch in batches:
        for probe in _places(batch.column(0).to_numpy(zero_copy_only=False), size):
            seen, times = np.unique(probe, return_counts=True)
            bit = (1 << (seen & 7)).astype(np.uint8)
            again = ((once[seen >> 3] & bit) != 0) | (times > 1)
            np.bitwise_or.at(more, seen[again] >> 3, bit[again])
            np.bitwise_or.at(once, seen >> 3, bit)
    for block in range(size // _BLOCK):
        part = slice(block * _BLOCK, (block + 1) * _BLOCK)
        if once[part].any():
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()), "once": [once[part].tobytes()], "more": [more[part].tobytes()]}
            )


def _merge(blocks: pd.DataFrame, which: tuple[str, ...]) -> pd.DataFrame:
    once, more = np.zeros(_BLOCK, np.uint8), np.zeros(_BLOCK, np.uint8)
    for a, b in zip(blocks["once"], blocks["more"]):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        more |= b | (once & a)
        once |= a
    bits = {"once": once, "more": more}
    return pd.DataFrame({"block": [blocks["block"].iloc[0]], **{name: [bits[name].tobytes()] for name in which}})
