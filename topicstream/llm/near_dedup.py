"""Near duplicates by banded MinHash with odd sketches.

1. Every text becomes MinHash samples of its word shingles. Bands of samples are keys; the samples also fold into an odd
   sketch, a bitmap in which each sample flips one bit, so that the bits in which two sketches differ tell how many
   samples differ. Equal word sequences are one node from here on.
2. Nodes with a band in common are tied to the smallest of them: a star, not all pairs. Whatever is linked lies inside one
   component of these stars.
3. Components are compared inside Spark groups: pairs whose sketches allow the similarity are confirmed on their full
   sets of shingles, unless they are connected already. Large components are cut into blocks, and pairs of blocks are
   groups, so no task holds more than two blocks and none emits more links than it has rows.
4. The components of the confirmed links are the result.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.llm.blocks import connect
from topicstream.llm.common import SPACE, components, lower_ascii, text_or_empty, unused, written

WORDS = 5
PERCENT = 80
ROWS = 6
MISS = 1e-5
SKETCH_BITS = 512
BLOCK = 128
_REMEMBERED = 300_000
_CHUNK = 512


def near_dedup(
    docs: DataFrame,
    *,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    miss: float = MISS,
) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are runs of other than white space after A-Z became lower case; a text's set holds its distinct runs of
    ``words`` words, or the whole sequence as one if it has fewer. Texts are linked if their sets' intersection is at
    least ``percent`` hundredths of their union, and component_id is the smallest id that links reach. There are as many
    bands as leave a pair just at the threshold without a common one with probability ``miss``.

    Null and blank texts have no shingles and are linked with nothing, not with each other either. Null ids are never the
    smallest, unless a component has no other; rows that repeat an id have a result each, with ``kept`` set wherever the
    id is its component's. An empty table gives an empty result; other columns are ignored.
    """
    bands = math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** ROWS))
    text = F.trim(F.regexp_replace(lower_ascii(text_or_empty(text_col)), f"[{SPACE}]+", " "))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("words"))
    rows = rows.withColumn("node", F.unhex(F.md5(F.col("words").cast("binary"))))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, doc_id {kind}, node binary, n_shingles long, bands array<long>, sketch binary, words string"
    sketched = written(rows.mapInArrow(lambda b: _sketches(b, words, bands), schema), "sketches")

    nodes = written(
        sketched.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("row").alias("row"), F.min("doc_id").alias("least"), F.count("*").alias("copies")),
        "nodes",
    )
    apart = written(sketched.select("row", "bands").join(nodes.select("row"), "row"), "bands")
    keyed = apart.select("row", F.explode("bands").alias("key"))
    # Written, so that the join below is between plain exchanges and adaptive execution can split a hot band.
    firsts = written(
        keyed.groupBy("key").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first < last"), "firsts"
    )
    stars = keyed.join(firsts, "key").where("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b"))
    near = components(stars, "near-bands")

    limit = _most_differing(percent / 100, ROWS * bands)
    texts = sketched.select("row", "words", "sketch")
    links = connect(near, texts, lambda pdf: _links(pdf, words, percent, limit), BLOCK, "near")
    linked = components(links, "near-links").withColumnRenamed("node", "row")
    reached = written(nodes.select("row", "least").join(linked, "row"), "reached")
    least = written(reached.groupBy("root").agg(F.min("least").alias("component_id")), "near-least")
    by_row = reached.join(least, "root").select("row", "component_id")
    named = nodes.where("copies > 1").select("row").union(by_row.select("row")).distinct()
    found = written(
        nodes.join(named, "row")
        .join(by_row, "row", "left")
        .select("node", F.coalesce("component_id", "least").alias("component_id"), F.lit(True).alias("grouped")),
        "components",
    )
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    with_words = (
        sketched.where("n_shingles > 0")
        .select("doc_id", "n_shingles", "node")
        .join(found, "node", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
    )
    blank = sketched.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return with_words.union(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs``, all columns, with one row of each component: that with the smallest id (nulls last)."""
    row, key = unused("row", docs.columns), unused("key", docs.columns)
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    of = F.col(f"`{id_col}`")
    keyed = numbered.withColumn(key, F.struct(of.isNull().alias("missing"), of.alias("id"), F.col(row).alias("row")))
    found = near_dedup(keyed, id_col=key, text_col=text_col, **settings)
    dropped = written(found.where("not kept").select(F.col("doc_id.row").alias(row)), "near-dropped")
    return numbered.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _most_differing(similarity: float, samples: int) -> float:
    """Bits in which the odd sketches of texts of this similarity differ at most, with five standard deviations to spare."""
    low = similarity - 5 * math.sqrt(similarity * (1 - similarity) / samples)
    expected = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * samples * (1 - low)))
    return expected + 4 * math.sqrt(expected)


def _links(pdf: pd.DataFrame, words: int, percent: int, limit: float) -> pd.DataFrame:
    pdf = pdf.sort_values("row")
    rows, block, texts = pdf["row"].to_numpy(), pdf["k"].to_numpy(), pdf["words"].to_numpy()
    bits = np.unpackbits(np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1), axis=1).astype(np.float32)
    ones = bits.sum(axis=1)
    differing = ones[:, None] + ones[None, :] - 2 * bits @ bits.T
    possible = np.triu(differing <= limit, 1)
    if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
        possible &= block[:, None] != block[None, :]  # pairs inside a block belong to the block's own group
    left, right = np.nonzero(possible)
    order = np.argsort(differing[left, right], kind="stable")
    sets: dict[int, set] = {}
    known: dict[str, int] = {}
    parent = list(range(len(rows)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def shingles(x: int) -> set:
        if x not in sets:
            ids = [known.setdefault(w, len(known)) for w in texts[x].split(" ")]
            sets[x] = set(zip(*[ids[i:] for i in range(words)])) or {tuple(ids)}
        return sets[x]

    found = []
    for x, y in zip(left[order].tolist(), right[order].tolist()):
        if top(x) == top(y):
            continue
        a, b = shingles(x), shingles(y)
        if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
            continue
        both = len(a & b)
        if 100 * both >= percent * (len(a) + len(b) - both):
            parent[top(y)] = top(x)
            found.append((rows[x], rows[y]))
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = found = xxh64_intdigest(word)
        return found


@cache
def _hashes() -> _Hashes:
    return _Hashes()


def _sketches(batches, words: int, bands: int):
    rng = np.random.default_rng(42)
    samples = bands * ROWS
    factor = rng.integers(1, 1 << 32, (samples, 1), np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, (samples, 1), np.uint32)
    band = rng.integers(1, 1 << 63, (bands, 1), np.uint64) | np.uint64(1)
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        of, keys, sizes, sketches = [], [], [], []
        for text in batch.column(1):
            hashed = _shingle_hashes(text.as_py(), words)
            sizes.append(len(hashed))
            if len(hashed):
                least = _minima((hashed >> np.uint64(32)).astype(np.uint32), factor, shift)
                keys.append(_band_keys(least, band))
                sketches.append(_odd_sketch(least))
            else:
                keys.append(np.zeros(0, np.int64))
                sketches.append(b"")
        n = batch.num_rows
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(number, number + n, dtype=np.int64)),
                batch.column(0),
                batch.column(2),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                pa.array(sketches, pa.binary()),
                batch.column(1),
            ],
            ["row", "doc_id", "node", "n_shingles", "bands", "sketch", "words"],
        )
        number += n


def _shingle_hashes(text: str, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles."""
    if not text:
        return np.zeros(0, np.uint64)
    found = text.split(" ")
    hashed = np.fromiter(map(_hashes().__getitem__, found), np.uint64, len(found))
    n = max(1, len(found) - words + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(min(words, len(found))):
        mixed = (mixed ^ hashed[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * np.uint64(0xC2B2AE3D27D4EB4F))


def _minima(values: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    least = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), _CHUNK):
        np.minimum(least, (values[None, at : at + _CHUNK] * factor + shift).min(axis=1), out=least)
    return least


def _band_keys(least: np.ndarray, band: np.ndarray) -> np.ndarray:
    mixed = band[:, 0].copy()
    for part in least.reshape(len(band), ROWS).T.astype(np.uint64):
        mixed = (mixed ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def _odd_sketch(least: np.ndarray) -> bytes:
    mixed = (least.astype(np.uint64) << np.uint64(16)) + np.arange(len(least), dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    flips = np.bincount((mixed >> np.uint64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS)
    return np.packbits(flips & 1).tobytes()
