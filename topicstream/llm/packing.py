"""Packing documents into sequences by exact-complement hashing, then best fit.

How many pieces have each length is all that the packing needs to know, and there are no more lengths than a sequence
has tokens. So Spark counts the lengths, a plan is made over the counts (:func:`plan`), and every piece finds its
place from its rank among the pieces of its length. The plan is as large for a thousand documents as for a billion.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topicstream.llm.common import text_or_empty, written
from topicstream.llm.tokens import encoder

CAPACITY = 2048
END = 0  # fixed value of the contract: the id after every document
_FLUSH = 8 << 20


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (doc_id, piece, start, length, ids, sequence_id, offset) for every piece of every document.

    A document is the ids of its whole text and a closing id 0, so an empty or null text is one piece of one id. Longer
    documents are cut into pieces of ``capacity`` ids of which the first may be shorter. ``ids`` holds little-endian
    unsigned 32-bit numbers. Sequences are numbered from 0 and filled from offset 0 without gaps. Repeated rows and
    rows without an id are documents of their own; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, ids binary, task int, nth long"
    pieces = written(rows.mapInArrow(lambda b: _pieces(b, tokenizer_path, capacity), schema), "pieces")
    return place(pieces, capacity).select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Needs ``length`` and the pair (``task``, ``nth``): the pieces of one length and task numbered from 0.
    """
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    sums = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most one row per length
    slots = plan({row.length: row.n for row in sums}, capacity)
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("length", "task", F.coalesce(before, F.lit(0)).cast("long").alias("before"))
    shared = pieces.sparkSession.sparkContext.broadcast(slots)

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = locate(shared.value, length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = pieces.join(written(starts, "piece-starts"), ["length", "task"])
    return ranked.withColumn("at", find("length", F.col("before") + F.col("nth"))).select("*", "at.*")


def locate(slots: dict[int, np.ndarray], lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for length in np.unique(lengths):
        of = np.nonzero(lengths == length)[0]
        rank = ranks[of]
        first, base, at, per = slots[int(length)][:, np.searchsorted(slots[int(length)][0], rank, "right") - 1]
        sequence[of] = base + (rank - first) // per
        offset[of] = at + (rank - first) % per * length
    return sequence, offset


def plan(counts: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """Places for ``counts[length]`` pieces of each length: by length, the columns (first rank, first sequence, offset,
    pieces per sequence) of runs of ranks; rank r of a run is piece (r - first) % per of sequence base + (r - first) // per.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} in sequences of {capacity}")
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    runs: dict[int, list] = defaultdict(list)
    open_bins: list[tuple[int, int, int]] = []  # (room, first sequence, sequences)
    sequences = 0

    def put(length: int, base: int, at: int, bins: int, per: int = 1) -> None:
        runs[length].append((used[length], base, at, per))
        used[length] += bins * per
        left[length] -= bins * per

    for length in range(capacity, 0, -1):
        while left[length]:
            rest = _complement(left, length, capacity)
            if rest is None:
                break
            need = defaultdict(int)
            for part in (length, *rest):
                need[part] += 1
            bins = int(min(left[part] // k for part, k in need.items()))
            at = 0
            for part, k in need.items():
                put(part, sequences, at, bins, k)
                at += part * k
            sequences += bins
    # Residuals, longest first, each into the fullest bins that have room; equal bins are one entry.
    by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        while left[length]:
            fitting = np.nonzero(rooms[length:])[0]
            if len(fitting):
                room = int(fitting[0]) + length
                base, bins = by_room[room].pop()
                rooms[room] = bool(by_room[room])
                if left[length] < bins:
                    by_room[room].append((base + int(left[length]), bins - int(left[length])))
                    rooms[room] = True
                    bins = int(left[length])
                per = max(1, min(room // length, int(left[length]) // bins))
            else:
                room, base = capacity, sequences
                per = min(capacity // length, int(left[length]))
                bins = int(left[length]) // per
                sequences += bins
            put(length, base, capacity - room, bins, per)
            room -= per * length
            if room:
                by_room[room].append((base, bins))
                rooms[room] = True
    return {length: np.array(found, np.int64).T for length, found in runs.items()}


def _complement(left: np.ndarray, length: int, capacity: int) -> tuple[int, ...] | None:
    """Up to three lengths still available that fill the gap beside ``length`` exactly, the longest possible first."""
    gap = capacity - length
    if not gap:
        return ()
    left[length] -= 1
    try:
        if left[gap]:
            return (gap,)
        there = np.nonzero(left[: gap + 1])[0][::-1]
        have = left[: gap + 1] > 0
        pairs = there[have[gap - there]]
        pairs = pairs[(2 * pairs != gap) | (left[pairs] > 1)]
        if len(pairs):
            return int(pairs[0]), int(gap - pairs[0])
        for first in there:
            rest = gap - first
            if 3 * first < gap:
                break
            left[first] -= 1
            second = there[(there <= first) & (there < rest)]
            second = second[(left[second] > 0) & (left[rest - second] > 0)]
            second = second[(2 * second != rest) | (left[second] > 1)]
            left[first] += 1
            if len(second):
                return int(first), int(second[0]), int(rest - second[0])
        return None
    finally:
        left[length] += 1


def _pieces(batches, path: str, capacity: int):
    tokens, task = encoder(path), TaskContext.get().partitionId()
    seen: dict[int, int] = defaultdict(int)
    end = np.array([END], "<u4").tobytes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        at = 0
        while at < batch.num_rows:  # whole documents, but few long ones at a time
            upto, size = at, 0
            while upto < batch.num_rows and (upto == at or size < _FLUSH):
                size += len(texts[upto].as_py())
                upto += 1
            of, piece, start, length, cut, nth = [], [], [], [], [], []
            for row, encoded in enumerate(tokens.encode(texts.slice(at, upto - at).to_pylist()), at):
                encoded += end
                n = len(encoded) // 4
                begin, number = 0, 0
                size = n % capacity or capacity
                while begin < n:
                    of.append(row)
                    piece.append(number)
                    start.append(begin)
                    length.append(size)
                    cut.append(encoded[4 * begin : 4 * (begin + size)])
                    nth.append(seen[size])
                    seen[size] += 1
                    begin, number, size = begin + size, number + 1, capacity
            at = upto
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(of, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(cut, pa.binary()),
                    pa.array([task] * len(of), pa.int32()),
                    pa.array(nth, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids", "task", "nth"],
            )
