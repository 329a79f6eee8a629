"""Packing by first-fit decreasing, run on its own in randomised groups of documents.

Documents are dealt to tasks at random and a task packs them group by group as they come, so no plan is made over the
whole corpus, no task waits for another, and a group is a fair sample however the input is sorted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import text_or_empty
from topicstream.llm.tokens import encoder

CAPACITY = 2048
END = 1  # fixed value of the contract: the id after every document
GROUP_DOCUMENTS = 4096
GROUP_TOKENS = 4 << 20
_AT_ONCE = 64
_IDS_AT_ONCE = 8 << 20

Piece = tuple[int, int, int]  # document, start, length


def pack_in_groups(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = CAPACITY,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (doc_id, start, length, ids, doc_tokens, sequence_id, offset) for every piece of every document.

    A document is the ids of its whole text and a closing id, so an empty or null text is one piece of one id. It is cut
    into pieces of ``capacity`` and a rest; rests are packed by first-fit decreasing, and the emptiest sequences of a group are
    cut to fill the gaps of the others. What is left of a group, less than one sequence, becomes sequences of powers
    of two. So every sequence has ``capacity`` ids or a power of two. ``ids`` holds little-endian unsigned 32-bit
    numbers. Repeated rows and rows without an id are documents of their own; an empty table gives no rows; other columns
    are ignored. A group ends at 4,096 documents or at four million ids, whichever comes first.
    """
    # The place in the input, not the content, decides where a row goes: no copies or null ids meet in one task, and a
    # task that is run again gets the same rows in the same order.
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        F.xxhash64(F.monotonically_increasing_id()).alias("mix"),
    )
    dealt = rows.repartition("mix").sortWithinPartitions("mix").drop("mix")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return dealt.mapInArrow(lambda batches: _packed(batches, tokenizer_path, capacity, end), schema)


def pack_group(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Sequences of pieces that hold documents of these lengths, each id once."""
    sequences: list[list[Piece]] = []
    rests: list[Piece] = []
    for doc, length in enumerate(lengths):
        whole = length // capacity * capacity
        sequences += [[(doc, start, capacity)] for start in range(0, whole, capacity)]
        if length > whole:
            rests.append((doc, whole, length - whole))
    bins: list[list[Piece]] = []
    for rest, at in zip(rests, first_fit_decreasing([length for _, _, length in rests], capacity)):
        bins += [[] for _ in range(at + 1 - len(bins))]
        bins[at].append(rest)
    _fill(bins, capacity)
    if bins and sum(length for _, _, length in bins[-1]) < capacity:
        bins[-1:] = _powers(bins[-1])
    return sequences + bins


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length: longest first, ties in their order, each into the first bin that has room.

    A tournament tree holds at every node the most room of any bin below it, so the first bin with enough room is
    found from the root down, and one path is played again when a bin loses room.
    """
    if any(not 0 < length <= capacity for length in lengths):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    most = [capacity] * (2 * leaves)
    found = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need, node = lengths[i], 1
        while node < leaves:
            node *= 2
            node += most[node] < need
        found[i] = node - leaves
        most[node] -= need
        while node > 1:
            node //= 2
            winner = max(most[2 * node], most[2 * node + 1])
            if winner == most[node]:
                break
            most[node] = winner
    return found


def _fill(bins: list[list[Piece]], capacity: int) -> None:
    """Fill the gaps of the first bins with what the last ones hold, until at most the last has a gap."""
    room = [capacity - sum(length for _, _, length in b) for b in bins]
    at = 0
    while at < len(bins) - 1:
        if not room[at]:
            at += 1
            continue
        doc, start, length = bins[-1].pop()
        cut = min(length, room[at])
        bins[at].append((doc, start, cut))
        room[at] -= cut
        if cut < length:
            bins[-1].append((doc, start + cut, length - cut))
        if not bins[-1]:
            bins.pop()


def _powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The same ids in sequences whose lengths are the powers of two of their number."""
    left, found = list(reversed(pieces)), []
    total = sum(length for _, _, length in pieces)
    for bit in reversed(range(total.bit_length())):
        need = total & 1 << bit
        if need:
            found.append([])
        while need:
            doc, start, length = left.pop()
            cut = min(length, need)
            found[-1].append((doc, start, cut))
            need -= cut
            if cut < length:
                left.append((doc, start + cut, length - cut))
    return found


def _packed(batches, path: str, capacity: int, end: int):
    tokens, closing = encoder(path), np.array([end], "<u4").tobytes()
    sequence = TaskContext.get().partitionId() << 36
    docs, encoded, size, kind = [], [], 0, pa.int64()
    for batch in batches:
        kind = batch.schema.field(0).type
        for at in range(0, batch.num_rows, _AT_ONCE):
            few = batch.slice(at, _AT_ONCE)
            docs += few.column(0).to_pylist()
            encoded += [ids + closing for ids in tokens.encode(few.column(1).to_pylist())]
            size += sum(map(len, encoded[-few.num_rows :])) // 4
            if len(docs) >= GROUP_DOCUMENTS or size >= GROUP_TOKENS:
                yield from _rows(docs, encoded, sequence, capacity, kind)
                sequence += len(docs) + size  # more than the group has sequences
                docs, encoded, size = [], [], 0
    yield from _rows(docs, encoded, sequence, capacity, kind)


def _rows(docs: list, encoded: list[bytes], sequence: int, capacity: int, kind: pa.DataType):
    rows, held = [], 0
    for number, pieces in enumerate(pack_group([len(ids) // 4 for ids in encoded], capacity), sequence):
        offset = 0
        for doc, start, length in pieces:
            ids = encoded[doc][4 * start : 4 * (start + length)]
            rows.append((docs[doc], start, length, ids, len(encoded[doc]) // 4, number, offset))
            offset += length
            held += len(ids)
        if held >= _IDS_AT_ONCE:
            yield _batch(rows, kind)
            rows, held = [], 0
    if rows:
        yield _batch(rows, kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [kind, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
