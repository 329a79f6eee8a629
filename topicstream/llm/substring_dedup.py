"""Passages that documents share, by content-defined chunks that are extended to the whole match.

1. A gear hash rolls over a text's bytes. Of every window of places the one with the least hash is a boundary, so
   boundaries depend on the bytes around them alone, move with them when something is inserted before, and are never far
   apart. A chunk goes from each boundary to the one of the window that begins ``least`` bytes on.
2. Chunks are compared by digest. Each is tied to the first place that holds it: a star, not all pairs.
3. The two texts of such a tie are compared byte by byte from the chunk to both sides. The least length applies to the
   extended match.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.llm import bloom
from topicstream.llm.common import text_or_empty, written

MIN_BYTES = 160
MOST = 256  # more than boundaries are apart with the least length as it is
_HASHED = 8
#: A value of 16 bits for every byte; the hash of a place depends on the 8 bytes before it.
_GEAR = np.random.default_rng(7).integers(0, 1 << 16, 256, np.uint16)
_ROWS = 500


def shared_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """One row (doc_id, start, length, first_doc_id, kept, passage) for every passage of a row that other rows hold too.

    Of the rows that hold a chunk, the one with the smallest id (nulls last; rows that repeat an id in the order in which
    they were read) is the first, and every other place of the chunk is compared with the chunk's first place there. What
    is equal around both, at least ``min_bytes`` bytes of UTF-8 in whole characters, is a match: a later occurrence in
    the one row, the first in the other. A passage is a longest stretch of matches that overlap or touch. Where it turns
    from first to later occurrences it is divided, so that ``kept`` holds for all of it; what is both is a later one.
    What is left of a first occurrence is left
    out if it is shorter than a quarter of the least length. ``start`` and
    ``length`` count code points; ``first_doc_id`` is the smallest id of rows that its matches were compared with, or its own
    if kept. Repeats within one row alone are not counted.

    Null and empty texts have no passages. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    # Texts are shuffled up to three times, so they travel compressed.
    schema = f"row long, doc_id {kind}, text binary, digests array<long>, starts array<int>"
    chunked = written(rows.mapInArrow(lambda b: _chunk_batches(b, min_bytes), schema), "chunks")
    # A chunk that a row repeats counts once for the row.
    digests = chunked.select(F.explode(F.array_distinct("digests")).alias("digest"))
    again = bloom.repeated_in(digests)
    occurrences = chunked.select("row", "doc_id", F.explode(F.arrays_zip("digests", "starts")).alias("chunk")).select(
        "row", "doc_id", F.col("chunk.digests").alias("digest"), F.col("chunk.starts").alias("start")
    )
    occurrences = written(occurrences.where(again("digest")), "chunk-repeats")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row", "start")
    # Written, so that the join is between plain exchanges and adaptive execution can split a very common chunk.
    shared = written(
        occurrences.groupBy("digest")
        .agg(F.min(order).alias("first"), F.max("row").alias("last_row"), F.min("row").alias("first_row"))
        .where("first_row < last_row")
        .select("digest", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")),
        "chunk-firsts",
    )
    ties = (
        occurrences.join(shared, "digest")
        .where("row <> first_row or start <> first_start")
        .groupBy("row", "first_row")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("first_start").alias("first_starts"))
    )
    ties = written(ties, "chunk-ties")
    tied = bloom.contained_in(ties.select("row").union(ties.select("first_row")))
    texts = chunked.select("row", "doc_id", "text").where(tied("row"))
    firsts = texts.select(F.col("row").alias("first_row"), F.col("doc_id").alias("first_doc_id"), F.col("text").alias("first_text"))
    pairs = ties.join(texts.select("row", "text"), "row").join(firsts, "first_row")
    pairs = pairs.select("row", "text", "starts", "first_row", "first_doc_id", "first_text", "first_starts")
    # ``source`` is the place a match within the row repeats, otherwise -1.
    schema = f"row long, start int, end int, source int, kept boolean, first_doc_id {kind}"
    matches = pairs.mapInArrow(lambda b: _match_batches(b, min_bytes), schema)
    # The first row of a common passage is matched by many rows, mostly in the same place.
    matches = written(matches.distinct(), "matches")
    groups = max(1, matches.count() // _ROWS)
    schema = f"row long, start int, size int, kept boolean, first_doc_id {kind}"
    parts = matches.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups))).applyInArrow(lambda t: _parts(t, min_bytes), schema)
    part = F.struct("start", "size", "kept", "first_doc_id")
    parts = written(parts.groupBy("row").agg(F.sort_array(F.collect_list(part)).alias("parts")), "passages")
    holding = bloom.contained_in(parts.select("row"))
    texts = chunked.select("row", "doc_id", "text").where(holding("row")).join(parts, "row")
    texts = texts.select("doc_id", "text", "parts.start", "parts.size", "parts.kept", "parts.first_doc_id")
    schema = f"doc_id {kind}, start long, length long, first_doc_id {kind}, kept boolean, passage string"
    return texts.mapInArrow(_passages, schema)


def _passages(batches):
    names = ["doc_id", "start", "length", "first_doc_id", "kept", "passage"]
    for batch in batches:
        ids, texts, starts, sizes, kept, firsts = batch.columns
        of, begins, lengths, found = [], [], [], []
        for n in range(batch.num_rows):
            data = zlib.decompress(texts[n].as_py())
            seen = chars = 0
            for start, size in zip(starts[n].as_py(), sizes[n].as_py()):  # in the order of their starts
                chars += len(data[seen:start].decode())
                seen = start
                found.append(data[start : start + size].decode())
                begins.append(chars)
                lengths.append(len(found[-1]))
                of.append(n)
        columns = [
            ids.take(pa.array(of, pa.int64())),
            pa.array(begins, pa.int64()),
            pa.array(lengths, pa.int64()),
            firsts.flatten(),
            kept.flatten(),
            pa.array(found, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)


def _hashes(raw: np.ndarray) -> np.ndarray:
    """The gear hash of the 8 bytes up to each place."""
    hashed = _GEAR[raw]
    for step in (1, 2, 4):  # hash of 1, 2, 4 and then 8 bytes
        shifted = hashed.copy()
        shifted[step:] += hashed[:-step] << np.uint16(step)
        hashed = shifted
    return hashed


def _sizes(min_bytes: int) -> tuple[int, int]:
    """Places of a window, and the least length of a chunk: then ``min_bytes`` bytes hold a whole chunk wherever they begin.

    The first boundary is at most the hashed bytes and a window from their beginning, the end of its chunk as much as the
    least length and another window on.
    """
    room = min_bytes - _HASHED
    window = max(1, room * 2 // 5)
    return window, room + 1 - 2 * window


def _least_places(data: bytes, window: int) -> np.ndarray:
    """The boundary of the window that begins at each place: the beginning of a character, with the least hash before it."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < _HASHED + window:
        return np.zeros(0, np.int64)
    hashed = _hashes(raw)[_HASHED - 1 : -1].astype(np.int64)
    inside = (raw[_HASHED:] & 0xC0) == 0x80
    least = (hashed + (inside.astype(np.int64) << 16)) << 32 | np.arange(_HASHED, len(raw))
    step = 1
    while 2 * step <= window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < window:  # two windows of a power of two that overlap
        least = np.minimum(least[: step - window], least[window - step :])
    return least & 0xFFFFFFFF  # never decreases


def boundaries(data: bytes, min_bytes: int = MIN_BYTES) -> np.ndarray:
    """Ends of the stretches between boundaries, the end of ``data`` being one."""
    found = np.unique(_least_places(data, _sizes(min_bytes)[0]))
    return np.r_[found, len(data)] if data else found


def chunks(data: bytes, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of ``data`` begin and end: any ``min_bytes`` bytes in a row hold a whole one, and which
    ones they hold depends on them alone, but for the bytes beside them that may add some."""
    if min_bytes < 4 * _HASHED:  # too short for windows: a chunk begins at every place
        starts = np.arange(max(0, len(data) - max(1, min_bytes) + 1))
        return starts, starts + max(1, min_bytes)
    window, least = _sizes(min_bytes)
    places = _least_places(data, window)
    starts = np.unique(places)
    starts = starts[starts + least - _HASHED < len(places)]
    return starts, places[starts + least - _HASHED]


def matched(a: bytes, b: bytes, seeds: list[tuple[int, int]], min_bytes: int) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the longest equal stretches around ``seeds``, places in a and b, that have at least
    ``min_bytes`` bytes of whole characters."""
    found, upto = [], {}
    for i, j in sorted(seeds):
        if i < upto.get(i - j, 0):
            continue
        behind, before = _common(a, i, b, j), _common_before(a, i, b, j)
        start, end = i - before, i + behind
        upto[i - j] = end
        while start < end and a[start] & 0xC0 == 0x80:
            start += 1
        # The bytes behind may differ, so that a character may begin behind the end in one text alone.
        last = end - 1
        while last > start and a[last] & 0xC0 == 0x80:
            last -= 1
        if end > start and end - last < _width(a[last]):
            end = last
        if end - start >= max(1, min_bytes):
            found.append((start, start - i + j, end - start))
    return found


def _width(lead: int) -> int:
    """Bytes of the character that ``lead`` begins."""
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def _common(a: bytes, i: int, b: bytes, j: int) -> int:
    n, size = 0, 256
    while part := min(size, len(a) - i - n, len(b) - j - n):
        x, y = a[i + n : i + n + part], b[j + n : j + n + part]
        if x != y:
            return n + int(np.argmax(np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8)))
        n, size = n + part, size * 2
    return n


def _common_before(a: bytes, i: int, b: bytes, j: int) -> int:
    n, size = 0, 256
    while part := min(size, i - n, j - n):
        x, y = a[i - n - part : i - n], b[j - n - part : j - n]
        if x != y:
            return n + int(np.argmax((np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8))[::-1]))
        n, size = n + part, size * 2
    return n


def _chunk_batches(batches, min_bytes: int):
    from xxhash import xxh64_intdigest

    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        digests, starts, offsets, packed = [], [], [0], []
        for text in batch.column(1):
            data = text.as_py().encode()
            packed.append(zlib.compress(data, 1))
            begins, ends = (at.tolist() for at in chunks(data, min_bytes))
            digests.extend(xxh64_intdigest(data[a:b]) for a, b in zip(begins, ends))
            starts.extend(begins)
            offsets.append(len(digests))
        places = pa.array(offsets, pa.int32())
        lists = lambda values: pa.ListArray.from_arrays(places, values)  # noqa: B023, E731
        rows = pa.array(np.arange(number, number + batch.num_rows, dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                rows,
                batch.column(0),
                pa.array(packed, pa.binary()),
                lists(pa.array(np.array(digests, np.uint64).view(np.int64))),
                lists(pa.array(starts, pa.int32())),
            ],
            ["row", "doc_id", "text", "digests", "starts"],
        )
        number += batch.num_rows


def _match_batches(batches, min_bytes: int):
    names = ["row", "start", "end", "source", "kept", "first_doc_id"]
    for batch in batches:
        found, of = [], []
        rows, texts, starts, first_rows, ids, first_texts, first_starts = batch.columns
        for n in range(batch.num_rows):
            row, first = rows[n].as_py(), first_rows[n].as_py()
            a, b = zlib.decompress(texts[n].as_py()), zlib.decompress(first_texts[n].as_py())
            for i, j, size in matched(a, b, list(zip(starts[n].as_py(), first_starts[n].as_py())), min_bytes):
                found.append((row, i, i + size, j if row == first else -1, False))
                if row != first:
                    found.append((first, j, j + size, -1, True))
            of.extend([n] * (len(found) - len(of)))
        columns = list(zip(*found)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([*arrays, ids.take(pa.array(of, pa.int64()))], names)


def _parts(matches: pa.Table, min_bytes: int) -> pa.Table:
    """The passages of some rows from all their matches."""
    ids = matches.column("first_doc_id").to_pylist()
    # Numbers of matches in the order of the rows they were compared with: nulls last.
    by_id = sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] if ids[n] is not None else 0))
    matches = matches.take(by_id)
    columns = (matches.column(c).to_pylist() for c in ("row", "start", "end", "source", "kept"))
    of_row: dict[int, list[tuple]] = {}
    for n, (row, *match) in enumerate(zip(*columns)):
        of_row.setdefault(row, []).append((*match, n))
    found, worth = [], max(1, min_bytes // 4)
    for row, of in of_row.items():
        firsts = _joined((start, end, n) for start, end, _, kept, n in of if kept)
        later = [(start, end, n) for start, end, source, kept, n in of if not kept and source < 0]
        known = _joined([*firsts, *later])
        # A repeat within the row counts as far as other rows hold what it repeats.
        for start, end, source, kept, n in of:
            if not kept and source >= 0:
                for low, high, _ in known:
                    low, high = max(low, source), min(high, source + end - start)
                    if high - low >= max(1, min_bytes):
                        later.append((low - source + start, high - source + start, n))
        later = _joined(later)
        found.extend((row, start, end - start, False, n) for start, end, n in later)
        for start, end, n in firsts:
            for low, high, _ in later:
                if low < end and high > start:
                    if low - start >= worth:
                        found.append((row, start, low - start, True, n))
                    start = max(start, high)
            if end - start >= worth:
                found.append((row, start, end - start, True, n))
    rows, starts, sizes, kept, of = list(zip(*found)) or [()] * 5
    return pa.table(
        {
            "row": pa.array(rows, pa.int64()),
            "start": pa.array(starts, pa.int32()),
            "size": pa.array(sizes, pa.int32()),
            "kept": pa.array(kept, pa.bool_()),
            "first_doc_id": matches.column("first_doc_id").take(pa.array(of, pa.int64())),
        }
    )


def _joined(ranges) -> list[tuple[int, int, int]]:
    """Ranges (start, end, n) that overlap or touch as one, with the least n."""
    joined: list[tuple[int, int, int]] = []
    for start, end, n in sorted(ranges):
        if joined and start <= joined[-1][1]:
            low, high, of = joined[-1]
            joined[-1] = (low, max(high, end), min(of, n))
        else:
            joined.append((start, end, n))
    return joined
