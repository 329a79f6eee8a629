"""Near-equal lines by a segment-partition edit join.

Two lines within t edits share one of any t + 1 segments of the shorter one, moved by at most t places. So every line is
indexed by its segments, each under the line's length and the segment's number, and every line probes for the segments
that shorter or equally long lines would have, at the few places where edits may have moved them (after Li et al. 2012).

1. Equal lines are one from here on. Keys that only one line has, or that lines probe for and none owns, drop out by Bloom
   filters before anything is shuffled.
2. Lines with a key in common, one of which has it as its own segment, are verified by a banded bit-parallel edit distance.
   No two lines are tied before that, so what is tied is linked.
   An edit changes at most two pairs of neighbouring characters, so lines whose counts of such pairs differ by more are
   not tried, nor are lines that links connect already. Where too many pairs are left, the lines get finer keys.
   The parts beside the shared segment are again within t edits, so they share one of t + 1 segments of those parts,
   and so on until keys are rare or nothing is left beside the shared segments.
3. All that is done in one task for a key that at most ``GROUP`` lines have. A key of more lines is worked off by several:
   with the first line of the key first; then, if few lines are not linked with it, those with all others, block by block;
   else the lines are shuffled by their finer keys.
4. The components of the links are the classes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from topicstream.llm import bloom
from topicstream.llm.common import components, text_or_empty, written

EDITS = 2
CHARS_PER_EDIT = 16
BLOCK = 128
GROUP = 4096
_FLUSH = 20_000
#: Lines that are tried without counts, pairs of lines whose counts are compared at once, kinds of counts, and misses a line
#: may have before it gets finer keys.
_FEW = 8
_AT_ONCE = 1 << 16
_KINDS = 64
_MISSES = 32


def near_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits: int = EDITS,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """One row (doc_id, line, text, class_doc_id, class_line, kept) for every line of every row that is not blank.

    Lines are what line feeds separate, numbered from 0. Two lines are linked if their edit distance in code points is
    at most ``edits``, and at most one for every ``chars_per_edit`` code points of the shorter one; shorter lines
    are linked with equal ones alone. A class is what links connect. Its first line (by id with nulls last, line, and
    the order in which rows were read) names it and is the one that is kept.

    Null and empty texts have no lines. Rows that repeat an id have lines of their own. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"at long, doc_id {kind}, line int, node binary, text string, segments array<long>"
    lines = written(rows.mapInArrow(lambda b: _line_batches(b, edits, chars_per_edit), schema), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "line", "at")
    nodes = lines.groupBy("node").agg(F.min(order).alias("first"))
    nodes = written(nodes.select("node", "first", F.col("first.at").alias("at")), "line-nodes")
    links = _all_links(lines, nodes.select("at"), edits, chars_per_edit)
    linked = components(links, "line-links").withColumnRenamed("node", "at")

    reached = written(nodes.select("node", "first", "at").join(linked, "at", "left"), "line-reached")
    # Lines without links have no root; they stay out of the join, where they would all meet in one task.
    grouped = reached.where("root is not null")
    classes = written(grouped.groupBy("root").agg(F.min("first").alias("class")), "line-roots")
    alone = reached.where("root is null").select("node", F.col("first").alias("class"))
    named = written(grouped.join(classes, "root").select("node", "class").union(alone), "line-classes")
    return lines.select("at", "doc_id", "line", "text", "node").join(named, "node").select(
        "doc_id",
        "line",
        "text",
        F.col("class.doc_id").alias("class_doc_id"),
        F.col("class.line").alias("class_line"),
        (F.col("at") == F.col("class.at")).alias("kept"),
    )


def allowed(length: int, edits: int, chars_per_edit: int) -> int:
    return min(edits, length // chars_per_edit)


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of ``parts`` segments of as even lengths as possible, the longer ones last."""
    short, longer = divmod(length, parts)
    found, start = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        found.append((start, size))
        start += size
    return found


#: Parts of a line that lie beside the segments it shares: (length in the shorter line, start and length in this one).
Parts = tuple[tuple[int, int, int], ...]


def cut(lengths: list[int], parts: int) -> list[tuple[int, int, int]]:
    """``parts`` segments, (number of the part, start in it, length), of parts of these lengths, as even as possible.

    Nothing if there are fewer characters than segments.
    """
    if sum(lengths) < parts:
        return []
    shares = [0] * len(lengths)
    for _ in range(parts):
        shares[max(range(len(lengths)), key=lambda i: lengths[i] / (shares[i] + 1))] += 1
    return [(i, *at) for i, k in enumerate(shares) if k for at in segments(lengths[i], k)]


@lru_cache(maxsize=1 << 11)
def _windows(n: int, edits: int, chars_per_edit: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, end, seed) of the own segments of lines of ``n`` characters, and of the places where those of a shorter line
    may stand."""
    own, probes = [], []
    for length in range(max(0, n - edits), n + 1):
        t, longer = allowed(length, edits, chars_per_edit), n - length
        if not t or longer > t:
            continue
        for i, (start, size) in enumerate(segments(length, t + 1)):
            # Of i edits before the segment and t - i behind it, at least one side's bound holds.
            low = max(0, start - i, start + longer - (t - i))
            high = min(n - size, start + i, start + longer + (t - i))
            for at in range(low, high + 1):
                (own if not longer and at == start else probes).append((at, at + size, length * 64 + i))
    return own, probes


def keys(text: str, edits: int, chars_per_edit: int) -> tuple[list[int], list[int]]:
    """Keys of the line's own segments, and of the places where the segments of a shorter line may stand in it."""
    own, probes = _windows(len(text), edits, chars_per_edit)
    return [_key(text[a:b], seed) for a, b, seed in own], [_key(text[a:b], seed) for a, b, seed in probes]


def _signed(digests: list[int]) -> np.ndarray:
    """The keys that :func:`_key` makes of these digests."""
    return (np.array(digests, np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def finer_keys(
    text: str, edits: int, chars_per_edit: int, shared: set[int], depth: int
) -> tuple[list[int], list[int], list[int]]:
    """Own and probing keys of what lies beside the segments whose keys are in ``shared``, ``depth`` of them: for 0 of them
    those of :func:`keys`.

    The third list holds those of the keys under which nothing is left to cut.
    """
    n, own, probes, last = len(text), [], [], []
    stack = [
        (((length, 0, n),), length == n, allowed(length, edits, chars_per_edit), length * 64, 0)
        for length in range(max(0, n - edits), n + 1)
        if 0 < allowed(length, edits, chars_per_edit) >= n - length
    ]
    while stack:
        parts, mine, t, seed, level = stack.pop()
        found = list(_places(text, parts, mine, t, seed))
        if not found and level == depth:
            key = _key("", seed)
            (own if mine else probes).append(key)
            last.append(key)
        for key, left, exact in found:
            if level == depth:
                (own if exact else probes).append(key)
            elif key in shared:
                stack.append((left, exact, t, key * 64, level + 1))
    return own, probes, last


def _places(text: str, parts: Parts, mine: bool, t: int, seed: int):
    """Keys of the segments of ``parts`` at all places where they may stand, with what lies beside, and whether it is the
    line's own segment."""
    for number, (i, start, size) in enumerate(cut([length for length, _, _ in parts], t + 1)):
        length, begin, here = parts[i]
        longer = here - length
        # Of a whole line's edits, some segment has at most its number before it and the rest behind it.
        before, behind = (number, t - number) if len(parts) == 1 else (t, t)
        low = max(0, start - before, start + longer - behind)
        for at in range(low, min(here - size, start + before, start + longer + behind) + 1):
            left = (start, begin, at), (length - start - size, begin + at + size, here - at - size)
            if all(abs(a - b) <= t for a, _, b in left):
                rest = (*parts[:i], *(part for part in left if part[0] or part[2]), *parts[i + 1 :])
                exact = mine and at == start
                yield _key(text[begin + at : begin + at + size], seed + number), rest, exact


def _key(segment: str, seed: int) -> int:
    return xxh64_intdigest(segment, seed % (1 << 64)) - (1 << 63)


def within(a: str, b: str, edits: int) -> bool:
    """True if the edit distance is at most ``edits``.

    Bit-parallel over the band of 2 edits + 1 diagonals: bit d of states[e] says that e edits lead from the first j
    characters of ``b`` to the first j - edits + d of ``a`` (after Wu and Manber 1992).
    """
    if abs(len(a) - len(b)) > edits:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high:  # length of the common beginning
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    a, b = a[low:], b[low:]
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        places[c] |= 1 << (i + edits)  # moved up, as the band begins ``edits`` before the diagonal
    full = (1 << (2 * edits + 1)) - 1
    states = [1 << edits]
    for _ in range(edits):
        states.append(states[-1] | (states[-1] << 1) & full)
    for j, c in enumerate(b):
        match = (places.get(c, 0) >> j) & full
        before, now = 0, 0
        for e in range(edits + 1):
            then = states[e]
            now = ((then & match) | before | (before >> 1) | (now << 1)) & full if e else then & match
            before, states[e] = then, now
        if not states[edits]:
            return False
    return bool(states[edits] >> (len(a) - len(b) + edits) & 1)


def _all_links(lines: DataFrame, ones: DataFrame, edits: int, chars_per_edit: int) -> DataFrame:
    """Links (a, b) that connect what pairwise comparison of the lines ``ones`` (at) would connect.

    Texts are shuffled only of lines that share a key with another.
    """
    one = bloom.contained_in(ones)  # a few other lines pass; they drop out when keys are joined
    first_ones = lines.where(one("at"))
    own = first_ones.select("at", F.explode("segments").alias("key"))
    owned, again = bloom.tester_and_repeated_in(own.select("key"))
    probes = first_ones.select("at", "text").mapInArrow(
        lambda b: _probes(b, edits, chars_per_edit, owned), "at long, key long"
    )
    probes = written(probes, "line-probes")
    probed = bloom.contained_in(probes.select("key"))
    own = own.where(again("key") | probed("key")).select("at", "key", F.lit(True).alias("own"))
    keyed = own.union(probes.select("at", "key", F.lit(False).alias("own"))).distinct().join(ones, "at")
    shared_yet = F.array().cast("array<long>").alias("shared")
    keyed = written(keyed.select("at", "key", "own", F.lit(False).alias("last"), shared_yet), "line-keys")
    wanted = bloom.contained_in(keyed.select("at"))
    texts = written(lines.where(wanted("at")).select("at", "text"), "line-texts")
    found: list[DataFrame] = []
    shared: DataFrame | None = None
    depth = 0
    while True:
        many = F.col("n") > GROUP
        groups = keyed.groupBy("key").agg(
            F.count("*").alias("n"), F.min(F.when(F.col("own"), F.col("at"))).alias("first"), F.max("last").alias("last")
        )
        groups = written(groups.where("n > 1 and first is not null"), "line-groups")
        few = keyed.drop("last").join(groups.where(~many).select("key", "last"), "key").join(texts, "at")
        few = few.select("key", "own", "at", "text", "last", "shared").repartition("key").sortWithinPartitions("key", "at")
        linked = few.mapInArrow(
            lambda b, depth=depth, block=BLOCK: _links_of_keys(b, edits, chars_per_edit, depth, block), "a long, b long"
        )
        found.append(written(linked, "line-links"))
        hot = written(groups.where(many), "line-hot")
        if hot.isEmpty():
            break
        hot = _around_first(keyed.drop("last", "shared").join(hot, "key"), texts, edits, chars_per_edit, found)
        if hot.isEmpty():
            break
        # The lines of what is left get finer keys, which lie under all the hot ones they had so far.
        now = hot.select("at", "key").distinct()
        shared = written(now if shared is None else now.union(shared), "line-shared")
        again = shared.groupBy("at").agg(F.collect_set("key").alias("shared")).join(now.select("at").distinct(), "at")
        depth += 1
        finer = again.join(texts, "at").select("at", "text", "shared")
        finer = finer.mapInArrow(
            lambda b, depth=depth: _finer(b, edits, chars_per_edit, depth),
            "at long, key long, own boolean, last boolean, shared array<long>",
        )
        keyed = written(finer, "line-finer")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def _around_first(rows: DataFrame, texts: DataFrame, edits: int, chars_per_edit: int, found: list[DataFrame]) -> DataFrame:
    """Compare the lines of large groups with the first of their group, and add the links to ``found``.

    Where few lines are left that are not linked with it, they are compared with all others of the group. ``rows`` has key,
    at, own, first, n, last. What is returned is those rows whose groups have more left over and can be cut further.
    """
    centre = texts.select(F.col("at").alias("first"), F.col("text").alias("centre"))
    pairs = rows.join(texts, "at").join(centre, "first").select(*rows.columns, "text", "centre")
    schema = f"{pairs.drop('text', 'centre').schema.simpleString()[7:-1].replace(':', ' ')}, linked boolean"
    tried = written(pairs.mapInArrow(lambda b: _tried(b, edits, chars_per_edit), schema), "line-tried")
    found.append(tried.where("linked and at <> first").select(F.col("at").alias("a"), F.col("first").alias("b")))
    left = written(tried.where("not linked").groupBy("key").agg(F.count("*").alias("left")), "line-left")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    few = tried.join(left, "key").where((F.col("left") <= BLOCK) | F.col("last"))
    own_block = F.pmod(F.xxhash64("at"), blocks).cast("int")
    # A line that is left over is in every block of its group; the blocks are as large as one of the others.
    placed = few.select(
        "key", "own", "at", "linked",
        F.explode(F.when(F.col("linked"), F.array(own_block)).otherwise(F.sequence(F.lit(0), blocks - 1))).alias("block"),
    )
    placed = placed.join(texts, "at").repartition("key", "block").sortWithinPartitions("key", "block", "linked", "at")
    placed = placed.select("key", "block", "own", "at", "text", "linked")
    found.append(written(placed.mapInArrow(lambda b: _links_of_blocks(b, edits, chars_per_edit), "a long, b long"), "line-links"))
    more = tried.where("not last").join(left.where(F.col("left") > BLOCK).select("key"), "key")
    return written(more.select("key", "at"), "line-more")


def _tried(batches, edits: int, chars_per_edit: int):
    for batch in batches:
        names = batch.schema.names
        texts, centres = (batch.column(names.index(c)).to_pylist() for c in ("text", "centre"))
        linked = [_near(a, b, edits, chars_per_edit) for a, b in zip(texts, centres)]
        kept = [c for c in names if c not in ("text", "centre")]
        columns = [batch.column(names.index(c)) for c in kept]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(linked)], [*kept, "linked"])


def _near(a: str, b: str, edits: int, chars_per_edit: int) -> bool:
    return a == b or within(a, b, allowed(min(len(a), len(b)), edits, chars_per_edit))


def _finer(batches, edits: int, chars_per_edit: int, depth: int):
    for batch in batches:
        rows = []
        for at, text, shared in zip(*(c.to_pylist() for c in batch.columns)):
            own, probes, last = finer_keys(text, edits, chars_per_edit, set(shared), depth)
            ends, mine = set(last), set(own)
            rows += [(at, key, key in mine, key in ends, shared) for key in mine | set(probes)]
        if rows:
            kinds = pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["at", "key", "own", "last", "shared"]
            )


def _links_of_keys(batches, edits: int, chars_per_edit: int, depth: int, block: int):
    """Links within every run of rows (key, own, at, text, last, shared) of one key; of two lines one must have the key as its
    own."""

    def links(run: list[tuple]) -> list[tuple[int, int]]:
        shared = {row[2]: row[5] for row in run}
        key, last = run[0][0], run[0][4]

        def finer(at: int, text: str, under: tuple[int, ...]):
            return finer_keys(text, edits, chars_per_edit, {*shared[at], key, *under}, depth + 1 + len(under))

        lines = [(at, text, own, False) for _, own, at, text, _, _ in run]
        return _connect(lines, edits, chars_per_edit, finer if len(run) > block and not last else None)

    return _links_of_runs(batches, 1, links)


def _links_of_blocks(batches, edits: int, chars_per_edit: int):
    """Links within every run of rows (key, block, own, at, text, linked) of one key and block; one of two lines must have the
    key as its own, and one must not be linked with the key's first line."""

    def links(run: list[tuple]) -> list[tuple[int, int]]:
        return _connect([(at, text, own, linked) for _, _, own, at, text, linked in run], edits, chars_per_edit)

    return _links_of_runs(batches, 2, links)


def _links_of_runs(batches, width: int, links: Callable[[list[tuple]], list[tuple[int, int]]]):
    """``links`` of every run of rows whose first ``width`` columns are the same."""
    group, run = None, []
    for batch in batches:
        found: list[tuple[int, int]] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:width] != group:
                found += links(run) if len(run) > 1 else []
                group, run = row[:width], []
            run.append(row)
        yield _pairs(found)
    yield _pairs(links(run) if len(run) > 1 else [])


def _connect(
    run: list[tuple[int, str, bool, bool]], edits: int, chars_per_edit: int, finer: Callable | None = None
) -> list[tuple[int, int]]:
    """Links that connect the rows (at, text, own, linked) of a run as all its links would.

    Rows that are linked already are so with one another. ``finer`` gives the finer keys of a line (at, text) under some keys.
    With it, pairs of lines without a finer key in common are left out where too many are not near.
    """
    lines: dict[int, tuple[str, bool, bool]] = {}
    for at, text, own, linked in run:
        lines[at] = text, own or at in lines and lines[at][1], linked
    ats, texts = list(lines), [text for text, _, _ in lines.values()]
    first = next((i for i, (_, _, linked) in enumerate(lines.values()) if linked), 0)
    parent = [first if linked else i for i, (_, _, linked) in enumerate(lines.values())]
    found: list[tuple[int, int]] = []
    counts = _counts(texts) if len(texts) > _FEW else None

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def tried(rows: list[int], own: np.ndarray, misses: float) -> bool:
        """Link near lines of ``rows``; false if more pairs than ``misses`` were not near, and the rest was left out."""
        for x, y in _candidates(rows, own, counts, 4 * edits, top):
            a, b = top(x), top(y)
            if a != b:
                if _near(texts[x], texts[y], edits, chars_per_edit):
                    parent[b] = a
                    found.append((ats[x], ats[y]))
                else:
                    misses -= 1
                    if misses < 0:
                        return False
        return True

    stack = [({i: own for i, (_, own, _) in enumerate(lines.values())}, (), finer is None)]
    while stack:
        members, under, last = stack.pop()
        rows, own = list(members), np.array(list(members.values()), bool)
        if tried(rows, own, float("inf") if last else _MISSES * len(rows)):
            continue
        groups: dict[int, dict[int, bool]] = defaultdict(dict)
        ends = set()
        for i in rows:
            mine, probes, last_ones = finer(ats[i], texts[i], under)
            ends.update(last_ones)
            for key in probes:
                groups[key][i] = False
            for key in mine:
                groups[key][i] = True
        stack += [(g, (*under, key), key in ends) for key, g in groups.items() if len(g) > 1 and any(g.values())]
    return found


def _candidates(
    rows: list[int], own: np.ndarray, counts: np.ndarray | None, most: int, top: Callable[[int], int]
) -> Iterator[tuple[int, int]]:
    """Pairs of ``rows`` of which one has the key as its own, that are not connected yet and whose counts differ by ``most``."""
    n = len(rows)
    if n <= _FEW:
        yield from ((rows[x], rows[y]) for y in range(n) for x in range(y) if own[x] or own[y])
        return
    of, places = counts[rows], np.arange(n)
    step = max(1, _AT_ONCE // n)
    for start in range(0, n, step):
        end = min(n, start + step)
        tops = np.array([top(i) for i in rows[:end]])
        may = (tops[start:, None] != tops) & (own[start:end, None] | own[:end]) & (places[start:end, None] > places[:end])
        if may.any():
            apart = of[start:end, None] - of[:end]
            # Counts are kept modulo 256, which only brings them closer.
            may &= np.minimum(apart, -apart).sum(2, dtype=np.uint32) <= most
        for y, x in zip(*(side.tolist() for side in np.nonzero(may))):
            yield rows[x], rows[start + y]


def _counts(texts: list[str]) -> np.ndarray:
    """How many pairs of neighbouring characters of each kind a text has, modulo 256; an edit changes at most two pairs."""
    found = np.zeros((len(texts), _KINDS), np.uint8)
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds = (codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]) * np.uint32(0x85EBCA6B) >> np.uint32(16)
        found[i] = np.bincount(kinds % _KINDS, minlength=_KINDS)
    return found


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = zip(*found) if found else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _line_batches(batches, edits: int, chars_per_edit: int):
    from hashlib import md5

    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        rows: list[tuple[int, int, bytes, str, int]] = []
        segments: list[int] = []
        for row, text in enumerate(batch.column(1).to_pylist()):
            for line, part in enumerate(text.split("\n")):
                if part and not part.isspace():
                    own = _windows(len(part), edits, chars_per_edit)[0]
                    segments += [xxh64_intdigest(part[a:b], seed) for a, b, seed in own]
                    rows.append((row, line, md5(part.encode()).digest(), part, len(own)))
            if len(rows) >= _FLUSH:
                yield _lines(number, rows, segments, batch.column(0))
                number += len(rows)
                rows, segments = [], []
        if rows:
            yield _lines(number, rows, segments, batch.column(0))
            number += len(rows)


def _lines(number: int, rows: list[tuple], segments: list[int], ids: pa.Array) -> pa.RecordBatch:
    row, line, node, text, sizes = zip(*rows)
    ends = np.cumsum([0, *sizes], dtype=np.int32)
    columns = [
        pa.array(np.arange(number, number + len(rows))),
        ids.take(pa.array(row, pa.int64())),
        pa.array(line, pa.int32()),
        pa.array(node, pa.binary()),
        pa.array(text, pa.string()),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(segments))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["at", "doc_id", "line", "node", "text", "segments"])


def _probes(batches, edits: int, chars_per_edit: int, owned):
    """The probing keys of lines that some line has as its own."""
    for batch in batches:
        found: list[int] = []
        counts = []
        for text in batch.column(1).to_pylist():
            probes = _windows(len(text), edits, chars_per_edit)[1]
            found += [xxh64_intdigest(text[a:b], seed) for a, b, seed in probes]
            counts.append(len(probes))
        values = _signed(found)
        kept = owned(values)
        ats = np.repeat(batch.column(0).to_numpy(), counts)
        yield pa.RecordBatch.from_arrays([pa.array(ats[kept]), pa.array(values[kept])], ["at", "key"])
