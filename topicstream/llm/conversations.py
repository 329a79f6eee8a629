"""Prefix trie of conversations, from adaptive radix trees over ranges of their keys.

A turn is a number of 16 bytes, taken from the hash of its role and text, and a conversation's key is its turns'
numbers, the most significant byte first. Sorted keys are cut into ranges of about equal size, so a first turn that a third of
all conversations share lies in a third of the ranges. Each range has a tree of its own. A trie node is in several
trees only if it is a prefix of the keys on both sides of a cut; of such nodes the parts are added up, all others are final.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topicstream.llm.common import text_or_empty, word_count, written
from topicstream.llm.radix import RadixTree
from topicstream.llm.ranks import sorted_in_ranges

TURN = 16  # bytes of a turn's number
BLOCK, MOST_SHARED = 20, 4  # fixed values of the contract
NOTHING = hashlib.sha256(b"").hexdigest()
_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_PART = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
    " ends_sha256 string, node binary, parent binary, ends binary, task int"
)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """One row (conv_id, turns: array of id and words) for each conversation: the first turns of the conversation that
    opens its block of twenty, then its own after as many."""
    role, text = text_or_empty("role"), text_or_empty("text")
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id is not null").select(
        (conv - conv % BLOCK).alias("block"),
        conv.alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.col("turn").alias("turn"),
            F.substring(F.sha2(both, 256), 1, 2 * TURN).alias("id"),
            word_count(text).alias("words"),
        ).alias("turn"),
    )
    own = turns.repartition("block").groupBy("block", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    opening = F.when(F.col("conv_id") == F.col("block"), F.slice("turns", 1, MOST_SHARED - 1))
    first = F.max(opening).over(W.partitionBy("block"))
    shared = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % MOST_SHARED).cast("int")
    own = own.select("conv_id", "turns", first.alias("opening"), shared.alias("shared"))
    front = F.when(F.col("opening").isNotNull(), F.slice("opening", 1, F.col("shared")))
    front = F.coalesce(front, F.slice("turns", 1, F.lit(0)))
    back = F.slice("turns", F.col("shared") + 1, F.size("turns"))
    return own.select("conv_id", F.concat(front, back).alias("turns"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for every node of the trie of rebuilt conversations.

    Null roles and texts are empty; a null turn comes first, and turns of one number follow their hash. Rows without a
    conv_id belong to no conversation. Repeated rows are turns of their own. Other columns are ignored, and a table
    without conversations gives no rows. A conversation's numbers of turns (24 bytes each) are in one row.
    """
    keys = rebuilt(conversations).select(
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
        "conv_id",
    )
    placed = sorted_in_ranges(written(keys, "trie-keys"), ["key", "conv_id"], "trie-ranges")
    cuts = _cuts(placed)
    parts = placed.groupBy("task").applyInPandas(lambda pdf: _part(pdf, *cuts[int(pdf["task"].iloc[0])]), _PART)
    return _whole(written(parts, "trie-parts"))


def _cuts(placed: DataFrame) -> dict[int, tuple[int, int]]:
    """By range, how many prefixes of whole turns its first key shares with the last one before the range, and its last key
    with the first one after it; the empty prefix counts. Two numbers for each range go through the driver."""
    ends = placed.groupBy("task").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    order = W.orderBy("task")  # a row for each range
    ends = ends.select(
        "task", "first", "last", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")
    )

    def count(batches):
        for pdf in batches:
            before = [_shared(key, other) for key, other in zip(pdf["first"], pdf["before"])]
            after = [_shared(key, other) for key, other in zip(pdf["last"], pdf["after"])]
            yield pd.DataFrame({"task": pdf["task"], "before": before, "after": after})

    return {r.task: (r.before, r.after) for r in ends.mapInPandas(count, "task int, before int, after int").collect()}


def _shared(key: bytes, other: bytes | None) -> int:
    if other is None:
        return 0
    turns = range(0, min(len(key), len(other)), TURN)
    return 1 + next((i for i, at in enumerate(turns) if key[at : at + TURN] != other[at : at + TURN]), len(turns))


def _whole(parts: DataFrame) -> DataFrame:
    columns = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
    split, alone = parts.where("node is not null"), parts.where("node is null")
    ends = split.where("ends is not null").select("node", "task", "ends").repartition("node")
    ends = ends.sortWithinPartitions("node", "task").mapInArrow(_hash_in_order, "node binary, hashed string")
    joined = split.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )
    joined = joined.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("hashed", F.lit(NOTHING)))
    joined = written(joined, "trie-split")
    parents = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    under = alone.where("parent is not null").drop("parent_conv_id").join(parents, "parent")
    top = joined.join(parents, "parent", "left")
    return alone.where("parent is null").select(*columns).union(under.select(*columns)).union(top.select(*columns))


@dataclass
class _Below:
    """What is known of the keys under a place in the tree."""

    n: int = 0
    conv: int | None = None
    leaves: int = 0
    saved: int = 0
    children: int = 0  # nodes of the next depth that begin in this range
    waiting: list = field(default_factory=list)  # rows of nodes that do not know their parent yet
    keys: tuple[int, int] | None = None  # numbers of the first and the last key

    def add(self, other: _Below) -> None:
        self.n += other.n
        self.conv = other.conv if self.conv is None else min(self.conv, other.conv)
        self.leaves += other.leaves
        self.saved += other.saved
        self.children += other.children
        self.waiting += other.waiting
        self.keys = other.keys if self.keys is None else (self.keys[0], other.keys[1])


def _part(pdf: pd.DataFrame, before: int, after: int) -> pd.DataFrame:
    """Nodes of the keys of one range, in the columns of ``_PART``; see :func:`_cuts`."""
    pdf = pdf.sort_values("nth")
    keys, words, members = [], [], []
    for key, counts, conv in zip(pdf["key"], pdf["words"], pdf["conv_id"]):
        if not keys or keys[-1] != key:
            keys.append(bytes(key))
            words.append(np.asarray(counts, np.int64))
            members.append([])
        members[-1].append(int(conv))
    tree = RadixTree()
    for number, key in enumerate(keys):
        tree.insert(key, number)
    split_before, split_after = _names(keys[0], before), _names(keys[-1], after)
    task, rows = int(pdf["task"].iloc[0]), []

    def emit(below: _Below, depth: int, own: list[int] | None) -> None:
        """Add the node of ``depth`` turns above what is below, and step over it."""
        first, last = below.keys
        began = first == 0 and depth < len(split_before)
        goes_on = last == len(keys) - 1 and depth < len(split_after)
        # The first key after the range may be the same one or go on from it: then who holds the last one says.
        if not below.waiting and not goes_on:
            below.leaves += 1
        said = int(words[first][depth - 1]) if depth else 0
        below.saved += said * (below.n - (not began))
        name = split_before[depth] if began else split_after[depth] if goes_on else None
        ends = ",".join(map(str, own)).encode() if own else None
        hashed = hashlib.sha256(ends or b"").hexdigest() if name is None else None
        row = [below.conv, depth, None, below.n, below.children, below.leaves, below.saved, hashed]
        row += [name, None, ends if name else None, task]
        for child in below.waiting:
            child[2 if name is None else 9] = below.conv if name is None else name
        rows.append(row)
        below.waiting, below.children = [row], int(not began)

    open_nodes: dict[int, list[_Below]] = {}
    for node, top in tree.from_below():
        bottom, below = top + len(node.path), _Below()
        own = None
        if node.value is not None:
            own = members[node.value]
            below.add(_Below(len(own), own[0], keys=(node.value, node.value)))
        for part in open_nodes.pop(bottom, []):
            below.add(part)
        # Nodes are where turns end: at the end of this path, and within it where it is compressed.
        for end in range(bottom - bottom % TURN, -1 if node is tree.root else top, -TURN):
            emit(below, end // TURN, own if end == bottom else None)
        open_nodes.setdefault(top, []).append(below)
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PART.split(", ")]).astype({"parent_conv_id": "Int64"})


def _names(key: bytes, prefixes: int) -> list[bytes]:
    """Names of the first so many turn-aligned prefixes of a key, by depth."""
    state, names = hashlib.blake2b(digest_size=TURN), []
    for depth in range(prefixes):
        state.update(key[TURN * max(0, depth - 1) : TURN * depth])
        names.append(state.digest())
    return names


def _hash_in_order(batches):
    """The hash of each node's parts, joined by commas; rows come sorted by node and range."""
    node, state = None, None
    for batch in batches:
        done = []
        for name, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(ends)
            else:
                state.update(b",")
                state.update(ends)
        if done:
            yield _hashed(done)
    if node is not None:
        yield _hashed([(node, state.hexdigest())])


def _hashed(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    nodes, hashes = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes)], ["node", "hashed"])
