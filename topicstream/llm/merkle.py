"""Merkle manifest of a dataset by checkpoint-and-recompute.

Every group of rows is a tree of runs of eight, and the groups' roots are the leaves of one more tree. Of each tree only
every second level is written (``STRIDE``). A proof needs the levels between as well: they are made again, for one
aligned subtree of at most 64 stored nodes at a time, from its stored descendants, and dropped once the siblings are
out. So what is stored is a 64th of the leaves for the first level above them, a 4096th for the next and so on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import let, lower_ascii, written
from topicstream.llm.ranks import ranked

RUN = 8  # fixed value of the contract: nodes under one parent
STRIDE = 2  # levels from one that is stored to the next
_BLOCK = RUN**STRIDE
NO_GROUP = "-"  # sorts before every name, as those begin with "="
PATH = "array<struct<before: string, after: string>>"


@dataclass(frozen=True)
class Forest:
    """Trees of hashes. ``stored[i]`` holds the nodes of level ``i * STRIDE``: tree, rank, node, and the tree's height."""

    stored: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        """One row (tree, node) for each tree."""
        return self.stored[-1].select("tree", "node")


@dataclass(frozen=True)
class Manifest:
    """``leaves``: one row for each row of the dataset. ``groups``: a tree for each group. ``top``: the tree over their roots."""

    leaves: DataFrame
    groups: Forest
    top: Forest


def digest(columns: Sequence[Column]) -> Column:
    """Hash of values, each ``-`` if null, else its length in UTF-8 bytes, a colon, and the value as text."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def manifest(rows: DataFrame, group: str, order: list[str]) -> Manifest:
    """The manifest of ``rows``, which have a hash ``leaf``; leaves of a group ascend by ``order``, nulls first.

    Rows that agree in ``order`` follow their leaf, so equal rows may change places without a change of any hash.
    A null group is a group of its own and comes first, the others follow bytewise. Without rows there is no root.
    """
    name = F.col(f"`{group}`").cast("string")
    tree = F.coalesce(F.concat(F.lit("="), name), F.lit(NO_GROUP))
    # A number of its own keeps equal rows from all landing in one range.
    rows = written(rows.select("*", tree.alias("tree"), F.monotonically_increasing_id().alias("number")), "merkle-leaves")
    placed = ranked(rows, "tree", [*order, "leaf", "number"], "merkle-order").drop("number")
    leaves = written(placed.withColumnRenamed("leaf", "node").withColumn("height", _height(F.col("size"))), "merkle-ranks")
    groups = _grow(leaves.select("tree", "rank", "node", "height"))
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    top = ranked(roots, "tree", ["of"], "merkle-groups").withColumn("height", _height(F.col("size")))
    return Manifest(leaves, groups, _grow(written(top.select("tree", "of", "rank", "node", "height"), "merkle-top")))


def _height(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(20)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), 3 * i) < size))


def _grow(leaves: DataFrame) -> Forest:
    height = leaves.agg(F.max("height")).first()[0] or 0
    stored = [leaves]
    for level in range(0, height, STRIDE):
        blocks = _blocks(stored[-1].select("tree", "rank", "node", "height"), ["node"])
        _, upper = _levels(F.col("nodes"), level)
        above = blocks.select("tree", F.col("block").alias("rank"), F.get(upper, F.lit(0)).alias("node"), "height")
        stored.append(written(above, "merkle-level"))
    return Forest(stored)


def _blocks(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """Aligned subtrees: up to 64 neighbours each, in order, as arrays. A tree of one node is left as it is."""
    block = F.floor(F.col("rank") / _BLOCK).alias("block")
    found = nodes.groupBy("tree", block, "height").agg(F.sort_array(F.collect_list(F.struct("rank", *carry))).alias("rows"))
    return found.select("tree", "block", "height", "rows", F.transform("rows", lambda r: r["node"]).alias("nodes"))


def _levels(nodes: Column, level: int) -> tuple[Column, Column]:
    """The levels one and two above ``nodes``, those of a subtree of ``level``; above its tree's height nothing changes."""
    first = F.when(F.col("height") > level, _parents(nodes)).otherwise(nodes)
    return first, let(first, lambda x: F.when(F.col("height") > level + 1, _parents(x)).otherwise(x))


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RUN).cast("int"))
    return F.transform(runs, lambda run: F.sha2(F.array_join(F.slice(nodes, run * RUN + 1, RUN), ""), 256))


def _siblings(nodes: Column, at: Column) -> Column:
    """The others of the run of node ``at``, those before it and those after it."""
    within = F.pmod(at, F.lit(RUN))
    return F.struct(
        F.array_join(F.slice(nodes, at - within + 1, within), "").alias("before"),
        F.array_join(F.slice(nodes, at + 2, RUN - 1 - within), "").alias("after"),
    )


def paths(forest: Forest, carry: list[str], above: DataFrame | None = None) -> DataFrame:
    """One row for each leaf: its tree, ``carry``, and its path: the siblings of every level from its own to the root.

    ``above`` has a row for each tree with the path (``path``) that goes on from its root, and what it is to hand down.
    """
    known, down = forest.stored[-1].select("tree", "rank"), []
    if above is None:
        known = known.withColumn("path", F.array().cast(PATH))
    else:
        known, down = known.join(above, "tree"), [c for c in above.columns if c not in ("tree", "path")]
    for i in reversed(range(len(forest.stored) - 1)):
        keep = carry if i == 0 else []
        blocks = _blocks(forest.stored[i], ["node", *(c for c in keep if c != "node")])
        # The level between is made here, used for this subtree, and not kept.
        blocks = blocks.withColumn("between", _levels(F.col("nodes"), i * STRIDE)[0])
        tops = known.withColumnRenamed("rank", "block")
        opened = blocks.join(tops, ["tree", "block"]).select(
            "tree", "height", "nodes", "between", "path", *down, F.posexplode("rows").alias("at", "row")
        )
        own = F.array(
            _siblings(F.col("nodes"), F.col("at")), _siblings(F.col("between"), F.floor(F.col("at") / RUN).cast("int"))
        )
        steps = F.least(F.lit(STRIDE), F.col("height") - i * STRIDE)
        # Trees as high as this level or less have one node here, whose path is that of the root.
        path = F.when(steps > 0, F.concat(F.slice(own, 1, F.greatest(steps, F.lit(1))), "path")).otherwise(F.col("path"))
        known = opened.select("tree", path.alias("path"), *down, "row.rank", *(F.col(f"row.`{c}`") for c in keep))
        if i:
            known = written(known, "merkle-paths")
    if len(forest.stored) == 1 and carry:
        known = known.join(forest.stored[0].select("tree", "rank", *carry), ["tree", "rank"])
    return known


def proofs(made: Manifest, carry: list[str]) -> DataFrame:
    """One row for each leaf of a manifest: ``carry``, leaf, its group's root, the dataset's root, and its path."""
    root = made.top.roots.first()
    of_groups = paths(made.top, ["of", "node"])
    of_groups = of_groups.select(F.col("of").alias("tree"), F.col("node").alias("subroot"), "path")
    leaves = Forest([made.leaves, *made.groups.stored[1:]])
    found = paths(leaves, ["node", *carry], written(of_groups, "merkle-groups-paths"))
    root = F.lit(root.node if root else None).cast("string")
    return found.select(*carry, F.col("node").alias("leaf"), "subroot", root.alias("root"), "path")


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings of a path, from left to right and from below to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def tampered(doc_id: Column) -> Column:
    """Rows whose text is changed to test the proofs."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 0, F.lit(False))


def verify_documents(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a copy gives that was tampered with in part.

    Leaves are of doc_id, source, lang, n_chars and text; groups are languages, ordered by doc_id. Nulls, empty texts, rows
    without an id and repeated rows are leaves like others; an empty table gives no rows; other columns are ignored.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    columns = [F.col(f"`{c}`") for c in fields]
    changed = F.when(tampered(F.col("doc_id")), digest([*columns[:-1], lower_ascii(F.col("text").cast("string"))]))
    rows = docs.select("doc_id", "lang", digest(columns).alias("leaf"), changed.alias("changed"))
    made = manifest(rows, "lang", ["doc_id"])
    found = proofs(made, ["doc_id", "changed"])
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
