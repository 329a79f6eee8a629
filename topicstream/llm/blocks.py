"""Comparing the members of groups of any size, block by block."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm import bloom
from topicstream.llm.common import components, written

_BLOCKS_AT_A_TIME = 3


def connect(
    near: DataFrame, rows: DataFrame, links: Callable[[pd.DataFrame], pd.DataFrame], block: int, purpose: str
) -> DataFrame:
    """Links (a, b) that connect within each group of ``near`` (node, root) what pairwise comparison would connect.

    ``rows`` has a column ``row``, the node (not negative), and what ``links`` needs. ``links`` gets up to two blocks of about
    ``block`` rows of a group, with their block numbers in ``k``, and returns links that connect what is linked; if ``i`` and
    ``j`` differ, it need only compare rows of different blocks. Groups of one block are handed over several at a time.

    A large group is compared in two rounds. First all blocks are compared with one of them. That connects most of a
    group of near copies, and what is connected already need not be compared again: the second round compares the
    blocks of the rows outside the group's largest class with each other and with the blocks of that class.
    """
    sizes = written(near.groupBy("root").agg(F.count("*").alias("size")), f"{purpose}-sizes")
    many = F.ceil(F.col("size") / block).cast("int")
    small = sizes.where(F.col("size") <= block).agg(F.sum("size")).first()[0] or 0
    bins = F.lit(max(1, small // (_BLOCKS_AT_A_TIME * block)))
    members = near.join(sizes, "root").select(
        F.col("node").alias("row"),
        F.when(many == 1, -1 - F.pmod(F.xxhash64("root"), bins)).otherwise(F.col("root")).alias("root"),
        _number("node", many).alias("k"),
        F.lit(1).alias("front"),
        many.alias("blocks"),
    )
    members = written(members, f"{purpose}-members")
    first = _compared(members, rows, links, purpose)
    large = members.where("blocks > 1").select("row", "root")
    if large.isEmpty():
        return first

    joined = components(first, f"{purpose}-classes").withColumnRenamed("root", "class")
    named = written(
        large.join(joined, large["row"] == joined["node"], "left").select(
            "row", "root", F.coalesce("class", "row").alias("class")
        ),
        f"{purpose}-named",
    )
    of_class = named.groupBy("root", "class").agg(F.count("*").alias("n"))
    largest = of_class.groupBy("root").agg(
        F.max_by("class", F.struct("n", "class")).alias("largest"), F.max("n").alias("inside"), F.sum("n").alias("size")
    )
    largest = written(largest.where("size > inside"), f"{purpose}-largest")
    front = F.ceil((F.col("size") - F.col("inside")) / block).cast("int")
    behind = F.ceil(F.col("inside") / block).cast("int")
    outside = F.col("class") != F.col("largest")
    number = F.when(outside, _number("row", front)).otherwise(front + _number("row", behind))
    again = named.join(largest, "root").select(
        "row", "root", number.alias("k"), front.alias("front"), (front + behind).alias("blocks")
    )
    return first.union(_compared(written(again, f"{purpose}-again"), rows, links, purpose))


def _number(node: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(node), blocks).cast("int")


def _compared(members: DataFrame, rows: DataFrame, links, purpose: str) -> DataFrame:
    """Links of all pairs of blocks of which one is among the first ``front`` of its group."""
    wanted = bloom.contained_in(members.select("row"))
    upto = F.when(F.col("k") < F.col("front"), F.col("blocks")).otherwise(F.col("front"))
    placed = (
        rows.where(wanted("row"))
        .join(members, "row")
        .select(*rows.columns, "root", "k", F.explode(F.sequence(F.lit(0), upto - 1)).alias("other"))
        .select(*rows.columns, "root", "k", F.least("k", "other").alias("i"), F.greatest("k", "other").alias("j"))
    )
    found = placed.groupBy("root", "i", "j").applyInPandas(links, "a long, b long")
    return written(found, f"{purpose}-links")
