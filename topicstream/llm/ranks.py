"""Ranks within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from topicstream.llm.common import written

_ROWS = (1 << 33) - 1


def sorted_in_ranges(df: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``df`` sorted by ``order`` and written, with the number ``task`` of each row's range and its place ``nth`` in it.

    Ranges follow one another in the order and are about equally large, whatever the groups are: a group that holds a
    third of all rows lies in a third of the ranges. Rows that agree in ``order`` share a range.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    rows = rows.select("*", F.shiftright(number, 33).cast("int").alias("task"), number.bitwiseAND(_ROWS).alias("nth"))
    return written(rows, purpose)


def ranked(df: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """``df`` with each row's ``rank`` from 0 in its group and the group's ``size``. ``group`` holds no nulls.

    Only a row for every range and group of it goes through a window.
    """
    placed = sorted_in_ranges(df, [group, *order], purpose)
    parts = placed.groupBy(group, "task").agg(F.min("nth").alias("first"), F.count("*").alias("rows"))
    parts = written(parts, f"{purpose}-parts")
    before = F.sum("rows").over(W.partitionBy(group).orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("rows").over(W.partitionBy(group))
    starts = parts.select(group, "task", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), total.alias("size"))
    return placed.join(starts, [group, "task"]).select(*df.columns, (F.col("nth") + F.col("shift")).alias("rank"), "size")
