"""Exact duplicates by two passes over Bloom filters.

The first pass builds a pair of Bloom filters in every task: bits set by one text, and bits set by more than one. Pairs
merge in any order (a bit set in two tasks counts as set twice), block by block on the executors. A text that occurs
twice has all its bits set twice, so the second pass lets every row pass straight through that has a bit which was set
only once; the rest, and only those, are shuffled by digest and compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm import bloom
from topicstream.llm.common import SPACE, text_or_empty, written


def digest(text: str) -> Column:
    """SHA-256 of the text with every run of white space as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(text_or_empty(text), f"[{SPACE}]+", " "), 256)


def exact_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = bloom.MAX_BYTES
) -> DataFrame:
    """One row (doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when identical after each run of white space became one space; of equal texts the row with the
    smallest id stays. A null text is an empty one. A null id comes after all others: its group is kept under another
    id if it has one. Rows that repeat both id and text are rows of one group, of which one stays. An empty table
    gives an empty result. Other columns of ``docs`` are ignored, whatever their names.

    ``max_filter_bytes`` bounds what is broadcast. The filter has 16 bits a row up to that bound; beyond it more
    rows than needed are shuffled (an id and a digest each), and the result is the same.
    """
    rows = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest(text_col).alias("text_sha256")), "digests")
    key = F.xxhash64("text_sha256")
    flagged = rows.withColumn("repeated", bloom.repeated_in(rows.select(key.alias("key")), max_filter_bytes)(key))
    counted = written(flagged.where("repeated").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("n")), "repeats")
    # Written, so that both sides of the join are plain exchanges and adaptive execution can split a hot digest.
    groups = written(
        counted.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")), "groups"
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")
    among = (
        counted.join(groups, "text_sha256")
        .select("*", copies)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    alone = flagged.where("not repeated").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(among)


def keep_first(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = bloom.MAX_BYTES
) -> DataFrame:
    """``docs``, all columns, without the rows that :func:`exact_dedup` does not keep.

    Of rows with the same id and equal texts, the one with the smallest raw text stays.
    """
    row, key = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest(text_col).alias("key")
    rows = docs.select(row, key)
    short = F.xxhash64("key")
    flagged = rows.withColumn("repeated", bloom.repeated_in(rows.select(short.alias("short")), max_filter_bytes)(short))
    doc_id, text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    first = F.min_by("row", F.struct(doc_id.isNull(), doc_id, text))
    kept = flagged.where("repeated").groupBy("key").agg(first.alias("row")).select("row")
    return flagged.where("not repeated").select("row").union(kept).select("row.*")
