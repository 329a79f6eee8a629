"""What the operators share: written intermediate tables, word counts, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream import storage

#: White space of the contracts: space and the controls from tab to carriage return.
SPACE = "\\x20\\x09-\\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder and read it back, so that lost executors recompute nothing
    before it and every later pass sees the same rows."""
    spark = df.sparkSession
    path = storage.scratch_dir(spark, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once even where ``body`` uses it inside other functions' lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    while name.lower() in [c.lower() for c in columns]:
        name = f"_{name}"
    return name


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): one row (node, root) for every node of an edge between two
    nodes, the root its component's smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), whose rounds grow with the logarithm
    of the longest path. Every round is written to the shared folder.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, purpose)
    while not _stars(e):
        # Large star: every larger neighbour of a node is tied to the smallest of the neighbourhood.
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The minima are written, so that adaptive execution can split a node with very many neighbours in the join.
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), purpose)
        tied = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = written(tied.distinct(), purpose)
        # Small star: the smaller neighbours of a node, and the node, are tied to the smallest of them.
        least = written(tied.groupBy("a").agg(F.min("b").alias("m")), purpose)
        others = tied.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(others.union(least.toDF("a", "b")).distinct(), purpose)
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """True if no node has two smaller neighbours, nor a smaller and a larger one."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()
