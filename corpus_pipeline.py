"""A corpus from raw documents to packed sequences, in five stages of the corpus operators.

Every stage takes all rows that the one before kept, is written as Parquet in the cluster's shared folder and read again.
All stages but the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.llm import exact_dedup, mixing, near_dedup, packing, quality, queries
from topicstream.llm.common import unused, word_count, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts, learnt from the labelled ones among them."""
    return quality.keep_accepted(docs, queries.train_quality(spark, docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that differ in white space at most, the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word shingles, the one with the smallest id."""
    return near_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for: not at all, once or twice."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = unused("row", ["id", "source", "size", *mixing.RESULT])
    sized = docs.select(
        F.struct(*columns).alias(row),
        F.col("doc_id").alias("id"),
        F.col("source"),
        word_count(F.col("text").cast("string")).alias("size"),
    )
    mixed = mixing.mix(sized, id_col="id")
    return mixed.where("copies > 0").select(row, F.explode(F.sequence(F.lit(1), "copies"))).select(f"{row}.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences of 2048."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: A learnt classifier and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
