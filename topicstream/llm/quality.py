"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader steps.

Features of a text are its words and word pairs, and the same of the words' shapes (case, digits, punctuation, whether a
word repeats the one before), hashed into a fixed number of places and counted as shares. A score is the logistic of a
sparse dot product. Training uses a bounded sample of labelled rows, in shards that Spark trains side by side and whose
weights are averaged.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import text_or_empty

BITS = 18
MAX_ROWS = 24_000
SHARDS = 8
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2  # fixed values of the contract
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_REMEMBERED = 300_000
_FLUSH = 8 << 20


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 2 by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
    max_rows: int = MAX_ROWS,
    shards: int = SHARDS,
    bits: int = BITS,
    epochs: int = 4,
) -> np.ndarray:
    """Weights learnt from the rows of ``labelled`` with label 0 or 1; rows with another label or null are left out.

    ``max_rows`` bounds the sample: rows whose hashed id is below the share that gives about so many, whole texts. The
    weights are 2^bits numbers and a bias, whatever the size of the table. With no rows all weights are 0, which scores
    everything 0.5.
    """
    rows = labelled.select(
        F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("h"),
        text_or_empty(text_col).alias("text"),
        F.col(f"`{label_col}`").cast("int").alias("label"),
    ).where("label in (0, 1)")
    n = rows.count()
    share = min(1.0, max_rows / n) if n else 1.0
    sample = rows.where(F.col("h").bitwiseAND(0xFFFFF) < int(share * (1 << 20)))
    shard = F.shiftrightunsigned("h", 24) % shards
    trained = (
        sample.select(shard.cast("int").alias("shard"), "h", "text", "label")
        .groupBy("shard")
        .applyInPandas(lambda pdf: _train_shard(pdf, bits, epochs), "shard int, n long, weights binary")
        .collect()  # one row of bounded size for each of a fixed number of shards
    )
    weights = np.zeros((1 << bits) + 1)
    total = sum(row.n for row in trained)
    for row in trained:
        weights += np.frombuffer(row.weights, np.float32) * (row.n / total)
    return weights.astype(np.float32)


def score(
    docs: DataFrame,
    weights: np.ndarray,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row (doc_id, held_out, score, predicted) for every row of ``docs``, from its whole text.

    A null text is an empty one; it has no features, so its score is that of the bias. Other columns are not used.
    """
    doc_id = F.col(f"`{id_col}`").alias("doc_id")
    rows = docs.select(doc_id, held_out(doc_id).alias("held_out"), text_or_empty(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double"
    scored = rows.mapInArrow(lambda batches: _score_batches(batches, shared), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_accepted(
    docs: DataFrame, weights: np.ndarray, *, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs``, all columns, without the rows that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        return pd.Series([_score(text, shared.value) >= threshold for text in texts], dtype=bool)

    return docs.where(accepted(text_or_empty(text_col)))


class _Words(dict):
    """Hash and shape of each token, remembered."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) > _REMEMBERED:
            self.clear()
        shape = _hash(_shape(token))
        self[token] = found = (_hash(token), shape)
        return found


@cache
def _words() -> _Words:
    return _Words()


def _hash(text: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text)


def _shape(token: str) -> str:
    if not token[0].isalnum():
        return token[:3]
    if token.isdigit():
        return "0"
    return "AA" if token.isupper() and len(token) > 1 else "Aa" if token[0].isupper() else "a" if token.islower() else "aA"


def features(text: str, bits: int) -> np.ndarray:
    """Places of all n-grams of the text, repeats included: words, pairs, shapes, pairs and triples of shapes."""
    found = list(map(_words().__getitem__, _TOKEN.findall(text)))
    if not found:
        return np.zeros(0, np.int64)
    pairs = np.array(found, np.uint64)
    word, shape = pairs[:, 0], pairs[:, 1].copy()
    shape[1:][word[1:] == word[:-1]] = 1  # the shape of a word that repeats the one before
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    grams = [word, word[:-1] * a + word[1:], shape + c, shape[:-1] * a + shape[1:] + c]
    if len(shape) > 2:
        grams.append((shape[:-2] * a + shape[1:-1]) * b + shape[2:])
    mixed = np.concatenate(grams) * b
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _score(text: str, weights: np.ndarray) -> float:
    places = features(text, (len(weights) - 1).bit_length() - 1)
    margin = float(weights[-1])
    if len(places):
        margin += _scale(len(places)) * float(weights[places].sum(dtype=np.float64))
    return 1.0 / (1.0 + np.exp(-margin))


def _scale(n: int) -> float:
    return 20.0 / n


def _score_batches(batches, shared):
    for batch in batches:
        texts = batch.column(2)
        scores = [_score(text.as_py(), shared.value) for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"]
        )


def _train_shard(pdf: pd.DataFrame, bits: int, epochs: int) -> pd.DataFrame:
    """Per-coordinate follow-the-regularised-leader (McMahan et al. 2013) over the rows in the order of their hashes."""
    alpha, beta, l1, l2 = 0.5, 1.0, 0.002, 0.01
    pdf = pdf.sort_values(["h", "text", "label"])
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = []
    for text, label in zip(pdf["text"], pdf["label"]):
        places, counts = np.unique(features(text, bits), return_counts=True)
        values = np.append(counts * (_scale(int(counts.sum())) if len(counts) else 0.0), 1.0)
        rows.append((np.append(places, size).astype(np.int32), values.astype(np.float32), float(label)))

    def weights_at(places):
        at = z[places]
        return np.where(np.abs(at) <= l1, 0.0, (np.sign(at) * l1 - at) / ((beta + np.sqrt(n[places])) / alpha + l2))

    for _ in range(epochs):
        for places, values, label in rows:
            w = weights_at(places)
            slope = (1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            square = slope * slope
            z[places] += slope - (np.sqrt(n[places] + square) - np.sqrt(n[places])) / alpha * w
            n[places] += square
    weights = weights_at(np.arange(size + 1)).astype(np.float32)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "n": [len(pdf)], "weights": [weights.tobytes()]})
