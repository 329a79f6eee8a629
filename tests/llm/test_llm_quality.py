"""The quality classifier against a plain trainer: dictionaries, one weight at a time."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import make_docs, sample, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from topicstream.llm import quality

MASK = (1 << 64) - 1
A, B, C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
BITS = 12


def shape_of(token: str) -> str:
    if not token[0].isalnum():
        return token[:3]
    if token.isdigit():
        return "0"
    if token.isupper() and len(token) > 1:
        return "AA"
    return "Aa" if token[0].isupper() else "a" if token.islower() else "aA"


def plain_features(text: str) -> dict[int, float]:
    tokens = re.findall(r"\w+|[^\w\s]+", text)
    words = [xxh64_intdigest(t) for t in tokens]
    shapes = [xxh64_intdigest(shape_of(t)) for t in tokens]
    for i in range(1, len(words)):
        if words[i] == words[i - 1]:
            shapes[i] = 1
    grams = words + [x * A + y for x, y in zip(words, words[1:])] + [s + C for s in shapes]
    grams += [x * A + y + C for x, y in zip(shapes, shapes[1:])]
    grams += [(x * A + y) * B + z for x, y, z in zip(shapes, shapes[1:], shapes[2:])]
    counts = Counter((g * B & MASK) >> (64 - BITS) for g in grams)
    return {place: 20.0 * n / len(grams) for place, n in counts.items()}


def plain_weights(rows: list[tuple[str, int]], epochs: int) -> dict[int, float]:
    """Follow the regularised leader, coordinate by coordinate; the bias is place -1."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(place):
        if abs(z[place]) <= 0.002:
            return 0.0
        return (math.copysign(0.002, z[place]) - z[place]) / ((1.0 + math.sqrt(n[place])) / 0.5 + 0.01)

    for _ in range(epochs):
        for text, label in rows:
            values = plain_features(text) | {-1: 1.0}
            held = {place: weight(place) for place in values}
            margin = sum(held[place] * value for place, value in values.items())
            off = 1 / (1 + math.exp(-max(-35.0, min(35.0, margin)))) - label
            for place, value in values.items():
                slope = off * value
                z[place] += slope - (math.sqrt(n[place] + slope**2) - math.sqrt(n[place])) / 0.5 * held[place]
                n[place] += slope**2
    return {place: weight(place) for place in z}


@pytest.mark.parametrize("shards", [1, 3])
def test_training_and_scores_are_those_of_the_plain_trainer(spark, sample, shards):
    texts = [(r.doc_id, (r.text or "")[:1500], r.doc_id % 3 != 0) for r in sample.orderBy("doc_id").limit(60).collect()]
    texts += [(1000, "", True), (1001, "one", False), (1002, "one one one", True), (1003, "Repeated REPEATED repeated 12 !!", False)]
    labelled = spark.createDataFrame([(i, t, int(label)) for i, t, label in texts], "doc_id long, text string, label int")
    found = quality.train(labelled, bits=BITS, shards=shards, epochs=2)
    hashed = labelled.select(F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "text", "label")
    hashed = hashed.withColumn("shard", F.shiftrightunsigned("h", 24) % shards).collect()
    expected = np.zeros((1 << BITS) + 1)
    for shard in range(shards):
        rows = sorted((r.h, r.text, r.label) for r in hashed if r.shard == shard)
        for place, weight in plain_weights([row[1:] for row in rows], 2).items():
            expected[place] += weight * len(rows) / len(texts)
    assert np.abs(expected).max() > 0.1
    np.testing.assert_allclose(found, expected, rtol=1e-3, atol=1e-4)
    scores = {r.doc_id: r.score for r in quality.score(labelled, found).collect()}
    for doc_id, text, _ in texts:
        margin = expected[-1] + sum(expected[place] * value for place, value in plain_features(text).items())
        assert scores[doc_id] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-3)
