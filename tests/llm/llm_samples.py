"""Rows and fixtures that the tests of the corpus operators share."""

from __future__ import annotations

import os
import re
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
LONG = "word and " * 40_000
# Nulls in every column, empty and blank texts, a very long one, repeated rows and ids, and ties.
ODD = [
    (1, "The same text, twice over, here and there", "a"),
    (2, "The same\ttext,  twice over, here and there", "a"),
    (2, "The same\ttext,  twice over, here and there", "a"),
    (3, None, None),
    (4, "", "b"),
    (5, " \n\t ", "b"),
    (6, LONG, "c"),
    (7, LONG + "tail", "c"),
    (None, "The same text, twice over, here and there", "a"),
    (None, "a text without an id", None),
    (8, "Ünïcödé 数据总线 😀😀 text " * 30, "a"),
    (8, "another text with the id of the one before", "a"),
    (9, "word", "b"),
]
#: Extra columns whose names clash with those of results and of intermediate steps.
CLASHES = ("row", "node", "kept", "size", "taken", "length", "score", "h", "key", "range", "next", "w", "at")


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    paths = [ROOT, spark.sparkContext.environment.get("PYTHONPATH", "")]
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashes=True):
        docs = spark.createDataFrame(
            [(i, text, "en", source, None if text is None else len(text)) for i, text, source in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
        if clashes:
            docs = docs.selectExpr("*", *[f"cast(null as string) as `{c}`" for c in CLASHES])
        return docs

    return make


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
