"""Every registered query against its SQL in DuckDB."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points
from conftest import TESTDATA

from topicstream.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = entry_points.queries()[name](spark, TESTDATA)
    result = duck.sql(entry_points.oracle_sql()[name])
    types = dict(zip(result.columns, map(str, result.types)))
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in found.schema} == types
    columns = sorted(types)
    actual = [tuple(row[c] for c in columns) for row in found.collect()]
    places = [result.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    assert expected


def test_entry(spark):
    assert entry_points.entry(spark).count() == 4


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_corpus_operators(tmp_path, pipeline):
    """The subpackage may be taken away, with or without the pipeline beside it."""
    here = Path(entry_points.__file__).resolve().parent
    shutil.copytree(here / "topicstream", tmp_path / "topicstream", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])]:
        if (here / name).exists():
            shutil.copy(here / name, tmp_path)
    program = "import __spark_entry__ as e, topicstream; print(topicstream.__file__, *e.queries()); e.oracle_sql()"
    run = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    origin, *names = run.stdout.split()
    assert origin.startswith(str(tmp_path)) and set(names) == set(catalog.QUERIES)
