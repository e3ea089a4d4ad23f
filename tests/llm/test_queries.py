"""Queries that SQL can express, against their SQL, on the smallest tables; the
others run and give a row per document."""

import pytest

from gaugeline.llm.queries import ORACLES, QUERIES
from oracle_check import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op9_decontaminate"}))
def test_a_row_per_document(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = QUERIES[name](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_nothing_else_imports_the_text_operators():
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("gaugeline/**/*.py"), *root.glob("catalog/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"gaugeline\.llm|corpus_pipeline", path.read_text()), path
