"""The numbered queries against their SQL, and the contract of the entry file."""

import sys
from pathlib import Path

import pytest
from tools.check import connect, rows_of

import __spark_entry__ as entry
import corpus_pipeline
from martflow.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    rel = connect(SMALL).execute(queries.SQL[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, rel.fetchall())


def test_all_thirteen_and_the_pipeline_are_registered():
    known = entry.queries()
    for n in range(1, 14):
        assert [x for x in known if x.startswith(f"op{n}_")], n
    assert known["pipeline"] is corpus_pipeline.run
    assert set(entry.oracle_sql()) <= set(known)
    assert len(corpus_pipeline.STAGES) == 5


def test_nothing_else_imports_the_subpackage():
    root = Path(entry.__file__).parent
    for f in (root / "martflow").rglob("*.py"):
        if "llm" not in f.parts:
            assert "martflow.llm" not in f.read_text(), f
    assert "martflow.llm" in sys.modules
