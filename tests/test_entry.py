import importlib
import os
import sys

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def _rows(frame):
    columns = sorted(frame.columns)
    text = lambda v: "" if v is None or v != v else f"{v:.9f}" if isinstance(v, float) else str(v)
    return columns, sorted(tuple(map(text, r)) for r in frame[columns].astype(object).itertuples(index=False))


def test_queries_equal_their_sql(spark, duck):
    from postalith.plans import queries

    assert set(queries.QUERIES) == set(queries.ORACLE)
    for name, run in queries.QUERIES.items():
        assert _rows(run(spark, DATA).toPandas()) == _rows(duck.sql(queries.ORACLE[name]).df()), name


def test_entry_imports_without_the_optional_parts(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("postalith.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "postalith.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert "rank_locations" in entry.queries() and not any(n.startswith("op") and n[2].isdigit() for n in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
