import importlib
import sys

import pytest



def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_optional_parts(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("leafmill.llm") or n in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "leafmill.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert "chunks" in entry.queries() and not any(n.startswith("op") or n == "pipeline" for n in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def rows_of(df):
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for _, v in sorted(r.items())) for r in df)


@pytest.mark.parametrize("name", ["md_blocks", "bbox_match", "logical_tables", "heading_path", "caption_link", "column_assign", "md_table_parse"])
def test_queries_match_sql(spark, name):
    import duckdb

    from leafmill.plans import catalogue

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "part", "orders", "customer", "lineitem", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    found = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = [dict(zip(names, row, strict=True)) for row in found.fetchall()]
    got = [r.asDict() for r in catalogue.queries()[name](spark, sf).collect()]
    assert rows_of(got) == rows_of(want)
