import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = pathlib.Path(entry.__file__).parent


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for n in (2, 3, 5):
        assert f"p{n}_found" in entry.queries()


def test_core_stands_alone():
    for path in (ROOT / "strandmill").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"strandmill\.llm|from \.+llm", path.read_text()), path


def rows(cells, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    clean = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted(repr(tuple(clean(r[k]) for k in order)) for r in cells)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in pathlib.Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    df = entry.queries()[name](spark, data)
    assert sorted(names) == sorted(df.columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(found.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_other_queries_run(spark, data, name):
    assert entry.queries()[name](spark, data).count() > 0


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["line_id", "reason"] and df.count() > 0
