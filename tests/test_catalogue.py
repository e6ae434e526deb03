import duckdb
import pytest

from provenant.plans import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


def shown(value):
    return "None" if value is None or value != value else repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_equals_sql(spark, oracle, name):
    got = catalogue.queries()[name](spark, DIR)
    columns = sorted(got.columns)
    rows = sorted(tuple(shown(r[c]) for c in columns) for r in got.collect())
    if name in catalogue.oracle_sql():
        want = oracle.sql(catalogue.oracle_sql()[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert rows == sorted(tuple(shown(r[i]) for i in at) for r in want.fetchall())
    else:
        assert rows


def test_nothing_outside_imports_the_llm_folder():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for p in (root / "provenant").rglob("*.py"):
        assert p.parent.name == "llm" or "provenant.llm" not in p.read_text()
