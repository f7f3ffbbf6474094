"""Every query with SQL against DuckDB on the smallest tables, as the driver does on larger ones."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


def kinds(types) -> list[str]:
    return ["int" if t.lower() in ("int", "bigint", "integer", "long") else "text" if t.lower() in ("string", "varchar") else t.lower() for t in types]


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    out = entry.queries()[name](spark, DATA)
    columns = sorted(out.columns)
    wanted = duck.sql(entry.oracle_sql()[name])
    assert sorted(wanted.columns) == columns
    kind = dict(zip(wanted.columns, map(str, wanted.types), strict=True))
    assert kinds(kind[c] for c in columns) == kinds(dict(out.dtypes)[c] for c in columns)
    ours = sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str)
    theirs = sorted((tuple(r[wanted.columns.index(c)] for c in columns) for r in wanted.fetchall()), key=str)
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_tables_in_parts_are_tables(spark, tmp_path):
    for k, t in enumerate(TABLES):
        own = tmp_path / f"{t}.parquet"
        if k % 2:
            own.mkdir()
            own /= "part-0000.parquet"
        own.touch()
    (tmp_path / "notes.txt").touch()
    assert sorted(r.path for r in entry.queries()["tree_files"](spark, str(tmp_path)).collect()) == sorted(f"{t}.parquet" for t in TABLES)
