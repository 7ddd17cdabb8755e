"""Every named query next to its SQL, at the smallest scale."""
import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for file in SF.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "-"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return f"{value:.10g}" if isinstance(value, float) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, str(SF))
    got = table(df.columns, df.collect())
    if name in oracle_sql():
        result = db.execute(oracle_sql()[name])
        assert got == table([c[0] for c in result.description], result.fetchall())
    else:
        assert got[1]


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["day", "source", "n", "avg_compound", "n_pos", "n_neg"]
