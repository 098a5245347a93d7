"""Every check query against its SQL on the smallest tables, value by value."""

import glob
import os

import duckdb
import pytest

from turnstile.checks import ORACLES, QUERIES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def comparable(rows, names):
    """Rows as sorted text, columns by name; whole numbers alike whatever their type."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if v is None:
            return "~"
        if isinstance(v, bool):
            return str(v)
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = tables.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = comparable([tuple(r) for r in df.collect()], df.columns)
    assert got == comparable(cursor.fetchall(), names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
