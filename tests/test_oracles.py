"""Every query of the library against its DuckDB SQL, at the smallest scale."""

import os

import duckdb
import pytest

from lodestone.plans import decoders  # noqa: F401  registers its queries
from lodestone.plans.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(cols).collect())
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


@pytest.mark.parametrize(
    ("name", "rule", "wrong"),
    [
        ("header_rows", "has_header", lambda rows: not all(isinstance(c, str) for c in rows[1])),
        ("table_regions", "regions", lambda rows: [[r] for r in rows if r]),
        ("table_regions", "regions", lambda rows: [rows]),
    ],
)
def test_sheet_queries_reach_the_decoder(spark, duck, monkeypatch, name, rule, wrong):
    """An error in the decoder's rule shows in the query."""
    from lodestone.plans import queries

    want = duck.sql(SQL[name])
    rows = sorted(map(repr, want.fetchall()))
    monkeypatch.setattr(queries, rule, wrong)
    assert sorted(repr(tuple(r)) for r in QUERIES[name](spark, DIR).select(want.columns).collect()) != rows


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
