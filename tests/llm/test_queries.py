"""The registered queries that SQL can express, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from skyledger.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def shown(value) -> str:
    if isinstance(value, float):
        return "" if value != value else f"{value:.9g}"
    return "" if value is None else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        db.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    wanted = db.sql(ORACLES[name])
    columns = sorted(wanted.columns)
    rows = [dict(zip(wanted.columns, r, strict=True)) for r in wanted.fetchall()]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == columns
    got = sorted(tuple(shown(r[c]) for c in columns) for r in found.collect())
    assert got == sorted(tuple(shown(r[c]) for c in columns) for r in rows)


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
