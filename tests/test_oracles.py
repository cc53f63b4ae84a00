"""Every query against its SQL on the given tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from skyledger.oracles import ORACLES
from skyledger.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, duck, key):
    df = queries()[key](spark, SF_DIR)
    relation = duck.sql(oracle_sql()[key])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    spark_types = {name: TYPES[kind] for name, kind in df.dtypes}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    assert spark_types == duck_types
    got = ordered([tuple(r[c] for c in columns) for r in df.collect()])
    order = [relation.columns.index(c) for c in columns]
    want = ordered([tuple(r[i] for i in order) for r in relation.fetchall()])
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if isinstance(a, float) and math.isnan(a):
                assert math.isnan(b)
            else:
                assert a == b, (g, w)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_clusters_cover_all_stations(spark):
    rows = queries()["kmeans_stations"](spark, SF_DIR).collect()
    known = spark.read.parquet(f"{SF_DIR}/supplier.parquet").filter("s_acctbal >= 0").count()
    assert len(rows) == known
    assert 1 < len({r["cluster"] for r in rows}) <= 10
