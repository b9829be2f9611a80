"""Every registered query against its DuckDB statement on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import SPARK_TO_DUCK, TABLES, frame_hash  # noqa: E402

from conftest import SF001  # noqa: E402

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF001}/{t}.parquet"
        if os.path.exists(path):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in df.schema.fields}
    assert types == {c: str(t) for c, t in zip(res.columns, res.types)}
    drows = res.fetchall()
    assert len(rows) == len(drows)
    assert frame_hash(df.columns, rows)[0] == frame_hash(list(res.columns), drows)[0]


def test_rows_only_query_runs(spark):
    assert E.queries()["random_split_native"](spark, SF001).count() == 1000
