"""Every query with a SQL statement gives the statement's rows."""
import pandas as pd
import pytest

from respengine.llm.oracle import ORACLE_SQL
from respengine.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_oracle(spark, oracle, name):
    want = oracle(ORACLE_SQL[name])
    got = QUERIES[name](spark, "/root/testdata/sf0.01").toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    got, want = (d[cols].sort_values(cols, ignore_index=True) for d in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-12)
