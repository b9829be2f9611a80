import re

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 7
    assert set(df.columns) == {"split", "features", "model", "metric", "value", "text"}


def test_registry_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    own = {q for q in qs if not re.match(r"op\d+_|pipeline$", q)}
    assert own - set(sql) == {"random_split_native"}


def test_grid_search_best_is_first_minimum(spark):
    df = E.queries()["grid_search"](spark, "/root/testdata/sf0.001")
    rows = sorted(df.collect(), key=lambda r: r["grid_pos"])
    best = [r for r in rows if r["is_best"]]
    assert len(best) == 1
    assert best[0]["log_loss"] == min(r["log_loss"] for r in rows)
