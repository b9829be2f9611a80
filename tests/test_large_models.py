"""Models and dictionaries that are not broadcast: weights by index range, lookups by blocks."""
import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from respengine.operators.blocks import distinct_keys
from respengine.operators.encode import build_dictionary, one_hot_encode
from respengine.operators.evaluate import evaluate_many
from respengine.operators.model import LogisticModel, fit_logistic_gd, predict, predict_many
from respengine.operators.model_ranges import fit_logistic_ranged, predict_ranged
from respengine.operators.hashing import hash_features
from respengine.operators.split import split_frames
from respengine.sources.tables import ctr_events
from respengine.sources.text import OBS_SCHEMA

from conftest import SF001

ENCODED = "row_id long, label double, indices array<int>, values array<double>"


@pytest.fixture(scope="module")
def ohe(spark):
    tr, va, _ = split_frames(ctr_events(spark, SF001))
    d = build_dictionary(tr)
    return one_hot_encode(tr, d).cache(), one_hot_encode(va, d).cache(), d.size


@pytest.mark.parametrize("intercept,tol", [(True, 0.05), (False, 1e-3)])
def test_ranged_fit_equals_whole(spark, ohe, intercept, tol):
    enc, va, d = ohe
    whole = fit_logistic_gd(enc, d, iterations=6, step_size=5.0, reg_param=1e-2, intercept=intercept, tol=tol)
    cut = fit_logistic_ranged(enc, d, iterations=6, step_size=5.0, reg_param=1e-2, intercept=intercept, tol=tol,
                              width=37, block_rows=90)
    weights = {r.idx: r.weight for r in cut.weights_df().collect()}
    assert sorted(weights) == list(range(d))
    assert max(abs(weights[i] - whole.weights[i]) for i in weights) < 1e-12
    assert cut.iterations == whole.iterations
    assert cut.intercept == pytest.approx(whole.intercept, abs=1e-12)
    if intercept:
        want = {r.row_id: r.score for r in predict(whole, va).collect()}
        got = {r.row_id: r.score for r in predict_ranged(cut, va).collect()}
        assert got.keys() == want.keys()
        assert max(abs(got[k] - want[k]) for k in want) < 1e-12


def test_ranged_fit_values_and_edges(spark):
    rows = [(1, 1.0, [0, 9], [2.0, -0.5]), (2, 0.0, [], []), (3, 1.0, None, None), (4, 0.0, [9], [0.25])]
    df = spark.createDataFrame(rows, ENCODED)
    a = fit_logistic_gd(df, 10, iterations=3, step_size=1.0)
    b = fit_logistic_ranged(df, 10, iterations=3, step_size=1.0, width=4, block_rows=1)
    assert np.allclose([r.weight for r in b.weights_df().orderBy("idx").collect()], a.weights, atol=1e-14)
    empty = fit_logistic_ranged(df.limit(0), 10, iterations=3)
    assert (empty.iterations, empty.intercept) == (0, 1.0)
    with pytest.raises(Exception, match="outside"):
        fit_logistic_ranged(df, 9, iterations=1)
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        fit_logistic_ranged(df.withColumn("label", F.lit(2.0)), 10, iterations=1)


def test_narrow_ranges_travel_together(spark, monkeypatch):
    import respengine.operators.model_ranges as ranges
    d, asked, stored = 700, [], ranges.materialize
    rows = spark.range(0, 300, 1, 2).select(
        F.pmod(F.xxhash64("id", F.lit(-1)), F.lit(2)).cast("double").alias("label"),
        F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(d // 7)).cast("int") + k * (d // 7) for k in range(7)]).alias("indices"),
        F.array(*[F.lit(0.5 + k) for k in range(7)]).alias("values")).cache()

    def spy(df):
        out = stored(df)
        asked.append(out.agg(F.max(F.size("asked"))).first()[0])
        return out

    monkeypatch.setattr(ranges, "materialize", spy)
    monkeypatch.setattr(ranges, "ENTRIES_PER_PULL", 100, raising=False)
    whole = fit_logistic_gd(rows, d, iterations=5, step_size=1.0, reg_param=1e-2)
    cut = fit_logistic_ranged(rows, d, iterations=5, step_size=1.0, reg_param=1e-2, width=3, block_rows=90)
    weights = [r.weight for r in cut.weights_df().orderBy("idx").collect()]
    assert np.allclose(weights, whole.weights, atol=1e-12) and cut.intercept == pytest.approx(whole.intercept, abs=1e-12)
    assert cut.table().count() == 234  # the ranges stay as narrow as asked for
    assert asked[0] < 64, "a block's exchange grows with the number of ranges"


SMALL_DRIVER = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.driver.maxResultSize", "4m").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
from respengine.operators.model_ranges import fit_logistic_ranged
d = 1 << 22
rows = spark.range(20000).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("double").alias("label"),
    F.array_sort(F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(d // 4)).cast("int") + k * (d // 4) for k in range(4)])).alias("indices"),
    F.array(*[F.lit(1.0)] * 4).alias("values"))
model = fit_logistic_ranged(rows, d, iterations=2, step_size=1.0)
n = model.weights_df().where("weight != 0").count()
assert model.weights_df().count() == d and n > 50000, n
print("fitted", model.iterations)
"""


def test_wide_fit_with_a_small_driver():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", SMALL_DRIVER.format(root=root)], env=env, capture_output=True, text=True, timeout=300)
    assert "fitted 2" in out.stdout, out.stderr[-2000:]


MANY_PARTIALS = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[8]").config("spark.driver.maxResultSize", "2m").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
import respengine.operators.model as model
model.MIN_ENTRIES_PER_TASK = 1
d = 60000
rows = spark.range(0, 8000, 1, 8).select((F.col("id") % 2).cast("double").alias("label"),
    F.array(F.pmod(F.xxhash64("id"), F.lit(d)).cast("int")).alias("indices"), F.array(F.lit(1.0)).alias("values"))
fitted = model.fit_logistic_many(rows, d, [(1.0, 0.0)], iterations=2, block_rows=500)[0]
print("fitted", fitted.iterations, int((fitted.weights != 0).sum()) > 5000)
"""


def test_partial_gradients_are_summed_before_the_driver():
    # Eight partial gradients of 480 KB: together more than the driver takes, their sum is not.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", MANY_PARTIALS.format(root=root)], env=env, capture_output=True, text=True, timeout=300)
    assert "fitted 2 True" in out.stdout, out.stderr[-2000:]


MANY_MODELS = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[8]").config("spark.driver.maxResultSize", "3m").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
import respengine.operators.model as model
from respengine.operators.search import grid_search
model.MIN_ENTRIES_PER_TASK = 1
d = 1 << 15
rows = spark.range(0, 8000, 1, 8).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("double").alias("label"),
    F.array(F.pmod(F.xxhash64("id"), F.lit(d)).cast("int")).alias("indices"), F.array(F.lit(1.0)).alias("values"))
cells, best = grid_search(rows, rows, d, [1, 10], [1e-6, 1e-3], iterations=2)
print("cells", cells.count(), int((best.weights != 0).sum()) > 5000)
"""


def test_a_grid_sends_the_driver_one_gradient_a_model():
    # Four models of 262 KB: the partial gradients of eight tasks are 8.4 MB, their sums 1 MB.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", MANY_MODELS.format(root=root)], env=env, capture_output=True, text=True, timeout=300)
    assert "cells 4 True" in out.stdout, out.stderr[-2000:]


def test_sliced_sum_equals_direct(spark, ohe, monkeypatch):
    import respengine.operators.model as model
    enc, _, d = ohe
    monkeypatch.setattr(model, "MIN_ENTRIES_PER_TASK", 1)
    monkeypatch.setattr(model, "_MIN_SLICE", 7)
    fits = []
    for limit in (1 << 40, 0):
        monkeypatch.setattr(model, "_DIRECT_REDUCE_LIMIT", limit)
        fits.append(model.fit_logistic_many(enc, d, [(5.0, 0.1), (1.0, 0.0)], iterations=4, block_rows=90))
    for a, b in zip(*fits):
        assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_equal_rows_stay_two(spark):
    rows = [(1, 1.0, [0, 2], [1.0, 0.5])] * 2 + [(1, 1.0, [1], [1.0]), (2, 0.0, [], []), (3, 0.0, None, None), (4, 1.0, [7, 0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, ENCODED)
    models = [LogisticModel(np.array([0.5, -1.0, 2.0]), 0.1), LogisticModel(np.array([1.0, 0.0, 0.0]), -0.2)]
    margins = [(1.5, 1.0), (1.5, 1.0), (-1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.5, 1.0)]
    want = sorted((r[0], *(1 / (1 + np.exp(-(m + model.intercept))) for m, model in zip(ms, models)))
                  for r, ms in zip(rows, margins))
    for limit in (None, 0):  # inside the row, and by blocks
        scored = predict_many(models, df, max_broadcast_rows=limit)
        got = sorted((r.row_id, r.score_0, r.score_1) for r in scored.collect())
        assert np.allclose(got, want)


def test_scoring_has_no_shuffle(spark, ohe):
    _, va, d = ohe
    obs = ctr_events(spark, SF001)
    model = LogisticModel(np.linspace(-1, 1, 64), 0.3)
    frames = [predict(model, hash_features(obs, 64)), predict(LogisticModel(np.ones(d), 0.0), va)]
    for scored in frames:
        plan = scored._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        assert "Exchange" not in plan and "Join" not in plan
    assert frames[0].count() == 1000
    assert evaluate_many([model], hash_features(obs, 64))[0] > 0


def test_encoding_by_blocks_keeps_equal_rows(spark):
    pair = lambda f, c: {"feature_id": f, "category": c}
    rows = [(1, 1.0, [pair(0, "a"), pair(1, "b")])] * 2 + [(1, 1.0, [pair(1, "b")]), (2, 0.0, []), (3, 0.0, [pair(0, None), pair(9, "a")])]
    obs = spark.createDataFrame(rows, OBS_SCHEMA)
    d = build_dictionary(obs.where("row_id < 3"))
    for limit in (None, 0):
        got = sorted((r.row_id, r.indices) for r in one_hot_encode(obs, d, max_broadcast_rows=limit).collect())
        assert got == [(1, [0, 1]), (1, [0, 1]), (1, [1]), (2, []), (3, [])]
    with pytest.raises(Exception, match="unseen feature pair"):
        one_hot_encode(obs, d, unseen="error", max_broadcast_rows=0).collect()


def test_distinct_keys():
    a, b = pa.array([1, 2, 1, None, 1, None]), pa.array(["x", "x", "x", "y", None, "y"])
    found, place = distinct_keys([a, b])
    pairs = list(zip(*[f.to_pylist() for f in found]))
    assert len(pairs) == 4 and [pairs[i] for i in place] == list(zip(a.to_pylist(), b.to_pylist()))
    none, place = distinct_keys([pa.array([], pa.int32())])
    assert len(none[0]) == 0 and len(place) == 0
