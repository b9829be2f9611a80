import numpy as np
import pytest
from pyspark.sql import functions as F

from respengine.operators.encode import build_dictionary, one_hot_encode
from respengine.operators.evaluate import evaluate_log_loss, evaluate_many
from respengine.operators.hashing import hash_features
from respengine.operators.model import (fit_logistic_gd, fit_logistic_many, predict,
                                        smallest_weights)
from respengine.operators.split import split_frames
from respengine.sources.tables import ctr_events

from conftest import SF001, SF01


@pytest.fixture(scope="module")
def ohe(spark):
    tr, va, _ = split_frames(ctr_events(spark, SF001))
    d = build_dictionary(tr)
    return one_hot_encode(tr, d).cache(), one_hot_encode(va, d).cache(), d.size


def _mllib(spark, enc, d, iters, step, reg, intercept=True, tol=1e-3):
    import warnings
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint
    rows = enc.select("label", "indices", "values").collect()
    rdd = spark.sparkContext.parallelize(
        [LabeledPoint(r[0], SparseVector(d, r[1], r[2])) for r in rows], 3)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return LogisticRegressionWithSGD.train(rdd, iterations=iters, step=step, regParam=reg,
                                               regType="l2", intercept=intercept,
                                               convergenceTol=tol)


@pytest.mark.parametrize("iters,step,reg", [(1, 10.0, 1e-6), (5, 10.0, 1e-6), (30, 1.0, 1e-3)])
def test_fit_matches_mllib(spark, ohe, iters, step, reg):
    enc, _, d = ohe
    ours = fit_logistic_gd(enc, d, iterations=iters, step_size=step, reg_param=reg)
    ml = _mllib(spark, enc, d, iters, step, reg)
    assert np.max(np.abs(np.array(ml.weights) - ours.weights)) < 1e-9
    assert abs(ml.intercept - ours.intercept) < 1e-9


def test_fit_without_intercept_matches_mllib(spark, ohe):
    enc, _, d = ohe
    ours = fit_logistic_gd(enc, d, iterations=4, step_size=5.0, reg_param=1e-4, intercept=False)
    ml = _mllib(spark, enc, d, 4, 5.0, 1e-4, intercept=False)
    assert np.max(np.abs(np.array(ml.weights) - ours.weights)) < 1e-9
    assert ours.intercept == 0.0


def test_many_equals_single(spark, ohe):
    enc, _, d = ohe
    configs = [(1.0, 1e-6), (10.0, 1e-3)]
    many = fit_logistic_many(enc, d, configs, iterations=6)
    grouped = fit_logistic_many(enc, d, configs, iterations=6, max_broadcast_bytes=8 * (d + 1))
    for a, b in zip(many, grouped):
        assert np.array_equal(a.weights, b.weights)
    for m, (s, r) in zip(many, configs):
        one = fit_logistic_gd(enc, d, iterations=6, step_size=s, reg_param=r)
        assert np.allclose(m.weights, one.weights, atol=1e-12)
        assert m.iterations == one.iterations


def test_early_stop_matches_mllib(spark, ohe):
    enc, _, d = ohe
    m = fit_logistic_gd(enc, d, iterations=100, step_size=10.0, reg_param=1e-6, tol=0.05)
    assert 1 < m.iterations < 100
    ml = _mllib(spark, enc, d, 100, 10.0, 1e-6, tol=0.05)
    assert np.max(np.abs(np.array(ml.weights) - m.weights)) < 1e-9
    longer = fit_logistic_gd(enc, d, iterations=m.iterations + 1, step_size=10.0,
                             reg_param=1e-6, tol=0.05)
    assert longer.iterations == m.iterations


def test_predict_paths_agree(spark, ohe):
    enc, va, d = ohe
    m = fit_logistic_gd(enc, d, iterations=5)
    want = {r[0]: r[2] for r in predict(m, va).collect()}
    spark.conf.set("respengine.broadcastMaxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        scored = predict(m, va)
        got = {r[0]: r[2] for r in scored.collect()}
        plan = scored._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in ("respengine.broadcastMaxRows", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert "SortMergeJoin" in plan
    assert want.keys() == got.keys()
    assert max(abs(want[k] - got[k]) for k in want) < 1e-12
    ll = evaluate_log_loss(m, va).first()[0]
    assert ll == pytest.approx(evaluate_many([m], va)[0])


def test_empty_rows_score_intercept(spark, ohe):
    enc, _, d = ohe
    m = fit_logistic_gd(enc, d, iterations=2)
    empty = spark.createDataFrame([(1, 1.0, [], [])],
                                  "row_id long, label double, indices array<int>, values array<double>")
    score = predict(m, empty).first()["score"]
    assert score == pytest.approx(1 / (1 + np.exp(-np.clip(m.intercept, -20, 20))))


def test_smallest_weights(spark, ohe):
    enc, _, d = ohe
    m = fit_logistic_gd(enc, d, iterations=3)
    got = [r["weight"] for r in smallest_weights(m, spark, 5).collect()]
    assert got == sorted(m.weights)[:5]


def test_hashed_fit_sparse_accumulation(spark, monkeypatch):
    import respengine.operators.model as model
    tr, _, _ = split_frames(ctr_events(spark, SF01))
    h = hash_features(tr, 2 ** 15).cache()
    dense = fit_logistic_gd(h, 2 ** 15, iterations=3)
    monkeypatch.setattr(model, "_DENSE_ACC_LIMIT", 0)
    monkeypatch.setattr(model, "_DIRECT_REDUCE_LIMIT", 0)
    sparse = fit_logistic_gd(h, 2 ** 15, iterations=3)
    assert np.allclose(dense.weights, sparse.weights, atol=1e-13)
    assert h.where(F.size("indices") == 0).count() == 0


def test_labels_must_be_binary(spark):
    bad = spark.createDataFrame([(1, 2.0, [0], [1.0])],
                                "row_id long, label double, indices array<int>, values array<double>")
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        fit_logistic_gd(bad, 4, iterations=1)


def test_wide_index_blocks_match_narrow(spark, ohe):
    # d above 2^16 stores indices as int32 instead of uint16; same data, same fit.
    enc, _, d = ohe
    narrow = fit_logistic_gd(enc, d, iterations=4)
    wide = fit_logistic_gd(enc, 70_000, iterations=4)
    assert np.array_equal(narrow.weights, wide.weights[:d])
    assert not wide.weights[d:].any() and narrow.intercept == wide.intercept


def test_weight_broadcast_bound(spark, ohe):
    enc, _, d = ohe
    with pytest.raises(ValueError, match="max_broadcast_bytes"):
        fit_logistic_many(enc, d, [(1.0, 0.0)], iterations=1, max_broadcast_bytes=8 * d)


def test_no_regularisation_matches_mllib(spark, ohe):
    import warnings
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint
    enc, _, d = ohe
    ours = fit_logistic_gd(enc, d, iterations=5, step_size=5.0, reg_param=0.1, reg_type=None)
    rows = enc.select("label", "indices", "values").collect()
    rdd = spark.sparkContext.parallelize(
        [LabeledPoint(r[0], SparseVector(d, r[1], r[2])) for r in rows], 2)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        ml = LogisticRegressionWithSGD.train(rdd, iterations=5, step=5.0, regParam=0.1,
                                             regType=None, intercept=True)
    assert np.max(np.abs(np.array(ml.weights) - ours.weights)) < 1e-9
    assert abs(ml.intercept - ours.intercept) < 1e-9
