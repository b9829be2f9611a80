import pytest
from pyspark.sql import functions as F

from respengine.operators.evaluate import base_rate, baseline_log_loss, roc_curve
from respengine.operators.search import GRID_SCHEMA, pivot_grid
from respengine.sources.tables import read_table

from conftest import SF01


# The reference's stored 6 x 6 log-loss surface (rows = step size,
# columns = regularisation).
SURFACE_STEPS = [3, 6, 9, 12, 15, 18]
SURFACE_REGS = [1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2]
SURFACE_LOG_LOSS = [
    [0.45808431, 0.45808493, 0.45809113, 0.45815333, 0.45879221, 0.46556321],
    [0.45188196, 0.45188306, 0.4518941, 0.4520051, 0.45316284, 0.46396068],
    [0.44886478, 0.44886613, 0.44887974, 0.44902096, 0.4505614, 0.46371153],
    [0.44706645, 0.4470698, 0.44708102, 0.44724251, 0.44905525, 0.46366507],
    [0.44588848, 0.44589365, 0.44590568, 0.44606631, 0.44807106, 0.46365589],
    [0.44508948, 0.44509474, 0.44510274, 0.44525007, 0.44738317, 0.46365405],
]


def surface_results(spark):
    """The stored surface as grid results."""
    rows = []
    for i, s in enumerate(SURFACE_STEPS):
        for j, r in enumerate(SURFACE_REGS):
            rows.append((i * len(SURFACE_REGS) + j, float(s), r, SURFACE_LOG_LOSS[i][j], 0, False))
    return spark.createDataFrame(rows, GRID_SCHEMA)


def _scored(spark):
    ev = read_table(spark, SF01, "events")
    return ev.select(F.col("event_id").alias("row_id"),
                     F.when(F.col("event_type") == "click", 1.0).otherwise(0.0).alias("label"),
                     (F.col("value") / 600.0).alias("score"))


def _brute_roc(rows):
    pts = {}
    for y, s in rows:
        p, n = pts.get(s, (0, 0))
        pts[s] = (p + y, n + 1 - y)
    tp = fp = 0
    out = []
    tpos = sum(v[0] for v in pts.values())
    tneg = sum(v[1] for v in pts.values())
    for s in sorted(pts, reverse=True):
        tp += pts[s][0]
        fp += pts[s][1]
        out.append((s, tp, fp, tp / tpos, fp / tneg))
    return out


def test_roc_matches_brute_force_across_ranges(spark):
    scored = _scored(spark)
    want = _brute_roc([(r[0], r[1]) for r in scored.select("label", "score").collect()])
    for ranges in (1, 3, 16):
        got = [tuple(r) for r in roc_curve(scored, num_ranges=ranges).orderBy(F.desc("score")).collect()]
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[0] == w[0] and g[1] == w[1] and g[2] == w[2]
            assert g[3] == pytest.approx(w[3]) and g[4] == pytest.approx(w[4])
    last = got[-1]
    assert last[3] == 1.0 and last[4] == 1.0


def test_roc_bins_and_no_negatives(spark):
    scored = _scored(spark)
    binned = roc_curve(scored, num_bins=10).collect()
    assert len(binned) <= 11
    pos_only = scored.where(F.col("label") == 1.0)
    rows = roc_curve(pos_only).collect()
    assert all(r["fpr"] is None for r in rows)


def test_base_rate_and_baseline(spark):
    scored = _scored(spark)
    rate = base_rate(scored).first()[0]
    assert rate == pytest.approx(2006 / 10000)
    ll = baseline_log_loss(rate, scored).first()[0]
    import math
    want = -(rate * math.log(rate) + (1 - rate) * math.log(1 - rate))
    assert ll == pytest.approx(want)
    # a fraction of 0 uses eps instead of failing
    assert baseline_log_loss(0.0, scored).first()[0] > 0
    assert baseline_log_loss(scored, scored).first()[0] == pytest.approx(want)


def test_pivot_surface(spark):
    piv = pivot_grid(surface_results(spark)).collect()
    assert [r["step_size"] for r in piv] == [3.0, 6.0, 9.0, 12.0, 15.0, 18.0]
    assert piv[-1]["reg_1e-07"] == 0.44508948
    assert piv[0]["reg_1e-02"] == 0.46556321
    best = surface_results(spark).orderBy("log_loss").first()
    assert (best["step_size"], best["reg_param"]) == (18.0, 1e-7)


def test_roc_edge_cases(spark):
    empty = spark.createDataFrame([], "label double, score double")
    assert roc_curve(empty).collect() == []
    one = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (1.0, 0.5)], "label double, score double")
    (row,) = roc_curve(one).collect()
    assert (row["tp"], row["fp"], row["tpr"], row["fpr"]) == (2, 1, 1.0, 1.0)


def test_range_bounds_are_even(spark):
    import bisect
    from collections import Counter

    from respengine.operators.evaluate import range_bounds
    # Scores crowd near 0, over many orders of magnitude.
    points = spark.range(60_000).select(F.pow(F.rand(3), F.lit(9.0)).alias("score")).distinct().persist()
    values = [r[0] for r in points.collect()]
    for ranges in (2, 300, 4000):
        bounds = range_bounds(points, "score", ranges)
        sizes = Counter(bisect.bisect_right(bounds, v) for v in values)
        assert len(sizes) == len(bounds) + 1 and len(sizes) >= ranges / 2
        assert max(sizes.values()) < 2 * len(values) / len(sizes)
    points.unpersist()
    few = spark.createDataFrame([(0.5,), (0.5,), (None,), (float("nan"),), (float("inf"),)], "score double")
    assert range_bounds(few, "score", 4) == [] and range_bounds(few.limit(0), "score", 4) == []


def test_report_lines(spark):
    from respengine.operators.evaluate import metric_report
    rows = metric_report(spark, [("validation", "hashed", "step=10.0, reg=1e-06", "log_loss", 0.44508),
                                 ("validation", "hashed", "logreg", "log_loss", 0.44508)]).collect()
    assert {r["text"] for r in rows} == {"stepSize = 10.0, regParam = 1e-06: logloss = 0.445", "0.445"}
