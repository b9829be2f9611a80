import hashlib
import math

import pytest
from pyspark.sql import functions as F

from respengine.functions.columns import (clamped_sigmoid, dense_dot, log_loss, md5_bucket,
                                          pow2_bucket, sparse_dot)

# FIXTURES 3: nine (p, y) pairs and their log loss.
LOG_LOSS = [
    (0.5, 1, 0.6931471805599453), (0.5, 0, 0.6931471805599453),
    (0.99, 1, 0.01005033585350145), (0.99, 0, 4.605170185988091),
    (0.01, 1, 4.605170185988091), (0.01, 0, 0.01005033585350145),
    (0.0, 1, 25.328436022934504), (1.0, 1, 1.000000082745371e-11),
    (1.0, 0, 25.328435940194137),
]


def test_log_loss_pairs(spark):
    df = spark.createDataFrame([(p, y) for p, y, _ in LOG_LOSS], "p double, y int")
    got = [r[0] for r in df.select(log_loss("p", "y")).collect()]
    for (_, _, want), g in zip(LOG_LOSS, got):
        assert g == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_log_loss_other_label_is_null(spark):
    df = spark.createDataFrame([(0.5, 2)], "p double, y int")
    assert df.select(log_loss("p", "y")).first()[0] is None


def test_log_loss_eps_is_not_a_clip(spark):
    df = spark.createDataFrame([(1e-300, 1)], "p double, y int")
    assert df.select(log_loss("p", "y")).first()[0] == pytest.approx(-math.log(1e-300))


def test_pow2_bucket(spark):
    cases = {0: 1, 1: 1, 2: 2, 3: 4, 4: 4, 5: 8, 8: 8, 9: 16, 512: 512, 513: 1024,
             1024: 1024, 1025: -1}
    df = spark.createDataFrame([(k,) for k in cases], "c long")
    got = dict(df.select("c", pow2_bucket("c")).collect())
    assert got == cases


def test_md5_bucket_matches_python(spark):
    strings = ["black1", "mouse0", "cat0", "mouse2", "tabby1", "bear0", "salmon2", "", "ü9"]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for n in (4, 100, 32768, 1000003, 2 ** 31 - 1):
        got = [r[0] for r in df.select(md5_bucket("s", n)).collect()]
        want = [int(hashlib.md5(s.encode()).hexdigest(), 16) % n for s in strings]
        assert got == want, n


def test_md5_bucket_fixture(spark):
    want = {"black1": (2, 14, 31698), "mouse0": (3, 31, 26755), "cat0": (0, 40, 4172),
            "mouse2": (2, 62, 18270), "tabby1": (0, 16, 7164), "bear0": (0, 72, 7712),
            "salmon2": (1, 5, 18761)}
    df = spark.createDataFrame([(s,) for s in want], "s string")
    rows = df.select("s", md5_bucket("s", 4), md5_bucket("s", 100), md5_bucket("s", 32768)).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == want


def test_dot_products(spark):
    w = [0.4, 3.1, -1.4, -0.5]
    df = spark.createDataFrame(
        [([0.0, 3.0, 0.0, 4.0], [1, 3], [3.0, 4.0], w), ([0.0, 0.0, 0.0, 1.0], [3], [1.0], w)],
        "a array<double>, i array<int>, v array<double>, w array<double>")
    rows = df.select(dense_dot("a", "w"), sparse_dot("i", "v", "w")).collect()
    assert rows[0][0] == pytest.approx(7.3) and rows[0][1] == pytest.approx(7.3)
    assert rows[1][0] == pytest.approx(-0.5) and rows[1][1] == pytest.approx(-0.5)


def test_clamped_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (-100.0,), (20.0,)], "z double")
    got = [r[0] for r in df.select(clamped_sigmoid("z")).collect()]
    assert got[0] == 0.5
    assert got[1] == got[3] == pytest.approx(1 / (1 + math.exp(-20)))
    assert got[2] == pytest.approx(1 / (1 + math.exp(20)))
    assert 0.0 < got[2] and got[1] < 1.0


def test_sparse_dot_empty_is_zero(spark):
    df = spark.createDataFrame([([], [], [1.0])], "i array<int>, v array<double>, w array<double>")
    assert df.select(sparse_dot("i", "v", "w")).first()[0] == 0.0
    assert df.select(F.lit(1)).count() == 1


def test_sparse_vector_sorts_and_rejects_repeats(spark):
    from respengine.functions.columns import sparse_vector
    df = spark.createDataFrame([([(3, 4.0), (1, 3.0)],)], "e array<struct<idx:int,value:double>>")
    row = df.select(sparse_vector("e").alias("v")).first()["v"]
    assert row["indices"] == [1, 3] and row["values"] == [3.0, 4.0]
    bad = spark.createDataFrame([([(1, 1.0), (1, 2.0)],)], "e array<struct<idx:int,value:double>>")
    with pytest.raises(Exception, match="strictly increasing"):
        bad.select(sparse_vector("e")).collect()
