import pytest
from pyspark.sql import functions as F

from respengine.operators.encode import (build_dictionary, categories_per_feature,
                                         distinct_features, encoded_long, lookup, one_hot_encode)
from respengine.operators.split import hash_split, split_frames, split_sizes
from respengine.sources.tables import ctr_events
from respengine.sources.text import OBS_SCHEMA, sample_observations

from conftest import SF01

SAMPLE_DICT = {(0, "bear"): 0, (0, "cat"): 1, (0, "mouse"): 2, (1, "black"): 3,
               (1, "tabby"): 4, (2, "mouse"): 5, (2, "salmon"): 6}


def test_sample_dictionary_golden(spark):
    d = build_dictionary(sample_observations(spark))
    got = {(r["feature_id"], r["category"]): r["idx"] for r in d.df.collect()}
    assert got == SAMPLE_DICT and d.size == 7 and d.total == 8
    assert d.bytes == sum(len(c.encode()) + 8 for _, c in SAMPLE_DICT)
    assert distinct_features(sample_observations(spark)).count() == 7


def test_sample_vectors_golden(spark):
    obs = sample_observations(spark)
    enc = one_hot_encode(obs, build_dictionary(obs), unseen="error")
    got = {r["row_id"]: (r["indices"], r["values"]) for r in enc.collect()}
    assert got == {1: ([2, 3], [1.0, 1.0]), 2: ([1, 4, 5], [1.0] * 3), 3: ([0, 3, 6], [1.0] * 3)}


def _with_unseen(spark):
    rows = [(1, 1.0, [{"feature_id": 0, "category": "mouse"}, {"feature_id": 1, "category": "black"},
                      {"feature_id": 0, "category": "fish"}]),
            (9, 0.0, [{"feature_id": 0, "category": "whale"}]),
            (10, 0.0, [])]
    return spark.createDataFrame(rows, OBS_SCHEMA)


def test_unseen_skip_keeps_rows(spark):
    d = build_dictionary(sample_observations(spark))
    got = {r["row_id"]: r["indices"] for r in one_hot_encode(_with_unseen(spark), d).collect()}
    assert got == {1: [2, 3], 9: [], 10: []}


def test_unseen_error_raises(spark):
    d = build_dictionary(sample_observations(spark))
    with pytest.raises(Exception, match="unseen feature pair"):
        one_hot_encode(_with_unseen(spark), d, unseen="error").collect()


def test_repeated_pair_raises(spark):
    d = build_dictionary(sample_observations(spark))
    obs = spark.createDataFrame(
        [(1, 1.0, [{"feature_id": 0, "category": "cat"}, {"feature_id": 0, "category": "cat"}])],
        OBS_SCHEMA)
    with pytest.raises(Exception, match="repeated feature pair"):
        one_hot_encode(obs, d).collect()


def test_dictionary_is_bijection_and_ordered(spark):
    obs = ctr_events(spark, SF01)
    d = build_dictionary(obs, num_partitions=5)
    rows = d.df.orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(d.size))
    keys = [(r["feature_id"], r["category"].encode()) for r in rows]
    assert keys == sorted(keys)
    d1 = build_dictionary(obs.repartition(3), num_partitions=1)
    assert {(r[0], r[1], r[2]) for r in d1.df.collect()} == {(r[0], r[1], r[2]) for r in rows}
    assert lookup(d, 4, "").count() == 1


def test_categories_per_feature(spark):
    obs = sample_observations(spark)
    assert [tuple(r) for r in categories_per_feature(obs).collect()] == [(0, 3), (1, 2), (2, 2)]
    approx = categories_per_feature(obs, approximate=True).collect()
    assert [r[1] for r in approx] == [3, 2, 2]


def test_salted_join_path_matches_broadcast(spark):
    obs = ctr_events(spark, SF01)
    tr, va, _ = split_frames(obs)
    d = build_dictionary(tr)
    want = {(r[0], r[2]) for r in encoded_long(one_hot_encode(va, d)).collect()}
    spark.conf.set("respengine.broadcastMaxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        enc = one_hot_encode(va, d)
        got = {(r[0], r[2]) for r in encoded_long(enc).collect()}
        plan = enc._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in ("respengine.broadcastMaxRows", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert got == want
    assert "_salt" in plan and "SortMergeJoin" in plan


def test_hash_split_sizes(spark):
    obs = ctr_events(spark, SF01)
    sizes = dict(split_sizes(hash_split(obs)).collect())
    assert sizes == {"train": 7957, "validation": 1008, "test": 1035, "total": 10000}
    again = dict(split_sizes(hash_split(obs.repartition(7))).collect())
    assert again == sizes


def test_split_frames_disjoint(spark):
    obs = ctr_events(spark, SF01)
    parts = split_frames(obs, weights=(1, 1, 2), seed=7)
    ids = [set(r[0] for r in p.select("row_id").collect()) for p in parts]
    assert sum(len(i) for i in ids) == 10000
    assert not (ids[0] & ids[1]) and not (ids[1] & ids[2]) and not (ids[0] & ids[2])
    assert obs.where(F.col("row_id") < 0).count() == 0


def test_byte_bound_forces_shuffle_plan(spark):
    obs = ctr_events(spark, SF01)
    tr, va, _ = split_frames(obs)
    d = build_dictionary(tr)
    want = {(r[0], r[2]) for r in encoded_long(one_hot_encode(va, d)).collect()}
    spark.conf.set("respengine.broadcastMaxBytes", "100")
    try:
        enc = one_hot_encode(va, d)
        got = {(r[0], r[2]) for r in encoded_long(enc).collect()}
        plan = enc._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("respengine.broadcastMaxBytes")
    assert got == want and "_salt" in plan
