import re

from respengine.operators.encode import build_dictionary, one_hot_encode
from respengine.operators.hashing import hash_features
from respengine.plans.workflow import featurize_hash, featurize_ohe, split_observations
from respengine.sources.tables import ctr_events

from conftest import SF01


def _ids(df):
    return sorted(r[0] for r in df.select("row_id").collect())


def test_split_storage_modes_agree(spark):
    obs = ctr_events(spark, SF01)
    ref = split_observations(obs, storage=None)
    for storage in ("cache", "table"):
        s = split_observations(obs, storage=storage)
        for a, b in ((s.train, ref.train), (s.validation, ref.validation), (s.test, ref.test)):
            assert _ids(a) == _ids(b)
            assert a.columns == ["row_id", "label", "feats"]
    table = split_observations(obs, storage="table")
    plan = table.test._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*split", plan)


def test_featurize_helpers(spark):
    s = split_observations(ctr_events(spark, SF01))
    d = build_dictionary(s.train)
    a = {r[0]: r[2] for r in featurize_ohe(s.validation, d).collect()}
    b = {r[0]: r[2] for r in one_hot_encode(s.validation, d).collect()}
    assert a == b
    h1 = {r[0]: (r[2], r[3]) for r in featurize_hash(s.test, 1024).collect()}
    h2 = {r[0]: (r[2], r[3]) for r in hash_features(s.test, 1024).collect()}
    assert h1 == h2 and len(h1) == 1035
