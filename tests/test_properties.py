"""Brute-force properties: Spark operators against direct Python versions of
the reference's rules, on random small inputs."""

import hashlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from respengine.functions.columns import pow2_bucket
from respengine.operators.encode import build_dictionary, one_hot_encode
from respengine.operators.hashing import hash_features
from respengine.sources.text import OBS_SCHEMA, parse_lines

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

token = st.sampled_from(["", "0", "1", "a", "bb", "7", " x", "y ", "é"])
line = st.lists(token, min_size=0, max_size=6).map("\t".join).flatmap(
    lambda body: st.sampled_from(["", " ", "\t", "\t\t", " \t\n", "\r"]).map(
        lambda pad: body + pad))


def py_parse(text):
    """strip, split, label '0' -> 0 else 1, features numbered from 0."""
    parts = text.strip().split("\t")
    label = 0.0 if parts[0] == "0" else 1.0
    return label, [(i, v) for i, v in enumerate(parts[1:])]


@SETTINGS
@given(st.lists(line, min_size=1, max_size=30))
def test_parse_lines_matches_python(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "row_id long, line string")
    got = {r["row_id"]: (r["label"], [(f["feature_id"], f["category"]) for f in r["feats"]])
           for r in parse_lines(df, blank="positive").collect()}
    want = {i: py_parse(t) for i, t in enumerate(lines)}
    assert got == want
    kept = {r["row_id"] for r in parse_lines(df, blank="drop").collect()}
    assert kept == {i for i, t in enumerate(lines) if t.strip() != ""}


cat = st.sampled_from(["", "a", "b", "c", "a1", "mouse", "ü"])
obs_rows = st.lists(st.lists(cat, min_size=0, max_size=5), min_size=1, max_size=25)


def _obs(spark, rows):
    data = [(i, float(i % 2), [{"feature_id": j, "category": c} for j, c in enumerate(r)])
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, OBS_SCHEMA)


def py_hash(feats, n):
    mapping = {}
    for ind, category in feats:
        s = category + str(ind)
        mapping[s] = int(hashlib.md5(s.encode()).hexdigest(), 16) % n
    out = defaultdict(float)
    for b in mapping.values():
        out[b] += 1.0
    return dict(out)


@SETTINGS
@given(obs_rows, st.sampled_from([1, 2, 4, 100, 32768]))
def test_hash_features_matches_python(spark, rows, n):
    got = {r["row_id"]: dict(zip(r["indices"], r["values"]))
           for r in hash_features(_obs(spark, rows), n).collect()}
    want = {i: py_hash(list(enumerate(r)), n) for i, r in enumerate(rows)}
    assert got == want


@SETTINGS
@given(obs_rows, obs_rows)
def test_dictionary_and_encoding_match_python(spark, train_rows, other_rows):
    pairs = sorted({(j, c) for r in train_rows for j, c in enumerate(r)},
                   key=lambda p: (p[0], p[1].encode()))
    ids = {p: i for i, p in enumerate(pairs)}
    d = build_dictionary(_obs(spark, train_rows), num_partitions=3)
    assert {(r["feature_id"], r["category"]): r["idx"] for r in d.df.collect()} == ids
    assert d.size == len(ids)
    got = {r["row_id"]: r["indices"] for r in one_hot_encode(_obs(spark, other_rows), d).collect()}
    want = {i: sorted(ids[(j, c)] for j, c in enumerate(r) if (j, c) in ids)
            for i, r in enumerate(other_rows)}
    assert got == want


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=5000), min_size=1, max_size=40))
def test_pow2_bucket_matches_python(spark, counts):
    def py_bucket(c):
        for i in range(11):
            if c <= 2 ** i:
                return 2 ** i
        return -1
    df = spark.createDataFrame([(c,) for c in counts], "c long")
    assert [r[0] for r in df.select(pow2_bucket("c")).collect()] == [py_bucket(c) for c in counts]
