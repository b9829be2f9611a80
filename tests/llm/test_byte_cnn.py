"""The byte network against direct sums, its gradient, and held-out labels."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from respengine.llm import byte_cnn as B
from respengine.llm.common import read_table
from respengine.llm.queries import op13_quality_classifier

SF = "/root/testdata/sf0.01"


def plain(net, text):
    """Every chunk's window by window, one at a time."""
    w, data = net.weights, list(text)
    logits, first = [], 0
    while True:
        chunk = (data[first:first + B.CHUNK] + [B.PAD] * B.CHUNK)[:B.CHUNK]
        best = np.full(B.FILTERS, -np.inf)
        for p in range(B.CHUNK - B.WIDTH + 1):
            best = np.maximum(best, np.concatenate([w["embed"][b] for b in chunk[p:p + B.WIDTH]]) @ w["filter"])
        hidden = np.tanh(np.maximum(best + w["offset"], 0) @ w["hidden"] + w["lean"])
        logits.append(float((hidden @ w["out"] + w["bias"])[0]))
        first += B.CHUNK - B.WIDTH + 1
        if first + B.WIDTH > len(data):
            return 1 / (1 + np.exp(-(np.mean(logits) + net.shift)))


def test_scores_are_those_of_all_windows():
    net, rnd = B.Network.fresh(3), np.random.default_rng(1)
    net.weights["out"] *= 5
    net.shift = 0.3
    sizes = [0, 1, B.WIDTH - 1, B.WIDTH, B.CHUNK - 1, B.CHUNK, B.CHUNK + 1, B.STEP + B.WIDTH - 1, B.STEP + B.WIDTH, 3000]
    texts = [rnd.integers(0, 255, n, np.uint8).tobytes() for n in sizes]
    got = net.score([*texts, *texts])
    assert got[:len(texts)] == pytest.approx([plain(net, t) for t in texts], abs=1e-5)
    assert got[:len(texts)] == pytest.approx(got[len(texts):], abs=1e-6)
    # A long text is one probability, in bounded passes; its end counts.
    long = b"a" * 600_000
    assert net.score([long])[0] != net.score([long + b"!?" * 300_000])[0]


def test_gradient():
    net, rnd = B.Network.fresh(5), np.random.default_rng(2)
    for k in net.weights:
        net.weights[k] = net.weights[k].astype(np.float64)
    rows = rnd.integers(0, 257, (5, B.CHUNK)).astype(np.int16)
    owner, label = np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        logit = net.head(net.pooled(rows).astype(np.float64))[2]
        mean = np.bincount(owner, logit) / np.bincount(owner)
        return np.mean(np.log1p(np.exp(-np.where(label == 1, mean, -mean))))

    given = net.gradient(rows, owner, label)
    for name in ("hidden", "lean", "out", "bias", "offset", "filter", "embed"):
        weight, slope = net.weights[name], given[name]
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before, step = weight[at], 3e-3
        weight[at] = before + step
        up = loss()
        weight[at] = before - step
        down = loss()
        weight[at] = before
        assert slope[at] == pytest.approx((up - down) / (2 * step), rel=0.08, abs=1e-5), name


def test_held_out_labels(spark):
    docs = read_table(spark, SF, "documents")
    told = op13_quality_classifier(spark, SF).cache()
    assert told.count() == docs.count() == told.select("doc_id").distinct().count()
    assert told.where("score is null or score < 0 or score > 1 or predicted != int(score >= 0.3)").isEmpty()
    rows = told.join(read_table(spark, SF, "labels"), "doc_id").select("held_out", "score", "quality", "predicted").collect()
    kept, gone = ([r for r in rows if r.held_out and r.quality == q] for q in (1, 0))
    assert len(kept) > 40 and len(gone) > 4
    assert np.mean([r.predicted for r in kept]) >= 0.95
    # Chance that a good text is scored above a bad one.
    assert np.mean([a.score > b.score for a in kept for b in gone]) >= 0.9


def test_cases(spark, documents):
    words = ["the", "cat", "sat", "on", "a", "mat"]
    rows = [(i, " ".join(words[(i * k) % 6] for k in range(1, 40)), None) for i in range(60)]
    rows += [(100 + i, "".join("@#$%"[(i * k) % 4] for k in range(1, 90)), None) for i in range(60)]
    rows += [(300, None), (301, ""), (302, "@#" * 40_000), (302, "@#" * 40_000), (None, "the cat sat on a mat")]
    docs = documents(rows, score="string", read="int")
    labels = spark.createDataFrame([(i, int(i < 100), 5) for i, *_ in rows[:120]] + [(None, 1, 5), (7, None, 5), (8, 3, 5), (999, 0, 5)],
                                   "doc_id long, quality int, text int")
    net = B.learn(docs, labels, epochs=6)
    told = B.classify(docs, net)
    assert set(told.columns) == {*docs.columns, "predicted"}
    got = told.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == int(i < 100) for i, *_ in rows[:120])
    assert (by_id[302].predicted, by_id[None].predicted) == (0, 1)
    assert by_id[300].score == by_id[301].score
    assert len({r.score for r in got if r.doc_id == 302}) == 1
    assert B.classify(docs.limit(0), net).count() == 0
    # Nothing to tell apart.
    assert B.learn(docs, labels.where("quality = 1")).score([b"x"])[0] > 0.9
    assert B.learn(docs, labels.limit(0)).score([b"x"])[0] == 0.5
    assert B.learn(docs.limit(0), labels).constant == pytest.approx(60.5 / 122)
