import os
import tempfile

from respengine.operators.hashing import hash_features
from respengine.operators.model import fit_logistic_gd, predict
from respengine.sources.tables import ctr_events, read_table
from respengine.streaming.scoring import (ctr_event_stream, hashed_stream, parquet_epoch_sink,
                                          score_stream)

from conftest import SF001


def test_stream_scores_equal_batch(spark):
    n = 1024
    batch = hash_features(ctr_events(spark, SF001), n)
    model = fit_logistic_gd(batch, n, iterations=3)
    want = {r["row_id"]: r["score"] for r in predict(model, batch).collect()}

    schema = read_table(spark, SF001, "events").schema
    src = tempfile.mkdtemp(prefix="respengine-stream-src-")
    os.symlink(f"{SF001}/events.parquet", os.path.join(src, "part-0.parquet"))
    stream = hashed_stream(ctr_event_stream(spark, src, schema), n)
    out = tempfile.mkdtemp(prefix="respengine-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="respengine-stream-ckpt-")
    q = score_stream(stream, model, parquet_epoch_sink(out), checkpoint_location=ckpt,
                     query_name="test_scores", available_now=True)
    q.awaitTermination(300)
    got = {r["row_id"]: r["score"] for r in spark.read.parquet(out).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12


def test_stream_restart_is_idempotent(spark):
    n = 256
    model = fit_logistic_gd(hash_features(ctr_events(spark, SF001), n), n, iterations=2)
    schema = read_table(spark, SF001, "events").schema
    src = tempfile.mkdtemp(prefix="respengine-stream-src-")
    os.symlink(f"{SF001}/events.parquet", os.path.join(src, "part-0.parquet"))
    out = tempfile.mkdtemp(prefix="respengine-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="respengine-stream-ckpt-")
    for _ in range(2):  # the second start finds nothing new to score
        stream = hashed_stream(ctr_event_stream(spark, src, schema), n)
        score_stream(stream, model, parquet_epoch_sink(out), checkpoint_location=ckpt,
                     query_name="restart_scores", available_now=True).awaitTermination(300)
    scored = spark.read.parquet(out)
    assert scored.count() == 1000 and scored.select("row_id").distinct().count() == 1000
