"""Small cases of the operators that use DataFrame functions only."""
import hashlib
import re
from collections import defaultdict
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from respengine.llm.chat_format import LLAMA, ChatTemplate, chat_format, escape, read_back, unescape
from respengine.llm.exact_dedup import drop_copies, exact_dedup
from respengine.llm.mixing import mix

NASTY = ["", "\\", "</s>", "<\\/s>", "<</s>>", "[[INST]]", "[/INST", "</s", "[INST][/INST]", "\\</s>\\",
         "a\nb\\\n", "[NEXT]", "[\\NEXT]", "$1 \\$0", "<s><s>", "日</s>本"]


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(t,) for t in NASTY + [a + b for a in NASTY for b in NASTY]], "t string")
    rows = df.select("t", escape(F.col("t")).alias("e")).select("*", unescape(F.col("e")).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(c in r.e for c in LLAMA.controls)


def test_template_is_checked():
    with pytest.raises(ValueError):
        ChatTemplate(end="[x<]")


def test_chat_cases(spark):
    rows = [(1, 0, "user", t) for t in NASTY] + [(1, 5, "assistant", t) for t in NASTY] + [
        (2, 1, "assistant", "b"), (2, 0, "assistant", "a"), (2, 2, None, None), (2, 3, "", "x"),
        (3, 0, "</s>", "[INST]"), (3, None, "user", "first"), (None, 0, "user", None),
        (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "conv_id long, turn long, role string, text string, turns string, t string")
    out = {r.conv_id: r for r in read_back(chat_format(df)).collect()}
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert set(out) == set(want)
    for c, turns in want.items():
        blocks = [(role, [t for _, t in g], role == "assistant") for role, g in groupby(turns, lambda x: x[0])]
        assert [(b.role, list(b.texts), b.trained) for b in out[c].blocks] == blocks
        assert (out[c].n_turns, out[c].n_blocks) == (len(turns), len(blocks))


def test_chat_empty(spark):
    assert chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


COPIES = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (7, "long " * 5000), (8, "long " * 5000),
          (None, "a"), (9, "b"), (9, "b"), (None, "z")]


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_exact_dedup_cases(spark, documents, tmp_path):
    df = documents(COPIES)
    for frame in (df, None):
        if frame is None:
            df.repartition(5).write.parquet(str(tmp_path / "d"))
            frame = spark.read.parquet(str(tmp_path / "d"))
        got = exact_dedup(frame, files_per_batch=1).collect()
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute_copies(COPIES)
        assert sum(r.kept for r in got) == 6 and all(r.kept <= (r.doc_id == r.keep_id) for r in got)
    left = drop_copies(frame)
    assert left.columns == df.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 5, 6, 8, 9]


def test_exact_dedup_checks_bytes(spark, documents):
    """A digest that covers different texts is found out and split."""
    got = exact_dedup(documents(COPIES), digest=lambda t: F.length(t)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute_copies(COPIES)
    assert sum(r.kept for r in got) == 6


def test_exact_dedup_hot_group(spark, documents):
    rows = [(i, "same" if i % 3 else f"t{i}") for i in range(6000)]
    got = {r.doc_id: r for r in exact_dedup(documents(rows)).collect()}
    assert got[1].group_size == 4000 and got[1].keep_id == 5999 and got[3].group_size == 1


def test_exact_dedup_empty(documents):
    assert exact_dedup(documents([])).count() == 0


def test_mix_cases(documents):
    rows = [(i, "w " * (i % 7), "en", "b") for i in range(50)] + [(100, "x y z", "en", "a"), (101, None, None, None),
            (102, "one two", None, None), (None, "n n n", "en", "c"), (103, "q", "en", "c"), (103, "q", "en", "c"),
            (104, "", "en", "empty"), (105, "r " * 30000, "en", "d")]
    out = mix(documents(rows)).collect()
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    total = sum(sizes.values())
    names = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, free, left = {}, set(names), total
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            want.update(share)
            break
        for s in over:
            want[s] = 3 * sizes[s]
            left -= want[s]
        free -= over
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert taken[s] == int(target[s] + 1e-9)
    assert sorted(map(str, out)) == sorted(map(str, mix(documents(rows).repartition(7)).collect()))


def test_mix_quality_column(documents):
    """Weights of a column; a third of the rows has none and still fills many ranges."""
    import pyspark.sql.functions as F
    rows = [(i, "w " * 20, "en", "abc"[i // 3 % 3]) for i in range(1800)]
    docs = documents(rows).withColumn("quality", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(
        F.col("doc_id") % 3 == 1, F.lit(8.0)).otherwise(F.lit(1.0)))
    out = [r for r in mix(docs, quality_col="quality").collect() if r.source == "a"]
    taken = [sum(r.taken for r in out if r.doc_id % 3 == k) for k in range(3)]
    assert taken[1] > taken[2] > taken[0]
    assert abs(sum(taken) - out[0].target) <= 1
    odd = documents(rows[:60]).withColumn("quality", F.expr(
        "case doc_id % 4 when 0 then 'NaN' when 1 then '-1' when 2 then 'x' else 'Infinity' end"))
    assert len(mix(odd, quality_col="quality").collect()) == 60


def test_mix_empty(documents):
    assert mix(documents([])).count() == 0
    assert [r.taken for r in mix(documents([(1, None), (2, " ")])).collect()] == [0, 0]


def test_mix_prefers_quality(documents):
    """Documents with ordinary word lengths are taken more often than others."""
    rows = [(i, ("word " if i % 2 else "x ") * 20, "en", "a") for i in range(2000)] + [
        (5000 + i, "word " * 20, "en", "b") for i in range(2000)]
    out = [r for r in mix(documents(rows)).collect() if r.source == "a"]
    good = sum(r.taken for r in out if r.doc_id % 2)
    assert good > 1.2 * sum(r.taken for r in out if not r.doc_id % 2)


def test_drop_copies_keeps_clashing_columns(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "a", "f", 1, 2), (2, "a", "g", 3, 4), (3, "b", None, None, None)],
                          "doc_id long, text string, _file string, _pos int, pos int").write.parquet(path)
    docs = spark.read.parquet(path)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r._file) for r in left.collect()) == [(2, "g"), (3, None)]
