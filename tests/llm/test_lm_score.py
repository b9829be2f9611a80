"""PPM scores and word counts against plain implementations."""
import random
import re
from collections import Counter, defaultdict
from math import log10

import pytest
from pyspark.sql import functions as F

from respengine.llm.lm_score import ORDER, _limited, lm_score


def plain(rows, train):
    """Dictionary PPM (method C, exclusion) and word unigrams, A-Z lower-cased."""
    rows = [(i, re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for i, t in rows]
    succ = defaultdict(Counter)
    lines = {i: [0] * ORDER + list((t or "").encode()) + [255] for i, t in rows}
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") + [None] for i, t in rows}
    words = Counter()
    for i in train:
        words.update(tokens[i])
        for p in range(ORDER, len(lines[i])):
            for k in range(ORDER + 1):
                succ[tuple(lines[i][p - k:p])][lines[i][p]] += 1
    total, out = sum(words.values()), {}
    for i, line in lines.items():
        score = 0.0
        for p in range(ORDER, len(line)):
            ruled = set()
            for k in range(ORDER, -1, -1):
                c = {s: n for s, n in succ.get(tuple(line[p - k:p]), {}).items() if s not in ruled}
                if not c:
                    continue
                if line[p] in c:
                    score += log10(c[line[p]] / (sum(c.values()) + len(c)))
                    break
                score += log10(len(c) / (sum(c.values()) + len(c)))
                ruled |= set(c)
            else:
                score -= log10(256 - len(ruled))
        base = sum(log10((words[t] + 0.1) / (total + 0.1 * (len(words) + 1))) for t in tokens[i])
        out[i] = (len(tokens[i]), sum(words[t] > 0 for t in tokens[i]), total, base, score)
    return out


@pytest.mark.parametrize("size", [1 << 22, 2000])
def test_against_plain(spark, documents, size):
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abABé日É") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "\n\t "), (83, "unseen words entirely Ω"), (84, "ab " * 900), (85, "AB aB İ ÀÀ")]
    spark.conf.set("respengine.llm.chunkBytes", str(size))
    got = lm_score(documents(rows), F.col("doc_id") % 5 != 3).collect()
    spark.conf.unset("respengine.llm.chunkBytes")
    want = plain(rows, [i for i, _ in rows if i % 5 != 3])
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3])
        assert r.score == pytest.approx(want[r.doc_id][4])


def test_nothing_learned_and_empty(documents):
    got = lm_score(documents([(1, "ab"), (1, "ab"), (None, None)]), F.lit(False)).collect()
    assert sorted(r.score for r in got) == pytest.approx([-3 * log10(256)] * 2 + [-log10(256)])
    assert {r.train_tokens for r in got} == {0}
    assert lm_score(documents([]), F.lit(True)).count() == 0


def test_capacity_bounds_the_model(documents):
    rows = [(i, f"text number {i} of many " * 3) for i in range(50)]
    few = {r.doc_id: r.score for r in lm_score(documents(rows), F.lit(True), capacity=40).collect()}
    all_ = {r.doc_id: r.score for r in lm_score(documents(rows), F.lit(True)).collect()}
    assert sum(few.values()) < sum(all_.values()) < 0


def test_no_gram_is_left_out(documents):
    # More than 2^19 n-grams of order 4, each learned twice: the text is coded in full contexts.
    rnd = random.Random(3)
    text = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+-!?#$%&()[]{}<>@^~|;", k=600_000))
    line = bytes(ORDER) + text.lower().encode() + b"\xff"
    grams = Counter(line[p - ORDER:p + 1] for p in range(ORDER, len(line)))
    assert len(grams) > 1 << 19
    context, kinds = Counter(), Counter()
    for g, n in grams.items():
        context[g[:-1]] += 2 * n
        kinds[g[:-1]] += 1
    want = sum(n * log10(2 * n / (context[g[:-1]] + kinds[g[:-1]])) for g, n in grams.items())
    got = lm_score(documents([(i, text) for i in range(3)]), F.col("doc_id") < 2).collect()
    assert [r.score for r in got] == pytest.approx([want] * 3)


def test_capacity_holds_for_singletons(spark):
    grams = spark.createDataFrame([(i, 8 if i < 3 else 1) for i in range(50)], "gram long, n long")
    some, all_ = (_limited([grams], size)[0].where("n > 0").count() for size in (10, 50))
    assert (some, all_) == (3, 50)
