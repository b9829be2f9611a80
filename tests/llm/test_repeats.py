"""Substring and suffix deduplication against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from respengine.llm import kernels as K
from respengine.llm.substring_dedup import COVER, PERIOD, substring_dedup
from respengine.llm.suffix_dedup import merge_runs, suffix_dedup

SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, chunk string, part int"


def brute_words(docs, window):
    seen = Counter()
    toks = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    for w in toks.values():
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = {}
    for i, w in toks.items():
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def brute_bytes(docs, width):
    seen = Counter()
    raw = {i: (t or "").encode() for i, t in docs}
    for b in raw.values():
        seen.update(b[i:i + width] for i in range(len(b) - width + 1))
    out = {}
    for i, b in raw.items():
        gone, until, spans = bytearray(len(b)), 0, 0
        for s in range(len(b) - width + 1):
            if seen[b[s:s + width]] > 1:
                spans += s > until or not until and not spans
                gone[max(s, until):s + width] = b"\1" * (s + width - max(s, until))
                until = s + width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def planted(seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé日\0") for _ in range(rnd.randint(1, 6)))
    vocab = [word() for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passages = [text(n) for n in (34, 35, 36, 60, 120)]
    docs = [(i, text(rnd.randint(0, 150))) for i in range(60)]
    for i in range(60, 120):
        docs.append((i, text(rnd.randint(0, 40)) + " " + rnd.choice(passages) + "\t" + text(30)))
    docs += [(120, None), (121, ""), (122, " \n"), (123, "a " * 300), (124, "x" * 900),
             (125, docs[70][1]), (126, docs[70][1]), (127, passages[0]), (128, passages[1]),
             (129, "é" * 150 + "b" * 60), (130, "b" * 60 + "é" * 150)]
    return docs


def sets(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)


@pytest.fixture(params=[1 << 22, 3000])
def chunks(request, spark):
    spark.conf.set("respengine.llm.chunkBytes", str(request.param))
    yield
    spark.conf.unset("respengine.llm.chunkBytes")


def test_difference_cover():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_words_match_regex():
    docs = ["", " a b", "c", "d e\x1cf\tg\x0b\x0ch\r\n", "  ", "日本 語"]
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    off = np.cumsum([0] + [len(d.encode()) for d in docs])
    s, e, w = K.words(data, off)
    got = [[data[a:b].tobytes().decode() for a, b in zip(s[w[i]:w[i + 1]], e[w[i]:w[i + 1]])]
           for i in range(len(docs))]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", d) for d in docs]


def test_merge_runs():
    rnd = random.Random(1)
    for k in (1, 2, 3, 5, 8):
        runs = [sorted({bytes(rnd.choice(b"ab") for _ in range(8)) for _ in range(rnd.randint(1, 60))})
                for _ in range(k)]
        count = Counter(x for r in runs for x in r)
        coded = []
        for r in runs:
            shared = [0] + [next(i for i in range(8) if a[i] != b[i]) for a, b in zip(r, r[1:])]
            coded.append((bytes(shared), b"".join(x[n:] for x, n in zip(r, shared))))
        for r, flags in zip(runs, merge_runs(coded, 8)):
            assert [count[x] > 1 for x in r] == flags.tolist()


def test_substring_small(spark, chunks):
    docs = planted()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup(sets(spark, docs)).collect()}
    assert got == brute_words(docs, 35)


def test_suffix_small(spark, chunks):
    docs = planted()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup(sets(spark, docs)).collect()}
    assert got == brute_bytes(docs, 200)


def test_empty_tables(spark):
    for op in (substring_dedup, suffix_dedup):
        assert op(sets(spark, [])).collect() == []


def test_null_ids_and_equal_rows(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = sets(spark, [(None, t), (None, t), (5, t), (5, t)])
    assert {r.n_removed for r in substring_dedup(rows).collect()} == {60}
    assert {r.n_removed for r in suffix_dedup(rows).collect()} == {len(t)}
    assert substring_dedup(rows).count() == 4


@pytest.mark.parametrize("op,brute,size", [(substring_dedup, brute_words, 35), (suffix_dedup, brute_bytes, 200)])
def test_table_against_brute_force(spark, op, brute, size):
    spark.conf.set("respengine.llm.chunkBytes", "300000")
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = op(docs, keep_text=False).drop("kept")
    if op is substring_dedup:
        got = got.drop("n_spans")
    got = {r[0]: tuple(r[1:]) for r in got.collect()}
    spark.conf.unset("respengine.llm.chunkBytes")
    assert got == brute(rows, size)


def test_pack_keys():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 5, 5000):
        for shift in (0, 20, 40):
            key = np.unique(rnd.integers(0, 1 << 63, n, np.uint64) >> np.uint64(shift))
            assert (K.unpack(K.pack(key), len(key)) == key).all()


def thue_morse(a, b, length):
    """Two sequences whose polynomials agree modulo 2^64 for every odd base."""
    signs = [bin(i).count("1") % 2 for i in range(length)]
    return [(a, b)[s] for s in signs], [(b, a)[s] for s in signs]


def test_crafted_texts_do_not_collide(spark):
    x, y = (b"".join(p).decode() for p in thue_morse(b"a", b"b", 2048))
    docs = [(1, "k" * 40 + x[:900]), (2, "k" * 40 + y[:900]), (3, x), (4, y)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup(sets(spark, docs)).collect()}
    assert got == brute_bytes(docs, 200)
    lead = " ".join(f"w{i}" for i in range(34))
    words = [(1, f"{lead} {x}"), (2, f"{lead} {y}")]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(sets(spark, words)).collect()}
    assert got == brute_words(words, 35)
    assert all(n == 0 for _, n, _ in got.values())


def test_crafted_long_texts_stay(spark):
    """Noise in both, and between its bytes the two sequences: no window is shared."""
    rnd = random.Random(11)
    noise = [rnd.choice("cdefghijklmnop") for _ in range(4096)]
    x, y = ("".join(n + s for n, s in zip(noise, p)) for p in thue_morse("a", "b", 4096))
    docs = [(1, x), (2, y)]
    assert {n for _, n, _, _ in brute_bytes(docs, 200).values()} == {0}
    assert {r.n_removed for r in suffix_dedup(sets(spark, docs)).collect()} == {0}


def test_word_hashes():
    words = [b"a", b"a\0", b"a\0\0", b"b" * 8, b"b" * 9, b"c" * 32, b"c" * 33, b"d" * 50000]
    data = np.frombuffer(b" ".join(words), np.uint8)
    off = np.array([0, len(data)])
    starts, ends, _ = K.words(data, off)
    one, other = (K.word_hashes(data, starts, ends, s) for s in (1, 2))
    assert len(set(one)) == len(words) and not set(one) & set(other)
    again = np.frombuffer(b"xx " + b" ".join(words[::-1]), np.uint8)
    starts, ends, _ = K.words(again, np.array([0, len(again)]))
    assert K.word_hashes(again, starts, ends, 1).tolist()[1:] == one.tolist()[::-1]


def test_prime_rolling():
    rnd = np.random.default_rng(5)
    data = rnd.integers(0, 256, 3000, np.uint8)
    data[2000:2300] = data[100:400]
    hashes = K.PrimeRolling(data, 9).ranges(np.array([100, 2000, 101]), np.array([400, 2300, 401]))
    assert hashes[0] == hashes[1] != hashes[2] and hashes.max() < (1 << 31)
