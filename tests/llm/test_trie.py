"""The conversation trie against a trie of dictionaries."""
import random
import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from respengine.llm import conversation_trie as C
from respengine.llm.conversation_trie import conversation_trie, placed_turns, prefix_trie

FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_id")


def ident(role, text):
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute(convs):
    """``convs``: id to list of (role, text)."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        way = tuple(ident(r, t) for r, t in convs[c])
        for d in range(len(way) + 1):
            members[way[:d]].append(c)
            if d:
                children[way[:d - 1]].add(way[:d])
        ends[way].append(c)
    words = {ident(r, t): len(re.findall(r"[^\x20\x09-\x0D]+", t)) for turns in convs.values() for r, t in turns}
    leaves, saved = defaultdict(int), defaultdict(int)
    for v in sorted(members, key=len, reverse=True):
        leaves[v] += not children[v]
        saved[v] += (len(members[v]) - 1) * words[v[-1]] if v else 0
        if v:
            leaves[v[:-1]] += leaves[v]
            saved[v[:-1]] += saved[v]
    return sorted(((min(m), len(v), min(members[v[:-1]]) if v else None, len(m), len(children[v]), leaves[v], saved[v],
                    sha256(",".join(map(str, sorted(ends[v]))).encode()).hexdigest(), v[-1] if v else None)
                   for v, m in members.items()), key=repr)


def collected(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=repr)


def planted(seed=4):
    rnd = random.Random(seed)
    turn = lambda i, n=3: ("assistant" if i % 2 else "user", f"turn {rnd.randrange(n)} of" + " word" * rnd.randrange(3))
    convs = {c: [turn(i) for i in range(rnd.randrange(1, 9))] for c in range(-4, 120)}
    same = [turn(i, 100) for i in range(5)]
    convs |= {c: list(same) for c in range(200, 260)}  # copies over several shards
    head = [turn(i, 100) for i in range(C.HEAD + 3)]  # alike beyond the sharded ids
    convs |= {c: head + [turn(i) for i in range(rnd.randrange(3))] for c in range(300, 350)}
    long = [turn(i, 50) for i in range(C.BAND * 3 + 7)]
    convs |= {400: list(long), 401: long[:C.BAND], 402: long[:C.BAND * 2], 403: long[:C.BAND + 1], 404: long[:150] + [turn(1, 99)],
              405: long[:C.BAND * 2], 406: long[:C.BAND - 1]}
    convs[500] = [("", "")]
    convs[501] = [("", ""), ("", "")]
    return convs


def table(spark, convs, extra=()):
    rows = [(c, i, r or None, t or None) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([(*r, "x", 1) for r in [*rows, *extra]],
                                 "conv_id long, turn long, role string, text string, key string, total int")


@pytest.mark.parametrize("size", [20_000, 23])
def test_against_brute_force(spark, size):
    convs = planted()
    placed, _ = placed_turns(table(spark, convs, [(None, 0, "user", "nobody")]))
    turns = placed.select("conv_id", F.col("pos").alias("at"), F.col("n").alias("total"), "id", "words")
    turnless = spark.createDataFrame([(600,), (3_000_000_000,)], "conv_id long")
    got = collected(prefix_trie(turns, turnless, rows_per_shard=size))
    assert got == brute(convs | {600: [], 3_000_000_000: []})


def test_order_ties_and_empty(spark):
    rows = [(1, None, "user", "first"), (1, 3, "user", "b"), (1, 2, "user", "a"), (2, 0, "x", "same"), (2, 0, "x", "same"),
            (3, 5, "b", "y"), (3, 5, "a", "z")]
    convs = {1: [("user", "first"), ("user", "a"), ("user", "b")], 2: [("x", "same")] * 2, 3: [("a", "z"), ("b", "y")]}
    assert collected(conversation_trie(table(spark, {}, rows))) == brute(convs)
    assert conversation_trie(table(spark, {}, [(None, 0, "user", "nobody")]).limit(0)).count() == 0
