"""Merkle manifests against trees built in memory."""
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from respengine.llm.merkle_manifest import fold, folded, leaf_hash, manifest

COLUMNS = ("doc_id", "lang", "text")


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H(*low[i:i + 2]) for i in range(0, len(low), 2)])
    return levels


def way(levels, i):
    out = []
    for low in levels[:-1]:
        out.append((low[i ^ 1] if i ^ 1 < len(low) else None, "LR"[~i & 1]))
        i >>= 1
    return out


def brute(rows):
    """Root, and (doc_id, leaf, subroot, siblings, sides) of every row."""
    groups = defaultdict(list)
    for doc_id, text, lang in rows:
        groups[lang].append((doc_id is not None, doc_id or 0, H(*map(encoded, (doc_id, lang, text))), doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([r[2] for r in sorted(groups[g])]) for g in names}
    top, out = tree([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for i, (_, _, leaf, doc_id) in enumerate(sorted(groups[g])):
            steps = way(trees[g], i) + way(top, k)
            out.append((doc_id, leaf, trees[g][-1][0], "".join(s for s, _ in steps if s),
                        "".join(side if s else "-" for s, side in steps)))
    return top[-1][0], out


ROWS = [(i, f"text {i} é", "en") for i in range(41)] + [(i, None, None) for i in range(5)] + [
    (100, "alone", "zz"), (101, "", ""), (None, "no id", "en"), (None, None, "en"), (7, "tie", "en"), (7, "tie", "en"),
    (8, "x" * 300_000, "Ω")] + [(200 + i, "same", f"g{i}") for i in range(6)]


@pytest.mark.parametrize("every", [2, 6])
def test_against_brute_force(documents, every):
    docs = documents([(i, t, g) for i, t, g in ROWS], tree="int", pos="string", hash="int", id="int", n="long")
    made = manifest(docs, columns=COLUMNS, every=every, other=F.when(F.col("doc_id") % 3 == 0, F.lit("0" * 64)))
    root, want = brute(ROWS)
    assert made.root == root
    got = made.proofs().withColumn("folded", fold(F.coalesce("other", "leaf"), F.col("siblings"), F.col("sides"))).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.siblings, r.sides) for r in got) == Counter(want)
    for r in got:  # a changed leaf gives another root
        assert (r.folded == root) == (r.other is None)
    kept = sum(df.count() for df in made.files.levels[1:])
    assert kept <= len(ROWS) / (2 ** every - 1) + len({g for _, _, g in ROWS}) * 7


def test_one_row_and_empty(documents):
    one = manifest(documents([(5, "a", "en")]), columns=COLUMNS)
    row = one.proofs().first()
    assert (row.leaf, row.subroot, row.siblings, row.sides) == (one.root, one.root, "", "")
    none = manifest(documents([]), columns=COLUMNS)
    assert none.root is None and none.proofs().count() == 0


def test_leaf_and_fold(spark):
    docs = spark.createDataFrame([(1, "é日", None)], "doc_id long, text string, lang string")
    assert docs.select(leaf_hash(*[F.col(c) for c in COLUMNS]).alias("h")).first().h == H("1:1", "-", "5:é日")
    a, b = H("a"), H("b")
    assert folded(a, b, "R-") == H(H(a, b))
    assert folded(a, b + b, "RL") == H(b, H(a, b)) and folded(None, b, "R") is None


def test_ranges_are_joined(spark, documents):
    """Places count on over the ranges of a large group."""
    from respengine.llm.common import stored
    from respengine.llm.ranks import ranked
    rows = stored(spark.range(1000).selectExpr("if(id < 700, 'hot', concat('g', id % 7)) as g", "id % 300 as x", "id"), "test")
    placed, groups = ranked(rows, "g", ["x"], label="test", rows_per_range=90)
    found = defaultdict(list)
    for r in placed.collect():
        found[r.g].append((r.pos, r.x, r.n))
    assert sum(map(len, found.values())) == 1000
    for members in found.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members)))
        assert [m[1] for m in members] == sorted(m[1] for m in members)
        assert {m[2] for m in members} == {len(members)}
    assert {r.g: r.n for r in groups.collect()} == {g: len(m) for g, m in found.items()}
