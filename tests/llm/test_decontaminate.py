"""Decontamination against brute force over all windows."""
import random
import re
from collections import Counter

from respengine.llm.decontaminate import contaminated

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width=5):
    w = words(text)
    return [tuple(w[k:k + width]) for k in range(len(w) - width + 1)]


def best(doc, item):
    """The largest similarity of a window of the document and the item."""
    n, found = len(item), 0.0
    if not n or not doc:
        return found
    want = Counter(item)
    for s in range(max(1, len(doc) - n + 1)):
        window = Counter(doc[s:s + n])
        common = sum((window & want).values())
        found = max(found, common / (sum(window.values()) + n - common))
    return found


def brute(docs, items):
    """An item below five words is one shingle, its whole sequence."""
    widths = {j: min(5, len(words(t))) for j, t in items}
    hashed = {j: shingles(t, widths[j]) if widths[j] else [] for j, t in items}
    cut = {(i, w): shingles(t, w) for i, t in docs for w in {*widths.values()} - {0}}
    return {(i, j): s for i, t in docs for j, item in hashed.items()
            if widths[j] and (s := best(cut[i, widths[j]], item)) >= 0.75}


def planted(seed=9):
    rnd = random.Random(seed)
    text = lambda n: [f"w{rnd.randrange(400)}" for _ in range(n)]
    items = [(j, text(n)) for j, n in enumerate((12, 25, 40, 60, 5, 3))]
    items.append((6, ["same"] * 30))
    docs, i = [], 0
    for j, item in items:
        for changes in (0, 1, 2, 4):
            copy = list(item)
            for _ in range(changes):
                copy[rnd.randrange(len(copy))] = "other"
            i += 1
            docs.append((i, " ".join(text(rnd.randrange(40)) + copy + text(rnd.randrange(40))).title()))
    docs += [(70 + j, " ".join(text(30) + item[:-1] + ["last"] + text(30))) for j, item in items]
    docs += [(i + 1 + k, " ".join(text(120))) for k in range(10)]
    docs += [(90, " ".join(items[3][1][:55])), (91, None), (92, ""), (93, "one two"), (94, "same " * 3000)]
    return docs, [(j, " ".join(t)) for j, t in items] + [(7, None), (8, "")]


def test_brute_force(spark, documents):
    docs, items = planted()
    found = contaminated(documents(docs, item_id="string", n="int", h="string"),
                         spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    want = brute(docs, items)
    assert len(want) >= 15
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_short_items(spark, documents):
    texts = ["yes", "To be", "one two three", "a b c d", "a b c e"]
    items = list(enumerate(texts)) + [(9, " "), (10, None)]
    docs = [(1, "YES"), (2, "yes no"), (3, "to  be or not to be"), (4, "x one two three four"), (5, "one two"),
            (6, "a b c d e"), (7, "yesterday"), (8, None), (9, ""), (10, "a b c")]
    found = contaminated(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found.collect()}
    assert got == {(1, 0): (1.0, 0), (2, 0): (1.0, 0), (3, 1): (1.0, 0), (4, 2): (1.0, 1), (6, 3): (1.0, 0)}


def test_beyond_the_broadcast_bounds(spark, documents):
    """Several blocks of items, and joins that shuffle, give the same rows."""
    docs, items = planted(4)
    docs, items = documents(docs), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, contaminated(docs, items).collect()))
    spark.conf.set("respengine.broadcastMaxRows", "60")
    try:
        assert sorted(map(tuple, contaminated(docs, items).collect())) == want
    finally:
        spark.conf.unset("respengine.broadcastMaxRows")


def test_repeated_item_ids(spark, documents):
    items = [(1, "a b c d e f g h"), (1, "k l m n o p q r"), (1, "a b c d e f g h"), (1, "z"), (None, "a b c d e f g h")]
    docs = [(1, "a b c d e f g h"), (2, "y k l m n o p q r"), (3, "z")]
    found = contaminated(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id or 0, r.similarity) for r in found) == [
        (1, 0, 1.0), (1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)]


def test_repeats_in_windows(spark, documents):
    """Places shared more often than the item has them do not count."""
    rnd = random.Random(5)
    items = [(j, " ".join(rnd.choice("xyz") for _ in range(rnd.randrange(6, 40)))) for j in range(12)]
    docs = [(i, " ".join(rnd.choice("xyz") for _ in range(rnd.randrange(4, 150)))) for i in range(60)]
    docs += [(100 + j, "x y " * 20 + t + " z" * 30) for j, t in items]
    found = contaminated(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.similarity for r in found.collect()}
    want = brute(docs, items)
    assert len(want) >= 12 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_repeated_rows_and_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    docs = documents([(1, "x A B C D E F G H y"), (1, "x A B C D E F G H y"), (None, "a b c d e f g h")])
    assert sorted((r.doc_id or 0, r.item_id) for r in contaminated(docs, items).collect()) == [(0, 1), (1, 1)]
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0
