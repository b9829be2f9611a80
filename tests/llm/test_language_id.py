"""Language ID: held-out accuracy on a given table, and small cases."""
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from respengine.llm.common import read_table
from respengine.llm.language_id import UNDEFINED, grams, identify, learn
from respengine.llm.queries import op2_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "lang", "text")
    told = op2_language_id(spark, SF)
    assert told.count() == docs.count()
    judged = told.join(docs, "doc_id").where(
        F.col("held_out") & F.col("lang").isNotNull() & (F.col("lang_pred") != UNDEFINED))
    n, right = judged.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 100 and right >= 0.97 * n
    assert told.where("score < 0 or score > 1 or score is null").isEmpty()
    # Without letters, and only then, nothing is predicted.
    lettered = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    assert told.join(docs, "doc_id").where(lettered == (F.col("lang_pred") == UNDEFINED)).isEmpty()


def test_cases(spark, documents):
    rows = [(1, "the cat and the dog and the bird", "en"), (2, "der hund und die katze und das tier", "de"),
            (3, None, "en"), (4, "", "de"), (5, "12 34 !?", None), (6, "the dog and the cat", None),
            (6, "the dog and the cat", None), (7, "und die katze " * 20_000, None), (None, "das tier und der hund", None)]
    docs = documents(rows, lang_pred="string", score="string")
    told = identify(docs, learn(docs.where("lang is not null")))
    assert set(told.columns) == set(docs.columns)
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in told.collect()))
    assert got == [(0, "de"), (1, "en"), (2, "de"), (3, UNDEFINED), (4, UNDEFINED), (5, UNDEFINED), (6, "en"),
                   (6, "en"), (7, "de")]


def test_nothing_learned(spark, documents):
    docs = documents([(1, "some words", "en")])
    none = learn(docs.where("lang is null"))
    assert [(r.lang_pred, r.score) for r in identify(docs, none).collect()] == [(UNDEFINED, 0.0)]
    assert identify(docs.where("doc_id > 5"), learn(docs)).count() == 0


def test_large_alphabets_share_no_place():
    rnd = random.Random(4)
    text = "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) if rnd.random() < 0.9 else " " for _ in range(60_000))
    padded = f" {text} "
    plain = set(text) - {" "}
    plain |= {padded[i:i + 2] for i in range(len(padded) - 1)} - {"  "}
    plain |= {padded[i:i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " "}
    # One letter and a pair with a boundary are told apart by their spaces.
    assert len(plain) > 1 << 16
    assert len(np.unique(grams(text))) == len(plain)


def test_clashing_names_and_ties(spark):
    # Helper columns stay apart from any column of the table, in any case.
    docs = spark.createDataFrame([(1, "abc abc", "aa", "x", 7, None)], "doc_id long, text string, lang string, read string, _read int, __READ int")
    told = identify(docs, learn(docs))
    assert told.columns == [*docs.columns, "lang_pred", "score"]
    assert [(r.lang_pred, r.read, r._read) for r in told.collect()] == [("aa", "x", 7)]
    # Equally near languages: the first in code point order.
    same = spark.createDataFrame([(1, "abc", "zz"), (2, "abc", "bb"), (3, "abc", "cc")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify(same, learn(same)).collect()} == {"bb"}


def plain_counts(text):
    """How often a text has each n-gram, by strings."""
    padded = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    found = [("1", c) for c in padded if c != " "]
    found += [("2", padded[i:i + 2]) for i in range(len(padded) - 1) if padded[i:i + 2] != "  "]
    found += [("3", padded[i - 1:i + 2]) for i in range(1, len(padded) - 1) if padded[i] != " "]
    return Counter(found)


def test_distance_against_brute_force(spark):
    """The nearest profile by plain dictionaries, for texts whose n-grams have distinct ranks."""
    rnd = random.Random(8)
    words = {"aa": ["ka", "kat", "kato", "mi"], "bb": ["ro", "rom", "romu", "li"]}
    rows, i = [], 0
    for lang, vocab in words.items():
        for _ in range(40):
            rows.append((i, " ".join(rnd.choices(vocab, [8, 4, 2, 1], k=30)), lang))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(docs, size=12)
    counts = {lang: {} for lang in words}
    for _, text, lang in rows:
        for g, n in plain_counts(text).items():
            counts[lang][g] = counts[lang].get(g, 0) + n
    for lang in words:  # places follow the counts
        kept = sorted(counts[lang].values(), reverse=True)[:12]
        place = model.place[model.languages.index(lang)][:-1]
        assert sorted(place[place < 12]) == list(range(12)) and len(kept) == 12
    told = {r.doc_id: r for r in identify(docs, model).collect()}
    for i, text, lang in rows:
        mine = plain_counts(text)
        lowest = None
        for other in words:
            known = dict(zip(model.known.tolist(), model.place[model.languages.index(other)].tolist()))
            every, n = np.unique(grams(text), return_counts=True)
            order = sorted(range(len(every)), key=lambda k: (-n[k], model.order[np.searchsorted(model.known, every[k])]
                           if int(every[k]) in known else model.order[-1]))[:12]
            away = sum(12 if known.get(int(every[k]), 12) == 12 else abs(known[int(every[k])] - at) for at, k in enumerate(order))
            lowest = min(lowest, (away, other)) if lowest else (away, other)
        assert len(mine) == len(np.unique(grams(text)))
        assert told[i].lang_pred == lowest[1] == lang
        assert abs(told[i].score - (1 - lowest[0] / (12 * min(12, len(mine))))) < 1e-9
