"""Language-model scores by prediction by partial matching (PPM).

A-Z are lower-cased first, for the model's bytes and for the words alike.

The model is a trie of byte contexts of up to ``ORDER`` bytes. A byte is coded in the
longest known context; where that has not seen it, an escape (method C: as likely as the
context has distinct successors) leads to the next shorter context, in which the bytes
just ruled out are excluded. Every text ends with the byte 0xFF, which UTF-8 never uses,
and begins in a context of zero bytes. The trie is pretrained: all n-grams of all training
texts are counted, and none is left out. It stays distributed: each order is a table of
its n-grams, joined with the next shorter order (at most 256 rows a key), so the code
length of every n-gram of the corpus is a table too. ``capacity``, if a caller sets it,
keeps only about the so many most frequent n-grams of each order, by count classes.

Each chunk of documents asks for the code lengths of its distinct n-grams by sorted
blocks, one per part, and in the same request for the counts of its distinct words by
64-bit hash (the word base model needs the count of every word of the corpus; no
vocabulary is broadcast). Parts add up the training counts of all chunks and answer in
the same order.

Defined results: null and empty texts have no words, one end token and the code length of
their end byte; with nothing to learn from, N and V are 0 and bytes are uniform; repeated
rows are scored (and counted) each; a null id is in the training part unless the checksum
of the empty text says otherwise; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respengine.llm import kernels as K
from respengine.llm.common import chunk_count, chunked, stored, text_of

ORDER = 4
END = 255

PACK = 1 << 20

ASKED = "chunk int, part int, keys binary, counts binary, grams binary"
PACKED = "part int, grams binary, costs binary"
ANSWERED = "chunk int, part int, totals binary, costs binary, words long, tokens long"
RESULT = ("doc_id long, n_tokens long, n_known long, known_log10 double, score double")


# -- byte n-grams -----------------------------------------------------------------------

def byte_grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end byte: the byte and the ``ORDER`` bytes
    before it as one number. Also the offset of each text among them."""
    count = len(off) - 1
    step = ORDER + 1
    place = np.arange(len(data)) + np.repeat(np.arange(count) * step + ORDER, np.diff(off))
    line = np.zeros(len(data) + count * step, np.uint64)
    line[place] = data
    ends = off[1:] + np.arange(count) * step + ORDER
    line[ends] = END
    grams = line.copy()
    for k in range(1, step):
        grams[k:] |= line[:-k] << np.uint64(8 * k)
    coded = np.ones(len(line), bool)
    begins = ends - np.diff(off) - ORDER
    coded[(begins[:, None] + np.arange(ORDER)).ravel()] = False
    return grams[coded], off + np.arange(count + 1)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every n-gram of the batches (text, train), and how often training rows have it."""
    keys, counts, held = [], [], 0

    def merged():
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        return every, np.bincount(where, np.concatenate(counts)).astype(np.int64)

    for batch in batches:
        train = batch.column(1).to_numpy(zero_copy_only=False)
        for first, data, off in K.text_slices(pa.Table.from_batches([batch])):
            grams, at = byte_grams(K.lower_ascii(data), off)
            found, where = np.unique(grams, return_inverse=True)
            keys.append(found)
            counts.append(np.bincount(where, np.repeat(train[first:first + len(off) - 1], np.diff(at))))
            held += len(found)
        if held > 4_000_000:
            k, c = merged()
            keys, counts, held = [k], [c], len(k)
            if held > 2_000_000:  # a varied corpus: pass on what there is
                yield pa.record_batch({"gram": pa.array(k.astype(np.int64)), "n": pa.array(c)})
                keys, counts, held = [], [], 0
    if keys:
        k, c = merged()
        yield pa.record_batch({"gram": pa.array(k.astype(np.int64)), "n": pa.array(c)})


def _low(column: Column, size: int) -> Column:
    """The last ``size`` bytes of an n-gram."""
    return column.bitwiseAND(F.lit((1 << (8 * size)) - 1).cast("long"))


def _limited(orders: list[DataFrame], capacity: int) -> list[DataFrame]:
    """The orders with the counts of all but about ``capacity`` n-grams each set to 0."""
    out, least = [], 0
    for grams in orders:
        # Frequencies by eighths of a power of two: at most 512 classes, taken from the top.
        level = F.floor(F.log2("n") * 8)
        classes = grams.where("n > 0").groupBy(level.alias("c")).count().collect()
        room, lowest = capacity, 0
        for c, count in sorted(((r.c, r["count"]) for r in classes), reverse=True):
            room -= count
            if room < 0:
                lowest = c + 1
                break
        least = max(least, lowest)  # a kept n-gram keeps its shorter ones
        kept = (F.col("n") > 0) & (level >= least)
        out.append(grams.withColumn("n", F.when(kept, F.col("n")).otherwise(0)))
    return out


def gram_costs(docs: DataFrame, capacity: int | None = None) -> DataFrame:
    """``gram, cost``: log10 probability of the last byte of every full n-gram of ``docs``
    (text, train), as learned from the rows with ``train``."""
    counted = docs.select("text", "train").mapInArrow(_count_grams, "gram long, n long")
    # n-grams of other rows are in the tables with count 0: they are asked for, not learned.
    orders = [stored(counted.groupBy("gram").agg(F.sum("n").alias("n")), "lm_score/grams")]
    for k in range(ORDER - 1, -1, -1):
        orders.insert(0, stored(orders[0].groupBy(_low(F.col("gram"), k + 1).alias("gram"))
                                .agg(F.sum("n").alias("n")), "lm_score/grams"))
    if capacity is not None:
        orders = _limited(orders, capacity)
    seen = F.col("n") > 0

    # ``total``, ``kinds``: count and distinct successors of the context. ``escaped``: cost
    # from the next shorter context on, once the context is known and has not seen the byte.
    total, kinds = orders[0].agg(F.sum("n"), F.sum(seen.cast("long"))).first()
    total, kinds = total or 0, kinds or 0
    table = orders[0].withColumn("total", F.lit(total).cast("long")).withColumn("kinds", F.lit(kinds).cast("long")) \
        .withColumn("escaped", F.lit(-log10(256 - kinds) if kinds < 256 else 0.0)) \
        .withColumn("shorter", F.col("escaped"))
    table = _with_cost(table)
    for k in range(1, ORDER + 1):
        below = table.select(F.col("gram").alias("below"), F.col("n").alias("below_n"),
                             F.col("total").alias("below_total"), F.col("kinds").alias("below_kinds"),
                             F.col("escaped").alias("below_escaped"), F.col("cost").alias("shorter"))
        context = Window.partitionBy(F.shiftright("gram", 8))
        # In the next shorter context, without the symbols seen in this one.
        gone = F.sum(F.when(seen, F.col("below_n")).otherwise(0)).over(context)
        others = F.col("below_kinds") - F.col("kinds")
        whole = F.col("below_total") - F.col("gone") + others
        escaped = F.when(F.col("below_n") > 0, F.log10("below_n") - F.log10(whole)) \
            .when(others > 0, F.log10(others / whole) + F.col("below_escaped")) \
            .otherwise(F.col("below_escaped"))
        joined = orders[k].withColumn("below", _low(F.col("gram"), k)).join(below, "below") \
            .withColumns({"total": F.sum("n").over(context), "kinds": F.sum(seen.cast("long")).over(context),
                          "gone": gone})
        table = _with_cost(joined.withColumn("escaped", F.when((F.col("total") > 0) & ~seen, escaped)))
    return table.select("gram", "cost")


def _with_cost(table: DataFrame) -> DataFrame:
    """Adds ``cost``, where the context of the row is the longest that is looked at."""
    all_ = F.col("total") + F.col("kinds")
    return table.withColumn("cost", F.when(F.col("total") == 0, F.col("shorter"))
                            .when(F.col("n") > 0, F.log10("n") - F.log10(all_))
                            .otherwise(F.log10(F.col("kinds") / all_) + F.col("escaped")))


def _pack(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Costs by part, some blocks for each. The keys are the mixed n-grams (no two alike)."""
    held, rows = [], 0

    def packed():
        table = pa.Table.from_batches(held)
        keys = K.Keys(K.mix(table.column("gram").to_numpy().astype(np.uint64)))
        costs = table.column("cost").to_numpy()[keys.order]
        blocks = list(keys.blocks(parts))
        return pa.record_batch({"part": pa.array([p for p, _ in blocks], pa.int32()),
                                "grams": pa.array([keys.key[s].tobytes() for _, s in blocks], pa.binary()),
                                "costs": pa.array([costs[s].tobytes() for _, s in blocks], pa.binary())})

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= PACK:
            yield packed()
            held, rows = [], 0
    if rows:
        yield packed()


class ChunkGrams:
    """The distinct full n-grams of a chunk, and the scores of its texts."""

    def __init__(self, table: pa.Table):
        self.slices = []
        for _, data, off in K.text_slices(table):
            grams, at = byte_grams(K.lower_ascii(data), off)
            self.slices.append((*np.unique(grams, return_inverse=True), at))
        self.every = np.unique(np.concatenate([s[0] for s in self.slices]))
        self.keys = K.Keys(K.mix(self.every))

    def scores(self, answers: np.ndarray) -> np.ndarray:
        if len(answers) != len(self.every):
            raise RuntimeError(f"{len(answers)} answers for {len(self.every)} n-grams")
        costs = self.keys.to_items(answers)
        return np.concatenate([np.add.reduceat(costs[np.searchsorted(self.every, found)][where], at[:-1])
                               for found, where, at in self.slices])


# -- words ------------------------------------------------------------------------------

def _answer(table: pa.Table, packed: pa.Table) -> pa.Table:
    """For the blocks of one part: word counts added up, and costs of n-grams."""
    blocks, grams = _arrays(table, "keys", np.uint64), _arrays(table, "grams", np.uint64)
    keys, where = np.unique(np.concatenate(blocks), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, where, np.concatenate(_arrays(table, "counts", np.int64)))
    answers = np.split(total[where], np.cumsum([len(b) for b in blocks])[:-1])

    none = np.zeros(0, np.uint64)
    known = np.concatenate([none, *_arrays(packed, "grams", np.uint64)])
    order = np.argsort(known)
    cost = np.concatenate([none.astype(np.float64), *_arrays(packed, "costs", np.float64)])[order]
    known, asked = known[order], np.concatenate(grams)
    at = np.searchsorted(known, asked)
    if len(asked) and (at.max() >= len(known) or (known[np.minimum(at, len(known) - 1)] != asked).any()):
        raise RuntimeError("an n-gram without a cost")
    costs = np.split(cost[at], np.cumsum([len(g) for g in grams])[:-1])
    n = table.num_rows
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                     "totals": pa.array([a.tobytes() for a in answers], pa.binary()),
                     "costs": pa.array([c.tobytes() for c in costs], pa.binary()),
                     "words": pa.array([int((total > 0).sum())] * n, pa.int64()),
                     "tokens": pa.array([int(total.sum())] * n, pa.int64())})


def _arrays(table: pa.Table, column: str, dtype: type) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype) for b in table.column(column).to_pylist()]


def lm_score(docs: DataFrame, training: Column, *, id_col: str = "doc_id", text_col: str = "text",
             capacity: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``training`` tells which rows of ``docs`` are learned from.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       F.coalesce(training, F.lit(False)).alias("train"))
    n = chunk_count(docs)
    salt = K.new_salt()
    packed = gram_costs(docs, capacity).mapInArrow(partial(_pack, parts=n), PACKED)
    base = chunked(docs, n, train=F.col("train"))

    def ask(table: pa.Table) -> pa.Table:
        hashes, off = K.table_words(table, salt, lower=True)
        learned = np.repeat(table.column("train").to_numpy(zero_copy_only=False), np.diff(off))
        keys = K.Keys(hashes)
        counts = np.add.reduceat(learned[keys.order].astype(np.int64), np.flatnonzero(keys.new)) \
            if len(hashes) else np.zeros(0, np.int64)
        grams = ChunkGrams(table).keys
        blocks = {p: (keys.key[s].tobytes(), counts[s].tobytes(), b"") for p, s in keys.blocks(n)}
        for p, s in grams.blocks(n):
            blocks[p] = (*blocks.get(p, (b"", b""))[:2], grams.key[s].tobytes())
        rows = sorted(blocks.items())
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()] * len(rows), pa.int32()),
                         "part": pa.array([p for p, _ in rows], pa.int32()),
                         "keys": pa.array([r[0] for _, r in rows], pa.binary()),
                         "counts": pa.array([r[1] for _, r in rows], pa.binary()),
                         "grams": pa.array([r[2] for _, r in rows], pa.binary())})

    asked = base.groupBy("chunk").applyInArrow(ask, ASKED)
    answers = stored(asked.groupBy("part").cogroup(packed.groupBy("part")).applyInArrow(_answer, ANSWERED),
                     "lm_score/answers")
    words, tokens = answers.select("part", "words", "tokens").distinct().agg(
        F.sum("words"), F.sum("tokens")).first()
    learned = docs.where("train").count()
    tokens = (tokens or 0) + learned
    vocabulary = (words or 0) + (1 if learned else 0)
    scale = log10(tokens + 0.1 * (vocabulary + 1))

    def score(table: pa.Table, totals: pa.Table) -> pa.Table:
        hashes, off = K.table_words(table, salt, lower=True)
        keys = K.Keys(hashes)
        totals = totals.sort_by("part")
        counts, costs = (np.concatenate([np.zeros(0, t), *_arrays(totals, c, t)])
                         for c, t in (("totals", np.int64), ("costs", np.float64)))
        if len(counts) != len(keys.key):
            raise RuntimeError(f"{len(counts)} answers for {len(keys.key)} words")
        per_word = keys.to_items(counts)
        known = _sums((per_word > 0).astype(np.int64), off) + (1 if learned else 0)
        logs = _sums(np.log10(per_word + 0.1), off) + log10(learned + 0.1)
        return pa.table({"doc_id": table.column("doc_id"), "n_tokens": pa.array(np.diff(off) + 1, pa.int64()),
                         "n_known": pa.array(known, pa.int64()), "known_log10": pa.array(logs, pa.float64()),
                         "score": pa.array(ChunkGrams(table).scores(costs), pa.float64())})

    told = answers.select("chunk", "part", "totals", "costs")
    scored = base.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, RESULT)
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         (F.col("known_log10") - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score")


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` per text (0 for texts without any)."""
    out = np.zeros(len(off) - 1, values.dtype)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        out[full] = np.add.reduceat(values, off[full])
    return out
