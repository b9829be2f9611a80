"""Substring deduplication by difference-cover anchors (words).

A window is ``window`` consecutive words of one document. Two equal windows at word
positions i and j share an offset d below ``period`` with both i+d and j+d at cover
positions (positions whose remainder modulo the period is in the difference cover), so
hashing ``window - period + 1`` words at cover positions only finds an aligned anchor in
every repeated window. Windows around repeated anchors are then extended: the whole
window is hashed to 80 bits and counted over the corpus. The hashes are keyed by a
secret of the call (see ``kernels``): windows that differ are taken for equal by chance
only, about 40 pairs among 10^13 windows, and texts made to collide cannot be prepared
(a chance of 2^-45 a pair and hash at most).

Three passes over each chunk of documents, joined by two exchanges of sorted key blocks:
anchors out, repeated anchors back; whole windows out, repeated windows back; removal.

Defined results: null and empty texts have no words; a text below ``window`` words loses
nothing; equal rows and equal texts count as separate occurrences; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respengine.llm import kernels as K
from respengine.llm.common import chunk_count, chunked

# Fixed value: a perfect difference set modulo 21; every residue is a difference of two.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)

RESULT = ("doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, "
          "kept string")


def _anchors(hashes: np.ndarray, off: np.ndarray, window: int):
    """Positions of cover anchors, and their keys."""
    size = window - PERIOD + 1
    left = K.room(off)
    local = np.arange(len(hashes)) - np.repeat(off[:-1], np.diff(off))
    mask = np.zeros(PERIOD, bool)
    mask[list(COVER)] = True
    at = np.flatnonzero(mask[local % PERIOD] & (left >= size))
    raw = K.Rolling(hashes).ranges(at, at + size)
    return at, K.Keys(K.mix(raw))


def _candidates(off: np.ndarray, at: np.ndarray, shared: np.ndarray, total: int, window: int):
    """Starts of whole windows that hold a repeated anchor in their first words."""
    hit = np.zeros(total + 1, np.int64)
    a = at[shared]
    np.add.at(hit, np.maximum(a - (PERIOD - 1), 0), 1)
    np.add.at(hit, a + 1, -1)
    return np.flatnonzero((np.cumsum(hit)[:total] > 0) & (K.room(off) >= window))


def _windows(hashes: np.ndarray, starts: np.ndarray, window: int) -> K.Keys:
    key = K.mix(K.Rolling(hashes).ranges(starts, starts + window))
    other = K.Rolling(K.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))).ranges(starts, starts + window)
    return K.Keys(key, (K.mix(other) >> np.uint64(48)).astype(np.uint16))


def substring_dedup(docs: DataFrame, *, window: int = 35, id_col: str = "doc_id",
                    text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per document: what is left without the words of repeated windows.

    ``kept`` (words joined by one space) is null with ``keep_text=False``.
    """
    if window < PERIOD:
        raise ValueError(f"window must have at least {PERIOD} words")
    n = chunk_count(docs, text_col)
    salt = K.new_salt()
    base = chunked(docs, n, id_col=id_col, text_col=text_col)

    def ask_anchors(table: pa.Table) -> pa.Table:
        hashes, off = K.table_words(table, salt)
        _, keys = _anchors(hashes, off, window)
        return K.request_table(table.column("chunk")[0].as_py(), keys, n)

    def located(table: pa.Table, answers: pa.Table):
        hashes, off = K.table_words(table, salt)
        at, keys = _anchors(hashes, off, window)
        shared = keys.to_items(K.answered(answers, len(keys.key)) | (keys.count > 1))
        starts = _candidates(off, at, shared, len(hashes), window)
        return off, starts, _windows(hashes, starts, window)

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return K.request_table(0, K.Keys(np.zeros(0, np.uint64)), n)
        _, _, keys = located(table, answers)
        return K.request_table(table.column("chunk")[0].as_py(), keys, n)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        level = answers.column("level")
        first = answers.filter(pa.compute.equal(level, 1))
        second = answers.filter(pa.compute.equal(level, 2))
        off, starts, keys = located(table, first)
        twice = keys.to_items(K.answered(second, len(keys.key)) | (keys.count > 1))
        change = np.zeros(int(off[-1]) + 1, np.int64)
        starts = starts[twice]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        gone = np.cumsum(change)[:-1] > 0
        rows = {"doc_id": [], "n_words": [], "n_removed": [], "n_spans": [], "kept_sha256": [],
                "kept": []}
        ids, texts = table.column("doc_id").to_pylist(), table.column("text")
        for i, doc_id in enumerate(ids):
            cut = gone[off[i]:off[i + 1]]
            removed = int(cut.sum())
            mine = texts[i].as_py().encode("utf-8").split()
            kept = b" ".join(compress(mine, ~cut) if removed else mine)
            edges = np.diff(cut.astype(np.int8), prepend=np.int8(0)) == 1
            rows["doc_id"].append(doc_id)
            rows["n_words"].append(len(mine))
            rows["n_removed"].append(removed)
            rows["n_spans"].append(int(edges.sum()))
            rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            rows["kept"].append(kept.decode("utf-8") if keep_text else None)
        return pa.table(rows, schema=pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]))

    grouped = lambda df: df.groupBy("chunk")
    ask1 = grouped(base).applyInArrow(ask_anchors, K.REQUEST)
    back1 = ask1.groupBy("part").applyInArrow(K.repeated, K.ANSWER)
    ask2 = grouped(base).cogroup(grouped(back1)).applyInArrow(ask_windows, K.REQUEST)
    back2 = ask2.groupBy("part").applyInArrow(K.repeated, K.ANSWER)
    both = back1.withColumn("level", F.lit(1)).unionAll(back2.withColumn("level", F.lit(2)))
    return grouped(base).cogroup(grouped(both)).applyInArrow(remove, RESULT)
