"""Language identification by rank-order n-gram profiles.

A text's letters, lower-cased, give n-grams of one to three characters (anything that is
not a letter is a word boundary). A profile lists the most frequent n-grams of a language
in order; a document is compared with each profile by the out-of-place distance: the sum,
over the document's own most frequent n-grams, of how far each is from its place in the
profile (the profile's length if it is not there). The nearest profile wins.

N-grams are kept as 64-bit numbers, no two of them alike. Training counts all labelled
texts: tasks emit their counts per language (in between, once they hold two million),
Spark sums them, and ``profile_size`` n-grams a language reach the driver. Equal counts
are ordered by number.

Defined results: ``und`` with score 0 for a null text, a text without letters, or when
nothing could be learned; ties between languages go to the first in code point order;
rows with a null label train nothing; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respengine.llm.common import free_name, text_of

HELD = 4_000_000
UNDEFINED = "und"
PROFILE_SIZE = 300

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str) -> np.ndarray:
    """The n-grams of a text as numbers, in order of place."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, 0).astype(np.uint64)
    padded = np.concatenate([np.zeros(1, np.uint64), points, np.zeros(1, np.uint64)])
    letter = points > 0
    # Code points have 21 bits. One letter: the top bit and the letter. Two and three
    # characters: at least one letter, 0 in the middle, and a letter in the middle.
    one = points[letter] | np.uint64(1 << 63)
    pairs = (padded[:-1] << np.uint64(42) | padded[1:])[(padded[:-1] > 0) | (padded[1:] > 0)]
    three = (padded[:-2] << np.uint64(42) | points << np.uint64(21) | padded[2:])[letter]
    return np.concatenate([one, pairs, three])


class Profiles:
    """Place of every n-gram in every language's profile."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        """``rows``: language, n-gram, place from 0."""
        self.size = size
        self.languages = sorted({r[0] for r in rows}, key=lambda s: s.encode("utf-8"))
        index = {name: i for i, name in enumerate(self.languages)}
        self.known = np.unique(np.array([r[1] for r in rows], np.int64).astype(np.uint64))
        # The last column is that of n-grams in no profile.
        self.place = np.full((len(self.languages), len(self.known) + 1), size, np.int32)
        for lang, gram, place in rows:
            at = np.searchsorted(self.known, np.int64(gram).astype(np.uint64))
            self.place[index[lang], at] = place
        # Equal counts inside a document are ordered by how common an n-gram is overall.
        self.order = np.argsort(np.argsort(self.place.sum(axis=0), kind="stable"))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text) if text else np.zeros(0, np.uint64)
        if not len(found) or not self.languages:
            return UNDEFINED, 0.0
        every, counts = np.unique(found, return_counts=True)
        at = np.searchsorted(self.known, every)
        at[self.known[np.minimum(at, len(self.known) - 1)] != every] = len(self.known)
        top = at[np.lexsort((self.order[at], -counts))[:self.size]]
        place = self.place[:, top]
        away = np.abs(place - np.arange(len(top)))
        distance = np.where(place == self.size, self.size, away).sum(axis=1)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(top))


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: empty text)."""
    as_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(as_text.cast("binary")) % modulus).cast("int")


def learn(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
          size: int = PROFILE_SIZE) -> Profiles:
    """Profiles from all rows of ``labelled`` with a language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        held = 0

        def add_up() -> int:
            for lang, found in raw.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                if lang in sums:
                    gram, where = np.unique(np.concatenate([sums[lang][0], gram]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([sums[lang][1], n])).astype(np.int64)
                sums[lang] = gram, n
            raw.clear()
            return sum(len(g) for g, _ in sums.values())

        def emit():
            for lang, (gram, n) in sums.items():
                yield pa.record_batch({"lang": pa.array([lang] * len(gram), pa.string()),
                                       "gram": pa.array(gram.view(np.int64)), "n": pa.array(n, pa.int64())})
            sums.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = grams(text)
                raw.setdefault(lang, []).append(found)
                held += len(found)
                if held > HELD:
                    held = 0
                    if add_up() > HELD // 2:  # a varied corpus: pass on what there is
                        yield from emit()
        add_up()
        yield from emit()

    rows = labelled.select(text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("lang is not null and text != ''")
    counts = rows.mapInArrow(count, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= size)
    return Profiles([(r.lang, r.gram, r.place - 1) for r in top.collect()], size)


def identify(docs: DataFrame, profiles: Profiles, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replacing columns of these names)."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    # Read by place: the column may share its name with one of ``kept``.
    rows = docs.select(*kept, F.col(text_col).cast("string").alias(free_name(docs.columns, "read")))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            got = [model.predict(t) for t in batch.column(len(kept)).to_pylist()]
            columns = [batch.column(i) for i in range(len(kept))] + [
                pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(predict, schema)
