"""Quality classification by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by a filter's
width less one, so every window of the whole text lies in a chunk. In a chunk, learned
byte embeddings go through learned filters at every position; each filter's largest value
in the chunk is kept (max pooling), and two layers make a logit of these. A text's
probability is that of the mean logit of all its chunks, however long it is.

Training takes a bounded sample: of the labelled rows at most ``sample`` of each label, in
order of a hash of their ids, and of each of these texts at most ``CHUNKS`` chunks, evenly
spread over the whole text. That much reaches the driver (``sample * 2 * CHUNKS * CHUNK``
bytes, 16 MiB by default), where Adam fits the weights; the log odds of all labelled rows,
counted by Spark, replace those of the sample. Scoring runs over Arrow batches in the
tasks, a bounded number of chunks at a time.

Defined results: a null or empty text is one chunk of padding; rows without an id, a text
or a label of 0 or 1 teach nothing; with labels of one kind only, every score is the share
of label 1 among them, smoothed (1/2 without any); equal texts get equal scores; repeated
label rows count as often as they are there; an empty table gives an empty result; extra
columns are kept, those named ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respengine.llm.common import free_name

CHUNK, WIDTH, EMBED, FILTERS, HIDDEN = 512, 8, 4, 32, 32
STEP = CHUNK - WIDTH + 1
PAD = 256
SAMPLE, CHUNKS = 2048, 8
EPOCHS, BATCH, RATE = 14, 64, 0.01
# Chunks that go through the network at once.
PASS = 64
THRESHOLD = 0.3


def chunks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The chunks at ``starts``, padded, as rows of byte numbers."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < len(data)
    out = np.full(at.shape, PAD, np.int16)
    out[inside] = data[at[inside]]
    return out


def chunk_starts(size: int) -> np.ndarray:
    """Starts of the chunks that cover every window of a text of ``size`` bytes."""
    return np.arange(max(1, -(-(size - WIDTH + 1) // STEP))) * STEP


@dataclass
class Network:
    """The weights by name, and how far the sample's log odds are from those of all rows."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0
    constant: float | None = None

    @classmethod
    def fresh(cls, seed: int = 0) -> Network:
        rnd = np.random.default_rng(seed)
        normal = lambda scale, *shape: rnd.normal(0, scale, shape).astype(np.float32)
        embed = normal(1.0, PAD + 1, EMBED)
        embed[PAD] = 0
        return cls({"embed": embed, "filter": normal((WIDTH * EMBED) ** -0.5, WIDTH * EMBED, FILTERS),
                    "offset": np.zeros(FILTERS, np.float32), "hidden": normal(FILTERS ** -0.5, FILTERS, HIDDEN),
                    "lean": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN ** -0.5, HIDDEN), "bias": np.zeros(1, np.float32)})

    def pooled(self, rows: np.ndarray, places: bool = False):
        """Largest value of each filter in each chunk (and where it is)."""
        w, count = self.weights, len(rows)
        seen = w["embed"][rows].reshape(count, -1)
        windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * EMBED, axis=1)[:, ::EMBED]
        best = np.empty((count, FILTERS), np.float32)
        where = np.empty((count, FILTERS), np.int64) if places else None
        for first in range(0, count, PASS):
            part = windows[first:first + PASS]
            value = (np.ascontiguousarray(part).reshape(-1, WIDTH * EMBED) @ w["filter"]).reshape(*part.shape[:2], FILTERS)
            best[first:first + PASS] = value.max(axis=1)
            if places:
                where[first:first + PASS] = value.argmax(axis=1)
        return (best + w["offset"], where) if places else best + w["offset"]

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kept values, hidden values and logits of chunks."""
        kept = np.maximum(pooled, 0)
        hidden = np.tanh(kept @ self.weights["hidden"] + self.weights["lean"])
        return kept, hidden, hidden @ self.weights["out"] + self.weights["bias"]

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self.head(self.pooled(rows))[2]

    def gradient(self, rows: np.ndarray, owner: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of texts; ``owner``: the text of each chunk."""
        w = self.weights
        pooled, where = self.pooled(rows, places=True)
        kept, hidden, logit = self.head(pooled)
        size = np.bincount(owner, minlength=len(label))
        mean = np.bincount(owner, logit, len(label)) / size
        error = (1 / (1 + np.exp(-mean)) - label) / len(label)
        d_logit = (error / size)[owner].astype(np.float32)
        d_hidden = d_logit[:, None] * w["out"] * (1 - hidden ** 2)
        d_pooled = (d_hidden @ w["hidden"].T) * (pooled > 0)
        # Only the window with the largest value learns.
        at = rows[np.arange(len(rows))[:, None, None], where[:, :, None] + np.arange(WIDTH)]
        seen = w["embed"][at]  # chunk, filter, place, embedding
        d_filter = np.einsum("cf,cfpe->pef", d_pooled, seen).reshape(WIDTH * EMBED, FILTERS)
        d_seen = d_pooled[:, :, None, None] * w["filter"].T.reshape(FILTERS, WIDTH, EMBED)
        flat = at.ravel()
        d_embed = np.stack([np.bincount(flat, d_seen[..., e].ravel(), PAD + 1) for e in range(EMBED)], axis=1)
        d_embed[PAD] = 0
        return {"embed": d_embed, "filter": d_filter, "offset": d_pooled.sum(axis=0), "hidden": kept.T @ d_hidden,
                "lean": d_hidden.sum(axis=0), "out": hidden.T @ d_logit, "bias": d_logit.sum(keepdims=True)}

    def fit(self, texts: list[np.ndarray], label: np.ndarray, *, epochs: int = EPOCHS, seed: int = 0) -> None:
        """Adam over the chunks of ``texts`` (one array of rows each)."""
        rnd, step = np.random.default_rng(seed), 0
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        total = epochs * -(-len(texts) // BATCH)
        for _ in range(epochs):
            order = rnd.permutation(len(texts))
            for first in range(0, len(order), BATCH):
                mine = order[first:first + BATCH]
                owner = np.repeat(np.arange(len(mine)), [len(texts[i]) for i in mine])
                given = self.gradient(np.concatenate([texts[i] for i in mine]), owner, label[mine])
                step += 1
                rate = RATE * (1 - (step - 1) / total)
                for k, g in given.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    change = rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - change).astype(np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 of whole texts."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        total, size = np.zeros(len(texts)), np.zeros(len(texts))
        held, owner, room = [], [], 8 * PASS

        def empty():
            logit = self.logits(np.concatenate(held))
            whose = np.concatenate(owner)
            total[:] += np.bincount(whose, logit, len(texts))
            size[:] += np.bincount(whose, minlength=len(texts))
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            data = np.frombuffer(text, np.uint8)
            starts = chunk_starts(len(data))
            for first in range(0, len(starts), room):
                some = starts[first:first + room]
                held.append(chunks(data, some))
                owner.append(np.full(len(some), i))
                if sum(map(len, held)) >= room:
                    empty()
        if held:
            empty()
        return 1 / (1 + np.exp(-(total / size + self.shift)))


def _sampled_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows of text, label and id: up to ``CHUNKS`` chunks, evenly spread over the text."""
    for batch in batches:
        out = []
        for text in batch.column(0).to_pylist():
            data = np.frombuffer(text.encode("utf-8"), np.uint8)
            starts = chunk_starts(len(data))
            if len(starts) > CHUNKS:
                starts = np.linspace(0, len(data) - CHUNK, CHUNKS).astype(np.int64)
            out.append(b"".join(data[s:s + CHUNK].tobytes().ljust(CHUNK, b"\xff") for s in starts))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1), batch.column(2)],
                                         names=["chunks", "label", "id"])


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE, epochs: int = EPOCHS) -> Network:
    """A network fitted to the rows of ``labels`` (id, 0 or 1) and their texts."""
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .where("id is not null and label in (0, 1)")
    counts = {r.label: r["count"] for r in given.groupBy("label").count().collect()}
    if len(counts) < 2:
        only = counts.get(1, 0) + 0.5
        return Network(constant=only / (sum(counts.values()) + 1))
    picked = [given.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(sample) for k in (0, 1)]
    # At most 2 * sample rows of two numbers.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .where("text is not null").join(F.broadcast(picked[0].unionAll(picked[1])), "id")
    kept = rows.select(F.lit(None).cast("binary").alias("chunks"), "label", "id").schema
    got = rows.select("text", "label", "id").mapInArrow(_sampled_chunks, kept).toArrow()
    got = got.sort_by([("id", "ascending"), ("label", "ascending")])  # the same in every run
    label, texts = got.column("label").to_numpy(), []
    for some in got.column("chunks").to_pylist():
        raw = np.frombuffer(some, np.uint8).reshape(-1, CHUNK)
        texts.append(np.where(raw == 0xFF, PAD, raw).astype(np.int16))  # 0xFF is in no UTF-8 text
    if len(set(label.tolist())) < 2:
        return Network(constant=(counts[1] + 0.5) / (counts[0] + counts[1] + 1))
    net = Network.fresh()
    net.fit(texts, label.astype(np.float64), epochs=epochs)
    net.shift = float(np.log(counts[1] / counts[0]) - np.log(label.sum() / (len(label) - label.sum())))
    return net


def classify(docs: DataFrame, network: Network, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    # Read by place: the column may share its name with one of ``kept``.
    rows = docs.select(*kept, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(free_name(docs.columns, "read")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            score = net.score([t.encode("utf-8") for t in batch.column(len(kept)).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(kept))], pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32))], names=[*kept, "score", "predicted"])

    return rows.mapInArrow(run, docs.select(*kept).schema.add("score", "double").add("predicted", "integer"))
