"""Logistic regression whose weights never come together on one machine.

The same update as ``model`` (MLlib's rule, the bias as one more column of ones), with the
weights cut into ranges of ``width`` indices (``RANGE`` by default), one table row each.
Narrow ranges travel together: a slab is as many consecutive ranges as leave ``SLABS`` slabs,
but never more than ``RANGE`` indices, so what an iteration moves does not grow with the
number of ranges times that of blocks. Training rows are packed once into blocks; a block
knows its distinct indices slab by slab, in the checkpoint folder. An iteration is one Spark
job:

1. Pull. A slab meets the lists of the blocks that touch it (a bounded number of indices
   to a group, so a slab used by all blocks is several groups) and answers with its weights.
2. Gradient. A block puts its answers together, and turns them into the partial gradient of
   its own indices with numpy.
3. Push. Partial gradients are sorted to their slab, streamed into one dense slice, and its
   updated ranges are written: the new weights are a reliable checkpoint, and lineage ends.

Only the squared lengths of the weights and of their change reach the driver. Memory of a
task: one block and its answers, or one slab. The table of the iteration before is deleted
once the next is written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lifetime import Lifetime, delete_table, own_table
from ..session import ensure_checkpoint_dir, materialize
from .blocks import BLOCK_ENTRIES, BLOCK_ROWS, numbered_blocks
from .model import MAX_ENTRIES_PER_TASK, MIN_ENTRIES_PER_TASK, looked_up_margins, scored

# Indices of one row of weights (at most 2^16: places in a range are 16-bit).
RANGE = 1 << 16
# Slabs that ranges are put together into, while a slab stays under RANGE indices.
SLABS = 32
# Indices asked of a slab in one group, about.
ENTRIES_PER_PULL = 1 << 22

_BLOCKS = ("block long, n int, label binary, lengths binary, place binary, val binary, "
           "asked array<struct<slab: int, at: binary>>")
_PULLED = "block long, slab int, at binary, w binary"
_PUSHED = "slab int, range int, at binary, g binary"
_WEIGHTS = "range int, w binary, moved double, length double"


@dataclass
class RangedModel:
    """Weights as a table ``range, w`` (little-endian float64 of ``width`` indices each)."""

    spark: SparkSession
    path: str
    num_features: int
    has_intercept: bool
    iterations: int
    step_size: float
    reg_param: float
    width: int = RANGE

    def table(self) -> DataFrame:
        return self.spark.read.schema(_WEIGHTS).parquet(self.path)

    @property
    def intercept(self) -> float:
        """The last index of the last range: one number to the driver."""
        if not self.has_intercept:
            return 0.0
        at, width = self.num_features, self.width
        piece = F.substring(F.col("w"), at % width * 8 + 1, 8)
        row = self.table().where(F.col("range") == at // width).select(piece.alias("b")).first()
        return float(np.frombuffer(bytes(row["b"]), "<f8")[0])

    def weights_df(self, name: str = "weight", index: str = "idx") -> DataFrame:
        """``(idx INT, weight DOUBLE)``, distributed by range; no intercept."""
        d, width = self.num_features, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    w = np.frombuffer(raw, "<f8")[:max(0, min(width, d - r * width))]
                    yield pa.record_batch({index: pa.array((r * width + np.arange(len(w))).astype(np.int32)),
                                           name: pa.array(w)})

        return self.table().select("range", "w").mapInArrow(run, f"`{index}` int, `{name}` double")


def _pack(d: int, slab: int, intercept: bool, block_rows: int, block_entries: int):
    """Partition function: rows of (label, indices, values) -> blocks."""
    step = min(4096, block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, rows, entries = numbered_blocks(), [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            y = table.column("label").to_numpy()
            if not np.all((y == 0.0) | (y == 1.0)):
                raise ValueError("labels must be 0 or 1")
            ind, val = (table.column(c).combine_chunks() for c in ("indices", "values"))
            lengths = pc.fill_null(pc.list_value_length(ind), 0).to_numpy(zero_copy_only=False).astype(np.int32)
            idx = ind.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            val = val.flatten().to_numpy(zero_copy_only=False)
            if len(idx) and (idx.min() < 0 or idx.max() >= d):
                raise ValueError(f"feature index outside [0, {d})")
            seen, place = np.unique(idx, return_inverse=True)
            if intercept:
                seen = np.append(seen, d)
            cuts = np.flatnonzero(np.diff(seen // slab)) + 1
            asked = [{"slab": int(part[0] // slab), "at": (part % slab).astype("<u2").tobytes()}
                     for part in np.split(seen, cuts) if len(part)]
            return pa.record_batch({
                "block": pa.array([next(number)], pa.int64()), "n": pa.array([len(y)], pa.int32()),
                "label": pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
                "lengths": pa.array([lengths.tobytes()], pa.binary()),
                "place": pa.array([place.astype(np.int32).tobytes()], pa.binary()),
                "val": pa.array([None if np.all(val == 1.0) else val.astype("<f8").tobytes()], pa.binary()),
                "asked": pa.array([asked], pa.list_(pa.struct([("slab", pa.int32()), ("at", pa.binary())])))})

        for batch in batches:
            for first in range(0, batch.num_rows, step):
                some = batch.slice(first, step)
                held.append(some)
                rows += some.num_rows
                entries += pc.sum(pc.list_value_length(some.column("indices"))).as_py() or 0
                if rows >= block_rows or entries >= block_entries:
                    yield block()
                    held, rows, entries = [], 0, 0
        if rows:
            yield block()

    return run


def _pull(asks: pa.Table, weights: pa.Table) -> pa.Table:
    """The weights that some blocks ask of a slab."""
    w = np.frombuffer(b"".join(weights.sort_by("range").column("w").to_pylist()), "<f8")
    got = [w[np.frombuffer(at, "<u2")].tobytes() for at in asks.column("at").to_pylist()]
    return pa.table({"block": asks.column("block"), "slab": asks.column("slab"), "at": asks.column("at"),
                     "w": pa.array(got, pa.binary())})


def _gradient(intercept: bool):
    """A block's partial gradient, slab by slab."""
    def run(block: pa.Table, pulled: pa.Table) -> pa.Table:
        pulled = pulled.sort_by("slab")
        at = pulled.column("at").to_pylist()
        w = np.concatenate([np.zeros(0), *[np.frombuffer(x, "<f8") for x in pulled.column("w").to_pylist()]])
        row = {c: block.column(c)[0].as_py() for c in ("n", "label", "lengths", "place", "val")}
        n, y = row["n"], np.frombuffer(row["label"], np.uint8).astype(np.float64)
        place = np.frombuffer(row["place"], np.int32)
        owner = np.repeat(np.arange(n), np.frombuffer(row["lengths"], np.int32))
        val = None if row["val"] is None else np.frombuffer(row["val"], "<f8")
        margin = np.bincount(owner, w[place] if val is None else w[place] * val, n)
        if intercept:
            margin = margin + w[-1]
        with np.errstate(over="ignore"):
            resid = 1.0 / (1.0 + np.exp(-margin)) - y
        g = np.zeros(len(w))  # (bincount of nothing gives integers)
        g += np.bincount(place, resid[owner] if val is None else resid[owner] * val, len(w))
        if intercept:
            g[-1] = resid.sum()
        cuts = np.cumsum([len(x) // 2 for x in at])[:-1]
        return pa.table({"slab": pulled.column("slab"), "range": pa.nulls(len(at), pa.int32()), "at": pulled.column("at"),
                         "g": pa.array([x.tobytes() for x in np.split(g, cuts)] if at else [], pa.binary())})
    return run


def _push(rows: int, step: float, reg: float):
    """Partition function over rows of a slab, the weights of its ranges first: the updated ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ranges, held, g = None, [], [], None

        def done() -> pa.RecordBatch:
            cuts = np.cumsum([len(w) for w in held])[:-1]
            old, grad = held, np.split(np.zeros(sum(map(len, held))) if g is None else g, cuts)
            new = [w * (1.0 - step * reg) - step * (part / rows) for w, part in zip(old, grad)]
            return pa.record_batch({
                "range": pa.array(ranges, pa.int32()), "w": pa.array([w.tobytes() for w in new], pa.binary()),
                "moved": pa.array([float(((w - before) ** 2).sum()) for w, before in zip(new, old)], pa.float64()),
                "length": pa.array([float((w ** 2).sum()) for w in new], pa.float64())})

        for batch in batches:
            for slab, r, at, raw in zip(*[batch.column(c).to_pylist() for c in ("slab", "range", "at", "g")]):
                part = np.frombuffer(raw, "<f8")
                if at is None:  # the weights of a range, before the gradients of its slab
                    if held and slab != current:
                        yield done()
                        ranges, held, g = [], [], None
                    current = slab
                    ranges.append(r)
                    held.append(part)
                else:
                    if g is None:
                        g = np.zeros(sum(map(len, held)))
                    g[np.frombuffer(at, "<u2")] += part
        if held:
            yield done()

    return run


def _start(d: int, width: int, intercept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.column(0).to_pylist():
                w = np.zeros(min(width, d + int(intercept) - r * width))
                if intercept and r == d // width:
                    w[d % width] = 1.0
                yield pa.record_batch({"range": pa.array([r], pa.int32()), "w": pa.array([w.tobytes()], pa.binary()),
                                       "moved": pa.array([0.0]), "length": pa.array([0.0])})
    return run


def fit_logistic_ranged(encoded: DataFrame, num_features: int, iterations: int = 50,
                        step_size: float = 10.0, reg_param: float = 1e-6, reg_type: str | None = "l2",
                        intercept: bool = True, tol: float = 1e-3, width: int = RANGE,
                        block_rows: int = BLOCK_ROWS, block_entries: int = BLOCK_ENTRIES) -> RangedModel:
    """Fit one logistic model by full-batch gradient descent, weights cut by index range."""
    if reg_type not in ("l2", None):
        raise ValueError("reg_type must be 'l2' or None")
    if not 0 < width <= RANGE:
        raise ValueError(f"width must be in [1, {RANGE}]")
    spark, d = encoded.sparkSession, int(num_features)
    ranges = max(1, -(-(d + int(intercept)) // width))
    together = max(1, min(RANGE // width, ranges // SLABS))
    rows = encoded.select(F.col("label").cast("double").alias("label"),
                          F.col("indices").cast("array<int>").alias("indices"),
                          F.col("values").cast("array<double>").alias("values"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables"
    path = None

    def write(weights: DataFrame, number: int) -> str:
        nonlocal path
        after = f"{folder}/{owner}-{number}"
        weights.write.parquet(after)
        if path is not None:
            delete_table(spark, path)
        path = after
        return after

    with Lifetime(spark) as mine:
        packed = materialize(rows.mapInArrow(_pack(d, together * width, intercept, block_rows, block_entries), _BLOCKS))
        owner = mine.tables[-1].rsplit("/", 1)[-1]
        stats = packed.agg(F.sum("n"), F.sum(F.octet_length("place"))).first()
        n, entries = int(stats[0] or 0), int(stats[1] or 0) // 4
        # A task for every slot, but none for less than MIN_ENTRIES_PER_TASK entries: an
        # iteration's fixed cost is that of its tasks.
        tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-entries // MIN_ENTRIES_PER_TASK)),
                    -(-entries // MAX_ENTRIES_PER_TASK))
        # (two bytes an index)
        most = packed.select(F.inline("asked")).groupBy("slab").agg(F.sum(F.octet_length("at")).alias("b")).agg(F.max("b")).first()[0]
        pulls = max(1, -(-int(most or 0) // (2 * ENTRIES_PER_PULL)))
        # Laid out once as the joins of every iteration need them.
        asks = packed.select("block", F.inline("asked"), F.pmod(F.xxhash64("block"), F.lit(pulls)).alias("pull")) \
            .repartition(tasks, "slab", "pull").persist(StorageLevel.MEMORY_AND_DISK)
        data = packed.drop("asked").repartition(tasks, "block").persist(StorageLevel.MEMORY_AND_DISK)
        mine.frames += [asks, data]
        write(spark.range(ranges).mapInArrow(_start(d, width, intercept), _WEIGHTS), 0)
        done = 0
        for i in range(1, iterations + 1 if n else 1):
            weights = spark.read.schema(_WEIGHTS).parquet(path) \
                .select((F.col("range") / F.lit(together)).cast("int").alias("slab"), "range", "w")
            spread = weights.withColumn("pull", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(pulls - 1).cast("bigint")))) \
                .repartition(tasks, "slab", "pull")
            pulled = asks.groupBy("slab", "pull").cogroup(spread.groupBy("slab", "pull")).applyInArrow(_pull, _PULLED) \
                .repartition(tasks, "block")
            pushed = data.groupBy("block").cogroup(pulled.groupBy("block")).applyInArrow(_gradient(intercept), _PUSHED)
            both = weights.select("slab", "range", F.lit(None).cast("binary").alias("at"), F.col("w").alias("g")).unionAll(pushed)
            step = step_size / math.sqrt(i)
            updated = both.repartition(tasks, "slab").sortWithinPartitions("slab", F.col("at").isNotNull(), "range") \
                .mapInArrow(_push(n, step, reg_param if reg_type else 0.0), _WEIGHTS)
            moved, length = spark.read.schema(_WEIGHTS).parquet(write(updated, i)) \
                .agg(F.sum("moved"), F.sum("length")).first()
            done = i
            if i > 1 and math.sqrt(moved) < tol * max(math.sqrt(length), 1.0):
                break
    own_table(path)
    return RangedModel(spark, path, d, intercept, done, float(step_size), float(reg_param), width)


def predict_ranged(model: RangedModel, encoded: DataFrame, hot_idx: DataFrame | None = None) -> DataFrame:
    """``(row_id, label, score)``: weights are looked up by blocks of rows, never broadcast."""
    table = model.weights_df("w_0", "indices").where("w_0 != 0")
    margins = looked_up_margins(encoded, table, 1, table_rows=model.num_features, hot_idx=hot_idx, max_broadcast_rows=0)
    return scored(margins, [model.intercept]).withColumnRenamed("score_0", "score")
