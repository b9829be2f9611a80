"""L2-regularised logistic regression by full-batch gradient descent, and scoring.

The update rule is the one of Spark MLlib's ``LogisticRegressionWithSGD``
(mini-batch fraction 1): with a bias column of ones appended and the bias
started at 1.0, iteration ``i`` takes ``s = step / sqrt(i)``,
``g = mean(x * (sigmoid(x.w) - y))`` and ``w = w * (1 - s * reg) - s * g``
(the bias is shrunk too), and stops once
``|w_i - w_{i-1}| < tol * max(|w_i|, 1)``.

The training rows are first packed into blocks of raw buffers (as Spark ML
stacks instances into blocks) and cached. Per iteration the weights of every
model still being fitted travel as one broadcast, and each task turns its
blocks into one partial gradient with numpy. While ``models x (d + 1)`` stays
under 4M values, the blocks are held as an RDD prepared once, as MLlib holds its
points: an iteration is then one small job without a plan of its own, and the
dense partial gradients are cut into slices, each of which one task adds up (or
added up straight on the driver, while all of them together are under 64K values).
Beyond that the gradients are summed per index by a grouped sum. Either way only
``d + 1`` values per model and iteration reach the driver, however many tasks there
are; ``model_ranges`` fits models whose weights should not reach it at all. Several
models (a grid) share each pass over the data.

Scoring happens inside the row: an Arrow function over the list columns against
one broadcast weight matrix, without a shuffle. Weights beyond the broadcast
bound are looked up by blocks of rows (``blocks``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clamped_sigmoid
from ..lifetime import own_broadcast
from ..session import materialize
from .blocks import Block, answers, packed, with_answers
from .joins import broadcast_byte_limit, broadcast_row_limit, hot_threshold

# Dense per-task accumulation up to this many doubles, sparse emission beyond.
_DENSE_ACC_LIMIT = 1 << 22
# Partial gradients go straight to the driver when partitions * models * (d + 1)
# stays under this bound (512 KB an iteration); beyond it they are summed on the
# executors first, slice by slice (dense) or by a grouped sum on the index (sparse).
_DIRECT_REDUCE_LIMIT = 1 << 16
# Values of a partial gradient below which it is not cut into more slices.
_MIN_SLICE = 1 << 12
# Partial gradient rows (a StructType: no DDL parsing in every iteration).
_GRAD_SCHEMA = T.StructType([T.StructField("k", T.IntegerType()),
                             T.StructField("idx", T.IntegerType()),
                             T.StructField("g", T.DoubleType())])
# Bound on the weights broadcast per iteration (all models of one pass).
DEFAULT_WEIGHT_BROADCAST_BYTES = 1 << 30


@dataclass
class LogisticModel:
    """Weights (``d`` float64 values on the driver) and intercept."""
    weights: np.ndarray
    intercept: float
    step_size: float = 0.0
    reg_param: float = 0.0
    iterations: int = 0

    @property
    def num_features(self) -> int:
        return int(self.weights.shape[0])

    def weights_df(self, spark: SparkSession, include_intercept: bool = True) -> DataFrame:
        """``(idx INT, weight DOUBLE)``; the intercept is ``idx = -1``."""
        idx = np.arange(self.num_features, dtype=np.int32)
        w = self.weights
        if include_intercept:
            idx = np.concatenate([np.array([-1], dtype=np.int32), idx])
            w = np.concatenate([np.array([self.intercept]), w])
        table = pa.table({"idx": pa.array(idx, pa.int32()), "weight": pa.array(w, pa.float64())})
        return _table_df(spark, table)


def _table_df(spark: SparkSession, table: pa.Table) -> DataFrame:
    """A frame from a driver-side Arrow table; frozen to the checkpoint folder when large."""
    df = spark.createDataFrame(table)
    if table.num_rows > broadcast_row_limit(spark):
        df = materialize(df)
    return df


_BLOCK_SCHEMA = ("n int, m long, idx_bytes byte, label binary, lengths binary, idx binary, "
                 "val binary")
# Stored entries below which another task costs more than it saves.
MIN_ENTRIES_PER_TASK = 1 << 20
# Stored entries beyond which partitions are not merged (about 256 MB of blocks).
MAX_ENTRIES_PER_TASK = 1 << 26
# Rows, and stored entries, after which a packed block of training data is closed.
DEFAULT_BLOCK_ROWS = 1 << 16
DEFAULT_BLOCK_ENTRIES = 1 << 23


def _pack_fn(block_rows: int, num_features: int):
    """Partition function: rows of (label, indices, values) -> packed blocks.

    A block holds up to ``block_rows`` rows as raw little-endian buffers:
    labels (uint8), row lengths (int32), flat indices (uint16 when ``d`` allows,
    else int32) and flat values (float64, null when every value in the block
    is 1.0, as for one-hot data). Blocks are what the fit caches and rereads in
    every iteration, so their size is the per-iteration IO at scale.
    """
    idx_type = np.uint16 if num_features <= 1 << 16 else np.int32

    def run(batches):
        ys, ls, fis, fvs, count = [], [], [], [], 0

        def flush():
            y = np.concatenate(ys)
            fv = np.concatenate(fvs)
            val = None if fv.size == 0 or bool(np.all(fv == 1.0)) else fv.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([y.shape[0]], pa.int32()), pa.array([fv.size], pa.int64()),
                 pa.array([np.dtype(idx_type).itemsize], pa.int8()),
                 pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
                 pa.array([np.concatenate(ls).tobytes()], pa.binary()),
                 pa.array([np.concatenate(fis).astype(idx_type).tobytes()], pa.binary()),
                 pa.array([val], pa.binary())],
                names=["n", "m", "idx_bytes", "label", "lengths", "idx", "val"])

        for rb in batches:
            if rb.num_rows == 0:
                continue
            ind, val = rb.column("indices"), rb.column("values")
            y = rb.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.all((y == 0.0) | (y == 1.0)):
                raise ValueError("labels must be 0 or 1")
            fi = ind.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if fi.size and (int(fi.max()) >= num_features or int(fi.min()) < 0):
                raise ValueError(f"feature index outside [0, {num_features})")
            ys.append(y)
            ls.append(ind.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                      .astype(np.int32))
            fis.append(fi)
            fvs.append(val.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            count += rb.num_rows
            if count >= block_rows or sum(f.size for f in fis) >= DEFAULT_BLOCK_ENTRIES:
                yield flush()
                ys, ls, fis, fvs, count = [], [], [], [], 0
        if count:
            yield flush()

    return run


def _block_gradient(block: tuple, W: np.ndarray, d: int, intercept: bool):
    """Of one packed block: residual sums by stored entry. Yields ``k, indices, values, bias``:
    model k's contributions, index by index as stored, and its bias gradient."""
    nrows, idx_bytes, label, lengths, idx, val = block
    y = np.frombuffer(label, np.uint8).astype(np.float64)
    lengths = np.frombuffer(lengths, np.int32)
    fi = np.frombuffer(idx, np.uint16 if idx_bytes == 2 else np.int32)
    fv = None if val is None else np.frombuffer(val, np.float64)
    rows = np.repeat(np.arange(nrows), lengths)
    with np.errstate(over="ignore"):
        for k in range(W.shape[0]):
            wk = W[k, fi] if fv is None else W[k, fi] * fv
            margin = np.bincount(rows, weights=wk, minlength=nrows)
            if intercept:
                margin = margin + W[k, d]
            resid = 1.0 / (1.0 + np.exp(-margin)) - y
            yield k, fi, resid[rows] if fv is None else resid[rows] * fv, resid.sum()


_BLOCK_COLUMNS = ("n", "idx_bytes", "label", "lengths", "idx", "val")


def _dense_gradient_fn(bc, d: int, intercept: bool):
    """Partition function: packed blocks -> one dense ``(K, d + 1)`` array (the bias last)."""
    def run(blocks):
        W = bc.value
        acc = np.zeros((W.shape[0], d + 1))
        for block in blocks:
            for k, fi, contrib, bias in _block_gradient(block, W, d, intercept):
                acc[k, :d] += np.bincount(fi, weights=contrib, minlength=d)
                acc[k, d] += bias
        yield acc

    return run


def _sliced(pieces: int):
    """Partition function: a task's partial gradients -> ``(slice, (task, values))``."""
    def run(task, partials):
        for acc in partials:
            for k, part in enumerate(np.array_split(acc.ravel(), pieces)):
                yield k, (task, part)

    return run


def _slice_sum(parts):
    """Partition function: the parts of one slice -> ``(slice, sum)``, added up in the tasks' order."""
    held = sorted(parts, key=lambda p: p[1][0])
    if held:
        yield held[0][0], sum((part for _, (_, part) in held), np.zeros_like(held[0][1][1]))


def _sparse_gradient_fn(bc, d: int, intercept: bool):
    """Partition function: packed blocks -> rows ``(k, idx, g)`` of the indices each block
    touches (the bias is idx = d)."""
    def run(batches):
        W = bc.value
        for rb in batches:
            for block in zip(*[rb.column(c).to_pylist() for c in _BLOCK_COLUMNS]):
                for k, fi, contrib, bias in _block_gradient(block, W, d, intercept):
                    uniq, inv = np.unique(fi, return_inverse=True)
                    ids = np.concatenate([uniq, [d]]).astype(np.int32)
                    g = np.append(np.bincount(inv, weights=contrib, minlength=uniq.shape[0]), bias)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(ids.shape[0], k, np.int32)), pa.array(ids), pa.array(g)],
                        names=["k", "idx", "g"])

    return run


class _Blocks:
    """Packed training rows, cached, and the gradient of a set of models over them."""

    def __init__(self, data: DataFrame, d: int, models: int, intercept: bool):
        self.data, self.d, self.intercept = data, d, intercept
        self.parts = data.rdd.getNumPartitions()
        self.prepared = None
        if models * (d + 1) <= _DENSE_ACC_LIMIT:
            self.prepared = data.select(*_BLOCK_COLUMNS).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
            self.prepared.count()
            data.unpersist()

    def gradient(self, W: np.ndarray) -> np.ndarray:
        sc = self.data.sparkSession.sparkContext
        bc = sc.broadcast(W)
        try:
            if self.prepared is None:
                return self._sparse(bc, W)
            partial = self.prepared.mapPartitions(_dense_gradient_fn(bc, self.d, self.intercept))
            if self.parts == 1 or self.parts * W.size <= _DIRECT_REDUCE_LIMIT:
                return sum(partial.collect(), np.zeros_like(W))
            # A task that adds up a slice holds one part of it from every task: about W again.
            pieces = max(1, min(self.parts, W.size // _MIN_SLICE))
            sums = partial.mapPartitionsWithIndex(_sliced(pieces)).partitionBy(pieces, lambda k: k) \
                .mapPartitions(_slice_sum).collect()
            return np.concatenate([part for _, part in sorted(sums, key=lambda s: s[0])]).reshape(W.shape)
        finally:
            bc.destroy()

    def _sparse(self, bc, W: np.ndarray) -> np.ndarray:
        partial = self.data.mapInArrow(_sparse_gradient_fn(bc, self.d, self.intercept), _GRAD_SCHEMA)
        if self.parts * W.size > _DIRECT_REDUCE_LIMIT:
            partial = partial.groupBy("k", "idx").agg(F.sum("g").alias("g"))
        grads = partial.toArrow()
        G = np.zeros_like(W)
        np.add.at(G, (grads.column("k").to_numpy(), grads.column("idx").to_numpy()),
                  grads.column("g").to_numpy())
        return G

    def release(self) -> None:
        self.data.unpersist()
        if self.prepared is not None:
            self.prepared.unpersist()


def fit_logistic_many(encoded: DataFrame, num_features: int, configs, iterations: int = 50,
                      intercept: bool = True, reg_type: str | None = "l2",
                      tol: float = 1e-3, block_rows: int = DEFAULT_BLOCK_ROWS,
                      max_broadcast_bytes: int = DEFAULT_WEIGHT_BROADCAST_BYTES
                      ) -> list[LogisticModel]:
    """Fit one model per ``(step_size, reg_param)`` in ``configs``, sharing each data pass.

    The weights of all models in a pass are broadcast every iteration; when
    ``models x (d + 1) x 8`` bytes would exceed ``max_broadcast_bytes``, the
    models are fitted in consecutive groups that stay under it. A single model
    above the bound is refused (``model_ranges.fit_logistic_ranged`` fits it).
    """
    if reg_type not in ("l2", None):
        raise ValueError("reg_type must be 'l2' or None")
    configs = list(configs)
    if 8 * (int(num_features) + 1) > max_broadcast_bytes:
        raise ValueError(
            f"{num_features} weights need {8 * (int(num_features) + 1)} bytes per broadcast, "
            f"above max_broadcast_bytes={max_broadcast_bytes}: fit_logistic_ranged keeps the "
            "weights on the executors; or hash the features into fewer buckets, or raise the bound")
    per_pass = max(1, int(max_broadcast_bytes // (8 * (int(num_features) + 1))))
    if len(configs) > per_pass:
        out: list[LogisticModel] = []
        for start in range(0, len(configs), per_pass):
            out.extend(fit_logistic_many(encoded, num_features, configs[start:start + per_pass],
                                         iterations, intercept, reg_type, tol, block_rows,
                                         max_broadcast_bytes))
        return out
    spark = encoded.sparkSession
    sc = spark.sparkContext
    d = int(num_features)
    configs = [(float(s), float(r)) for s, r in configs]
    K = len(configs)
    rows = encoded.select(F.col("label").cast("double").alias("label"),
                          F.col("indices").cast("array<int>").alias("indices"),
                          F.col("values").cast("array<double>").alias("values"))
    # Packed once and cached: each iteration then hands a few large buffers per
    # partition to Python instead of converting every row to Arrow again.
    data = rows.mapInArrow(_pack_fn(block_rows, d), _BLOCK_SCHEMA).persist(
        StorageLevel.MEMORY_AND_DISK)
    blocks = None
    try:
        stats = data.agg(F.sum("n").alias("rows"), F.sum("m").alias("entries"),
                         F.count(F.lit(1)).alias("blocks")).first()
        n, num_blocks = int(stats["rows"] or 0), int(stats["blocks"])
        # Blocks are the unit of work. Aim for one task per slot, but no more
        # tasks than blocks and none with less than MIN_ENTRIES_PER_TASK
        # entries: spread blocks (a one-off shuffle of a few large rows) or merge
        # partitions (no shuffle) to get there. Slots seen now (few under dynamic
        # allocation) never make a task larger than MAX_ENTRIES_PER_TASK.
        entries = int(stats["entries"] or 0)
        want = max(1, min(num_blocks, sc.defaultParallelism, -(-entries // MIN_ENTRIES_PER_TASK)),
                   min(num_blocks, -(-entries // MAX_ENTRIES_PER_TASK)))
        have = data.rdd.getNumPartitions()
        if have != want:
            moved = (data.repartition(want) if have < want else data.coalesce(want)).persist(
                StorageLevel.MEMORY_AND_DISK)
            moved.count()
            data.unpersist()
            data = moved
        blocks = _Blocks(data, d, K, intercept)
        W = np.zeros((K, d + 1))
        if intercept:
            W[:, d] = 1.0
        steps = np.array([c[0] for c in configs])
        regs = np.array([c[1] for c in configs]) if reg_type == "l2" else np.zeros(K)
        active = np.ones(K, dtype=bool)
        done_at = np.full(K, iterations, dtype=int)
        if n == 0:
            active[:] = False
        for i in range(1, iterations + 1):
            if not active.any():
                break
            ks = np.flatnonzero(active)
            G = blocks.gradient(W[ks]) / n
            if not intercept:
                G[:, d] = 0.0
            s = (steps[ks] / np.sqrt(i))[:, None]
            new = W[ks] * (1.0 - s * regs[ks][:, None]) - s * G
            if i > 1:
                diff = np.linalg.norm(new - W[ks], axis=1)
                conv = diff < tol * np.maximum(np.linalg.norm(new, axis=1), 1.0)
            else:
                conv = np.zeros(ks.shape[0], dtype=bool)
            W[ks] = new
            for j, k in enumerate(ks):
                if conv[j]:
                    active[k] = False
                    done_at[k] = i
    finally:
        data.unpersist()
        if blocks is not None:
            blocks.release()
    return [LogisticModel(weights=W[k, :d].copy(), intercept=float(W[k, d]) if intercept else 0.0,
                          step_size=configs[k][0], reg_param=configs[k][1],
                          iterations=int(done_at[k]))
            for k in range(K)]


def fit_logistic_gd(encoded: DataFrame, num_features: int, iterations: int = 50,
                    step_size: float = 10.0, reg_param: float = 1e-6,
                    reg_type: str | None = "l2", intercept: bool = True,
                    tol: float = 1e-3) -> LogisticModel:
    """Fit one logistic model by full-batch gradient descent (see module doc)."""
    return fit_logistic_many(encoded, num_features, [(step_size, reg_param)], iterations,
                             intercept=intercept, reg_type=reg_type, tol=tol)[0]


def _weights_table(spark: SparkSession, models: list[LogisticModel]) -> DataFrame:
    """``(indices, w_0 .. w_{K-1})`` over the union of indices with a non-zero weight."""
    stacked = np.vstack([m.weights for m in models])
    keep = np.flatnonzero(np.any(stacked != 0.0, axis=0)).astype(np.int32)
    cols = {"indices": pa.array(keep, pa.int32())}
    for k in range(len(models)):
        cols[f"w_{k}"] = pa.array(stacked[k, keep], pa.float64())
    return _table_df(spark, pa.table(cols))


def _margin_fn(bc):
    """Arrow function: margins (without intercept) of every model for rows of list columns."""
    def margins(indices: pa.Array, values: pa.Array) -> pa.Array:
        W = bc.value  # (K, d)
        K, d = W.shape
        rows, idx, val = _entries(indices, values)
        known = (idx >= 0) & (idx < d)
        rows, idx, val = rows[known], idx[known], val[known]
        out = np.zeros((len(indices), K))
        for k in range(K):
            out[:, k] = np.bincount(rows, weights=W[k, idx] * val, minlength=len(indices))
        off = pa.array(np.arange(len(indices) + 1, dtype=np.int32) * K)
        return pa.ListArray.from_arrays(off, pa.array(out.ravel()))

    return F.arrow_udf(margins, "array<double>")


def _entries(indices: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, index and value of every stored entry (a null index is -1, a null value 0)."""
    lengths = pc.fill_null(pc.list_value_length(indices), 0).to_numpy(zero_copy_only=False)
    idx = pc.fill_null(indices.flatten(), -1).to_numpy(zero_copy_only=False)
    val = pc.fill_null(values.flatten(), 0.0).to_numpy(zero_copy_only=False)
    if len(idx) != len(val):
        raise ValueError("indices and values differ in length")
    return np.repeat(np.arange(len(indices)), lengths), idx, val


def _with_margins(block: Block, found: pa.Table, models: int) -> pa.Table:
    """The rows of a block with their margins, from the weights of its distinct indices."""
    W = np.zeros((models, block.keys))
    at = found.column("k").to_numpy()
    for k in range(models):
        W[k, at] = pc.fill_null(found.column(f"w_{k}"), 0.0).to_numpy()
    _, _, val = _entries(*[block.rows.column("values").combine_chunks()] * 2)
    out = np.zeros((len(block.lengths), models))
    for k in range(models):
        out[:, k] = np.bincount(block.owner, weights=W[k, block.place] * val, minlength=len(block.lengths))
    off = pa.array(np.arange(len(block.lengths) + 1, dtype=np.int32) * models)
    return block.rows.drop_columns("values").append_column("m", pa.ListArray.from_arrays(off, pa.array(out.ravel())))


def looked_up_margins(encoded: DataFrame, table: DataFrame, models: int, *, table_rows: int,
                      hot_idx: DataFrame | None = None, max_broadcast_rows: int | None = None) -> DataFrame:
    """``(row_id, label, m)`` with the margins of rows against a weight table
    (``indices, w_0 ..``) that is not broadcast: blocks of rows ask for their indices."""
    rows = encoded.select("row_id", "label", F.col("indices").cast("array<int>").alias("indices"),
                          F.col("values").cast("array<double>").alias("values"))
    blocks = packed(rows, ["indices"])
    if hot_idx is None:
        # Asks per index: at most one a block.
        counts = blocks.select(F.explode("asked").alias("a")).groupBy("a.indices").agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.sum("n")).first()[0] or 0
        hot_idx = counts.where(F.col("n") >= F.lit(max(2, hot_threshold(total)))).select("indices")
    else:
        hot_idx = hot_idx.select(F.col(hot_idx.columns[0]).alias("indices"))
    found = answers(blocks, table, ["indices"], table_rows=table_rows, table_bytes=table_rows * (4 + 8 * models),
                    hot_keys=hot_idx, max_broadcast_rows=max_broadcast_rows)
    schema = rows.select("row_id", "label").schema.add("m", T.ArrayType(T.DoubleType()))
    return with_answers(blocks, found.drop("indices"), lambda b, t: _with_margins(b, t, models), schema)


def predict_many(models: list[LogisticModel], encoded: DataFrame,
                 hot_idx: DataFrame | None = None,
                 max_broadcast_rows: int | None = None) -> DataFrame:
    """``(row_id, label, score_0 .. score_{K-1})``: clamped sigmoid of ``x.w + b`` per model.

    All models score in one pass inside the row, against one broadcast matrix; equal rows
    stay separate rows. Above ``respengine.broadcastMaxRows`` weights that are not 0 (or
    ``max_broadcast_rows``), or ``respengine.broadcastMaxBytes``, blocks of rows look their
    weights up instead. Rows without stored entries score their intercept.
    """
    spark = encoded.sparkSession
    K = len(models)
    stacked = np.vstack([m.weights for m in models])
    table_rows = int(np.count_nonzero(np.any(stacked != 0.0, axis=0)))
    limit = broadcast_row_limit(spark) if max_broadcast_rows is None else max_broadcast_rows
    if table_rows <= limit and stacked.nbytes <= broadcast_byte_limit(spark):
        bc = own_broadcast(spark.sparkContext.broadcast(stacked))
        margin = _margin_fn(bc)(F.col("indices").cast("array<int>"), F.col("values").cast("array<double>"))
        margins = encoded.select("row_id", "label", margin.alias("m"))
    else:
        margins = looked_up_margins(encoded, _weights_table(spark, models), K, table_rows=table_rows,
                                    hot_idx=hot_idx, max_broadcast_rows=limit)
    return scored(margins, [m.intercept for m in models])


def scored(margins: DataFrame, intercepts: list[float]) -> DataFrame:
    """``(row_id, label, score_0 ..)`` of ``(row_id, label, m)``."""
    return margins.select("row_id", "label", *[
        clamped_sigmoid(F.get("m", F.lit(k)) + F.lit(float(b))).alias(f"score_{k}") for k, b in enumerate(intercepts)])


def predict(model: LogisticModel, encoded: DataFrame,
            hot_idx: DataFrame | None = None, max_broadcast_rows: int | None = None) -> DataFrame:
    """``(row_id, label, score)`` for one model."""
    return (predict_many([model], encoded, hot_idx, max_broadcast_rows)
            .withColumnRenamed("score_0", "score"))


def smallest_weights(model: LogisticModel, spark: SparkSession | None = None, k: int = 5,
                     tie_digits: int | None = None) -> DataFrame:
    """The ``k`` smallest weights (intercept excluded), ties broken by index."""
    spark = spark or SparkSession.getActiveSession()
    w = model.weights_df(spark, include_intercept=False)
    key = F.col("weight") if tie_digits is None else F.round("weight", tie_digits)
    return w.orderBy(key.asc(), F.col("idx").asc()).limit(k)


def model_summary(model: LogisticModel, spark: SparkSession) -> DataFrame:
    """One row: intercept, iterations run, step and regularisation."""
    schema = T.StructType([T.StructField("intercept", T.DoubleType()),
                           T.StructField("iterations", T.IntegerType()),
                           T.StructField("step_size", T.DoubleType()),
                           T.StructField("reg_param", T.DoubleType())])
    return spark.createDataFrame([(model.intercept, model.iterations, model.step_size,
                                   model.reg_param)], schema)
