"""Evaluation: base rate, log loss, ROC table and metric reports."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import log_loss
from ..lifetime import own_frame
from .model import LogisticModel, predict, predict_many

# Distinct scores handled by one range task of the ROC running sums.
ROC_POINTS_PER_RANGE = 250_000


def base_rate(train: DataFrame) -> DataFrame:
    """Click fraction of the training rows: one row ``(base_rate)``."""
    return train.agg(F.avg(F.col("label").cast("double")).alias("base_rate"))


def base_rate_value(train: DataFrame) -> float:
    """The base rate as a driver scalar (one number)."""
    return float(base_rate(train).first()[0])


def baseline_log_loss(rate: float | DataFrame, data: DataFrame) -> DataFrame:
    """Mean log loss of predicting the training fraction for every row: ``(log_loss)``.

    ``rate`` is the training fraction, or the training frame to take it from.
    """
    if isinstance(rate, DataFrame):
        rate = base_rate_value(rate)
    return data.agg(F.avg(log_loss(F.lit(float(rate)), F.col("label"))).alias("log_loss"))


def baseline_by_split(tagged: DataFrame, col: str = "split", train: str = "train") -> DataFrame:
    """``(split, log_loss)`` of the training fraction as the prediction for every split.

    One pass and one small aggregate: for a constant prediction the mean log loss
    follows from the count and the positives of a split (one row per split is collected).
    """
    spark = tagged.sparkSession
    counts = tagged.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).collect()
    rate = next((r["pos"] / r["n"] for r in counts if r[col] == train), None)
    parts = spark.createDataFrame([(r[col], int(r["n"]), float(r["pos"])) for r in counts],
                                  f"`{col}` string, n long, pos double")
    p = F.lit(rate).cast("double")
    total = F.col("pos") * log_loss(p, F.lit(1.0)) + (F.col("n") - F.col("pos")) * log_loss(p, F.lit(0.0))
    return parts.select(col, (total / F.col("n")).alias("log_loss"))


def evaluate_log_loss(model: LogisticModel, encoded: DataFrame) -> DataFrame:
    """Mean log loss of a model's scores: one row ``(log_loss)``."""
    return predict(model, encoded).agg(
        F.avg(log_loss(F.col("score"), F.col("label"))).alias("log_loss"))


def evaluate_many(models: list[LogisticModel], encoded: DataFrame,
                  baseline_rate: float | None = None) -> list[float]:
    """Log loss of several models in one pass over ``encoded``.

    With ``baseline_rate`` the baseline's log loss comes from the same pass and
    is appended as the last element.
    """
    scored = predict_many(models, encoded)
    aggs = [F.avg(log_loss(F.col(f"score_{k}"), F.col("label"))).alias(f"ll_{k}")
            for k in range(len(models))]
    if baseline_rate is not None:
        aggs.append(F.avg(log_loss(F.lit(float(baseline_rate)), F.col("label"))).alias("ll_base"))
    row = scored.agg(*aggs).first()
    out = [row[a] for a in row.asDict()]
    return [float(v) if v is not None else float("nan") for v in out]


# Cells of the first histogram for every range; a cell of more than half a range is cut again.
_CELLS_PER_RANGE = 4
_CUTS = 1024


_LOWEST = -(1 << 63)


def _place(x: float) -> int:
    """Floats in order as integers: neighbours differ by one."""
    bits = int(np.float64(x).view(np.int64))
    return bits if bits >= 0 else _LOWEST - bits


def _cut(low: float, high: float, cells: int) -> set[float]:
    """Bounds of cells with equally many floats each, both ends included."""
    a, b = _place(low), _place(high)
    places = {a + (b - a) * i // cells for i in range(cells + 1)}
    bits = np.array([p if p >= 0 else _LOWEST - p for p in places], np.int64)
    return set(bits.view(np.float64).tolist())


def _cell_counts(values: DataFrame, splits: list[float]) -> dict[int, int]:
    """Rows of ``values`` (v) in each cell ``[splits[i], splits[i + 1])``, the last one closed."""
    bc = values.sparkSession.sparkContext.broadcast(np.array(splits[1:-1]))

    def cell(v: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bc.value, v.to_numpy(zero_copy_only=False), side="right"), pa.int64())

    try:
        rows = values.groupBy(F.arrow_udf(cell, "bigint")("v").alias("cell")).count().collect()
    finally:
        bc.destroy()
    return {r["cell"]: r["count"] for r in rows}


def range_bounds(points: DataFrame, col: str, ranges: int) -> list[float]:
    """Bounds that cut the rows of ``points`` into about ``ranges`` ranges of ``col``.

    Exact counts, no sample: a distributed histogram of cells, then another one in which the
    cells of more than half a range are cut finer in proportion to their rows, until there
    are none (two passes as a rule; cells are equal in floats, so values that crowd over
    orders of magnitude need no more; one value's cell is not cut). Ranges are filled cell
    by cell, so none holds more than 1.5 times the rows asked for, or one value's. The
    counts of a few cells for every range reach the driver. Nulls, NaN and infinities take
    no part.
    """
    use = points.where(F.col(col).isNotNull() & ~F.isnan(col) & (F.abs(col) < math.inf)) \
        .select(F.col(col).cast("double").alias("v"))
    low, high, n = use.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if not n or low == high:
        return []
    target = n / ranges
    splits = sorted(_cut(low, high, _CELLS_PER_RANGE * ranges))
    while True:
        counts = _cell_counts(use, splits)
        finer = {s for i, c in counts.items() if c > target / 2
                 for s in _cut(splits[i], splits[i + 1], min(_CUTS, math.ceil(4 * c / target)))}
        if finer <= set(splits):
            break
        splits = sorted({*splits, *finer})
    bounds, held = [], 0
    for i in sorted(counts):
        if held and held + counts[i] > 1.5 * target:
            bounds.append(splits[i])
            held = 0
        held += counts[i]
        if held >= target and i + 2 < len(splits):
            bounds.append(splits[i + 1])
            held = 0
    return sorted(set(bounds))


def roc_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label",
              num_bins: int | None = None, round_digits: int | None = None,
              num_ranges: int | None = None) -> DataFrame:
    """ROC table along descending score: ``(score, tp, fp, tpr, fpr)``.

    One point per distinct score (rows with equal scores enter together), or per
    bin of width ``1/num_bins`` / per rounded score. The running sums are exact
    and distributed: scores are cut into ranges by exact counts (``range_bounds``),
    each range runs its own window, and ranges are offset by the totals of the
    ranges above them (one small row per range reaches the driver). Rates are
    null when a class is absent.
    """
    spark = scored.sparkSession
    key = F.col(score_col).cast("double")
    if num_bins:
        key = F.floor(key * F.lit(num_bins)) / F.lit(float(num_bins))
    elif round_digits is not None:
        key = F.round(key, round_digits)
    y = F.col(label_col).cast("double")
    points = (scored.select(key.alias("score"), y.alias("_y"))
              .groupBy("score")
              .agg(F.sum("_y").alias("_pos"), F.sum(F.lit(1.0) - F.col("_y")).alias("_neg"))
              .persist())
    own_frame(points)
    if num_ranges is None:
        # About ROC_POINTS_PER_RANGE distinct scores per range task.
        num_ranges = max(1, -(-points.count() // ROC_POINTS_PER_RANGE))
    ranges = num_ranges
    bounds = []
    if ranges > 1:
        bounds = range_bounds(points, "score", ranges)
    if bounds:
        # Range 0 holds the highest scores: number of bounds above the score,
        # found by binary search (JVM Bucketizer) rather than a scan of the bounds.
        cut = Bucketizer(splits=[-math.inf] + [float(b) for b in bounds] + [math.inf],
                         inputCol="score", outputCol="_bucket", handleInvalid="keep")
        ranged = (cut.transform(points)
                  .withColumn("_range", (F.lit(len(bounds)) - F.col("_bucket")).cast("int"))
                  .drop("_bucket"))
    else:
        ranged = points.withColumn("_range", F.lit(0))
    # (one range only: at most ROC_POINTS_PER_RANGE points, unless the caller asks for it)
    totals = (ranged.groupBy("_range").agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("q"))
              .orderBy("_range").collect())  # one row per range
    offs, tp0, fp0 = [], 0.0, 0.0
    for r in totals:
        offs.append((r["_range"], tp0, fp0))
        tp0 += r["p"]
        fp0 += r["q"]
    off = spark.createDataFrame(offs, T.StructType([
        T.StructField("_range", T.IntegerType()), T.StructField("_tp0", T.DoubleType()),
        T.StructField("_fp0", T.DoubleType())]))
    w = (Window.partitionBy("_range").orderBy(F.col("score").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offset = ranged.join(F.broadcast(off), "_range") if bounds else \
        ranged.withColumns({"_tp0": F.lit(0.0), "_fp0": F.lit(0.0)})
    out = (offset
           .select("score",
                   (F.col("_tp0") + F.sum("_pos").over(w)).alias("tp"),
                   (F.col("_fp0") + F.sum("_neg").over(w)).alias("fp")))
    return out.select(
        "score", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        F.try_divide(F.col("tp"), F.lit(tp0)).alias("tpr"),
        F.try_divide(F.col("fp"), F.lit(fp0)).alias("fpr"))


REPORT_SCHEMA = T.StructType([
    T.StructField("split", T.StringType()), T.StructField("features", T.StringType()),
    T.StructField("model", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def metric_report(spark: SparkSession, entries) -> DataFrame:
    """Long metric table ``(split, features, model, metric, value, text)``.

    ``text`` formats like the reference's report: ``%.3f`` for log loss and
    rates, ``%.7e`` for sparsity, and a line that names the cell for a model of a grid
    (``model``: ``step=<step>, reg=<reg>``).
    """
    df = spark.createDataFrame([tuple(e) for e in entries], REPORT_SCHEMA)
    cell = F.split("model", "step=|, reg=")
    line = F.format_string("stepSize = %.1f, regParam = %.0e: logloss = %.3f", F.try_element_at(cell, F.lit(2)).cast("double"),
                           F.try_element_at(cell, F.lit(3)).cast("double"), F.col("value"))
    fmt = F.when(F.col("model").startswith("step="), line).when(F.col("metric").isin("avg_nnz", "density"),
                 F.format_string("%.7e", F.col("value"))).otherwise(
        F.format_string("%.3f", F.col("value")))
    return df.withColumn("text", fmt)
