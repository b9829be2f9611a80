"""Hyper-parameter search over step size and regularisation."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .evaluate import evaluate_many
from .model import LogisticModel, fit_logistic_many

GRID_SCHEMA = T.StructType([
    T.StructField("grid_pos", T.IntegerType()), T.StructField("step_size", T.DoubleType()),
    T.StructField("reg_param", T.DoubleType()), T.StructField("log_loss", T.DoubleType()),
    T.StructField("iterations", T.IntegerType()), T.StructField("is_best", T.BooleanType()),
])


def grid_search(train: DataFrame, validation: DataFrame, num_features: int, step_sizes,
                reg_params, iterations: int = 500, intercept: bool = True,
                start_best: float = 1e10) -> tuple[DataFrame, LogisticModel | None]:
    """Fit every (step, reg) cell on ``train`` and score it on ``validation``.

    All cells share each pass over the training data and one pass over the
    validation data. The best cell is the first strict minimum in grid order
    (steps outer, regularisers inner), starting from ``start_best``.
    Returns ``(grid_pos, step_size, reg_param, log_loss, iterations, is_best)``
    and the best model.
    """
    spark = train.sparkSession
    configs = [(s, r) for s in step_sizes for r in reg_params]
    models = fit_logistic_many(train, num_features, configs, iterations, intercept=intercept)
    losses = evaluate_many(models, validation)
    best, best_loss = None, start_best
    for pos, ll in enumerate(losses):
        if not math.isnan(ll) and ll < best_loss:
            best, best_loss = pos, ll
    rows = [(pos, float(m.step_size), float(m.reg_param), float(ll), int(m.iterations), pos == best)
            for pos, (m, ll) in enumerate(zip(models, losses))]
    return spark.createDataFrame(rows, GRID_SCHEMA), (models[best] if best is not None else None)


def reg_column_name(reg: float) -> str:
    return f"reg_{reg:.0e}"


def pivot_grid(results: DataFrame, reg_params=None) -> DataFrame:
    """Surface table: one row per step size, one column per regulariser."""
    if reg_params is None:
        # one row per grid column
        reg_params = sorted(r[0] for r in results.select("reg_param").distinct().collect())
    reg_params = [float(r) for r in reg_params]
    piv = (results.groupBy("step_size").pivot("reg_param", reg_params)
           .agg(F.first("log_loss")))
    renamed = piv.select("step_size", *[F.col(f"`{c}`").alias(reg_column_name(float(c)))
                                        for c in piv.columns if c != "step_size"])
    return renamed.orderBy("step_size")
