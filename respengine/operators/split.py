"""Reproducible splitting.

``hash_split`` assigns each row by a hash of its key, so the assignment does
not depend on partitioning or on task retries and can be recomputed in SQL.
``random_split`` is Spark's own ``randomSplit`` (partition-dependent), kept
for users of the reference's call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import unit_hash

DEFAULT_NAMES = ("train", "validation", "test")


def split_bounds(weights) -> list[float]:
    """Cumulative upper bounds of normalised weights, rounded against float noise."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    bounds, acc = [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(round(acc, 12))
    bounds[-1] = 1.0
    return bounds


def hash_split(df: DataFrame, key: str = "row_id", weights=(0.8, 0.1, 0.1), seed: int = 42,
               names=None, col: str = "split") -> DataFrame:
    """Add a ``split`` column: part i when ``u < bound_i`` for u = md5-derived value of the key."""
    names = list(names or (DEFAULT_NAMES if len(weights) == 3 else
                           [f"part{i}" for i in range(len(weights))]))
    if len(names) != len(weights):
        raise ValueError("one name per weight")
    u = unit_hash(F.col(key), seed)
    bounds = split_bounds(weights)
    expr = F.when(u < F.lit(bounds[0]), F.lit(names[0]))
    for b, n in zip(bounds[1:-1], names[1:-1]):
        expr = expr.when(u < F.lit(b), F.lit(n))
    expr = expr.otherwise(F.lit(names[-1]))
    return df.withColumn(col, expr)


def split_frames(df: DataFrame, key: str = "row_id", weights=(0.8, 0.1, 0.1),
                 seed: int = 42, names=None) -> list[DataFrame]:
    """The parts of ``hash_split`` as separate frames (each a pushed-down filter)."""
    names = list(names or (DEFAULT_NAMES if len(weights) == 3 else
                           [f"part{i}" for i in range(len(weights))]))
    tagged = hash_split(df, key, weights, seed, names, col="_split")
    return [tagged.where(F.col("_split") == F.lit(n)).drop("_split") for n in names]


def random_split(df: DataFrame, weights=(0.8, 0.1, 0.1), seed: int = 42) -> list[DataFrame]:
    """Spark's ``randomSplit`` (depends on the input partitioning)."""
    return df.randomSplit(list(weights), seed)


def split_sizes(tagged: DataFrame, col: str = "split", total_name: str = "total") -> DataFrame:
    """Rows per split plus a total row: ``(split, n_rows)``."""
    return (tagged.rollup(col).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.coalesce(F.col(col), F.lit(total_name)).alias("split"),
                    F.col("n_rows").cast("bigint").alias("n_rows")))
