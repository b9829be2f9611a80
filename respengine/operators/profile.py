"""Feature frequency and sparsity profiles of encoded frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pow2_bucket


def feature_counts(encoded: DataFrame) -> DataFrame:
    """Rows holding each index: ``(idx, n)`` (partial + final aggregate)."""
    return (encoded.select(F.explode("indices").alias("idx"))
            .groupBy("idx").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def count_histogram(encoded: DataFrame, overflow: bool = True) -> DataFrame:
    """Indices per power-of-two count bucket; counts above 1024 are in bucket -1.

    ``(bucket, n_features, ln_bucket, ln_count)``; ``ln_bucket`` of the overflow
    bucket is null. ``overflow=False`` leaves that bucket out, as the reference does.
    """
    counts = feature_counts(encoded)
    return (counts.select(pow2_bucket(F.col("n")).alias("bucket"))
            .where(F.lit(overflow) | (F.col("bucket") != F.lit(-1)))
            .groupBy("bucket").agg(F.count(F.lit(1)).cast("bigint").alias("n_features"))
            .select("bucket", "n_features",
                    F.log(F.col("bucket").cast("double")).alias("ln_bucket"),
                    F.log(F.col("n_features").cast("double")).alias("ln_count")))


def sparsity(encoded: DataFrame, num_features: int) -> DataFrame:
    """Mean stored entries per row (what the reference reports) and that over ``d``.

    ``(avg_nnz, density)``.
    """
    return encoded.agg(F.avg(F.size("values").cast("double")).alias("avg_nnz")).select(
        "avg_nnz", (F.col("avg_nnz") / F.lit(float(num_features))).alias("density"))
