"""Lookup joins against tables that are unique on their key (dictionaries,
weight vectors).

The lookup side is broadcast only when its exact row count is under a bound.
Beyond it the join shuffles, and keys known to be hot (a few keys may carry a
third of all rows, e.g. the empty category) are resolved from a small
broadcast table and routed through the shuffle with spread-out salts, so no
single reducer receives a hot key's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
DEFAULT_MAX_HOT_KEYS = 10_000
# Fewest salts per hot key (more when there are more shuffle partitions).
DEFAULT_SALT_BUCKETS = 64


def broadcast_row_limit(spark: SparkSession) -> int:
    """Row bound for broadcasting a lookup table (``respengine.broadcastMaxRows``)."""
    return int(spark.conf.get("respengine.broadcastMaxRows", str(DEFAULT_BROADCAST_ROWS)))


def broadcast_byte_limit(spark: SparkSession) -> int:
    """Byte bound for broadcasting a lookup table (``respengine.broadcastMaxBytes``)."""
    return int(spark.conf.get("respengine.broadcastMaxBytes", str(DEFAULT_BROADCAST_BYTES)))


def hot_threshold(total: int, max_hot: int = DEFAULT_MAX_HOT_KEYS) -> int:
    """Frequency above which a key counts as hot.

    With ``total`` occurrences, at most ``max_hot`` keys can reach
    ``total / max_hot``, so the hot table has a proven size bound.
    """
    return max(1, -(-int(total) // max_hot))


def lookup_join(left: DataFrame, table: DataFrame, keys: list[str], *, table_rows: int,
                table_bytes: int | None = None, hot_keys: DataFrame | None = None,
                salt_buckets: int | None = None,
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Left join ``left`` to ``table`` (unique on ``keys``); unmatched rows get nulls.

    ``table_rows`` (and, when known, ``table_bytes``) are the exact size of
    ``table``; it is broadcast only when both are under their bounds.
    ``hot_keys`` (bounded) lists keys that may be heavily repeated on the left,
    either as keys only or as the matching rows of ``table`` itself.
    """
    spark = left.sparkSession
    limit = broadcast_row_limit(spark) if max_broadcast_rows is None else max_broadcast_rows
    if table_rows <= limit and (table_bytes is None
                                or table_bytes <= broadcast_byte_limit(spark)):
        return left.join(F.broadcast(table), keys, "left")
    if hot_keys is None:
        # No frequency information: leave skew splitting to AQE's skew join.
        return left.join(table, keys, "left")

    values = [c for c in table.columns if c not in keys]
    if set(table.columns) <= set(hot_keys.columns):
        hot_rows = hot_keys.select(*table.columns)  # already the hot rows of the table
    else:
        hot_rows = table.join(F.broadcast(hot_keys.select(*keys)), keys, "left_semi")
    hot = hot_rows.select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in values],
                          F.lit(True).alias("_is_hot"))
    tagged = left.join(F.broadcast(hot), keys, "left")
    # Hot rows get a salt in 1..S that never matches the table side (salt 0), so
    # the shuffle spreads them over S partitions and they keep their broadcast
    # value. S follows the shuffle parallelism: a key holding a third of all rows
    # then lands on as many reducers as there are shuffle partitions.
    if salt_buckets is None:
        salt_buckets = max(DEFAULT_SALT_BUCKETS,
                           int(spark.conf.get("spark.sql.shuffle.partitions")))
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    # Rows with a null key match nothing and are spread like hot ones.
    spread = F.col("_is_hot")
    for k in keys:
        spread = spread | F.col(k).isNull()
    salted = tagged.withColumn(
        "_salt", F.when(spread, F.pmod(row_hash, F.lit(salt_buckets)) + 1)
                  .otherwise(F.lit(0)))
    cold = table.withColumn("_salt", F.lit(0))
    joined = salted.join(cold, keys + ["_salt"], "left")
    out = joined
    for c in values:
        out = out.withColumn(c, F.coalesce(F.col(f"_hot_{c}"), F.col(c)))
    return out.select(*left.columns, *values)
