"""Feature hashing: no dictionary, no shuffle.

Each observation's distinct feature strings (category followed by feature id)
are hashed with md5 into ``num_buckets``; the value at a bucket is the number
of distinct strings that landed there: the length of the bucket's run in the
sorted buckets of the row, so the work grows with a row's width alone. Everything is array functions on the
row, so the operator is a narrow projection (and works on a stream as is).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import feature_string, md5_bucket_of_hex

# Fixed value: the reference hashes into 2^15 buckets.
DEFAULT_BUCKETS = 2 ** 15


def feature_strings(feats) -> F.Column:
    """Distinct ``category || feature_id`` strings of an observation."""
    return F.array_distinct(F.transform(
        feats, lambda f: feature_string(f["feature_id"], f["category"])))


def hash_features(obs: DataFrame, num_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``(row_id, label, indices, values)`` with md5 buckets and per-bucket counts."""
    digests = F.transform(feature_strings(F.col("feats")), lambda s: F.md5(s))
    buckets = F.array_sort(F.transform(digests, lambda h: md5_bucket_of_hex(h, num_buckets)))
    with_buckets = obs.select("row_id", "label", buckets.alias("_b"))
    places = F.when(F.size("_b") > 0, F.sequence(F.lit(0), F.size("_b") - 1)).otherwise(F.array().cast("array<int>"))
    # Where a run of equal buckets begins.
    runs = F.filter(places, lambda i: (i == 0) | (F.get("_b", i) != F.get("_b", i - 1)))
    return (with_buckets.select("row_id", "label", "_b", runs.alias("_runs"))
            .select("row_id", "label",
                    F.transform("_runs", lambda i: F.get("_b", i)).alias("indices"),
                    F.transform("_runs", lambda i, k: (
                        F.coalesce(F.get("_runs", k + 1), F.size("_b")) - i).cast("double")).alias("values")))


def md5_buckets_long(obs: DataFrame, bucket_counts=(4, 100, DEFAULT_BUCKETS)) -> DataFrame:
    """Per feature: its string and its bucket for several bucket counts."""
    long = obs.select("row_id", F.inline("feats"))
    s = feature_string(F.col("feature_id"), F.col("category"))
    h = F.md5(s)
    return long.select("row_id", "feature_id", s.alias("feature_string"),
                       *[md5_bucket_of_hex(h, n).alias(f"bucket_{n}") for n in bucket_counts])
