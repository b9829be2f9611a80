"""Scalar column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for right results.
# Characters removed by the line strip (ASCII whitespace of Python's str.strip).
STRIP_CHARS = " \t\n\r\x0b\x0c"
# Log-loss epsilon, written 10e-12 in the reference: applied only when p is exactly 0 or 1.
LOG_LOSS_EPS = 10e-12
# Raw-score clamp of the scoring sigmoid.
SCORE_BOUND = 20.0
# Largest exponent of the power-of-two count buckets (2^0 .. 2^10); larger counts get -1.
POW2_MAX_EXP = 10
# Label text that means "negative"; any other text is a positive.
NEGATIVE_LABEL = "0"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_line(line) -> Column:
    """Python-style ``strip()`` of ASCII whitespace at both ends."""
    return F.btrim(_col(line), F.lit(STRIP_CHARS))


def split_fields(line, sep: str = "\t") -> Column:
    """Split on a literal separator, keeping interior and trailing empties."""
    return F.split(_col(line), re.escape(sep), -1)


def parse_label(first) -> Column:
    """Exactly ``"0"`` is 0.0; anything else (including ``''``) is 1.0."""
    return F.when(_col(first) == F.lit(NEGATIVE_LABEL), F.lit(0.0)).otherwise(F.lit(1.0))


def parse_features(fields) -> Column:
    """Fields after the first, numbered from 0: ``array<struct<feature_id, category>>``."""
    fields = _col(fields)
    rest = F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0)))
    return F.transform(
        rest,
        lambda x, i: F.struct(i.cast("int").alias("feature_id"), x.alias("category")),
    )



def feature_array(categories: list) -> Column:
    """Features of a table row, by position: ``array<struct<feature_id, category>>``.

    A null value is the missing category ``''``.
    """
    return F.array(*[
        F.struct(F.lit(i).cast("int").alias("feature_id"),
                 F.coalesce(_col(c).cast("string"), F.lit("")).alias("category"))
        for i, c in enumerate(categories)
    ])


def pow2_bucket(count, max_exp: int = POW2_MAX_EXP) -> Column:
    """Smallest power of two ``2^0..2^max_exp`` that is >= count; -1 above it.

    A CASE chain rather than ``ceil(log2(c))``, which is inexact for large
    counts and would need its own branch for the overflow value.
    """
    count = _col(count)
    expr = F.when(count <= F.lit(1), F.lit(1))
    for e in range(1, max_exp + 1):
        expr = expr.when(count <= F.lit(2 ** e), F.lit(2 ** e))
    return expr.otherwise(F.lit(-1))


def log_loss(p, y) -> Column:
    """Log loss of probability ``p`` for label ``y``; null when y is not 0 or 1.

    eps is added or subtracted only when p is exactly 0 or 1 (not a clip).
    """
    p, y = _col(p).cast("double"), _col(y)
    q = (F.when(p == F.lit(0.0), p + F.lit(LOG_LOSS_EPS))
         .when(p == F.lit(1.0), p - F.lit(LOG_LOSS_EPS))
         .otherwise(p))
    return (F.when(y == F.lit(1), -F.log(q))
            .when(y == F.lit(0), -F.log(F.lit(1.0) - q)))


def clamped_sigmoid(z, bound: float = SCORE_BOUND) -> Column:
    """``1 / (1 + exp(-z))`` with z clamped to ``[-bound, bound]``."""
    z = F.greatest(F.lit(-bound), F.least(F.lit(bound), _col(z).cast("double")))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def feature_string(feature_id, category) -> Column:
    """Category followed by the feature id, no separator (``'mouse' + '0'``)."""
    return F.concat(_col(category), _col(feature_id).cast("string"))


def md5_bucket_of_hex(hex_digest, num_buckets: int) -> Column:
    """``int(hex_digest, 16) % num_buckets`` for a 32-digit md5 hex string.

    Horner's rule over four 32-bit words, reducing after each step, keeps every
    intermediate below 2^63 for ``num_buckets < 2^31``.
    """
    if not 0 < num_buckets < 2 ** 31:
        raise ValueError("num_buckets must be in [1, 2^31)")
    h = _col(hex_digest)
    acc = F.lit(0).cast("bigint")
    for k in range(4):
        word = F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("bigint")
        acc = (acc * F.lit(4294967296) + word) % F.lit(num_buckets)
    return acc.cast("int")


def md5_bucket(s, num_buckets: int) -> Column:
    """md5 of the UTF-8 bytes of ``s`` as a 128-bit integer, modulo ``num_buckets``."""
    return md5_bucket_of_hex(F.md5(_col(s)), num_buckets)


def unit_hash(key, seed: int) -> Column:
    """Uniform value in [0, 1) from the first 32 bits of md5('seed:key')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def dense_dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays, in float64."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def sparse_dot(indices, values, dense) -> Column:
    """Dot product of a sparse vector (0-based ``indices``, ``values``) with a dense array."""
    dense = _col(dense)
    prods = F.zip_with(
        _col(indices), _col(values),
        lambda i, v: v.cast("double") * F.element_at(dense, i + 1).cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def sparse_from_dense(dense, threshold: float = 0.0) -> tuple[Column, Column]:
    """Indices (0-based) and values of the entries with ``|x| > threshold``."""
    dense = _col(dense)
    kept = F.filter(
        F.transform(dense, lambda x, i: F.struct(i.alias("i"), x.cast("double").alias("v"))),
        lambda s: F.abs(s["v"]) > F.lit(threshold))
    return F.transform(kept, lambda s: s["i"]), F.transform(kept, lambda s: s["v"])


def sparse_vector(entries) -> Column:
    """``struct(indices, values)`` from an array of ``struct(idx, value)`` entries.

    Entries are sorted by index, as the dict form of a sparse vector sorts its
    keys; a repeated index fails, as a sparse vector needs strictly increasing
    indices.
    """
    ordered = F.array_sort(_col(entries), lambda a, b: F.when(a["idx"] < b["idx"], -1)
                           .when(a["idx"] > b["idx"], 1).otherwise(0))
    idx = F.transform(ordered, lambda e: e["idx"].cast("int"))
    checked = F.when(F.size(F.array_distinct(idx)) != F.size(idx),
                     F.raise_error(F.lit("sparse vector indices are not strictly increasing"))
                     ).otherwise(idx)
    return F.struct(checked.alias("indices"),
                    F.transform(ordered, lambda e: e["value"].cast("double")).alias("values"))
