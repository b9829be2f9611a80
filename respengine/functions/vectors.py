"""Encoded rows as MLlib vectors and back, by built-in expressions only.

An encoded frame keeps a sparse vector as two arrays; Spark ML's estimators want its vector
type. Both directions go through the type's own fields (kind, size, indices, values) as
JSON text in the JVM, which Spark writes and reads for user-defined types; doubles keep
every bit, and no vector is widened to its full size.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIELDS = T.StructType([T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
                        T.StructField("indices", T.ArrayType(T.IntegerType())),
                        T.StructField("values", T.ArrayType(T.DoubleType()))])
_SPARSE, _DENSE = 0, 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _root(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("v", kind)])


def increasing(indices: Column, size: int) -> Column:
    """``indices``, which must be strictly increasing and within ``[0, size)``."""
    later = F.slice(indices, 2, F.greatest(F.size(indices) - 1, F.lit(0)))
    earlier = F.slice(indices, 1, F.greatest(F.size(indices) - 1, F.lit(0)))
    ordered = F.forall(F.zip_with(earlier, later, lambda a, b: a < b), lambda x: x)
    inside = F.forall(indices, lambda i: (i >= 0) & (i < size))
    return F.when(ordered & inside, indices).otherwise(F.raise_error(F.concat(
        F.lit(f"sparse vector indices are not strictly increasing in [0, {size}): "),
        indices.cast("string"))).cast("array<int>"))


def to_vector(indices, values, size: int) -> Column:
    """The sparse vector of an encoded row (0-based ``indices``, ``values``)."""
    idx = increasing(_col(indices).cast("array<int>"), size)
    entries = F.struct(F.lit(_SPARSE).cast("tinyint").alias("type"), F.lit(int(size)).alias("size"),
                       idx.alias("indices"), _col(values).cast("array<double>").alias("values"))
    text = F.to_json(F.struct(entries.alias("v")))
    return F.from_json(text, _root(VectorUDT()))["v"]


def from_vector(vector) -> Column:
    """``struct(size, indices, values)`` of a vector; a dense one loses its zeros.

    Indices of a sparse vector must be strictly increasing.
    """
    raw = F.from_json(F.to_json(F.struct(_col(vector).alias("v"))), _root(_FIELDS))["v"]
    dense = F.filter(F.transform(raw["values"], lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                     lambda e: e["x"] != 0)
    sparse = raw["type"] == _SPARSE
    size = F.when(sparse, raw["size"]).otherwise(F.size(raw["values"]))
    indices = F.when(sparse, raw["indices"]).otherwise(F.transform(dense, lambda e: e["i"]))
    values = F.when(sparse, raw["values"]).otherwise(F.transform(dense, lambda e: e["x"]))
    return F.struct(size.alias("size"), indices.alias("indices"), values.alias("values"))


def with_vector(encoded, size: int, name: str = "features"):
    """``row_id, label`` and the vector of every row of an encoded frame."""
    return encoded.select("row_id", "label", to_vector("indices", "values", size).alias(name))


def with_arrays(df, name: str = "features"):
    """The encoded frame of a frame with ``row_id, label`` and a vector."""
    fields = from_vector(name)
    return df.select("row_id", "label", fields.alias("_v")).select(
        "row_id", "label", "_v.indices", "_v.values")
