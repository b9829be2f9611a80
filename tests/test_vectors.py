"""Encoded rows as MLlib vectors and back."""
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT

from respengine.functions.vectors import from_vector, with_arrays, with_vector

ROWS = [(1, 1.0, [0, 5, 9], [1.0, 0.1, 1e-300]), (2, 0.0, [], []), (3, 1.0, [2], [-0.0])]
ENCODED = "row_id long, label double, indices array<int>, values array<double>"


def test_both_ways(spark):
    df = spark.createDataFrame(ROWS, ENCODED)
    vectors = with_vector(df, 10)
    assert isinstance(vectors.schema["features"].dataType, VectorUDT)
    got = {r.row_id: r.features for r in vectors.collect()}
    assert got == {i: SparseVector(10, idx, val) for i, _, idx, val in ROWS}
    assert sorted(map(tuple, with_arrays(vectors).collect())) == ROWS
    assert "Python" not in vectors._jdf.queryExecution().executedPlan().toString()
    LogisticRegression(maxIter=1).fit(vectors)  # an estimator takes them


def test_dense_vectors_lose_their_zeros(spark):
    df = spark.createDataFrame([(Vectors.dense([0, 1.5, 0, float("inf")]),), (Vectors.sparse(4, [1], [2.0]),)], ["v"])
    got = [tuple(r.f) for r in df.select(from_vector("v").alias("f")).collect()]
    assert got == [(4, [1, 3], [1.5, float("inf")]), (4, [1], [2.0])]


@pytest.mark.parametrize("indices", [[3, 3], [4, 2], [-1, 2], [2, 10]])
def test_indices_must_increase(spark, indices):
    df = spark.createDataFrame([(1, 1.0, indices, [1.0, 1.0])], ENCODED)
    with pytest.raises(Exception, match="not strictly increasing"):
        with_vector(df, 10).collect()
