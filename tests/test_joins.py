from pyspark.sql import functions as F

from respengine.operators.joins import hot_threshold, lookup_join
from respengine.sources.tables import read_table

from conftest import SF01


def test_salted_lookup_on_hot_keys(spark):
    li = read_table(spark, SF01, "lineitem").select(
        F.monotonically_increasing_id().alias("rid"), "l_linenumber", "l_quantity")
    table = (li.groupBy("l_linenumber").agg(F.avg("l_quantity").alias("avg_qty"),
                                            F.count(F.lit(1)).alias("n")).cache())
    total = li.count()
    # every line number holds about a seventh of the rows: all of them are hot
    hot = table.where(F.col("n") >= F.lit(hot_threshold(total, max_hot=10)))
    assert hot.count() == 7
    want = {r[0]: r[1] for r in li.join(table, "l_linenumber").select("rid", "avg_qty").collect()}
    for k, v in [("spark.sql.autoBroadcastJoinThreshold", "-1"),
                 ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")]:
        spark.conf.set(k, v)
    try:
        out = lookup_join(li, table.select("l_linenumber", "avg_qty"), ["l_linenumber"],
                          table_rows=7, hot_keys=hot.select("l_linenumber"),
                          max_broadcast_rows=0, salt_buckets=16)
        got = {r[0]: r[1] for r in out.select("rid", "avg_qty").collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert got == want and len(got) == total
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_broadcast_path_under_bound(spark):
    left = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    table = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    out = lookup_join(left, table, ["k"], table_rows=5, max_broadcast_rows=10)
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where(F.col("w") != F.col("k") * 10).count() == 0 and out.count() == 100
