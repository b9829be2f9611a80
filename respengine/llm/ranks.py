"""Places of rows in the order of their group, without a task that holds a group.

Rows are range partitioned by (group, order), so a group of any size covers as many
partitions as its rows need. A row's place in its partition is kept in a stored table;
what is before the partition is added from one row per (partition, group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respengine.llm.common import stored
from respengine.operators.joins import lookup_join

ROWS_PER_RANGE = 500_000
BROADCAST_ROWS = 100_000


def ranked(rows: DataFrame, group: str, order: list[str], *, label: str,
           rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, DataFrame]:
    """``rows`` (a stored table) with ``pos`` (long, from 0) and ``n`` (rows of the group),
    and ``group, n`` for every group.

    ``group`` is never null. Rows that tie are told apart by their place in the table.
    """
    names = rows.columns
    count = rows.count()
    ranges = max(1, -(-count // rows_per_range))
    numbered = rows.withColumn("at_", F.monotonically_increasing_id()) \
        .repartitionByRange(ranges, group, *order, "at_") \
        .sortWithinPartitions(group, *order, "at_") \
        .select(*names, F.spark_partition_id().alias("part_"), F.monotonically_increasing_id().alias("at_"))
    numbered = stored(numbered, label)
    pieces = numbered.groupBy("part_", group).agg(F.count("*").alias("rows_"), F.min("at_").alias("first_"))
    # One row for each partition that a group covers.
    earlier = Window.partitionBy(group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(pieces.select(
        "part_", group, (F.coalesce(F.sum("rows_").over(earlier), F.lit(0)) - F.col("first_")).alias("base_"),
        F.sum("rows_").over(Window.partitionBy(group)).alias("n")), label)
    joined = lookup_join(numbered, starts, ["part_", group], table_rows=starts.count(),
                         max_broadcast_rows=BROADCAST_ROWS)
    return (joined.select(*names, (F.col("base_") + F.col("at_")).alias("pos"), "n"),
            starts.select(group, "n").distinct())
