"""Row ids that follow from the content of a row.

An id taken at the scan (``monotonically_increasing_id``) depends on how files are packed
into tasks, and so on the number of cores. Here equal rows are counted, and each copy gets
an id from the digest of the row and its place among the copies. Equal rows cannot be told
apart by anything but that place, so the result is the same for every packing, order and
retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of one row that one task writes out.
COPIES_PER_RUN = 100_000


def content_id(content: Column, copy: Column) -> Column:
    """60 bits of md5 over the content, a newline and the copy's number."""
    digest = F.md5(F.concat(content, F.lit("\n"), copy.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def with_content_ids(df: DataFrame, content: Column, row_id: str = "row_id",
                     copies_per_run: int = COPIES_PER_RUN) -> DataFrame:
    """``row_id`` before the columns of ``df``; ``content`` is a string that names a row.

    One shuffle of the distinct rows; copies collapse before it. A row with many copies is
    written out in runs that are dealt over all tasks, so no task holds a hot row. Null
    content counts as empty.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    last = F.col("_n") - 1
    few = counted.where(F.col("_n") <= copies_per_run).select(
        *cols, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_copy"))
    runs = counted.where(F.col("_n") > copies_per_run).select(
        *cols, "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), last,
                                          F.lit(copies_per_run).cast("bigint"))).alias("_from"))
    many = runs.repartition(F.col("_from"), F.xxhash64(*cols)).select(
        *cols, F.explode(F.sequence(F.col("_from"), F.least(
            F.col("_from") + copies_per_run - 1, last))).alias("_copy"))
    key = F.coalesce(content, F.lit(""))
    return few.unionByName(many).select(content_id(key, F.col("_copy")).alias(row_id), *cols)
