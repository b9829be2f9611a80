"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the key ``-ln(u) / quality`` from a hash of its id, so heavier
documents come earlier and reruns agree. Within a source documents are taken in key order.
A source's word budget first pays for complete epochs of the source; the rest is paid by
prefix sums of the sizes in key order. The document that crosses the budget gives its
first words only, so a source's words meet the budget exactly.

The prefix sums need no task that holds a whole source: documents fall into about
sqrt(rows) key ranges per source, are summed inside their range, and start from the sum
of the ranges before. The ranges follow the distribution that the weights give the keys (a
count for each power of two reaches the driver), so equal weights cannot fill one range. Only the table of sources (one row each) is ordered in one task.

Defined results: null text has size 0; a null source is a source of its own and comes
last; ties in the key are ordered by id and size; documents of size 0 give nothing; an
empty table gives an empty result; extra columns are ignored. With ``quality_col`` the weight
is that column, kept within [1e-6, 1e6]; null, NaN and what is no number weigh 1e-6, so these
documents come last. Without it a plain measure of the words' length stands in.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respengine.llm.common import stored, text_of

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
LEAST_QUALITY, MOST_QUALITY = 1e-6, 1e6


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality(size: Column, chars: Column) -> Column:
    """Sampling weight in [0.25, 1]: highest where words have 4 to 7 characters on
    average (blanks included), as running prose has."""
    mean = chars / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.25), F.lit(1.0) - F.greatest(F.lit(4.0) - mean, mean - F.lit(7.0),
                                                         F.lit(0.0)) / F.lit(4.0))


def uniform(seed: int, doc_id: Column) -> Column:
    """A number in (0, 1) from the first 48 bits of an md5 digest."""
    hexed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(hexed, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def given(column: str) -> Column:
    """The weight that a column gives, within its bounds."""
    value = F.col(column).try_cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(LEAST_QUALITY)) \
        .otherwise(F.least(F.greatest(value, F.lit(LEAST_QUALITY)), F.lit(MOST_QUALITY)))


def key_place(rows: DataFrame) -> tuple[int, Column]:
    """The number of rows, and about which part of them has a smaller key (rises with the key)."""
    classes = rows.groupBy(F.floor(F.log2("weight")).alias("power")) \
        .agg(F.count("*").alias("n"), F.avg("weight").alias("mean")).orderBy("power").collect()
    total = sum(r.n for r in classes)
    place = F.lit(0.0)
    for r in classes:
        place = place + F.lit(r.n / total) * (1 - F.exp(-F.col("key") * F.lit(r.mean)))
    return total, place


def targets(sources: DataFrame) -> DataFrame:
    """``skey, source_size, target``: weights 1, 2, 3 repeating in source order share all
    words; a target stops at three times the source, the excess goes to the others.

    With sources ordered by cap / weight, the capped ones are a prefix: the first source
    whose cap is not below its share of what is left ends it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("w", (F.row_number().over(order) - 1) % 3 + 1) \
        .withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    ratio = F.col("cap") / F.col("w")
    by_ratio = Window.orderBy("ratio", "skey")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything)
             - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(onward)
    levels = weighed.withColumn("ratio", ratio).withColumn("level", level) \
        .withColumn("place", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(everything)
    return levels.withColumn("share", first["level"]).select(
        "skey", "source_size",
        F.when(F.col("ratio") < F.col("share"), F.col("cap").cast("double"))
        .otherwise(F.col("w") * F.col("share")).alias("target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", quality_col: str | None = None, seed: int = 7) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document."""
    source = F.col(source_col).cast("string")
    text = text_of(text_col)
    sized = docs.select(F.col(id_col).alias("doc_id"), source.alias("source"),
                        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("skey"),
                        word_count(text).alias("size"), F.length(text).alias("chars"),
                        (given(quality_col) if quality_col else F.lit(None).cast("double")).alias("given"))
    keyed = sized.withColumn("weight", F.coalesce("given", quality(F.col("size"), F.col("chars")))).withColumn(
        "key", -F.log(uniform(seed, F.col("doc_id"))) / F.col("weight"))
    rows = stored(keyed.drop("chars", "given"), "mixing")
    total, place = key_place(rows)
    ranges = max(1, ceil(sqrt(total)))
    rows = rows.withColumn("range", F.floor(F.lit(float(ranges)) * place).cast("long"))

    sums = rows.groupBy("skey", "source", "range").agg(F.sum("size").alias("range_size"))
    per_source = targets(sums.groupBy("skey", "source").agg(F.sum("range_size").alias("source_size")))
    earlier = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("skey", "range",
                         F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("start")) \
        .join(per_source, "skey")

    within = Window.partitionBy("skey", "range").orderBy("key", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))) \
        .join(starts, ["skey", "range"])
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("start") - F.col("inner")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         taken.cast("long").alias("taken"))
