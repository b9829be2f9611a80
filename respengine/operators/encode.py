"""Feature dictionary and one-hot encoding.

The dictionary maps each distinct ``(feature_id, category)`` of the training
observations to a dense id ``0..n-1`` in ``(feature_id, category)`` byte
order. Numbering is global and distributed: the distinct pairs are range
partitioned, each range is numbered locally, and ranges are offset by the
sizes of the ranges before them (a few numbers per partition reach the
driver). No window runs over one partition and no feature is held by one task.

Encoded frames have ``row_id, label, indices ARRAY<INT>, values ARRAY<DOUBLE>``
with strictly increasing indices; their length ``d`` travels beside them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..lifetime import own_broadcast, own_frame
from ..session import materialize
from .blocks import Block, answers, packed, with_answers
from .joins import broadcast_byte_limit, broadcast_row_limit, hot_threshold

# Dictionary entries per range partition when numbering.
ENTRIES_PER_RANGE = 1_000_000


@dataclass
class Dictionary:
    """A numbered dictionary: ``df`` has ``feature_id, category, idx, n``.

    ``n`` is the number of training rows holding the pair; ``size``, ``total``
    (sum of ``n``) and ``bytes`` (the lookup table's size: category bytes plus
    two ints per entry) are exact, taken while numbering.
    """
    df: DataFrame
    size: int
    total: int
    bytes: int = 0
    packed: Broadcast | None = None

    def hot_keys(self) -> DataFrame:
        """Pairs frequent enough to skew a shuffle; bounded by ``hot_threshold``."""
        return (self.df.where(F.col("n") >= F.lit(hot_threshold(self.total)))
                .select("feature_id", "category", "idx"))

    def table(self) -> DataFrame:
        return self.df.select("feature_id", "category", "idx")

    def release(self) -> None:
        """Drop the cached and broadcast copies (the numbered table stays in the checkpoint folder)."""
        self.df.unpersist()
        if self.packed is not None:
            self.packed.unpersist()


def to_long(obs: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per feature: ``(row_id, label, feature_id, category)``.

    ``keep_empty`` keeps observations without features as one row of nulls.
    """
    gen = F.inline_outer if keep_empty else F.inline
    return obs.select("row_id", "label", gen("feats"))


def distinct_features(obs: DataFrame) -> DataFrame:
    """Set of ``(feature_id, category)`` pairs."""
    return to_long(obs).select("feature_id", "category").distinct()


def categories_per_feature(obs: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct categories per feature id (``''`` counts), ordered by feature id."""
    if approximate:
        pairs, agg = to_long(obs), F.approx_count_distinct("category")
    else:
        pairs, agg = distinct_features(obs), F.count(F.lit(1))
    return (pairs.groupBy("feature_id").agg(agg.alias("n_categories"))
            .select("feature_id", F.col("n_categories").cast("bigint"))
            .orderBy("feature_id"))


def build_dictionary(obs: DataFrame, num_partitions: int | None = None) -> Dictionary:
    """Number the distinct pairs of ``obs`` in ``(feature_id, category)`` order.

    Without ``num_partitions`` the range count follows the dictionary's size:
    about ``ENTRIES_PER_RANGE`` entries per range, at most the session's
    shuffle partitions.
    """
    spark = obs.sparkSession
    # The pair counts (one row per dictionary entry) are cached so that the
    # sizing, the range-bounds sample and the numbering read them instead of
    # the input.
    counts = (to_long(obs).groupBy("feature_id", "category")
              .agg(F.count(F.lit(1)).alias("n"))
              .persist(StorageLevel.MEMORY_AND_DISK))
    if num_partitions:
        parts = num_partitions
    else:
        entries = counts.count()
        parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                           -(-entries // ENTRIES_PER_RANGE)))
    ranged = (counts.repartitionByRange(parts, "feature_id", "category")
              .sortWithinPartitions("feature_id", "category")
              .select("feature_id", "category", "n",
                      F.spark_partition_id().alias("_part"),
                      F.monotonically_increasing_id().alias("_pos")))
    # Frozen in the reliable checkpoint folder: range bounds, partition ids and
    # positions stay identical for every later use of the dictionary.
    ranged = materialize(ranged)
    counts.unpersist()
    per_part = (ranged.groupBy("_part")
                .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"),
                     F.sum("n").alias("_n"),
                     F.sum(F.octet_length("category") + F.lit(8)).alias("_bytes"))
                .orderBy("_part").collect())  # one row per range partition
    offsets, acc, total, size_bytes = [], 0, 0, 0
    for r in per_part:
        offsets.append((r["_part"], acc, r["_first"]))
        acc += r["_cnt"]
        total += r["_n"]
        size_bytes += r["_bytes"] or 0
    if acc > 2 ** 31:
        raise ValueError(f"{acc} dictionary entries do not fit the INT ids: hash the features instead")
    off_schema = T.StructType([T.StructField("_part", T.IntegerType()),
                               T.StructField("_offset", T.LongType()),
                               T.StructField("_first", T.LongType())])
    off = spark.createDataFrame(offsets, off_schema)
    df = (ranged.join(F.broadcast(off), "_part")
          .select("feature_id", "category",
                  (F.col("_offset") + F.col("_pos") - F.col("_first")).cast("int").alias("idx"),
                  F.col("n").cast("bigint").alias("n"))
          .persist())
    own_frame(df)
    return Dictionary(df=df, size=acc, total=total, bytes=int(size_bytes))


def lookup(dictionary: Dictionary, feature_id: int, category: str) -> DataFrame:
    """Id of one pair (empty when absent)."""
    return (dictionary.table()
            .where((F.col("feature_id") == F.lit(feature_id)) & (F.col("category") == F.lit(category))))


def _pair_hashes(fid: Column, cat: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a pair, null for a null category (which no join finds either)."""
    given = fid.isNotNull() & cat.isNotNull()
    return F.when(given, F.xxhash64(fid, cat)), F.when(given, F.xxhash64(cat, fid))


def _packed(dictionary: Dictionary):
    """The dictionary as a broadcast of arrays sorted by hash, or None.

    20 bytes an entry; the caller bounds the entries. None when two entries share their
    first hash: the pairs are then joined.
    """
    if dictionary.packed is None:
        first, second = _pair_hashes(F.col("feature_id"), F.col("category"))
        table = (dictionary.df.select(first.alias("first"), second.alias("second"), "idx")
                 .where("first is not null").toArrow())
        keys, also, idx = (table.column(c).to_numpy() for c in table.column_names)
        order = np.argsort(keys, kind="stable")
        keys, also, idx = keys[order], also[order], idx[order]
        if np.any(keys[1:] == keys[:-1]):
            return None
        dictionary.packed = own_broadcast(
            dictionary.df.sparkSession.sparkContext.broadcast((keys, also, idx)))
    return dictionary.packed


def _finder(packed):
    """Arrow function: dictionary ids of arrays of hash pairs, -1 for unknown pairs."""
    def find(first: pa.Array, second: pa.Array) -> pa.Array:
        keys, also, idx = packed.value
        ends = np.cumsum(pc.list_value_length(first).to_numpy(zero_copy_only=False))
        known = first.flatten().is_valid().to_numpy(zero_copy_only=False)
        a = first.flatten().fill_null(0).to_numpy(zero_copy_only=False)
        b = second.flatten().fill_null(0).to_numpy(zero_copy_only=False)
        found = np.full(len(a), -1, np.int32)
        if len(keys):
            place = np.minimum(np.searchsorted(keys, a), len(keys) - 1)
            known = known & (keys[place] == a) & (also[place] == b)
            found[known] = idx[place[known]]
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    return F.arrow_udf(find, "array<int>")


def _unseen(fid: Column, cat: Column) -> Column:
    return F.raise_error(F.concat(F.lit("unseen feature pair ("), fid.cast("string"), F.lit(", '"),
                                  F.coalesce(cat, F.lit("null")), F.lit("')")))


def one_hot_encode(obs: DataFrame, dictionary: Dictionary, unseen: str = "skip",
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """Encode observations with a dictionary: one 1.0 per known pair.

    ``unseen='skip'`` drops unknown pairs (an observation with none known is an
    empty vector and stays); ``unseen='error'`` fails on the first unknown pair.
    A pair repeated within one observation fails in both modes.

    A dictionary within ``max_broadcast_rows`` (default
    ``respengine.broadcastMaxRows``) and ``respengine.broadcastMaxBytes`` is
    broadcast once, and pairs are looked up inside the row by two 64-bit hashes:
    no shuffle. For a larger one the rows are packed into blocks, each block asks for
    its distinct pairs through a shuffle in which hot pairs are salted, and the ids come
    back to the block (``blocks``). Rows are never regrouped or merged: ids may repeat.
    """
    if unseen not in ("skip", "error"):
        raise ValueError("unseen must be 'skip' or 'error'")
    spark = obs.sparkSession
    limit = broadcast_row_limit(spark) if max_broadcast_rows is None else max_broadcast_rows
    packed = None
    if dictionary.size <= limit and dictionary.size * 20 <= broadcast_byte_limit(spark):
        packed = _packed(dictionary)
    if packed is not None:
        indices = _looked_up(obs, packed, unseen)
    else:
        indices = _joined(obs, dictionary, unseen, limit)
    checked = F.when(F.size(F.array_distinct("indices")) != F.size("indices"),
                     F.raise_error(F.lit("repeated feature pair in one observation"))
                     ).otherwise(F.col("indices"))
    return indices.select(
        "row_id", "label", checked.cast("array<int>").alias("indices"),
        F.transform(checked, lambda _: F.lit(1.0)).alias("values"))


def _looked_up(obs: DataFrame, packed, unseen: str) -> DataFrame:
    first = F.transform("feats", lambda f: _pair_hashes(f["feature_id"], f["category"])[0])
    second = F.transform("feats", lambda f: _pair_hashes(f["feature_id"], f["category"])[1])
    found = obs.select("row_id", "label", "feats", _finder(packed)(first, second).alias("_idx"))
    idx = F.col("_idx")
    if unseen == "error":
        unknown = F.get("feats", F.array_position(idx, F.lit(-1)).cast("int") - 1)
        idx = F.when(F.array_contains(idx, F.lit(-1)),
                     _unseen(unknown["feature_id"], unknown["category"])).otherwise(idx)
    return found.select("row_id", "label",
                        F.array_sort(F.filter(idx, lambda i: i >= 0)).alias("indices"))


def _joined(obs: DataFrame, dictionary: Dictionary, unseen: str, limit: int) -> DataFrame:
    keys = ["feature_id", "category"]
    blocks = packed(obs.select("row_id", "label", *[
        F.col(f"feats.{k}").alias(k) for k in keys]), keys)
    found = answers(blocks, dictionary.table(), keys, table_rows=dictionary.size, table_bytes=dictionary.bytes,
                    hot_keys=dictionary.hot_keys(), max_broadcast_rows=limit)
    idx = F.col("idx")
    if unseen == "error":
        idx = F.when(idx.isNull(), _unseen(F.col("feature_id"), F.col("category"))).otherwise(idx)
    schema = obs.select("row_id", "label").schema.add("indices", T.ArrayType(T.IntegerType()))
    return with_answers(blocks, found.select("block", "k", idx.alias("idx")), _with_ids, schema)


def _with_ids(block: Block, found: pa.Table) -> pa.Table:
    """The rows of a block with the ids of their known pairs, in order."""
    known = found.filter(pc.is_valid(found.column("idx")))
    ids = np.full(block.keys, -1, np.int64)
    ids[known.column("k").to_numpy()] = known.column("idx").to_numpy()
    entry = ids[block.place]
    row, entry = block.owner[entry >= 0], entry[entry >= 0]
    order = np.lexsort((entry, row))
    off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(block.lengths)))]).astype(np.int32)
    indices = pa.ListArray.from_arrays(pa.array(off), pa.array(entry[order].astype(np.int32)))
    return block.rows.append_column("indices", indices)


def encoded_long(encoded: DataFrame) -> DataFrame:
    """``(row_id, label, idx, value)``, one row per stored entry."""
    return (encoded.select("row_id", "label",
                           F.inline(F.zip_with("indices", "values",
                                               lambda i, v: F.struct(i.alias("idx"),
                                                                     v.alias("value"))))))


def with_feature_counts(encoded: DataFrame) -> DataFrame:
    """Number of stored entries per row (``nnz``)."""
    return encoded.select("row_id", "label", F.size("indices").alias("nnz"))
