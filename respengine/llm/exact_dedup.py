"""Exact deduplication with streaming state that never expires.

Every text is digested once; the narrow rows (digest, identifier, locator) run through a
Structured Streaming aggregation whose state lives in RocksDB on disk and is backed up to
the shared folder: per digest the identifier and locator of the row that stays, and the
number of rows. There is no watermark, so nothing is ever forgotten, and a later stream
over new files continues from the same checkpoint folder. The aggregation combines rows
before the shuffle, so a digest with a third of all rows reaches its state as one row per
task.

A hit (a digest with several rows) is not trusted: the full text of every such row is
compared with the text that the state's locator names. Large groups are spread over salts
for that, a thousand rows to a salt. Should a digest ever cover different texts, its rows
are grouped again by the texts themselves.

Defined results: null and empty texts are equal; of equal texts the row with the largest
id stays (a null id only if all are null; among equal ids the last locator); exactly one
row of a group stays, repeated rows included; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respengine.llm.common import free_name, shared_path, text_of
from respengine.operators.joins import hot_threshold, lookup_join

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"
SALT_ROWS = 1000
MAX_HOT = 1000
BROADCAST_ROWS = 100_000


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, file, pos``: rows that their file and position identify."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:  # not read from Parquet: give the rows a place first
        path = shared_path(docs.sparkSession, "exact_dedup/rows")
        docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")) \
            .write.parquet(path)
        docs, id_col, text_col = docs.sparkSession.read.schema(
            "doc_id long, text string").parquet(path), "doc_id", "text"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("pos"))


def fold_stream(rows: DataFrame, out_path: str, state_path: str) -> None:
    """Run the streaming ``rows`` (digest, doc_id, file, pos) through the keyed state.

    Every micro-batch writes the digests it touched under its own number, so a batch that
    is repeated after a failure replaces its own output.
    """
    spark = rows.sparkSession
    folded = rows.groupBy("digest").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "file", "pos")).alias("keep"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    # A store leaves the local disk after each batch (an open one sets aside megabytes,
    # however little it holds); the state is in the checkpoint folder.
    wanted = {PROVIDER: ROCKSDB, UNLOAD: "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        folded.writeStream.outputMode("update").foreachBatch(write) \
            .option("checkpointLocation", state_path).trigger(availableNow=True) \
            .start().awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _state(spark: SparkSession, out_path: str) -> DataFrame:
    """The last word of the state on every digest."""
    kept = "struct<doc_id: long, file: string, pos: long>"
    rows = spark.read.schema(f"digest string, n long, keep {kept}, batch long") \
        .option("basePath", out_path).parquet(f"{out_path}/batch=*")
    last = rows.groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("last"))
    return last.select("digest", "last.n", "last.keep")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256,
                files_per_batch: int = 1000) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, file, pos`` for every row."""
    spark = docs.sparkSession
    content = located(docs, id_col, text_col)
    path = shared_path(spark, "exact_dedup/digests")
    schema = "digest string, text_sha256 string, doc_id long, file string, pos long"
    content.select(digest(F.col("text")).cast("string").alias("digest"),
                   sha256(F.col("text")).alias("text_sha256"), "doc_id", "file", "pos") \
        .write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    total = rows.count()
    if not total:
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"),
                           F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                           "text_sha256", "file", "pos")
    out_path = shared_path(spark, "exact_dedup/groups")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(path).select("digest", "doc_id", "file", "pos")
    fold_stream(stream, out_path, shared_path(spark, "exact_dedup/state"))
    state = _state(spark, out_path)

    hot = state.where(F.col("n") >= hot_threshold(total, MAX_HOT))
    joined = lookup_join(rows, state, ["digest"], table_rows=total, hot_keys=hot,
                         max_broadcast_rows=BROADCAST_ROWS)
    result = joined.select("doc_id", F.col("keep.doc_id").alias("keep_id"),
                           F.col("n").alias("group_size"),
                           ((F.col("file") == F.col("keep.file"))
                            & (F.col("pos") == F.col("keep.pos"))).alias("kept"),
                           "text_sha256", "file", "pos", "digest")

    differ = _differing(content, joined)
    if differ.isEmpty():
        return result.drop("digest")
    wrong = differ.select("digest").distinct()
    texts = content.join(rows.join(wrong, "digest", "left_semi")
                         .select("file", "pos", "digest", "text_sha256"), ["file", "pos"])
    groups = texts.groupBy("digest", "text").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "file", "pos")).alias("keep"))
    again = texts.join(groups, ["digest", "text"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("file") == F.col("keep.file")) & (F.col("pos") == F.col("keep.pos"))).alias("kept"),
        "text_sha256", "file", "pos")
    return result.join(wrong, "digest", "left_anti").drop("digest").unionByName(again)


def _differing(content: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of repeated digests whose bytes are not those of the row that stays."""
    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    members = joined.where("n > 1").select(
        "digest", "file", "pos", salts.alias("salts"),
        ((F.col("file") == F.col("keep.file")) & (F.col("pos") == F.col("keep.pos"))).alias("kept"))
    texts = content.select("file", "pos", "text").join(members, ["file", "pos"])
    keepers = texts.where("kept").select(
        "digest", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.col("text").alias("keep_text"))
    others = texts.where("not kept").select(
        "digest", F.pmod(F.xxhash64("file", "pos"), F.col("salts")).cast("int").alias("salt"), "text")
    return others.join(keepers, ["digest", "salt"]).where("text != keep_text")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (read from Parquet) that stay, with all their columns."""
    file, pos = free_name(docs.columns, "file"), free_name(docs.columns, "pos")
    gone = exact_dedup(docs, id_col=id_col, text_col=text_col).where("not kept") \
        .select(F.col("file").alias(file), F.col("pos").alias(pos))
    named = docs.select("*", F.col("_metadata.file_path").alias(file),
                        F.col("_metadata.row_index").alias(pos))
    return named.join(gone, [file, pos], "left_anti").select(*docs.columns)
