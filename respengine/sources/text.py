"""Labelled delimited text: one observation per line, label first, then
categorical features numbered by position.

Observation frames everywhere in the library have the columns
``row_id BIGINT, label DOUBLE, feats ARRAY<STRUCT<feature_id INT, category STRING>>``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parse_features, parse_label, split_fields, strip_line
from ..lifetime import own_broadcast
from .rows import with_content_ids

FEATS_TYPE = T.ArrayType(T.StructType([
    T.StructField("feature_id", T.IntegerType(), False),
    T.StructField("category", T.StringType(), True),
]), False)

OBS_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("label", T.DoubleType(), False),
    T.StructField("feats", FEATS_TYPE, False),
])


def parse_lines(lines: DataFrame, line_col: str = "line", row_id_col: str = "row_id",
                sep: str = "\t", blank: str = "drop") -> DataFrame:
    """Parse a frame of text lines into observations.

    The line is stripped first, so trailing empty fields vanish while interior
    empties stay ``''``. ``blank='drop'`` removes lines that are empty after the
    strip; ``blank='positive'`` keeps them as label 1.0 with no features, which
    is what the reference makes of blank lines inside its input.
    """
    if blank not in ("drop", "positive"):
        raise ValueError("blank must be 'drop' or 'positive'")
    stripped = lines.select(F.col(row_id_col).cast("bigint").alias("row_id"),
                            strip_line(line_col).alias("_line"))
    if blank == "drop":
        stripped = stripped.where(F.col("_line") != F.lit(""))
    fields = split_fields("_line", sep)
    return stripped.select(
        "row_id",
        parse_label(fields[0]).alias("label"),
        parse_features(fields).alias("feats"),
    )


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def _numbered(lines: DataFrame, ids: str, num_partitions: int | None) -> DataFrame:
    if ids == "content":
        lines = with_content_ids(lines, F.col("line"))
    else:
        lines = lines.select(F.monotonically_increasing_id().alias("row_id"), "line")
    return lines.repartition(num_partitions, "row_id") if num_partitions else lines


def _offsets_fn(begins):
    """Arrow function over (file hash, split start, line bytes) as scanned: the byte each line
    begins at. ``begins``: broadcast of the byte at which the first line of a split begins."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, held = None, 0
        for columns in batches:
            file, start, size = (c.to_numpy(zero_copy_only=False) for c in columns)
            if not len(size):
                yield pa.array([], pa.int64())
                continue
            size = size.astype(np.int64) + 1  # and its newline
            new = np.ones(len(size), bool)
            new[1:] = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
            new[0] = (file[0], start[0]) != last
            before = np.cumsum(size) - size
            first = np.flatnonzero(new)
            # What a split's lines add to the bytes before them in the batch; the first rows
            # may go on with the split of the batch before.
            shift = np.array([held, *[_begin(begins.value, file[i], start[i]) - before[i] for i in first]], np.int64)
            out = before + shift[np.cumsum(new)]
            yield pa.array(out, pa.int64())
            last, held = (file[-1], start[-1]), int(out[-1] + size[-1])

    return F.arrow_udf(run, "bigint")


def _begin(begins: dict, file: int, start: int) -> int:
    try:
        return begins[int(file), int(start)]
    except KeyError:
        raise RuntimeError("the two scans of the text were split differently") from None


def with_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, line``: every line of the files and the byte it begins at.

    Two scans, no shuffle of the lines: the first adds up the bytes of each split's lines
    (one row per split reaches the driver; lines and their newlines tile a file, so the
    splits before a split tell where its first line begins), the second counts on inside the
    split. Only lengths leave the JVM. A split without a place is an error: the scans were
    planned differently, as when executors came or went in between.
    """
    scan = _scan(spark, path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.octet_length("value").alias("size"))
    splits = scan.groupBy(F.xxhash64("file").alias("file"), "start").agg(F.sum(F.col("size") + 1).alias("bytes")).collect()
    begins, ends = {}, {}
    for r in sorted(splits, key=lambda r: r["start"]):
        begins[r["file"], r["start"]] = ends.get(r["file"], 0)
        ends[r["file"]] = ends.get(r["file"], 0) + r["bytes"]
    offsets = _offsets_fn(own_broadcast(spark.sparkContext.broadcast(begins)))
    return scan.select("file", offsets(F.xxhash64("file"), F.col("start"), F.col("size")).alias("offset"), "line")


def _offset_ids(lines: DataFrame) -> DataFrame:
    return lines.select(F.xxhash64("file", "offset").alias("row_id"), "line")


def read_lines(spark: SparkSession, path: str, num_partitions: int | None = None,
               ids: str = "offset") -> DataFrame:
    """Text lines split on ``\\n`` only, as ``row_id, line``.

    ``ids='offset'`` (default) derives the id from the file and the byte the line begins at
    (64 bits of a hash): the same for every packing of the files into tasks, without a
    shuffle of the lines. ``ids='content'`` derives it from the line and its place among
    equal lines, whatever file they are in, at the price of one shuffle. ``ids='scan'``
    numbers lines as they are scanned; such ids change with the number of cores and the
    split size. An explicit partition count (the reference's ``numPartitions``) repartitions
    after the id is assigned.
    """
    _check_ids(ids)
    if ids == "offset":
        lines = _offset_ids(with_offsets(spark, path))
        return lines.repartition(num_partitions, "row_id") if num_partitions else lines
    return _numbered(_scan(spark, path).select(F.col("value").alias("line")), ids, num_partitions)


def _check_ids(ids: str) -> None:
    if ids not in ("offset", "content", "scan"):
        raise ValueError("ids must be 'offset', 'content' or 'scan'")


_COMPRESSED = r"(?i)\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"


def final_blank_lines(spark: SparkSession, path: str) -> DataFrame:
    """One empty ``line`` per input file that ends in a newline, at the file's end.

    Such a file is as long as its lines and one newline each (less a byte order mark of
    three bytes, which the reader skips). The size of a compressed file tells nothing about
    its lines, so such a file is an error.
    """
    size = F.when(F.col("file_path").rlike(_COMPRESSED), F.raise_error(F.concat(
        F.lit("blank='positive' needs uncompressed files: "), F.col("file_path")))
        ).otherwise(F.col("file_size"))
    per_file = (_scan(spark, path)
                .select("value", "_metadata.file_path", "_metadata.file_size")
                .groupBy("file_path", "file_size")
                .agg(F.sum(F.octet_length("value") + 1).alias("lines")))
    return (per_file.where((size - F.col("lines")).isin(0, 3))
            .select(F.col("file_path").alias("file"), F.col("lines").alias("offset"), F.lit("").alias("line")))


def read_labelled_lines(spark: SparkSession, path: str, sep: str = "\t",
                        blank: str = "drop", num_partitions: int | None = None,
                        ids: str = "offset") -> DataFrame:
    """Read a labelled delimited text file (or folder) into observations.

    With ``blank='positive'``, blank lines become positives without features,
    as in the reference; that includes the empty line after a file's final
    newline, which Spark's line reader does not yield, so one empty line is
    added per input file that ends in a newline.
    """
    _check_ids(ids)
    if ids == "offset":
        lines = with_offsets(spark, path)
        if blank == "positive":
            lines = lines.unionByName(final_blank_lines(spark, path))
        lines = _offset_ids(lines)
        lines = lines.repartition(num_partitions, "row_id") if num_partitions else lines
    else:
        lines = _scan(spark, path).select(F.col("value").alias("line"))
        if blank == "positive":
            lines = lines.unionByName(final_blank_lines(spark, path).select("line"))
        lines = _numbered(lines, ids, num_partitions)
    return parse_lines(lines, sep=sep, blank=blank)


def lines_from_observations(obs: DataFrame, sep: str = "\t") -> DataFrame:
    """Write observations back as text lines ``label, f0, f1, ...`` (label as 0/1)."""
    return obs.select(
        "row_id",
        F.concat_ws(sep,
                    F.array_prepend(F.transform("feats", lambda f: f["category"]),
                                    F.col("label").cast("int").cast("string"))
                    ).alias("line"))


# The reference's three-observation sample (feature 0 = animal,
# 1 = colour, 2 = food, the third one optional).
SAMPLE_ROWS = [
    (1, [(0, "mouse"), (1, "black")]),
    (2, [(0, "cat"), (1, "tabby"), (2, "mouse")]),
    (3, [(0, "bear"), (1, "black"), (2, "salmon")]),
]


def sample_observations(spark: SparkSession) -> DataFrame:
    """The reference's inline three-row sample as an observation frame (label 1.0)."""
    rows = [(rid, 1.0, [{"feature_id": f, "category": c} for f, c in feats])
            for rid, feats in SAMPLE_ROWS]
    return spark.createDataFrame(rows, OBS_SCHEMA)
