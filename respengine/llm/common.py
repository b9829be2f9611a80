"""Helpers shared by the operators of this package.

Chunks. The operators that compare all texts with all others deal the documents into
chunks of about ``respengine.llm.chunkBytes`` bytes of text (default 4 MiB). A chunk is
one group of one task, so its bytes bound the memory of a task whatever the input is.
What a chunk asks of the rest of the corpus travels as one sorted block per (chunk,
part); the answer comes back as one bit per key in the same order. Rows with equal text
but other ids fall into different chunks, so no group of copies ends up in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respengine.session import ensure_checkpoint_dir

DEFAULT_CHUNK_BYTES = 4 * 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}/{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, no lineage."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text column as a string, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def chunk_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get("respengine.llm.chunkBytes", str(DEFAULT_CHUNK_BYTES)))


def chunk_count(docs: DataFrame, text_col: str = "text") -> int:
    """Number of chunks for the bytes of all texts (at least 1)."""
    total = docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    return max(1, -(-int(total) // chunk_bytes(docs.sparkSession)))


def chunk_of(n: int) -> Column:
    """The chunk of a row of ``doc_id, text``."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")


def chunked(docs: DataFrame, n: int, *, id_col: str = "doc_id", text_col: str = "text",
            **extra: Column) -> DataFrame:
    """``chunk, doc_id, text`` (and ``extra`` columns), one shuffle of the texts.

    Other columns of ``docs`` are left behind, so their names cannot clash.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
                      *[c.alias(name) for name, c in extra.items()])
    return out.select(chunk_of(n).alias("chunk"), "*").repartition(n, "chunk")
