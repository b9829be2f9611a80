"""Lookups of large tables by blocks of rows.

Where a lookup table is too large to broadcast, rows are not exploded, joined and regrouped.
They are packed once into blocks (stored in the checkpoint folder), each block asks the
table for its distinct keys, and the answers come back to the block as one array: a row
travels once, inside its block, and is never merged with an equal one. A key that a third
of all rows hold is asked for once a block.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .joins import lookup_join

# Rows, and entries of their lists, after which a block is closed.
BLOCK_ROWS = 1 << 16
BLOCK_ENTRIES = 1 << 20


def numbered_blocks() -> Iterator[int]:
    """Numbers for the blocks of a task, which no other task of the stage uses."""
    return itertools.count(TaskContext.get().partitionId() << 32)


def distinct_keys(columns: list[pa.Array]) -> tuple[list[pa.Array], np.ndarray]:
    """The distinct combinations of equally long columns, and which of them each entry is."""
    place, found = np.zeros(len(columns[0]), np.int64), []
    for column in columns:
        coded = column.dictionary_encode(null_encoding="encode")
        size = max(1, len(coded.dictionary))
        # At most the entries of a block times the values of one column.
        seen, place = np.unique(place * size + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        found = [f.take(pa.array(seen // size)) for f in found] + [coded.dictionary.take(pa.array(seen % size))]
    return found, place.astype(np.int32)


def _packer(keys: list[str], kept: list[str], block_rows: int, block_entries: int):
    step = min(4096, block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, rows, entries = numbered_blocks(), [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lists = [table.column(k).combine_chunks() for k in keys]
            lengths = pc.fill_null(pc.list_value_length(lists[0]), 0).to_numpy(zero_copy_only=False).astype(np.int32)
            found, place = distinct_keys([x.flatten() for x in lists])
            sink = pa.BufferOutputStream()
            own = table.select(kept)
            with pa.ipc.new_stream(sink, own.schema) as writer:
                writer.write_table(own)
            asked = pa.StructArray.from_arrays(found, names=keys)
            return pa.record_batch({
                "block": pa.array([next(number)], pa.int64()),
                "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                "lengths": pa.array([lengths.tobytes()], pa.binary()),
                "place": pa.array([place.tobytes()], pa.binary()),
                "asked": pa.ListArray.from_arrays(pa.array([0, len(asked)], pa.int32()), asked)})

        for batch in batches:
            for first in range(0, batch.num_rows, step):
                some = batch.slice(first, step)
                held.append(some)
                rows += some.num_rows
                entries += pc.sum(pc.list_value_length(some.column(keys[0]))).as_py() or 0
                if rows >= block_rows or entries >= block_entries:
                    yield block()
                    held, rows, entries = [], 0, 0
        if rows:
            yield block()

    return run


def packed(rows: DataFrame, keys: list[str], *, block_rows: int = BLOCK_ROWS,
           block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Stored blocks of ``rows``: ``block, rows, lengths, place, asked``.

    ``keys``: array columns of equal length in every row; together, entry by entry, they are
    the keys a row asks for. All other columns are kept as they are.
    """
    kept = [c for c in rows.columns if c not in keys]
    item = T.StructType([T.StructField(k, rows.schema[k].dataType.elementType) for k in keys])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.BinaryType()),
                           T.StructField("lengths", T.BinaryType()), T.StructField("place", T.BinaryType()),
                           T.StructField("asked", T.ArrayType(item))])
    return materialize(rows.mapInArrow(_packer(keys, kept, block_rows, block_entries), schema))


def answers(blocks: DataFrame, table: DataFrame, keys: list[str], *, table_rows: int,
            table_bytes: int | None = None, hot_keys: DataFrame | None = None,
            max_broadcast_rows: int | None = None) -> DataFrame:
    """``block, k``, the key and the table's columns (null where it has none) of every key
    that a block asks for; ``k`` is the key's number in the block."""
    # (A column of its own, told apart from the blocks' when the answers meet them.)
    asked = blocks.select((F.col("block") + 0).alias("block"), F.posexplode("asked").alias("k", "key")) \
        .select("block", "k", "key.*")
    return lookup_join(asked, table, keys, table_rows=table_rows, table_bytes=table_bytes,
                       hot_keys=hot_keys, max_broadcast_rows=max_broadcast_rows)


class Block:
    """A block's own rows, its entries (row by row) and the number of each entry's key."""

    def __init__(self, table: pa.Table):
        self.rows = pa.ipc.open_stream(pa.py_buffer(table.column("rows")[0].as_py())).read_all()
        self.lengths = np.frombuffer(table.column("lengths")[0].as_py(), np.int32)
        self.place = np.frombuffer(table.column("place")[0].as_py(), np.int32)
        self.owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.keys = int(self.place.max()) + 1 if len(self.place) else 0


def with_answers(blocks: DataFrame, found: DataFrame, finish: Callable[[Block, pa.Table], pa.Table],
                 schema: T.StructType) -> DataFrame:
    """``finish(block, answers)`` of every block; ``found``: rows of ``block, k`` and values."""
    def run(block: pa.Table, mine: pa.Table) -> pa.Table:
        return finish(Block(block), mine)
    return blocks.drop("asked").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, schema)
