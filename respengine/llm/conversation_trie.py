"""Prefix trie of conversations over padded matrices of turn ids.

A node is a distinct sequence of first turns; its members are the conversations that begin
with it. A turn's id is 128 bits of SHA-256 of its role and text.

1. Bands. A conversation is cut into bands of ``BAND`` turns, one row each, so that no row
   grows with a conversation. A band's row has the key of all turns before it; the keys of
   a long conversation are chained from one digest a band.
2. Shards. Rows are range partitioned by (key before, first ``HEAD`` ids, conversation).
   The conversation is in the order, so copies of one conversation, or a third of all
   that begin alike, are spread over as many shards as their rows need.
3. Matrix. A shard numbers its turn ids, pads its rows with 0 to a matrix and sorts it by
   numpy's lexsort. A change against the row above, OR-accumulated over the columns, marks
   where the nodes of each depth begin; reduceat over these marks gives each node's
   members, and its subtree's sums come from the depth below.
4. Boundary nodes. A node whose rows may go on elsewhere (the nodes of a shard's first and
   last rows up to ``HEAD`` turns and all below these, and those of rows that fill their
   band) leaves its shard as a partial row. Partial rows are added up by key, and what is
   below them is summed over the boundary nodes alone by doubling: in round k every node
   gets the sums of its descendants less than 2^k below. All other nodes are complete.
   Conversations that end in a boundary node are hashed as a sorted stream, by pieces.

Defined results: turns are ordered by number (null first), then role, then id; a null role
or text is empty; rows without a conversation are left out; a conversation without turns is
a member of the root and ends there; equal turns are separate turns; a long conversation is
one path; no conversations give no nodes; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respengine.llm.common import stored
from respengine.llm.ranks import ranked
from respengine.operators.joins import hot_threshold, lookup_join

BAND = 64
HEAD = 16
ROWS_PER_SHARD = 20_000
TURNS_PER_SHARD = 200_000
MAX_HOT = 1000
BROADCAST_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)

CHAIN = "conv_id long, band long, before binary"
PARTS = ("inner boolean, key binary, parent binary, depth long, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, turn_id binary, "
         "ends_sha256 string, ends string, first long")
ENDS = "key binary, ends_sha256 string"
NO_CONV = np.iinfo(np.int64).max


# -- turns ------------------------------------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    """128 bits that tell a turn (role and text, not null) from others."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def placed_turns(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``conv_id, id, words, pos, n``: every turn's place in its conversation of ``n``; and
    ``conv_id, n`` of all conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        turn_id(role, text).alias("id"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"))
    placed, groups = ranked(stored(turns, "trie/turns"), "conv_id", ["turn", "role", "id"], label="trie/places")
    return (placed.select("conv_id", "id", "words", "pos", "n"),
            groups.select("conv_id", F.col("n").cast("long").alias("n")))


# -- bands ------------------------------------------------------------------------------

def _digest(ids: Column) -> Column:
    joined = F.aggregate(ids, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return F.unhex(F.substring(F.sha2(joined, 256), 1, 32))


def _chain(table: pa.Table) -> pa.Table:
    """The keys before a conversation's second band and later ones."""
    table = table.sort_by("band")
    before, out = ROOT, []
    for digest in table.column("digest").to_pylist():
        before = sha256(before + digest).digest()[:16]
        out.append(before)
    bands = [b + 1 for b in table.column("band").to_pylist()]
    return pa.table({"conv_id": table.column("conv_id"), "band": pa.array(bands, pa.int64()),
                     "before": pa.array(out, pa.binary())})


def _bands(turns: DataFrame, turnless: DataFrame) -> DataFrame:
    """``conv_id, band, before, ids, words, total`` of every band of every conversation."""
    band = F.floor(F.col("at") / BAND).cast("long").alias("band")
    rows = turns.groupBy("conv_id", band).agg(
        F.sort_array(F.collect_list(F.struct("at", "id", "words"))).alias("t"), F.max("total").alias("total"))
    rows = rows.select("conv_id", "band", F.col("t.id").alias("ids"), F.col("t.words").alias("words"), "total")
    none = turnless.select(F.col("conv_id").cast("long"), F.lit(0).cast("long").alias("band"),
                           F.array().cast("array<binary>").alias("ids"), F.array().cast("array<bigint>").alias("words"),
                           F.lit(0).cast("long").alias("total"))
    rows = stored(rows.unionByName(none), "trie/bands")
    full = rows.where((F.size("ids") == BAND) & (F.col("total") > F.col("band") * BAND + BAND))
    keys = full.select("conv_id", "band", _digest(F.col("ids")).alias("digest")) \
        .groupBy("conv_id").applyInArrow(_chain, CHAIN)
    first = rows.where("band = 0").withColumn("before", F.lit(ROOT))
    return first.unionByName(rows.where("band > 0").join(keys, ["conv_id", "band"]))


# -- shards -----------------------------------------------------------------------------

def _dense(ids: np.ndarray) -> np.ndarray:
    """Numbers from 1 for 16-byte values (rows of bytes), in their order."""
    halves = np.ascontiguousarray(ids).view(">u8").astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new)
    return out


class Shard:
    """The sorted, padded matrix of a shard's rows."""

    def __init__(self, table: pa.Table):
        ids, words = table.column("ids").combine_chunks(), table.column("words").combine_chunks()
        size = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.frombuffer(b"".join(ids.flatten().to_pylist()), np.uint8).reshape(-1, 16)
        before = np.frombuffer(b"".join(table.column("before").to_pylist()), np.uint8).reshape(-1, 16)
        conv = table.column("conv_id").to_numpy()
        off = np.concatenate([[0], np.cumsum(size)])
        matrix = np.zeros((len(size), 1 + int(size.max())), np.int32)
        matrix[:, 0] = _dense(before)
        row = np.repeat(np.arange(len(size)), size)
        matrix[row, 1 + np.arange(len(flat)) - off[row]] = _dense(flat)
        order = np.lexsort([conv, *matrix.T[::-1]])
        self.matrix, self.size, self.conv, self.off = matrix[order], size[order], conv[order], off[order]
        self.flat, self.words = flat, words.flatten().to_numpy(zero_copy_only=False)
        self.before, self.band = before[order], table.column("band").to_numpy()[order]
        self.ends = self.band * BAND + self.size == table.column("total").to_numpy()[order]
        change = np.ones(self.matrix.shape, bool)
        change[1:] = self.matrix[1:] != self.matrix[:-1]
        self.change = np.logical_or.accumulate(change, axis=1)
        head = self.matrix[:, :1 + HEAD]
        self.open = (self.size == BAND) | (head == head[0]).all(axis=1) | (head == head[-1]).all(axis=1)

    def key(self, row: int, depth: int) -> bytes:
        """The key of the node that a row's first ``depth`` turns make."""
        before = self.before[row].tobytes()
        if not depth:
            return before
        ids = self.flat[self.off[row]:self.off[row] + depth].tobytes()
        return sha256(before + sha256(ids).digest()[:16]).digest()[:16]


class Level:
    """The nodes of one depth of a shard: where their rows start and stop, and their sums."""

    def __init__(self, shard: Shard, depth: int):
        starts = np.flatnonzero(shard.change[:, depth])
        stops = np.append(starts[1:], len(shard.size))
        lowest = np.minimum.reduceat(shard.conv, starts)
        opened = np.logical_or.reduceat(shard.open, starts) | (depth == 0)
        real = shard.size[starts] >= depth  # the others are padding
        self.start, self.stop, self.open = starts[real], stops[real], opened[real]
        # A band's first column is the node that ends the band before, counted there.
        counted = (shard.band[self.start] == 0) | (depth > 0)
        self.conv = np.where(counted, lowest[real], NO_CONV)
        self.n = np.where(counted, self.stop - self.start, 0)
        self.words = shard.words[shard.off[self.start] + depth - 1] if depth else np.zeros(len(self.start), np.int64)
        self.children, self.leaves, self.saved = (np.zeros(len(self.start), np.int64) for _ in range(3))

    def add(self, below: Level) -> np.ndarray:
        """Add up the complete nodes of the depth below; returns the parent of every node there."""
        parent = np.searchsorted(self.start, below.start, side="right") - 1
        done = ~below.open
        for mine, theirs in ((self.children, 1), (self.leaves, below.leaves[done]), (self.saved, below.saved[done])):
            np.add.at(mine, parent[done], theirs)
        return parent

    def close(self) -> None:
        """Complete nodes: a leaf counts itself, and every node what its turn saves."""
        done = ~self.open
        self.leaves[done & (self.children == 0)] = 1
        self.saved[done] += ((self.n - 1) * self.words)[done]


def _ended(shard: Shard, level: Level, depth: int) -> dict[int, str]:
    """For nodes where conversations end: their ids, joined by commas."""
    rows = np.flatnonzero(shard.ends & (shard.size == depth))
    node = np.searchsorted(level.start, rows, side="right") - 1
    cuts = np.flatnonzero(np.diff(node)) + 1
    return {int(node[part[0]]): ",".join(map(str, shard.conv[rows[part]].tolist()))
            for part in np.split(np.arange(len(rows)), cuts) if len(part)}


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard: complete ones, and parts of boundary nodes."""
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    shard = Shard(pa.Table.from_batches(held))
    del held
    depth, below, ready = shard.matrix.shape[1] - 1, None, None
    while depth >= -1:
        level = Level(shard, depth) if depth >= 0 else None
        if level:
            parent = level.add(below) if below else None
            level.close()
        if below:
            yield _written(shard, below, depth + 1, level, parent if level else None)
        below, depth = level, depth - 1


def _written(shard: Shard, level: Level, depth: int, above: Level | None, parent: np.ndarray | None) -> pa.RecordBatch:
    count, ended = len(level.start), _ended(shard, level, depth)
    none = sha256(b"").hexdigest()
    keys = [shard.key(int(level.start[i]), depth) if level.open[i] else None for i in range(count)]
    parents, parent_conv = [None] * count, [None] * count
    if above:
        # A parent that is not complete is known by its key only.
        known: dict[int, bytes] = {}
        for i, p in enumerate(parent.tolist()):
            if above.open[p]:
                if p not in known:
                    known[p] = shard.key(int(above.start[p]), depth - 1)
                parents[i] = known[p]
            else:
                parent_conv[i] = int(above.conv[p])
    long = lambda x: pa.array(x, pa.int64())
    ids = shard.flat[shard.off[level.start] + depth - 1] if depth else None
    return pa.record_batch({
        "inner": pa.array(~level.open), "key": pa.array(keys, pa.binary()), "parent": pa.array(parents, pa.binary()),
        "depth": long(shard.band[level.start] * BAND + depth),
        "conv_id": pa.array(level.conv, pa.int64(), mask=level.conv == NO_CONV),
        "parent_conv_id": long(parent_conv), "n_convs": long(level.n), "n_children": long(level.children),
        "n_leaves": long(level.leaves), "saved_tokens": long(level.saved), "words": long(level.words),
        "turn_id": pa.array([None if ids is None else ids[i].tobytes() for i in range(count)], pa.binary()),
        "ends_sha256": pa.array([None if level.open[i] else sha256(ended[i].encode()).hexdigest() if i in ended else none
                                 for i in range(count)], pa.string()),
        "ends": pa.array([ended.get(i) if level.open[i] else None for i in range(count)], pa.string()),
        "first": long([int(ended[i].split(",", 1)[0]) if level.open[i] and i in ended else None for i in range(count)])})


# -- boundary nodes ---------------------------------------------------------------------

def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of every key, which come in order."""
    key, state = None, None

    def done():
        return pa.record_batch({"key": pa.array([key], pa.binary()), "ends_sha256": pa.array([state.hexdigest()])})

    for batch in batches:
        for k, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state:
                    yield done()
                key, state = k, sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
    if state:
        yield done()


def _below(nodes: DataFrame, deepest: int) -> DataFrame:
    """``key, leaves, saved``: sums of ``nodes`` (key, parent, leaves, saved) over their subtrees."""
    total = nodes.count()
    sums, step = nodes.withColumnRenamed("parent", "up"), 1
    while step <= deepest:
        given = sums.where("up is not null")
        got = given.groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        crowd = given.groupBy("up").count().where(F.col("count") >= hot_threshold(total, MAX_HOT)).select("up")
        further = lookup_join(sums, sums.select(F.col("key").alias("up"), F.col("up").alias("next")), ["up"],
                              table_rows=total, hot_keys=crowd, max_broadcast_rows=BROADCAST_ROWS)
        added = lookup_join(further, got, ["key"], table_rows=total, max_broadcast_rows=BROADCAST_ROWS)
        sums = stored(added.select(
            "key", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "trie/sums")
        step *= 2
    return sums.select("key", "leaves", "saved")


def prefix_trie(turns: DataFrame, turnless: DataFrame, *, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, at: place from 0, total: turns of
    the conversation, id: 16 bytes, words) and of the conversations ``turnless`` (conv_id).

    ``conv_id`` (least member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, turn_id`` (of the last turn).
    """
    rows = stored(_bands(turns, turnless), "trie/rows")
    count, length = rows.agg(F.count("*"), F.sum(F.size("ids"))).first()
    shards = max(1, -(-count // rows_per_shard), -(-(length or 0) // TURNS_PER_SHARD))
    dealt = rows.repartitionByRange(shards, "before", F.slice("ids", 1, HEAD), "conv_id")
    parts = stored(dealt.mapInArrow(_nodes, PARTS), "trie/parts")

    met = parts.where("not inner").groupBy("key").agg(
        F.first("parent", ignorenulls=True).alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"), F.max("turn_id").alias("turn_id"))
    children = met.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("more"))
    own = met.join(children, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    boundary = stored(own.select(
        "key", "parent", "depth", "conv_id", "n_convs", "n_children", "turn_id",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie/boundary")
    size, deepest, most = boundary.agg(F.count("*"), F.max("depth"), F.sum("n_children")).first()
    sums = _below(boundary.select("key", "parent", "leaves", "saved"), deepest or 0)

    ended = parts.where("ends is not null").select("key", "ends", "first") \
        .repartition("key").sortWithinPartitions("key", "first").select("key", "ends").mapInArrow(_hashed, ENDS)
    none = F.lit(sha256(b"").hexdigest())
    kept = boundary.drop("leaves", "saved").join(sums, "key").join(ended, "key", "left").select(
        "parent", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "turn_id",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
    nodes = parts.where("inner").select(*kept.columns).unionAll(kept)
    named = boundary.select(F.col("key").alias("parent"), F.col("conv_id").alias("named"))
    crowd = boundary.where(F.col("n_children") >= hot_threshold(most or 0, MAX_HOT)) \
        .select(F.col("key").alias("parent"), F.col("conv_id").alias("named"))
    found = lookup_join(nodes, named, ["parent"], table_rows=size, hot_keys=crowd, max_broadcast_rows=BROADCAST_ROWS)
    return found.select("conv_id", "depth", F.coalesce("parent_conv_id", "named").alias("parent_conv_id"), "n_convs",
                        "n_children", "n_leaves", "saved_tokens", "ends_sha256", F.lower(F.hex("turn_id")).alias("turn_id"))


def conversation_trie(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of a table of turns, as they are."""
    placed, _ = placed_turns(conversations, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    turns = placed.select("conv_id", F.col("pos").alias("at"), F.col("n").alias("total"), "id", "words")
    return prefix_trie(turns, turns.where(F.lit(False)).select("conv_id"))
