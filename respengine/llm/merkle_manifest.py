"""Merkle manifest of a dataset: checkpoint and recompute.

Every row is a leaf; the leaves of a group, in order of their ids, are the bottom of a
binary tree, and the group roots, in order of the groups, are the leaves of the top tree.
A node is the hash of its two children (of its only child at the end of a level).

1. Places. Leaves get their place in their group by range partitioning (``ranks``), so a
   group of any size is spread over partitions.
2. Checkpoints. Nodes are stored only every ``every`` levels: a group of one task is an
   aligned block of at most ``2 ** every`` nodes, and only what it collapses to is kept.
   A tree of n leaves stores about n / 2 ** every nodes.
3. Proofs, from the top down. The proof of a stored node meets the stored nodes below it;
   their block's missing interior nodes are made again, each node is given the siblings
   on its way through the block, and the interior is discarded. Only leaves keep proofs.

A proof is the hex siblings from the bottom up, and one letter for every level: ``L`` or
``R`` for the side the sibling is on, ``-`` where the node is alone.

Defined results: a null in any column is ``-`` in the leaf; null ids come first, null
groups are a group of their own and come first; equal ids are ordered by their leaves, and
equal rows take the places next to each other (their proofs differ by place); a text of
any length is one value of one row; an empty table has no root (null) and no proofs;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respengine.llm.common import stored
from respengine.llm.ranks import ranked

EVERY = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, pos long, n long, hash string"
PATH = ("tree", "pos", "leaf", "siblings", "sides", "subroot")


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """The leaf of a row with these values."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _levels(hashes: list[bytes], levels: int) -> list[list[bytes]]:
    """An aligned block's nodes, level by level, as long as there are two or more of the
    tree (``levels`` at most)."""
    out = [hashes]
    for _ in range(levels):
        low = out[-1]
        out.append([sha256(b"".join(low[i:i + 2])).hexdigest().encode() for i in range(0, len(low), 2)])
    return out


def _height(n: int) -> int:
    """Levels above ``n`` nodes."""
    return (n - 1).bit_length()


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def _collapse(table: pa.Table, every: int) -> pa.Table:
    table = _ordered(table)
    n, first = table.column("n")[0].as_py(), table.column("pos")[0].as_py()
    steps = min(every, _height(n))
    top = _levels([h.encode() for h in table.column("hash").to_pylist()], steps)[-1][0]
    return pa.table({"tree": table.column("tree").slice(0, 1), "pos": pa.array([first >> every], pa.int64()),
                     "n": pa.array([-(-n >> steps)], pa.int64()), "hash": pa.array([top.decode()])})


def _expand(nodes: pa.Table, paths: pa.Table, every: int, carry: list[str]) -> pa.Table:
    """The proofs of a block's nodes, from that of the node above it."""
    nodes = _ordered(nodes)
    hashes = [h.encode() for h in nodes.column("hash").to_pylist()]  # none: the node above is a leaf
    steps = min(every, _height(nodes.column("n")[0].as_py())) if hashes else 0
    levels = _levels(hashes, steps)
    above, sides_above, subroot = (paths.column(c)[0].as_py() for c in ("siblings", "sides", "subroot"))
    siblings, sides = [], []
    for i in range(len(hashes)):
        got, side = [], []
        for k in range(steps):
            node = i >> k
            if node ^ 1 < len(levels[k]):
                got.append(levels[k][node ^ 1])
                side.append("L" if node & 1 else "R")
            else:
                side.append("-")
        siblings.append(b"".join(got).decode() + above)
        sides.append("".join(side) + sides_above)
    return pa.table({"tree": nodes.column("tree"), "pos": nodes.column("pos"), "leaf": nodes.column("hash"),
                     "siblings": pa.array(siblings, pa.string()), "sides": pa.array(sides, pa.string()),
                     "subroot": pa.array([subroot] * len(hashes), pa.string()),
                     **{c: nodes.column(c) for c in carry}})


@dataclass
class Forest:
    """Trees over ranked leaves: the stored levels (``NODE``; the first holds the leaves and
    what they carry), and ``tree, n`` of all trees."""

    levels: list[DataFrame]
    trees: DataFrame
    every: int
    carry: list[str]

    def roots(self) -> DataFrame:
        """``tree, level, hash``: the root of every tree, at the first stored level that has it."""
        every = [df.where("n = 1").select("tree", F.lit(j).alias("level"), "hash")
                 for j, df in enumerate(self.levels)]
        out = every[0]
        for df in every[1:]:
            out = out.unionAll(df)
        return out


def _block(every: int) -> Column:
    return F.shiftright("pos", every).alias("block")


def forest(leaves: DataFrame, order: list[str], *, every: int, carry: list[str], label: str) -> Forest:
    """Trees over ``leaves`` (a stored table of tree, hash, ``order`` and ``carry``)."""
    placed, trees = ranked(leaves, "tree", order, label=label)
    levels = [stored(placed.select("tree", "pos", "n", "hash", *carry), label)]
    most = trees.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = levels[-1].where("n > 1").select("tree", "pos", "n", "hash").groupBy("tree", _block(every))
        levels.append(stored(blocks.applyInArrow(lambda t: _collapse(t, every), NODE), label))
        most = -(-most >> min(every, _height(most)))
    return Forest(levels, trees, every, carry)


def paths(trees: Forest, above: DataFrame) -> DataFrame:
    """The proof of every leaf, and what leaves carry. ``above``: for every tree, the proof
    of its root (tree, siblings, sides, subroot)."""
    known = None
    for j in range(len(trees.levels) - 1, -1, -1):
        carry = trees.carry if j == 0 else []
        level = trees.levels[j]
        at_root = level.where("n = 1").join(above, "tree") \
            .withColumnRenamed("hash", "leaf").select(*PATH, *carry)
        if known is None:
            known = at_root
            continue
        below = level.where("n > 1").groupBy("tree", _block(trees.every)).cogroup(
            known.groupBy("tree", F.col("pos").alias("block")))
        known = below.applyInArrow(partial(_expand, every=trees.every, carry=carry), at_root.schema) \
            .unionAll(at_root)
    return known


@dataclass
class Manifest:
    """``root``: hex, null for an empty dataset. ``files``: the forest of the rows.
    ``top``: the tree over the group roots."""

    root: str | None
    files: Forest
    top: Forest

    def subroots(self) -> DataFrame:
        """``tree, hash`` of every group (``tree``: empty for the null group, else ``=`` and the group)."""
        return self.files.roots().select("tree", "hash")

    def proofs(self) -> DataFrame:
        """Of every row: ``tree, pos`` (its place), ``leaf, siblings, sides, subroot``, ``doc_id``
        and what it carries."""
        none = self.top.trees.select("tree", *[F.lit("").alias(c) for c in ("siblings", "sides", "subroot")])
        above = paths(self.top, none).select("group", "siblings", "sides", F.col("leaf").alias("subroot"))
        return paths(self.files, above.withColumnRenamed("group", "tree"))


def manifest(docs: DataFrame, *, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id",
             group_col: str = "lang", every: int = EVERY, **carry: Column) -> Manifest:
    """The Merkle manifest of ``docs``.

    ``carry``: narrow columns that stay with a leaf up to its proof (names other than those
    of ``PATH``).
    """
    if every < 1:
        raise ValueError("every must be at least 1")
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    rows = docs.select(group.alias("tree"), F.col(id_col).alias("id"), leaf_hash(*[F.col(c) for c in columns]).alias("hash"),
                       *[c.alias(name) for name, c in carry.items()])
    rows = stored(rows.withColumn("doc_id", F.col("id")), "merkle/leaves")
    files = forest(rows, ["id", "hash"], every=every, carry=["doc_id", *carry], label="merkle/nodes")
    subroots = files.roots().select(F.lit("top").alias("tree"), F.col("tree").alias("group"), "hash")
    top = forest(stored(subroots, "merkle/subroots"), ["group"], every=every, carry=["group"], label="merkle/top")
    root = top.roots().first()
    return Manifest(root["hash"] if root else None, files, top)


def folded(leaf: str | None, siblings: str, sides: str) -> str | None:
    """The root that a leaf and a proof give."""
    if leaf is None:
        return None
    node, at, raw = leaf.encode(), 0, siblings.encode()
    for side in sides:
        if side == "-":
            node = sha256(node).hexdigest().encode()
            continue
        other = raw[at:at + 64]
        at += 64
        node = sha256(other + node if side == "L" else node + other).hexdigest().encode()
    return node.decode()


def fold(leaf: Column, siblings: Column, sides: Column) -> Column:
    """``folded`` over columns, in Arrow batches."""
    def run(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in parts:
            yield pa.array(map(folded, *[c.to_pylist() for c in columns]), pa.string())
    return F.arrow_udf(run, "string")(leaf, siblings, sides)
