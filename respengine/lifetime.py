"""What a workflow leaves behind, and its removal.

Workflows store tables in the checkpoint folder, cache frames and broadcast lookup tables.
Inside a ``Lifetime`` each of these is noted as it is made, and freed when the block ends,
also by an error:

    with Lifetime(spark):
        rows = ohe_report(run_ohe(splits)).collect()

A frame that was built inside and is used after the block has lost its tables: collect or
write it first. Without a ``Lifetime`` nothing is noted and tables stay (a query that
returns a lazy frame cannot know when it has been read). Blocks may be nested; the inner
one owns what is made in it.
"""

from __future__ import annotations

from contextvars import ContextVar

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

_CURRENT: ContextVar[Lifetime | None] = ContextVar("respengine_lifetime", default=None)


class Lifetime:
    """Owner of stored tables, cached frames and broadcasts."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[str] = []
        self.frames: list[DataFrame] = []
        self.broadcasts: list[Broadcast] = []
        self._tokens = []

    def __enter__(self) -> Lifetime:
        self._tokens.append(_CURRENT.set(self))
        return self

    def __exit__(self, *failure) -> None:
        _CURRENT.reset(self._tokens.pop())
        self.free()

    def free(self) -> None:
        """Free everything noted so far; what cannot be freed does not keep the rest."""
        errors = []
        steps = [*[(f.unpersist, ()) for f in self.frames], *[(b.destroy, ()) for b in self.broadcasts],
                 *[(delete_table, (self.spark, t)) for t in self.tables]]
        self.frames, self.broadcasts, self.tables = [], [], []
        for step, args in steps:
            try:
                step(*args)
            except Exception as e:  # noqa: BLE001 - told below, after the other steps
                errors.append(e)
        if errors:
            raise RuntimeError(f"{len(errors)} of {len(steps)} not freed") from errors[0]


def delete_table(spark: SparkSession, path: str) -> None:
    """Remove a stored table, and its parent folder once that is empty."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(place, True)
    parent = place.getParent()
    if fs.exists(parent) and not len(fs.listStatus(parent)):
        fs.delete(parent, False)


def own_table(path: str) -> str:
    """Note a stored table (a path) for the current lifetime."""
    owner = _CURRENT.get()
    if owner is not None:
        owner.tables.append(path)
    return path


def own_frame(df: DataFrame) -> DataFrame:
    """Note a cached frame for the current lifetime."""
    owner = _CURRENT.get()
    if owner is not None:
        owner.frames.append(df)
    return df


def own_broadcast(value: Broadcast) -> Broadcast:
    """Note a broadcast for the current lifetime."""
    owner = _CURRENT.get()
    if owner is not None:
        owner.broadcasts.append(value)
    return value
