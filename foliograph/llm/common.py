"""What the operators of this subpackage share: stored intermediate tables, state of a Python worker, row batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.plans.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: lineage ends here, and lost executors cost nothing.

    Unlike a checkpoint the table that is read back has no known partitioning, so a join with it shuffles both sides and
    Spark can split the partitions of a hot key.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_state(key, make):
    """What ``make()`` returned when this Python worker last asked for ``key``; asking for another key drops it.

    Functions travel to workers by value, so module globals last one task; this lasts as long as the worker.
    """
    import sys
    import types

    held = sys.modules.setdefault("_foliograph_worker", types.ModuleType("_foliograph_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def forget_worker_state() -> None:
    """Drops what this worker keeps for another operator, before work that needs memory of its own."""
    import sys

    module = sys.modules.get("_foliograph_worker")
    if module is not None:
        module.__dict__.get("held", {}).clear()


class Kept:
    """Values by their keys, at most about ``most`` bytes with both; when half of that is new, those not asked since go."""

    def __init__(self, most: int):
        self.most, self.size, self.new, self.old = most, 0, {}, {}

    def add(self, key, value) -> None:
        from sys import getsizeof

        self.new[key] = value
        self.size += getsizeof(key) + getsizeof(value) + 100
        if isinstance(value, tuple):
            self.size += sum(map(getsizeof, value))

    def missing(self, keys: set) -> set:
        """Those of the keys without a value; all others are in ``new`` from now on."""
        if 2 * self.size > self.most:
            self.old, self.new, self.size = self.new, {}, 0
        absent = keys.difference(self.new)
        for key in absent.intersection(self.old):
            self.add(key, self.old[key])
        return absent.difference(self.new)


def slices(batch: pa.RecordBatch, column: int = 1, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes in one column, each of a row at least."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
