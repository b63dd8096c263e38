"""Operator 9: exact top-k inner products with a three-phase uniform threshold.

The dimensions are cut into m slices; a vector's score is the sum of its slice scores, each a local list. Vectors travel in
groups of blocks, packed as bytes; every group of queries meets every group of vectors once a pass, and a task has the scores of
as many pairs at once as two blocks have.

1. Each meeting takes the k best vectors of each local list and adds up their slices. The k-th best of these sums over all
   meetings is a cutoff that no result of the query lies below.
2. The cutoff goes to every meeting of the query. A vector whose score reaches it has a slice score of at least cutoff / m,
   so only entries of some local list from there on are collected.
3. The remaining slices of these entries are resolved, what falls below the cutoff goes, and the k best are ranked by score
   and then by the smaller id.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows with a null id;
vectors meet vectors of their own dimension only; a query with fewer than k candidates gets them all; equal scores rank by
the smaller id; rows that repeat an id are candidates each, ask once, with the least of their vectors, and never meet rows
of their own id; an empty table gives no rows; other columns are not read. Scores are exact while they fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import stored

BLOCK = 1024  # vectors of each side whose scores are formed at once
WIDE = 16  # blocks that travel together; a vector is copied once per group of blocks of the other side
LEAST_GROUPS = 4  # groups of a side that has as many blocks, so that a small product is shared by tasks
LOWEST = -(1 << 63)  # the cutoff of a query without one


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null if the vector is null or holds a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def groups_of(vectors: DataFrame, block: int) -> DataFrame:
    """``vectors`` with their group among the ``n`` of their dimension: ``WIDE`` blocks, dealt by a hash of the id."""
    count = vectors.groupBy("dim").agg(F.count("*").alias("rows"))
    blocks = F.ceil(F.col("rows") / block)
    share = F.greatest(F.lit(1), F.ceil(blocks / WIDE), F.least(F.lit(LEAST_GROUPS), blocks)).cast("long")
    return vectors.join(count.select("dim", share.alias("n")), "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n")))


def _bytes(values) -> bytes:
    return values.astype(values.dtype.newbyteorder("<"), copy=False).tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch as one row a group, with whole numbers in as few bytes as the largest of them takes."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        dims, numbers, blocks, ids, cutoffs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "n", "block", "vec_id", "cutoff"))
        items = batch.column("items")
        order = np.lexsort((blocks, dims))
        edges = np.flatnonzero(np.diff(dims[order], prepend=-1) | np.diff(blocks[order], prepend=-1))
        rows = []
        for start, end in zip(edges, [*edges[1:], len(order)], strict=True):
            at = order[start:end]
            flat = items.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            span = (int(flat.min(initial=0)), int(flat.max(initial=0)))
            kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= span[0] and span[1] <= np.iinfo(k).max)
            rows.append((int(dims[at[0]]), int(numbers[at[0]]), int(blocks[at[0]]), np.dtype(kind).itemsize, _bytes(ids[at]), _bytes(flat.astype(kind)), _bytes(cutoffs[at])))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["dim", "n", "block", "width", "ids", "items", "cutoffs"])


def packed(rows: DataFrame, block: int) -> DataFrame:
    """``rows(vec_id, items, dim, cutoff)`` in groups, each group some rows of many vectors."""
    dealt = groups_of(rows, block).select("dim", "n", "block", "vec_id", "items", F.coalesce("cutoff", F.lit(LOWEST)).alias("cutoff"))
    # dealt by group first, so that a group is a few rows and not one of every batch
    return dealt.repartition("dim", "block").mapInArrow(_pack, "dim int, n long, block long, width int, ids binary, items binary, cutoffs binary")


def _unpacked(side: pa.Table, dim: int):
    """Ids, vectors and cutoffs of a group."""
    import numpy as np

    ids = [np.frombuffer(x, "<i8") for x in side.column("ids").to_pylist()]
    items = [np.frombuffer(x, f"<i{w}").reshape(len(i), dim) for x, w, i in zip(side.column("items").to_pylist(), side.column("width").to_pylist(), ids, strict=True)]
    cutoffs = [np.frombuffer(x, "<i8") for x in side.column("cutoffs").to_pylist()]
    return np.concatenate(ids), np.concatenate(items).astype(np.int64), np.concatenate(cutoffs)


def meetings(queries: DataFrame, vectors: DataFrame, work, schema: str, block: int, slices: int) -> DataFrame:
    """What ``work`` makes of every group of queries and every group of vectors of the same dimension, block by block.

    Each pair of groups has its own key and is read by itself, so a task holds one pair at a time, however many it works through.
    """
    def every(side: DataFrame, own: str, across: str, other: DataFrame) -> DataFrame:
        numbers = other.groupBy("dim").agg(F.max("n").alias("other"))
        return side.join(numbers, "dim").select(
            "dim", F.col("block").alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.col("other") - 1)).alias(across), "width", "ids", "items", "cutoffs")

    def met(key, left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        names = [x.split()[0] for x in schema.split(", ")]
        empty = pa.table([pa.array([], pa.int64()) for _ in names], names=names)
        if not (left.num_rows and right.num_rows):
            return empty
        dim = key[0].as_py()
        (q, a, cutoffs), (v, b, _) = _unpacked(left, dim), _unpacked(right, dim)
        order = np.argsort(v, kind="stable")
        v, b = v[order], b[order]
        found = []
        strip = max(1, block * block // len(v))  # the scores formed at once are those of two blocks
        for i in range(0, len(q), strip):
            found += work(Meeting(q[i:i + strip], a[i:i + strip], v, b, slices), cutoffs[i:i + strip])
        return pa.concat_tables([pa.table([pa.array(c, pa.int64()) for c in f], names=names) for f in found]) if found else empty

    keys = ("dim", "q", "v")
    # few bytes that take long: a fixed number of partitions, as AQE would put them into one task
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked, listed = every(queries, "q", "v", vectors).repartition(parts, *keys), every(vectors, "v", "q", queries).repartition(parts, *keys)
    return asked.groupBy(*keys).cogroup(listed.groupBy(*keys)).applyInArrow(met, schema)


class Meeting:
    """Local score lists of some queries on a group of vectors, whose ids rise."""

    def __init__(self, q, a, v, b, slices: int):
        import numpy as np

        self.q, self.v, dim = q, v, a.shape[1]
        # whole numbers below 2^53 are exact in floating point, whose products are faster
        top = [float(np.abs(x).max(initial=0)) for x in (a, b)]
        if top[0] * top[1] * max(1, dim) < 2.0**53:
            a, b = a.astype(np.float64), b.astype(np.float64)
        edges = [dim * i // slices for i in range(slices + 1)]
        self.local = [(a[:, s:e] @ b[:, s:e].T).astype(np.int64) for s, e in zip(edges, edges[1:], strict=False)]
        self.own = self.q[:, None] == self.v[None, :]

    def cutoff_sums(self, k: int):
        """Queries and, for each, the k best sums of vectors that lead some local list."""
        import numpy as np

        n, total = len(self.v), sum(self.local)
        picked = np.zeros(total.shape, bool)
        for x in self.local:
            x = np.where(self.own, LOWEST, x)
            at = np.argpartition(x, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), total.shape)
            np.put_along_axis(picked, at, True, axis=1)
        picked &= ~self.own
        at, to = np.nonzero(picked)
        score = total[at, to]
        order = np.lexsort((-score, at))
        at, score = at[order], score[order]
        first = np.arange(len(at)) - np.searchsorted(at, at) < k
        return self.q[at[first]], score[first]

    def resolved(self, cutoffs, k: int):
        """Query, id and score of the k best vectors that reach the query's cutoff (``LOWEST``: every vector)."""
        import numpy as np

        m = len(self.local)
        # a cutoff over the slices, rounded up; the lowest one stays, as every vector counts
        share = np.where(cutoffs == LOWEST, LOWEST, -(-np.where(cutoffs == LOWEST, 0, cutoffs) // m))[:, None]
        entry = np.zeros(self.own.shape, bool)
        for x in self.local:
            entry |= x >= share
        entry &= ~self.own
        at, to = np.nonzero(entry)
        score = sum(x[at, to] for x in self.local)
        kept = score >= cutoffs[at]
        at, to, score = at[kept], to[kept], score[kept]
        order = np.lexsort((to, -score, at))  # ids rise, so equal scores keep the smaller id first
        at, to, score = at[order], to[order], score[order]
        first = np.arange(len(at)) - np.searchsorted(at, at) < k
        return self.q[at[first]], self.v[to[first]], score[first]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, slices: int = 2, block: int = BLOCK, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query row; ``is_query`` is a condition on vec_id."""
    items = quantised(F.col(vector_col))
    usable = stored(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), items.alias("items"))
        .where("vec_id IS NOT NULL AND items IS NOT NULL").withColumn("dim", F.size("items")), "vectors")
    no_cutoff = F.lit(None).cast("long").alias("cutoff")
    all_groups = stored(packed(usable.select("*", no_cutoff), block), "vector-groups")
    one_each = usable.where(is_query).groupBy("vec_id").agg(F.min("items").alias("items")).withColumn("dim", F.size("items"))
    asked = stored(packed(one_each.select("*", no_cutoff), block), "query-groups")

    sums = meetings(asked, all_groups, lambda m, _: [m.cutoff_sums(k)], "query_id long, sum long", block, slices)
    place = F.row_number().over(_by("query_id", F.desc("sum")))
    cutoffs = sums.withColumn("place", place).where(F.col("place") == k).select(F.col("query_id").alias("vec_id"), F.col("sum").alias("cutoff"))
    with_cutoff = stored(packed(one_each.join(cutoffs, "vec_id", "left"), block), "query-cutoffs")

    entries = meetings(with_cutoff, all_groups, lambda m, cutoffs: [m.resolved(cutoffs, k)], "query_id long, vec_id long, score long", block, slices)
    ranked = entries.withColumn("rank", F.row_number().over(_by("query_id", F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _by(key: str, *order):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)
