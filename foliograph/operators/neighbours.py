"""Similar rows above a floor: blocks of near vectors meet only where their centres and radii allow a score above it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.operators.vectors import (
    BLOCK, DIGITS, NULL_PAIRS, STRIP, WIDE, _by_id, _met, _packed, _scores, _strongest, hash_order, null_pairs, top_k,
)
from foliograph.plans.session import cut_lineage
from foliograph.plans.shapes import top_n

SLACK = 1e-6  # what rounding may add to an angle


def score_floor(a: DataFrame, b: DataFrame, percentile: float, n: int = NULL_PAIRS, seed: int = 42, key: str = "id", vec: str = "vec") -> float:
    """The score that ``percentile`` percent of about ``n`` random pairs of the two sides stay below; -1 without a pair."""
    scores = null_pairs(a, b, n, seed, key, vec)
    found = scores.agg(F.percentile(F.round("score", 4), percentile / 100)).first()[0]
    return -1.0 if found is None else float(found)


def celled(df: DataFrame, key: str = "id", vec: str = "vec", size: int = BLOCK, seed: int = 42) -> DataFrame:
    """``(block, ids, flat, centre, radius)``: rows packed with the rows near them.

    One row in ``size`` is a pivot, in hash order, and each row goes to the nearest pivot's cell; a cell of more than ``size`` rows is
    cut by a hash. A block's centre is the direction of its mean, its radius the largest angle between centre and row. Vectors
    are expected normalised.
    """
    rows = cut_lineage(df.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL"))
    n = rows.count()
    pivots = rows.orderBy(hash_order("id", seed), "id").limit(max(1, -(-n // size)))
    cells = top_k(rows, pivots, 1).select(F.col("source").alias("id"), F.col("target").alias("cell"))
    placed = cut_lineage(rows.join(cells, "id"))
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    dealt = placed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    packed = dealt.groupBy("cell", "part").agg(F.collect_list(F.struct("id", "vec")).alias("rows"))
    kind = rows.schema["id"].dataType

    def centred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                v = np.array([np.asarray(r["vec"], dtype=np.float64) for r in row.rows])
                mean = v.sum(axis=0)
                length = np.linalg.norm(mean)
                centre = mean / length if length > 0 else v[0]
                least = np.clip((v @ centre).min(), -1.0, 1.0)
                out.append((row.block, [r["id"] for r in row.rows], v.ravel().tolist(), centre.tolist(), float(np.arccos(least))))
            yield pd.DataFrame(out, columns=["block", "ids", "flat", "centre", "radius"])

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("flat", T.ArrayType(T.DoubleType())),
        T.StructField("centre", T.ArrayType(T.DoubleType())), T.StructField("radius", T.DoubleType())])
    return cut_lineage(packed.select(F.monotonically_increasing_id().alias("block"), "rows").mapInPandas(centred, schema))


def blocks_that_may_meet(x: DataFrame, y: DataFrame, floor: float) -> DataFrame:
    """``(bx, by)``: blocks of the two sides that may hold a pair with a score of ``floor``.

    No pair of two blocks is closer than their centres' angle less both radii.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                angle = np.arccos(np.clip(_scores(row), -1.0, 1.0))
                closest = angle - np.asarray(row.radius_x)[:, None] - np.asarray(row.radius_y)[None, :] - SLACK
                at, to = np.nonzero(np.cos(np.clip(closest, 0.0, np.pi)) >= floor - 10.0 ** -DIGITS)
                yield pd.DataFrame({"bx": np.asarray(row.ids_x)[at], "by": np.asarray(row.ids_y)[to]})

    met = _met(_packed(x, "block", "centre", "x", ["radius"]), _packed(y, "block", "centre", "y", ["radius"]), x, y)
    return met.drop("x", "y").mapInPandas(run, "bx long, by long")


def _gathered(df: DataFrame, side: str) -> tuple[DataFrame, Column]:
    """Blocks gathered into groups of about ``WIDE`` rows, and the group of a block's number."""
    groups = F.greatest(F.ceil(df.agg(F.sum(F.size("ids"))).scalar() / WIDE), F.lit(1))
    group = lambda block: F.pmod(F.xxhash64(block), groups)
    rows = df.groupBy(group("block").alias("g" + side)).agg(F.collect_list(F.struct("block", "ids", "flat")).alias("all"))
    packed = rows.select(
        "g" + side, F.col("all")["block"].alias("blocks_" + side), F.transform(F.col("all")["ids"], F.size).alias("sizes_" + side),
        F.flatten(F.col("all")["ids"]).alias("ids_" + side), F.flatten(F.col("all")["flat"]).alias("flat_" + side))
    return packed, group("b" + side)


def _above(floor: float, k: int, exclude_self: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids_x, ids_y = np.asarray(row.ids_x), np.asarray(row.ids_y)
                x = np.asarray(row.flat_x, dtype=np.float64).reshape(len(ids_x), -1)
                order = _by_id(ids_y)
                of_y = np.repeat(np.arange(len(row.sizes_y)), row.sizes_y)[order]
                ids_y, y = ids_y[order], np.asarray(row.flat_y, dtype=np.float64).reshape(len(ids_y), -1)[order]
                own = int(pd.Series(ids_y).value_counts().max()) if exclude_self else 0
                meets = np.zeros((len(row.blocks_x), len(row.blocks_y)), dtype=bool)
                meets[pd.Index(row.blocks_x).get_indexer(row.of_x), pd.Index(row.blocks_y).get_indexer(row.of_y)] = True
                ends = np.cumsum(row.sizes_x)
                for block in range(len(ends)):
                    if not meets[block].any():
                        continue
                    part = slice(None) if meets[block].all() else np.flatnonzero(meets[block][of_y])
                    ids, near = ids_y[part], y[part]
                    for i in range(ends[block] - row.sizes_x[block], ends[block], STRIP):
                        last = min(i + STRIP, ends[block])
                        at, to, score = _strongest(x[i:last] @ near.T, k + own, floor)
                        found = pd.DataFrame({"source": ids_x[i + at], "target": ids[to], "score": score})
                        if exclude_self:
                            found = found[found["source"] != found["target"]].groupby("source", sort=False).head(k)
                        yield found
    return run


def similar_above(x: DataFrame, y: DataFrame, floor: float, k: int = 30, exclude_self: bool = False, digits: int = 4) -> DataFrame:
    """``(source, target, cos, rank)``: for each row of ``x`` the ``k`` best rows of ``y`` with a score of at least ``floor``.

    ``x`` and ``y`` come from :func:`celled`. Exact: a pair of blocks is left out only if none of its scores can reach the floor. Blocks
    travel in groups, two groups only if some of their blocks may meet, so a vector is copied once per group and not once per
    block. A row without a partner above the floor has no row; ties go to the smaller target.
    """
    wide_x, of_x = _gathered(x, "x")
    wide_y, of_y = _gathered(y, "y")
    pairs = blocks_that_may_meet(x, y, floor).groupBy(of_x.alias("gx"), of_y.alias("gy")).agg(
        F.collect_list(F.struct("bx", "by")).alias("pairs"))
    pairs = pairs.select("gx", "gy", F.col("pairs")["bx"].alias("of_x"), F.col("pairs")["by"].alias("of_y"))
    met = pairs.join(wide_x, "gx").join(wide_y, "gy").drop("gx", "gy")
    schema = T.StructType([T.StructField("source", x.schema["ids"].dataType.elementType), T.StructField("target", y.schema["ids"].dataType.elementType),
                           T.StructField("score", T.DoubleType())])
    found = met.mapInPandas(_above(floor, k, exclude_self), schema)
    best = top_n(found, ["source"], [F.col("score").desc(), F.col("target")], k, out="rank")
    return best.select("source", "target", F.round("score", digits).alias("cos"), "rank")


def similar_by_kind(vecs: DataFrame, kind: str, kinds: Sequence[str], floor: float | None = None, percentile: float = 95.0, k: int = 30,
                    key: str = "id", vec: str = "vec", size: int = BLOCK) -> DataFrame:
    """:func:`similar_above` for every ordered pair of kinds, with ``source_kind`` and ``target_kind``; a row is not its own neighbour.

    Without a stated ``floor`` each pair of kinds has that of its random pairs at ``percentile``. Every kind is packed once.
    """
    rows = {x: vecs.where(F.col(kind) == x) for x in kinds}
    packs = {x: celled(df, key, vec, size) for x, df in rows.items()}
    out = []
    for a in kinds:
        for b in kinds:
            least = score_floor(rows[a], rows[b], percentile, key=key, vec=vec) if floor is None else floor
            found = similar_above(packs[a], packs[b], least, k, a == b)
            out.append(found.select("*", F.lit(a).alias("source_kind"), F.lit(b).alias("target_kind")))
    return reduce(DataFrame.unionByName, out)
