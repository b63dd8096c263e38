"""Exact top-k search against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from foliograph.llm import topk


def brute(rows, ask, k):
    kept = {}
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, a in usable:
        if ask(q):
            found = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a)]
            kept[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return {q: v for q, v in kept.items() if v}


@pytest.mark.parametrize(("k", "slices", "block"), [(5, 2, 16), (20, 3, 64), (500, 2, 1024)])
def test_top_k(spark, k, slices, block):
    rng = random.Random(k)
    rows = [(i, [float(F32(rng.gauss(0, 0.3))) for _ in range(8)]) for i in range(150)]
    rows += [(i, rows[20][1]) for i in range(150, 190)]  # ties
    rows += [(190, None), (191, [1.0, None] * 4), (192, [float("nan")] * 8), (193, [float("inf")] * 8), (None, rows[0][1]),
             (200, [1.0, 2.0]), (201, [3.0, -2.0]), (220, [0.5]), (240, []), (-20, [-9.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'own' AS items", "1 AS dim", "2 AS block")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k, slices, block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute(rows, lambda i: i % 20 == 0, k)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def F32(x):
    import numpy as np

    return np.float32(x)


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [1.0, 1.0]), (1, [2.0, 1.0]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") == 0, 3).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got)] == [(1, 1, 32 * 128), (2, 1, 32 * 64), (3, 2, 0)]
