"""Vectors of op9 travel as few bytes in few groups, and a task reads one pair of groups at a time."""

import random

from pyspark.sql import functions as F

from foliograph.llm import topk


def _rows(spark, n, dim, far):
    rng = random.Random(n)
    rows = [(i, [rng.randint(-far, far) for _ in range(dim)], dim) for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, items array<long>, dim int").withColumn("cutoff", F.lit(None).cast("long"))


def test_bytes_of_groups(spark):
    """A vector takes its dimension in bytes and two numbers, and is in one group of WIDE blocks."""
    groups = topk.packed(_rows(spark, 4096, 64, 100), 64).cache()
    size = groups.select(F.sum(F.length("ids") + F.length("items") + F.length("cutoffs"))).first()[0]
    assert size == 4096 * (64 + 16)
    assert groups.select("block").distinct().count() == 4096 // (64 * topk.WIDE)
    assert {r.width for r in topk.packed(_rows(spark, 64, 4, 1 << 40), 64).collect()} == {8}


def test_one_pair_at_a_time(spark):
    """Every vector of a pair of groups is met in strips of no more scores than two blocks have."""
    queries, vectors = (topk.packed(_rows(spark, 1024, 8, 50), 32) for _ in range(2))

    def work(meeting, cutoffs):
        n = len(meeting.q) * len(meeting.v)
        return [([n], [len(cutoffs)])]

    sizes = topk.meetings(queries, vectors, work, "scores long, asked long", 32, 2).collect()
    assert sum(r.scores for r in sizes) == 1024 * 1024
    assert max(r.scores for r in sizes) <= 32 * 32 or max(r.asked for r in sizes) == 1
