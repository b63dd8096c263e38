"""Keys with few intervals are joined without copies to bins; keys with many are cut into bins, and both together lose nothing."""

import random

import pytest

from foliograph.operators import timelines as tl


@pytest.mark.parametrize("plain", [0, 3, 256])
def test_few_and_many_intervals(spark, monkeypatch, plain):
    monkeypatch.setattr(tl, "PLAIN", plain)
    rng = random.Random(plain)
    some = lambda n: [(k, rng.choice([None, rng.randint(-20, 20)]), rng.choice([None, rng.randint(-20, 40)])) for k, m in n for _ in range(m)]
    left = [(i, *r) for i, r in enumerate(some([(1, 12), (2, 30), (3, 1), (None, 2)]))]
    right = [(i, *r) for i, r in enumerate(some([(1, 3), (2, 25), (4, 2), (None, 2)]))]
    binned = []
    real = tl._met_in_bins
    monkeypatch.setattr(tl, "_met_in_bins", lambda x, y, on: binned.append({r[0] for r in x.select("k").collect()}) or real(x, y, on))
    x = spark.createDataFrame(left, "i long, k long, a int, b int")
    y = spark.createDataFrame(right, "j long, k long, c int, d int")
    got = sorted((r.i, r.j) for r in tl.interval_join(x, y, ["k"], ("a", "b"), ("c", "d")).collect())
    low, high = (lambda v: -99 if v is None else v), (lambda v: 99 if v is None else v)
    want = sorted((i, j) for i, k, a, b in left for j, m, c, d in right if k == m and k is not None
                  and low(a) <= high(b) and low(c) <= high(d) and low(a) <= high(d) and low(c) <= high(b))
    assert got == want
    assert binned == {0: [{1, 2}], 3: [{2}], 256: []}[plain]
