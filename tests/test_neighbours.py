"""Neighbours above a floor against all pairs, with blocks left out, and stored vectors over loads."""

import numpy as np
from pyspark.sql import functions as F

from foliograph.operators import neighbours as nb
from foliograph.streaming.incremental import VectorStore


def clustered(seed, n=400, dim=8, centres=10):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    v = c[rng.integers(0, centres, n)] + 0.05 * rng.normal(size=(n, dim))
    return v / np.linalg.norm(v, axis=1)[:, None]


def frame(spark, v):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id long, vec array<double>")


def test_exact_with_blocks_left_out(spark):
    v = clustered(1)
    df = frame(spark, v)
    cells = nb.celled(df, size=32)
    assert cells.agg(F.sum(F.size("ids"))).first()[0] == len(v) and cells.agg(F.max(F.size("ids"))).first()[0] <= 64
    n = cells.count()
    cos = np.round(v @ v.T, 9)
    for floor, k in ((0.9, 7), (0.999, 30), (-1.0, 5)):
        met = nb.blocks_that_may_meet(cells, cells, floor).count()
        assert met < 0.6 * n * n if floor > 0 else met == n * n
        got: dict = {}
        for r in nb.similar_above(cells, cells, floor, k, True).collect():
            got.setdefault(r.source, {})[r["rank"]] = r.target
        for i in range(len(v)):
            want = sorted((j for j in range(len(v)) if j != i and cos[i, j] >= floor), key=lambda j: (-cos[i, j], j))[:k]
            assert [got.get(i, {}).get(x + 1) for x in range(len(want))] == want and len(got.get(i, {})) == len(want)


def test_floor_and_kinds(spark):
    v = clustered(2, 200)
    df = frame(spark, v).withColumn("kind", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    floor = nb.score_floor(df.where("kind = 'a'"), df.where("kind = 'b'"), 90, n=20_000)
    cos = v[::2] @ v[1::2].T
    assert abs((cos < floor).mean() - 0.9) < 0.03
    out = nb.similar_by_kind(df, "kind", ["a", "b"], percentile=90, k=3, size=32).collect()
    assert {(r.source_kind, r.target_kind) for r in out} == {(x, y) for x in "ab" for y in "ab"}
    assert all(r.source != r.target and r["rank"] <= 3 for r in out)
    assert nb.score_floor(df.where("id < 0"), df, 95) == -1.0


def test_store_over_loads(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "vectors"))
    asked = []

    def embed(df):
        asked.append(sorted(r.hash for r in df.select("hash").collect()))
        return df.select("hash", F.array(F.length("text").cast("double"), F.lit(float(len(asked)))).alias("vec"))

    def texts(*rows):
        return spark.createDataFrame(list(rows), "hash string, text string")

    first = texts(("a", "x"), ("b", "xx"), ("b", "xx"), (None, "no"))
    got = {r.hash: r.vec for r in store.refresh("2026-01", first, embed).collect()}
    assert got == {"a": [1.0, 1.0], "b": [2.0, 1.0]} and asked == [["a", "b"]]
    second = texts(("b", "xx"), ("c", "xxx"), ("d", "xxxx"))
    brought = spark.createDataFrame([("d", [9.0, 9.0]), ("b", [8.0, 8.0])], "hash string, vec array<double>")
    for _ in range(2):  # the same load again asks for the same and adds nothing
        got = {r.hash: r.vec[0] for r in store.refresh("2026-02", second, embed, brought).collect()}
        assert got == {"b": 8.0, "c": 3.0, "d": 9.0} and asked[-1] == ["c"]
    assert store.vectors().count() == 4 and store.vectors("2026-02").count() == 2
    got = {r.hash: r.vec[0] for r in store.refresh("2026-03", texts(("a", "x"), ("e", "")), embed).collect()}
    assert got == {"a": 1.0, "e": 0.0} and asked[-1] == ["e"]
    small = store.compact("2026-04", second, str(tmp_path / "compact"))
    assert {r.hash for r in small.vectors().collect()} == {"b", "c", "d"}
    assert VectorStore(spark, str(tmp_path / "none")).vectors().count() == 0
