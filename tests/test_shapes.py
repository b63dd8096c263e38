"""Plan shapes: large groups, global positions, lookups, graphs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from foliograph.operators import graph as g
from foliograph.plans import shapes as sh


def test_many_to_many_equals_plain_join_when_one_key_holds_a_third(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", i) for i in range(600)]
    left = spark.createDataFrame(rows, "k string, a long")
    right = left.withColumnRenamed("a", "b")
    got = sh.many_to_many(left, right, ["k"], same=True, tile=16)
    assert got.count() == left.join(right, "k").count()
    assert got.exceptAll(left.join(right, "k").select(*got.columns)).isEmpty()
    other = sh.many_to_many(left, right.where("b % 3 = 0"), ["k"], tile=16)
    assert other.exceptAll(left.join(right.where("b % 3 = 0"), "k").select(*other.columns)).isEmpty()


def test_large_groups_are_spread(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    cells = sh.big_groups(rows, ["k"], 100).collect()
    assert [(r["k"], r["_n"]) for r in cells] == [("hot", 1000)]


def test_a_hot_group_is_cut_whatever_its_share(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    assert [(r["k"], r["_n"]) for r in sh.big_groups(rows, ["k"], 4).collect()] == [("hot", 9)]
    pairs = sh.block_pairs(rows, ["k"], "id")
    assert pairs.count() == 36
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_labels_run_until_they_settle(spark):
    from foliograph.operators import graph as g

    # a chain whose label needs one round a step
    agg = spark.createDataFrame([(i, i + 1, float(100 - i), 1) for i in range(12)], "node1 long, node2 long, weight double, n_docs long")
    got = {r["node"]: r["community"] for r in g.communities(agg).collect()}
    assert len(got) == 13 and len(set(got.values())) == 1


def test_global_position(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 37 % 101).alias("v"))
    got = {r["id"]: r["position"] for r in sh.global_numbered(df, ["v", "id"]).collect()}
    want = {i: p for p, (_, i) in enumerate(sorted((i * 37 % 101, i) for i in range(1000)), 1)}
    assert got == want


def test_strict_lookup_raises(spark):
    rows = spark.createDataFrame([("a",), ("x",), (None,)], "c string")
    names = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="x"):
        sh.lookup(rows, F.col("c"), names, "k", "v", "out")
    assert sh.lookup(rows, F.col("c"), names, "k", "v", "out", strict=False).count() == 3


def test_percentile_rank_ties(spark):
    df = spark.createDataFrame([(v,) for v in (0.1, 0.2, 0.2, 0.4)], "v double")
    got = sorted(r["pct_rank"] for r in sh.pct_rank_avg(df, "v").collect())
    assert got == [0.25, 0.625, 0.625, 1.0]


@pytest.mark.parametrize("k, total, weight", [(2, None, 1.0), (3, None, 0.5), (3, 9, 1 / 8), (2, 1, 1.0)])
def test_fractional_counting(spark, k, total, weight):
    df = spark.createDataFrame([("d", i) for i in range(k)], "doc string, node int")
    known = None if total is None else spark.createDataFrame([("d", total)], "doc string, k int")
    got = g.project_pairs(df, "doc", "node", known).collect()
    assert len(got) == k * (k - 1) // 2 and all(abs(r["weight_frac"] - weight) < 1e-12 for r in got)


def test_fractional_counting_edge_cases(spark):
    alone = spark.createDataFrame([("d", 1), ("d", 1)], "doc string, node int")
    assert g.project_pairs(alone, "doc", "node").count() == 0
    two = spark.createDataFrame([("d", 1), ("d", 2)], "doc string, node int")
    unknown = spark.createDataFrame([("e", 3)], "doc string, k int")
    assert g.project_pairs(two, "doc", "node", unknown).first()["weight_frac"] is None


def test_components_of_chain_star_and_alone(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + star, "a long, b long")
    vertices = spark.createDataFrame([(i,) for i in itertools.chain(range(301), range(1000, 1200), [5000])], "id long")
    got = {r["id"]: r["component"] for r in g.components(edges, vertices).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1200)} == {1000} and got[5000] == 5000
    assert len(got) == 502


def test_components_are_repeatable_over_partitions(spark):
    rng = random.Random(3)
    edges = spark.createDataFrame([(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "a long, b long")
    vertices = spark.range(200)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(tuple(r) for r in g.components(edges, vertices).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_strength_is_one_for_an_even_network(spark):
    agg = spark.createDataFrame([(a, b, 1.0, 1) for a, b in itertools.combinations(range(4), 2)],
                                "node1 int, node2 int, weight double, n_docs long")
    forces = {round(r["force"], 6) for r in g.association_strength(agg).collect()}
    assert forces == {round(2 * 6 * 1 / 9, 6)}


def test_communities_split_two_cliques(spark):
    pairs = list(itertools.combinations(range(5), 2)) + list(itertools.combinations(range(10, 14), 2))
    agg = spark.createDataFrame([(a, b, 2.0) for a, b in pairs] + [(4, 10, 0.1)], "node1 int, node2 int, weight double")
    got = {r["node"]: r["community"] for r in g.communities(agg).collect()}
    assert {got[i] for i in range(5)} == {0} and {got[i] for i in range(10, 14)} == {1}


def test_checkpoint_dir_comes_from_the_session(spark):
    from foliograph.plans.session import ensure_checkpoint_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    used = ensure_checkpoint_dir(spark)
    assert used and (named is None or named.rstrip("/") in used)
