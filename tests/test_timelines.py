"""Interval and as-of joins, periods, medians and trends against plain loops."""

import random
from math import sqrt
from statistics import median

from pyspark.sql import functions as F

from foliograph.operators import timelines as tl


def test_interval_join(spark):
    rng = random.Random(1)

    def side(n):
        rows = []
        for i in range(n):
            lo = rng.randint(-40, 2000) if rng.random() < 0.5 else rng.randint(0, 60)
            hi = lo + rng.choice([0, 0, 1, 3, 60, 700, -1])
            rows.append((i, rng.choice(["hot", "hot", "a", None]), None if rng.random() < 0.1 else lo, None if rng.random() < 0.1 else hi))
        return rows

    x, y = side(150), side(130)
    left, right = spark.createDataFrame(x, "i long, k string, lo int, hi int"), spark.createDataFrame(y, "j long, k string, f int, t int")
    got = [(r.i, r.j) for r in tl.interval_join(left, right, ["k"], ("lo", "hi"), ("f", "t")).collect()]
    inf = 10**9
    span = lambda r: (-inf if r[2] is None else r[2], inf if r[3] is None else r[3])
    want = {(a[0], b[0]) for a in x for b in y if a[1] is not None and a[1] == b[1]
            and span(a)[0] <= span(a)[1] and span(b)[0] <= span(b)[1] and span(a)[0] <= span(b)[1] and span(b)[0] <= span(a)[1]}
    assert len(got) == len(set(got)) and set(got) == want
    assert tl.interval_join(left.where("i < 0"), right, ["k"], ("lo", "hi"), ("f", "t")).collect() == []


def test_asof_join(spark):
    rng = random.Random(2)
    keys = ["hot"] * 6 + ["a", "b", None]
    moment = lambda: None if rng.random() < 0.05 else rng.randint(0, 400)
    x, y = [(i, rng.choice(keys), moment()) for i in range(500)], [(i, rng.choice(keys[:-2] + [None]), moment()) for i in range(300)]
    left, right = spark.createDataFrame(x, "i long, k string, at int"), spark.createDataFrame(y, "j long, k string, t int")
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # keys fill several partitions
    try:
        for strict in (False, True):
            got = {r.i: (r.who, r.when) for r in tl.asof_join(left, right, ["k"], "at", "t", {"j": "who", "t": "when"}, strict).collect()}
            for i, k, at in x:
                before = [(t, j) for j, kk, t in y if k is not None and kk == k and t is not None and at is not None and (t < at if strict else t <= at)]
                t, j = max(before) if before else (None, None)
                assert got[i] == (j, t), (i, k, at)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_group_median(spark):
    rng = random.Random(3)
    rows = [(k, rng.randint(0, 5) if rng.random() < 0.9 else None) for k in ["hot"] * 101 + ["even"] * 40 + ["one"] for _ in range(1)]
    got = {r.k: (r.median, r.n) for r in tl.group_median(spark.createDataFrame(rows, "k string, v int"), ["k"], "v").collect()}
    for k in {k for k, _ in rows}:
        v = [x for kk, x in rows if kk == k and x is not None]
        assert not v and k not in got or got[k] == (median(v), len(v))


def test_unit_periods(spark):
    ev = [("p", f"d{i}", u, y) for i, (u, y) in enumerate([("A", 2000), ("A", 2001), ("B", 2001), ("B", 2002), ("B", 2008), ("C", 2008)])]
    ev += [("p", "d0", "A", 2000), ("q", "x", "Z", 1990), (None, "y", "A", 1), ("p", "n", None, 2003)]
    evidence = spark.createDataFrame(ev, "person_id string, doc_uid string, unit_id string, year int")
    registered = spark.createDataFrame([("p", "R"), ("r", "S"), ("s", None)], "person_id string, unit_id string")
    got = sorted(
        ((r.person_id, r.first, r.last, r.unit_id, r.source) for r in tl.unit_periods(evidence, registered).collect()), key=str)
    assert got == sorted([
        ("p", None, 1999, "R", "cadastro"), ("p", 2000, 2000, "A", "inferida"), ("p", 2001, 2003, "B", "inferida"), ("p", 2004, 2006, "R", "cadastro"),
        ("p", 2007, 2008, "B", "inferida"), ("p", 2009, None, "R", "cadastro"), ("q", 1990, 1990, "Z", "inferida"), ("r", None, None, "S", "cadastro")], key=str)
    rows = spark.createDataFrame([("p", y) for y in (1950, 2000, 2005, 2030)] + [("r", 1), ("q", 1991), ("s", 5)], "person_id string, at int")
    at = sorted((r.person_id, r.at, r.unit_id) for r in tl.units_at(rows, tl.unit_periods(evidence, registered), "at").collect())
    assert at == [("p", 1950, "R"), ("p", 2000, "A"), ("p", 2005, "R"), ("p", 2030, "R"), ("r", 1, "S")]


def plain_trend(points):
    points = sorted((y, v) for y, v in points if y is not None and v is not None)
    n = len(points)
    s = sum((b[1] > a[1]) - (b[1] < a[1]) for i, a in enumerate(points) for b in points[i + 1:])
    ties = [sum(w == v for _, w in points) for v in {v for _, v in points}]
    variance = (n * (n - 1) * (2 * n + 5) - sum(t * (t - 1) * (2 * t + 5) for t in ties)) / 18
    z = (s - (s > 0) + (s < 0)) / sqrt(variance) if variance > 0 else 0.0
    slopes = [(b[1] - a[1]) / (b[0] - a[0]) for i, a in enumerate(points) for b in points[i + 1:]]
    return n, s, variance, z, (z > 1.96) - (z < -1.96), median(slopes) if slopes else None


def test_trend(spark):
    rng = random.Random(4)
    series = {k: [(y, None if rng.random() < 0.1 else float(round(rise * y + rng.gauss(0, 2)))) for y in range(2000, 2000 + n) if rng.random() < 0.8]
              for k, (n, rise) in enumerate([(20, 1), (15, -1), (12, 0), (3, 0), (1, 0), (2, 1)])}
    series[9] = [(2000, 1.0), (2001, 1.0), (2005, 1.0)]
    rows = [(k, y, v) for k, s in series.items() for y, v in s]
    got = {r.k: r for r in tl.trends(spark.createDataFrame(rows, "k int, y int, v double"), ["k"], "y", "v").collect()}
    for k, points in series.items():
        if points:
            r, want = got[k], plain_trend(points)
            assert (r.n, r.s, r.direction) == (want[0], want[1], want[4])
            assert abs(r.variance - want[2]) < 1e-9 and abs(r.z - want[3]) < 1e-9 and (r.slope is None) == (want[5] is None)
            assert r.slope is None or abs(r.slope - want[5]) < 1e-12
    assert got[0].direction == 1 and got[1].direction == -1


def test_activity(spark):
    ev = spark.createDataFrame([("p", y) for y in (1990, 1991, 1995, 2010, 2010, None)] + [(None, 1)], "person_id string, year int")
    spans = sorted((r.person_id, r.first, r.last, r.n_years) for r in tl.activity_spans(ev, pause=4).collect())
    assert spans == [("p", 1990, 1995, 3), ("p", 2010, 2010, 1)]
    cands = spark.createDataFrame([("p", y) for y in (1987, 1988, 1997, 1998, 2012)] + [("q", 2000), ("p", None)], "person_id string, at int")
    got = {(r.person_id, r["at"]): r.active for r in tl.active_candidates(cands, tl.activity_spans(ev, pause=4), "at").collect()}
    assert got == {("p", 1987): False, ("p", 1988): True, ("p", 1997): True, ("p", 1998): False, ("p", 2012): True, ("q", 2000): False, ("p", None): False}


def test_lag_of_first_stage(spark):
    rows = [("t", "P", "2000-01-01", 1), ("t", "B", "2000-01-11", 2), ("t", "B", "1999-01-01", 3), ("t", "T", "2000-02-01", 4), ("u", "T", "2000-01-01", 5)]
    df = spark.createDataFrame(rows, "theme string, stage string, d string, k long").withColumn("d", F.to_date("d"))
    got = {r.key: (r.after, r.lag) for r in tl.stage_lags(df, "theme", "stage", "d", "k", ["P", "B", "T"]).collect()}
    assert got == {2: (1, 10), 3: (None, None), 4: (2, 21), 5: (None, None)}
