"""People on an axis: what is not read of them is not worked out, and null keys stay out."""

from __future__ import annotations

from foliograph.operators import indicators as ind


def test_evidence_that_is_not_read_is_left_out(spark):
    rows = [(p, d, 2000 + d, True, False, False, 1.0) for p in ("a", "b", None) for d in range(1, 4)]
    weights = spark.createDataFrame(rows, "person_id string, doc_uid long, year int, recent boolean, led boolean, technology boolean, weight double")
    axis = spark.createDataFrame([(d, x) for d in range(1, 4) for x in ("x", None)], "doc_uid long, axis string")
    who = ind.who_works(weights, axis)
    assert [(r.person_id, r.axis, r.n_docs, r.focus, r.evidence) for r in who.orderBy("person_id").collect()] == [
        ("a", "x", 3, 1.0, "3;2;1"), ("b", "x", 3, 1.0, "3;2;1")]
    listed = who.select("person_id", "axis")
    assert sorted(listed.collect()) == [("a", "x"), ("b", "x")]
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
