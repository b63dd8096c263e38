"""Mentions of one spelling in works of the same units are decided once; null spellings stay in the result."""

from __future__ import annotations

from foliograph.operators import entity as en


def test_equal_mentions_are_decided_once(spark, monkeypatch):
    n = 300
    rows = [(f"d{i}", f"w{i}", 1, "MAIA, T.", "MAIA", "T") for i in range(n)] + [("e", "w0", 1, "?", None, None)]
    mentions = spark.createDataFrame(rows, "doc_uid string, work string, ord int, raw string, surname string, initials string")
    signatures = spark.createDataFrame([(f"PE{i}", "MAIA", f"T{i}") for i in range(3)], "person_id string, surname string, initials string")
    units = spark.createDataFrame([("PE1", "u1")], "person_id string, unit_id string")
    works = spark.createDataFrame([(f"w{i}", "u1") for i in range(n)], "work string, unit_id string")
    carried, decide = [], en.decide
    monkeypatch.setattr(en, "decide", lambda scored: (carried.append(scored.count()), decide(scored))[1])
    got = {r["doc_uid"]: (r["level"], [(c["person_id"], c["score"]) for c in r["candidates"] or ()])
           for r in en.resolve_mentions(mentions, signatures, units, works).collect()}
    assert max(carried) <= 2
    assert got.pop("e") == ("D", [])
    assert len(got) == n and set(map(str, got.values())) == {str(("C", [("PE1", 4), ("PE0", 1), ("PE2", 1)]))}
