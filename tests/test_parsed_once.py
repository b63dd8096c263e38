"""A signature is parsed once for all mentions that spell it alike."""

from __future__ import annotations

from foliograph.operators import entity as en


def test_mentions_join_parsed_signatures(spark):
    df = spark.createDataFrame([("d1", "w1", "Silva, A. B.;; silva ,A.B."), ("d2", "w2", "Silva,  A. B."), ("d3", "w3", None)],
                               "doc string, work string, authors string")
    out = en.explode_mentions(df, "doc", "work", "authors")
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp" not in plan and "posexplode" not in plan
    got = sorted((r["doc_uid"], r["ord"], r["raw"], r["surname"], r["initials"]) for r in out.collect())
    assert got == [("d1", 1, "Silva, A. B.", "SILVA", "AB"), ("d1", 3, "silva ,A.B.", "SILVA", "AB"), ("d2", 1, "Silva, A. B.", "SILVA", "AB")]
