"""Signatures whose spelling fits many people: lists are made per spelling and units, mentions carry the best two only."""

from __future__ import annotations

from foliograph.operators import entity as en


def test_mentions_carry_the_best_two_and_ambiguous_ones_get_the_whole_list(spark, monkeypatch):
    n = 40
    # d1 and d2 share MAIA, T.; PE07 has the unit of w1, and LOPES, known from w3 with PE09, signs w2
    mentions = spark.createDataFrame(
        [("d1", "w1", 1, "MAIA, T.", "MAIA", "T"), ("d2", "w2", 1, "MAIA, T.", "MAIA", "T"),
         ("d2", "w2", 2, "LOPES, Q. R. S.", "LOPES", "QRS"), ("d3", "w3", 1, "LOPES, Q. R. S.", "LOPES", "QRS"),
         ("d3", "w3", 2, "MAIA, T. U.", "MAIA", "TU"), ("d4", "w4", 1, "NUNES, A.", "NUNES", "A")],
        "doc_uid string, work string, ord int, raw string, surname string, initials string")
    people = [(f"PE{i:02}", "MAIA", "TU" if i == 9 else f"T{chr(65 + i % 20)}Z") for i in range(n)] + [("PE90", "LOPES", "QRS")]
    signatures = spark.createDataFrame(people, "person_id string, surname string, initials string")
    units = spark.createDataFrame([("PE07", "u1"), ("PE09", "u3"), ("PE90", "u3")], "person_id string, unit_id string")
    works = spark.createDataFrame([("w1", "u1"), ("w2", None), ("w3", "u3")], "work string, unit_id string")
    carried, decide = [], en.decide
    monkeypatch.setattr(en, "decide", lambda scored: (carried.append(scored.count()), decide(scored))[1])
    got = {(r["doc_uid"], r["ord"]): r for r in en.resolve_mentions(mentions, signatures, units, works).collect()}
    assert max(carried) <= 2 * 5 + 1  # two a mention, and one with a co-author
    levels = {k: (r["level"], r["person_id"]) for k, r in got.items()}
    assert levels == {("d1", 1): ("C", None), ("d2", 1): ("C", None), ("d2", 2): ("B", "PE90"), ("d3", 1): ("A", "PE90"),
                      ("d3", 2): ("A", "PE09"), ("d4", 1): ("D", None)}
    listed = {k: [(c["person_id"], c["score"]) for c in r["candidates"]] for k, r in got.items() if r["candidates"]}
    ids = [f"PE{i:02}" for i in range(n)]
    assert listed == {("d1", 1): [("PE07", 4)] + [(p, 1) for p in ids if p != "PE07"],
                      ("d2", 1): [("PE09", 3)] + [(p, 1) for p in ids if p != "PE09"]}
