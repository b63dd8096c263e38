"""Decisions by hand and leaders meet sums of rules and candidates, not the rows behind them."""

from foliograph.operators import entity as en

LINKS = "doc_uid string, person_id string, role string, ord int, raw string, level string, method string"
RULES = "row int, context string, doc_uid string, raw string, unit_doc string, person_id string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_last_rule_of_all_scopes_wins(spark):
    links = spark.createDataFrame(
        [(d, "old", "autor", o, raw, "C", "assinatura") for d in ("d1", "d2", "d3") for o, raw in ((1, "S"), (2, "T"), (3, None))], LINKS)
    rules = spark.createDataFrame(
        [(1, "", "", "S", "", "all"), (2, "", "", "S", "u1", "unit"), (3, "", "d1", "S", "", "doc"), (4, "", "d2", "S", "u9", "elsewhere"),
         (5, "", "d3", "S", "u2", "both"), (6, "", "", "T", "u2", "two"), (7, "", "", "T", "u1", "EXTERNO"), (8, "", "", "S", "", " "[:0])], RULES)
    units = spark.createDataFrame([("d1", "u1"), ("d2", "u1"), ("d2", "u2"), ("d3", "u2")], "doc_uid string, unit_id string")
    done = en.apply_overrides(links, rules, units)
    got = {(r["doc_uid"], r["ord"]): (r["person_id"], r["level"]) for r in done.collect()}
    assert got == {("d1", 1): ("doc", "M"), ("d2", 1): ("unit", "M"), ("d3", 1): ("both", "M"), ("d1", 2): (None, "D"),
                   ("d2", 2): (None, "D"), ("d3", 2): ("two", "M"), **{(d, 3): ("old", "C") for d in ("d1", "d2", "d3")}}
    assert "Window" not in plan(done)  # mentions are not ranked against every rule of their spelling


def test_documents_do_not_meet_candidates(spark):
    names = spark.createDataFrame([(f"PE{i}", "HELENA ROCHA LIMA", "nome") for i in range(4)], "person_id string, name_norm string, origin string")
    units = spark.createDataFrame([(f"PE{i}", f"u{i // 2}") for i in range(1, 4)], "person_id string, unit_id string")
    docs = spark.createDataFrame([("d1", "u0", "Helena Rocha Lima"), ("d2", "u1", "Helena Rocha Lima"), ("d3", None, "Helena Rocha Lima")],
                                 "doc_uid string, unit_id string, raw string")
    done = en.resolve_leaders(docs, names, units)
    got = {r["doc_uid"]: (r["person_id"], r["level"], r["candidates"] and len(r["candidates"])) for r in done.collect()}
    assert got == {"d1": ("PE1", "A", None), "d2": (None, "C", 4), "d3": (None, "C", 4)}
    assert "Aggregate [doc_uid" not in plan(done)  # no sum over documents times candidates
