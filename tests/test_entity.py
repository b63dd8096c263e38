"""Decision rules, conflicts, overrides and leaders on literal rows."""

import pytest

from pyspark.sql import functions as F

from foliograph.functions.text import name_key
from foliograph.operators import entity as en

SCORED = "doc_uid string, ord int, work string, n_ini int, people long, person_id string, exact boolean, unit boolean, n_coauthors int, score int"


def row(doc, person, exact=True, unit=False, co=0, n_ini=2, people=9):
    score = (3 if exact else 1) + (3 if unit else 0) + 2 * min(co, 2)
    return (doc, 1, "w", n_ini, people, person, exact, unit, co, score)


@pytest.mark.parametrize("rows, level, person", [
    ([row("d", "PE1", unit=True)], "A", "PE1"),
    ([row("d", "PE1", n_ini=3)], "B", "PE1"), ([row("d", "PE1", n_ini=2, people=3)], "B", "PE1"),
    ([row("d", "PE1", n_ini=1, people=1)], "B", "PE1"), ([row("d", "PE1", n_ini=2, people=4)], "C", "PE1"),
    ([row("d", "PE1", exact=False, unit=True)], "B", "PE1"), ([row("d", "PE1", exact=False, co=1)], "B", "PE1"),
    ([row("d", "PE1"), row("d", "PE2", exact=False)], "B", "PE1"),
    ([row("d", "PE1", exact=False, unit=True, co=1), row("d", "PE2", exact=True)], "B", "PE1"),
    ([row("d", "PE1", n_ini=1), row("d", "PE2", exact=False, n_ini=1)], "C", "PE1"),
    ([row("d", "PE2"), row("d", "PE1")], "C", "PE1"),
])
def test_decision(spark, rows, level, person):
    got = en.decide(spark.createDataFrame(rows, SCORED)).first()
    assert (got["level"], got["person_id"]) == (level, person)


def test_same_person_twice_is_ambiguous(spark):
    rows = [("d", 1, "PE1", "A"), ("d", 2, "PE1", "B"), ("d", 3, "PE2", "A"), ("e", 1, "PE1", "A")]
    df = spark.createDataFrame(rows, "doc_uid string, ord int, person_id string, level string")
    got = {(r["doc_uid"], r["ord"]): r["level"] for r in en.demote_conflicts(df).collect()}
    assert got == {("d", 1): "C", ("d", 2): "C", ("d", 3): "A", ("e", 1): "A"}


def test_overrides(spark):
    links = spark.createDataFrame(
        [("d1", "PE1", "autor", 1, "X", "A", "assinatura"), ("d2", None, "autor", 1, "X", "C", "assinatura"),
         ("d3", None, "autor", 1, "X", "C", "assinatura"), ("d3", None, "lider", 1, "X", "D", "sem_candidato"),
         ("d4", "PE4", "autor", 2, "Y", "B", "assinatura")],
        "doc_uid string, person_id string, role string, ord int, raw string, level string, method string")
    rules = spark.createDataFrame(
        [(1, "autor", "", "X", "", "PE9"), (2, "autor", "d1", "X", "", "EXTERNO"), (3, "autor", "", "X", "u3", "PE7"),
         (4, "autor", "", "Y", "u9", "PE8"), (5, "autor", "", "Y", "", "")],
        "row int, context string, doc_uid string, raw string, unit_doc string, person_id string")
    units = spark.createDataFrame([("d3", "u3"), ("d4", "u4")], "doc_uid string, unit_id string")
    got = {(r["doc_uid"], r["role"]): (r["person_id"], r["level"], r["method"])
           for r in en.apply_overrides(links, rules, units).collect()}
    assert got == {("d1", "autor"): (None, "D", "manual"), ("d2", "autor"): ("PE9", "M", "manual"),
                   ("d3", "autor"): ("PE7", "M", "manual"), ("d3", "lider"): (None, "D", "sem_candidato"),
                   ("d4", "autor"): ("PE4", "B", "assinatura")}


def test_mention_positions_and_blank_entries(spark):
    df = spark.createDataFrame([("d", "w", "SILVA, A.; ;REIS, B. C."), ("e", "w", None)], "doc string, work string, authors string")
    got = [(r["ord"], r["raw"], r["surname"], r["initials"]) for r in en.explode_mentions(df, "doc", "work", "authors").orderBy("ord").collect()]
    assert got == [(1, "SILVA, A.", "SILVA", "A"), (3, "REIS, B. C.", "REIS", "BC")]


def test_rounds_learn_units_and_coauthors(spark):
    """The second round resolves a signature through a co-author known from another work."""
    mentions = spark.createDataFrame(
        [("d1", "w1", 1, "LOPES, Q. R. S.", "LOPES", "QRS"), ("d1", "w1", 2, "MAIA, T. U. V.", "MAIA", "TUV"),
         ("d2", "w2", 1, "LOPES, Q. R. S.", "LOPES", "QRS"), ("d2", "w2", 2, "MAIA, T.", "MAIA", "T")],
        "doc_uid string, work string, ord int, raw string, surname string, initials string")
    people = [("PE1", "LOPES", "QRS"), ("PE2", "MAIA", "TUV")] + [(f"PE{i}", "MAIA", "Z") for i in range(3, 9)]
    signatures = spark.createDataFrame(people, "person_id string, surname string, initials string")
    units = spark.createDataFrame([], "person_id string, unit_id string")
    works = spark.createDataFrame([("w1", "u"), ("w2", "u")], "work string, unit_id string")

    def levels(rounds):
        out = en.resolve_mentions(mentions, signatures, units, works, rounds).collect()
        return {(r["doc_uid"], r["ord"]): r["level"] for r in out}

    assert levels(1) == {("d1", 1): "B", ("d1", 2): "B", ("d2", 1): "B", ("d2", 2): "C"}
    # PE1 and PE2 met only in w1, so in w2 the known co-author speaks for PE2; in d2 PE1 learns the unit
    assert levels(3)[("d2", 2)] == "B"


def test_leaders(spark):
    names = spark.createDataFrame(
        [("PE1", "HELENA ROCHA LIMA", "nome"), ("PE2", "HELENA ROCHA LIMA", "nome"), ("PE3", "RUI DE ALMEIDA PRADO", "nome"),
         ("PE4", "IVO REIS", "nome_anterior")], "person_id string, name_norm string, origin string")
    units = spark.createDataFrame([("PE1", "u1"), ("PE2", "u2"), ("PE3", "u3"), ("PE4", "u4")], "person_id string, unit_id string")
    docs = spark.createDataFrame(
        [("d1", "u1", "Helena Rocha Lima"), ("d2", "u9", "Helena Rocha Lima"), ("d3", "u9", "Rui A. Prado"),
         ("d4", "u9", "Ivo Reis"), ("d5", "u9", "Ninguém Aqui"), ("d6", "u9", None), ("d7", "u9", "Rui Prado")],
        "doc_uid string, unit_id string, raw string")
    got = {r["doc_uid"]: (r["person_id"], r["level"], r["method"]) for r in en.resolve_leaders(docs, names, units).collect()}
    assert got == {"d1": ("PE1", "A", "exato_nome"), "d2": (None, "C", "exato_nome"), "d3": ("PE3", "B", "tokens"),
                   "d4": ("PE4", "A", "exato_nome_anterior"), "d5": (None, "D", "sem_candidato"),
                   "d6": (None, "D", "sem_candidato"), "d7": (None, "C", "tokens")}


def test_the_current_name_counts_before_a_previous_one(spark):
    docs = spark.createDataFrame([("d", "u", "Rui A. Prado")], "doc_uid string, unit_id string, raw string")
    names = spark.createDataFrame([("p", "RUI PRADO", "nome_anterior"), ("p", "RUI DE ALMEIDA PRADO", "nome")],
                                  "person_id string, name_norm string, origin string")
    units = spark.createDataFrame([("p", "elsewhere")], "person_id string, unit_id string")
    names = names.withColumn("name_norm", name_key(F.col("name_norm")))
    (r,) = en.resolve_leaders(docs, names, units).collect()
    assert (r["person_id"], r["level"]) == ("p", "B")
