"""Literal cases of the text, name and signature rules."""

import pytest
from pyspark.sql import functions as F

from foliograph.functions import scalars as sc
from foliograph.functions import text as tx


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(fn(F.col("c")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw, surname, initials", [
    ("PRADO, M. T. L. de B.", "PRADO", "MTLB"),          # lower-case particle
    ("CAMPOS FILHO, R.", "CAMPOS FILHO", "R"),           # suffix in the surname
    ("LIMA-VERDE, C.", "LIMA VERDE", "C"),               # hyphen
    ("MOTA, E. J. S. da", "MOTA", "EJS"),                # trailing particle
    ("REIS, N. DAS", "REIS", "N"),                       # upper-case particle
    ("COSTA, V. H. D.", "COSTA", "VHD"),                 # a single letter is an initial
    ("Órgão Técnico", "ORGAO TECNICO", ""),              # no comma
])
def test_signature_parse(spark, raw, surname, initials):
    got = one(spark, raw, tx.parse_signature)
    assert (got["surname"], got["initials"]) == (surname, initials)


def test_signature_parse_null(spark):
    got = one(spark, None, tx.parse_signature)
    assert got["surname"] is None


@pytest.mark.parametrize("name, surname, initials", [
    ("Helena Cristina da Rocha", "ROCHA", "HC"), ("Carlos Alberto de Melo Prado Júnior", "PRADO JUNIOR", "CAM"),
    ("Rui Neto", "NETO", "R"), ("Ana", "ANA", ""),
])
def test_signature_of_name(spark, name, surname, initials):
    got = one(spark, name, tx.signature_of)
    assert (got["surname"], got["initials"]) == (surname, initials)


@pytest.mark.parametrize("a, b, kind", [
    ("RB", "RB", tx.EXACT), ("RT", "RBT", tx.COMPATIBLE), ("RBT", "RT", tx.COMPATIBLE), ("RB", "RT", tx.INCOMPATIBLE),
    ("RB", "TB", tx.INCOMPATIBLE), ("", "RB", tx.INCOMPATIBLE),
])
def test_initials(spark, a, b, kind):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(tx.initials_compat("a", "b").alias("o")).first()["o"] == kind


@pytest.mark.parametrize("a, b, same", [
    ("MARCOS VINICIUS DE T FONSECA", "Marcos Vinicius de Toledo Fonseca", True),
    ("LUIS ANTONIO DE M PRADO JR", "Luis Antonio de Melo Prado Junior", True),
    ("HELENA CRISTINA ROCHA", "HELENA BEATRIZ ROCHA", False), ("RUI ROCHA", "RAUL ROCHA", False),
    ("A B C K", "A C B K", False), ("A K", "A B C K", True), ("ANA", "ANA", False),
])
def test_names_compatible(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    cols = tx.name_tokens(F.col("a")).alias("a"), tx.name_tokens(F.col("b")).alias("b")
    assert df.select(*cols).select(tx.names_compatible("a", "b").alias("o")).first()["o"] is same


@pytest.mark.parametrize("fn, raw, out", [
    (tx.display_name, "HELENA CRISTINA DA ROCHA E SILVA", "Helena Cristina da Rocha e Silva"),
    (tx.display_name, "ANA-MARIA DOS REIS", "Ana-Maria dos Reis"),
    (tx.name_key, " João  d'Ávila-Müller 2 ", "JOAO D AVILA MULLER"),
    (tx.title_key, "Größe & Æther: 3ª edição", "grosse aether 3 edicao"),
    (tx.squish, " a \t b\n c ", "a b c"),
    (lambda c: tx.fold(c, "ascii"), "São Pará ß", "Sao Para "),
    (lambda c: tx.fold(c, "hyphen"), "Batata-Doce ", "batata doce"),
    (tx.guess_language, "the growth of maize in the field", "en"),
    (tx.guess_language, "o cultivo do milho em campo", "pt"),
    (tx.split_keywords, "milho, soja;; feijão ", ["milho", "soja", "feijão"]),
    (tx.short_to_null, "curto", None),
    (lambda c: tx.shorten(c, 3), "abcd", "abc…"),
])
def test_small_functions(spark, fn, raw, out):
    assert one(spark, raw, fn) == out


def test_combining_marks_and_exact_fold(spark):
    raw = "Élève"
    assert one(spark, raw, lambda c: tx.fold(c, "marks")) == "eleve"
    assert one(spark, raw, tx.fold_exact) == "eleve"


def test_scalars(spark):
    assert one(spark, "03/2019", lambda c: sc.month_year(c)["year"]) == 2019
    assert one(spark, "0.4", lambda c: sc.level(c.cast("double"))) == "moderada"
    assert one(spark, "0.61", lambda c: sc.level(c.cast("double"))) == "muito alta"
    assert one(spark, "PE1", sc.public_id).startswith("PS")
    assert one(spark, "7", lambda c: sc.format_id("T", c.cast("int"), 3)) == "T007"
    assert one(spark, "true", sc.flag) is True
    assert one(spark, "2017", lambda c: sc.year_bin_label(c.cast("int"), 5)) == "2015–2019"
