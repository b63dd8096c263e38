"""From raw CSV to the document mart."""

import pytest
from pyspark.sql import functions as F

from foliograph.operators import entity as en
from foliograph.operators import indicators as ind
from foliograph.operators import works as wk
from foliograph.sources import io
from foliograph.sources import project as pj

PROJECTS = '''"Id","Título","Resumo","Mês/Ano de Início","Mês/Ano de Finalização","Unidade Líder","Líder do Projeto","Palavras-chave","Situação"
"7","Manejo  do solo","curto","03/2001","12/2004","Unidade Sol","Ana  Lima","solo, água","Concluído"
'''
PUBLICATIONS = '''"Id","Título","Resumo","Ano de Publicação","Tipo de Publicação","Unidade","Autores","Palavras-chave","Página da Publicação no Portal"
"1","Um estudo longo sobre o solo seco","um resumo com mais de trinta
caracteres","2002","Livro","SOL","SILVA, A.","solo","http://x/1"
"2","Um Estudo longo sobre o solo seco.","um resumo bem mais longo, com mais de trinta caracteres","2002","Folder","Mar","SILVA, A.; REIS, B.","",""
"3","Outro","curto demais","NA","Mapa","","","",""
'''
TECHNOLOGIES = '''"Id","Nome","Descrição","Tipo","Subtipo","Ano de Lançamento","Bioma","Unidade Responsável","Onde Encontrar","Palavras-chave"
"9","Semente  X","uma semente","Cultivar","Soja","2010","Cerrado","unidade mar","","soja"
'''


def tables(spark, tmp_path):
    units = spark.createDataFrame([("u1", "Unidade Sol", "SOL"), ("u2", "Unidade Mar", "MAR")], "unit_id string, name string, short string")
    aliases = en.alias_table((units, "name", "unit_id", "nome"), (units, "short", "unit_id", "sigla")).select("key", "unit_id")
    kinds = spark.createDataFrame([("Livro", "livro"), ("Folder", "livro")], "type string, kind_group string")
    read = {}
    for name, text in (("p", PROJECTS), ("b", PUBLICATIONS), ("t", TECHNOLOGIES)):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        read[name] = io.read_export(spark, str(tmp_path / f"{name}.csv"), allow_truncated=False)
    return read, aliases, kinds


def test_from_exports_to_the_document_mart(spark, tmp_path):
    read, aliases, kinds = tables(spark, tmp_path)
    projects = pj.project_source(read["p"], pj.PROJECTS, aliases)
    records = pj.project_source(read["b"], pj.PUBLICATIONS, aliases, kinds)
    technologies = pj.project_source(read["t"], pj.TECHNOLOGIES, aliases)
    (p,) = projects.collect()
    assert (p.doc_uid, p.title, p.abstract, p.year, p.month, p.year_end, p.unit_id, p.leader_raw, p.url) == (
        "P:7", "Manejo do solo", "curto", 2001, 3, 2004, "u1", "Ana Lima", None)
    got = {r.id: r for r in records.collect()}
    assert [(got[i].short_text, got[i].kind_group, got[i].unit_id, got[i].year) for i in (1, 2, 3)] == [
        (False, "livro", "u1", 2002), (False, "livro", "u2", 2002), (True, "nao_classificado", None, None)]
    assert got[1].abstract == "um resumo com mais de trinta caracteres" and got[1].url == "http://x/1" and got[3].abstract is None
    grouped = wk.group_works(records, "id", F.col("title"), F.col("year"), wk.author_keys(F.col("authors_raw")))
    assert {r.id: r.work for r in grouped.collect()} == {1: 1, 2: 1, 3: 3}
    merged = wk.summarise_works(records.join(grouped, "id"), "work", "id", "abstract", "unit_id", ("doc_uid", "title", "year", "kind_group"))
    works = merged.select(F.concat(F.lit("O:"), "work").alias("work"), F.col("doc_uid").alias("representative"), "title", "year", "kind_group", "n_records")
    mart = {r.doc_uid: r for r in ind.document_mart(projects, works, records, technologies).collect()}
    assert set(mart) == {"P:7", "O:1", "O:3", "T:9"}
    assert (mart["O:1"].representative, mart["O:1"].n_records, mart["O:1"].unit_id, mart["O:1"].kind) == ("B:2", 2, "u2", "publicacao")
    assert (mart["T:9"].title, mart["T:9"].unit_id, mart["T:9"].category, mart["T:9"].detail) == ("Semente X", "u2", "Cultivar", "Soja")


def test_unknown_units_and_missing_columns_raise(spark, tmp_path):
    read, aliases, kinds = tables(spark, tmp_path)
    with pytest.raises(ValueError, match="MAR"):
        pj.project_source(read["b"], pj.PUBLICATIONS, aliases.where("unit_id = 'u1'"), kinds)
    with pytest.raises(ValueError, match="situacao"):
        pj.project_source(read["p"].drop("situacao"), pj.PROJECTS, aliases)
