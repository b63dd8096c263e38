"""The typed source projections on driver columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query
from foliograph.operators import entity as en
from foliograph.sources import io
from foliograph.sources import project as pj

def _units(t: Tables):
    letter = F.char(65 + F.col("n_nationkey").cast("bigint"))
    named = t.nation.select(F.col("n_nationkey").alias("unit_id"), F.concat(F.lit("Unidade "), letter).alias("name"),
                            F.concat(F.lit("U-"), letter).alias("short"))
    return en.alias_table((named, "name", "unit_id", "nome"), (named, "short", "unit_id", "sigla"))


def _unit_name(key):
    letter = F.char(65 + (key % 25).cast("bigint"))
    return F.when(key % 3 == 0, F.concat(F.lit(" unidade   "), letter)).when(key % 3 == 1, F.concat(F.lit("u-"), letter))


@query("project_source_projects", f"""
SELECT 'P:' || o_orderkey AS doc_uid, CAST(o_orderkey AS INTEGER) AS id, 'Projeto ' || o_orderpriority AS title,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE trim(regexp_replace(o_orderpriority || '  x ', '\\s+', ' ', 'g')) END AS abstract,
       year(o_orderdate) AS year, month(o_orderdate) AS month, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE year(o_orderdate) + 2 END AS year_end,
       o_orderstatus AS state, CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey % 25 END AS unit_id
FROM orders
""")
def project_source_projects(t: Tables):
    key = F.col("o_orderkey")
    raw = t.orders.select(
        key.cast("string").alias("id"), F.concat(F.lit(" Projeto  "), "o_orderpriority").alias("titulo"),
        F.when(key % 5 != 0, F.concat(F.lit(" "), "o_orderpriority", F.lit("\n x"))).alias("resumo"),
        F.date_format("o_orderdate", "MM/yyyy").alias("mes_ano_de_inicio"),
        F.when(key % 4 != 0, F.concat(F.lit("01/"), F.year("o_orderdate") + 2)).alias("mes_ano_de_finalizacao"),
        _unit_name(key).alias("unidade_lider"), F.lit("A  B").alias("lider_do_projeto"), F.lit("a, b").alias("palavras_chave"),
        F.col("o_orderstatus").alias("situacao"))
    out = pj.project_source(raw, pj.PROJECTS, _units(t).select("key", "unit_id"))
    return out.select("doc_uid", "id", "title", "abstract", "year", "month", "year_end", "state", "unit_id")


@query("project_source_publications_whole", """
SELECT 'B:' || doc_id AS doc_uid, CAST(doc_id AS INTEGER) AS id,
       CASE WHEN length(a) >= 30 THEN md5(a) END AS abstract, coalesce(length(a) < 30, true) AS short_text, lang AS type,
       CASE lang WHEN 'en' THEN 'livro' WHEN 'fr' THEN 'artigo' ELSE 'nao_classificado' END AS kind_group,
       CASE WHEN doc_id % 3 < 2 THEN doc_id % 25 END AS unit_id
FROM (SELECT *, trim(regexp_replace(CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN lang ELSE text END, '[ \\n]+', ' ', 'g')) AS a FROM documents)
""")
def project_source_publications_whole(t: Tables):
    """Whole texts as abstracts; one in seven is missing, one short by itself."""
    part = F.col("doc_id") % 7
    return _publications(t, F.when(part == 1, F.col("lang")).when(part > 1, F.col("text")))


def _publications(t: Tables, text):
    key = F.col("doc_id")
    raw = t.documents.select(
        key.cast("string").alias("id"), F.lit("t").alias("titulo"), F.regexp_replace(text, " ", " \n ").alias("resumo"),
        F.lit("2001").alias("ano_de_publicacao"), F.col("lang").alias("tipo_de_publicacao"), _unit_name(key).alias("unidade"),
        F.lit("SILVA, A.").alias("autores"), F.lit("x").alias("palavras_chave"))
    kinds = t.spark.createDataFrame([("en", "livro"), ("fr", "artigo")], "type string, kind_group string")
    out = pj.project_source(raw, pj.PUBLICATIONS, _units(t).select("key", "unit_id"), kinds)
    return out.select("doc_uid", "id", F.md5("abstract").alias("abstract"), "short_text", "type", "kind_group", "unit_id")


@query("project_source_technologies", """
SELECT 'T:' || p_partkey AS doc_uid, CAST(p_partkey AS INTEGER) AS id, trim(p_name) AS title, p_brand AS type, p_type AS subtype,
       1990 + CAST(p_size AS INTEGER) AS year, CASE WHEN p_partkey % 3 < 2 THEN p_partkey % 25 END AS unit_id FROM part
""")
def project_source_technologies(t: Tables):
    key = F.col("p_partkey")
    raw = t.part.select(
        key.cast("string").alias("id"), F.concat(F.lit("  "), "p_name").alias("nome"), F.lit(None).cast("string").alias("descricao"),
        F.col("p_brand").alias("tipo"), F.col("p_type").alias("subtipo"), (1990 + F.col("p_size")).cast("string").alias("ano_de_lancamento"),
        F.lit("Cerrado").alias("bioma"), _unit_name(key).alias("unidade_responsavel"), F.lit("").alias("onde_encontrar"),
        F.lit("").alias("palavras_chave"))
    out = pj.project_source(raw, pj.TECHNOLOGIES, _units(t).select("key", "unit_id"))
    return out.select("doc_uid", "id", "title", "type", "subtype", "year", "unit_id")


@query("project_source_people", """
SELECT CAST(c_custkey AS INTEGER) AS record_id, 'Nome ' || c_custkey AS name, CASE WHEN c_custkey % 2 = 0 THEN 'Antes ' || c_custkey END AS previous_name,
       c_custkey % 5 = 0 AS active, CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 25 END AS unit_id FROM customer
""")
def project_source_people(t: Tables):
    key = F.col("c_custkey")
    text = key.cast("string")
    raw = t.customer.select(
        text.alias("id_autor"), F.concat(F.lit(" Nome   "), text).alias("nome"),
        F.when(key % 2 == 0, F.concat(F.lit("Antes \n"), text)).alias("nome_anterior"), F.lit("SILVA, A.").alias("autoria"),
        _unit_name(key).alias("afiliacao"), F.when(key % 5 == 0, "S").when(key % 5 == 1, "N").alias("ativado"))
    out = pj.project_source(raw, pj.PEOPLE, _units(t).select("key", "unit_id"))
    return out.select("record_id", "name", "previous_name", "active", "unit_id")


# --- the value rules of exports and dictionaries ---

WHOLE_QUOTED_SQL = """q AS (SELECT doc_id, chr(34) || replace(replace(text, ', ', '", "'), '. ', chr(34) || chr(10) || chr(34))
      || CASE WHEN doc_id % 3 = 0 THEN '' ELSE chr(34) || chr(10) END AS t FROM documents)"""


def _quoted(t: Tables):
    """Texts as quoted records, some of them without the last quote."""
    cells = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit('", "')), F.lit(". "), F.lit('"\n"'))
    return t.documents.select("doc_id", F.concat(F.lit('"'), cells, F.when(F.col("doc_id") % 3 == 0, "").otherwise('"\n')).alias("t"))


@query("export_integrity_whole", f"""
WITH {WHOLE_QUOTED_SQL}
SELECT doc_id, NOT ((length(t) - length(replace(t, chr(34), ''))) % 2 = 0 AND regexp_matches(right(t, 20), '"\\s*\\z')) AS truncated FROM q
""")
def export_integrity_whole(t: Tables):
    return _quoted(t).select("doc_id", io.ends_inside(F.col("t")).alias("truncated"))


@query("export_complete_records_whole", f"""
WITH {WHOLE_QUOTED_SQL} SELECT doc_id, md5(regexp_extract(t, '\\A(?:(?:[^"\\n]|"[^"]*")*\\n)*', 0)) AS kept FROM q
""")
def export_complete_records_whole(t: Tables):
    return _quoted(t).select("doc_id", F.md5(io.complete_records(F.col("t"))).alias("kept"))


@query("export_null_tokens", """
SELECT doc_id, CASE WHEN lang IN ('', 'NA', 'fr') THEN NULL ELSE lang END AS lang, CASE WHEN source = 'fr' THEN NULL ELSE source END AS source
FROM documents
""")
def export_null_tokens(t: Tables):
    texts = t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source")
    return io.null_tokens(texts, [*io.NULL_TOKENS, "fr"]).withColumn("doc_id", F.col("doc_id").cast("long"))


@query("wordlist_entries", """
SELECT DISTINCT w AS word FROM (SELECT trim(unnest(string_split(replace(text, ' ', chr(10) || CASE WHEN doc_id % 4 = 0 THEN '#' ELSE ' ' END), chr(10)))) AS w
                                FROM documents) WHERE w <> '' AND NOT starts_with(w, '#')
""")
def wordlist_entries(t: Tables):
    mark = F.when(F.col("doc_id") % 4 == 0, "\n#").otherwise("\n ")
    lines = t.documents.select(F.explode(F.split(F.replace(F.col("text"), F.lit(" "), mark), "\n")).alias("line"))
    return io.word_entries(lines, F.col("line"))


@query("gazetteer_places", """
SELECT CAST(c_custkey AS VARCHAR) AS place_id, c_name AS place, CASE c_custkey % 3 WHEN 0 THEN 'TO' WHEN 1 THEN 'GO' END AS state FROM customer
""")
def gazetteer_places(t: Tables):
    """IO-8: the state under the old path, under the new one, or nowhere."""
    name = F.concat(F.lit('{"id": "'), F.col("c_custkey").cast("string"), F.lit('", "nome": "'), "c_name", F.lit('"'))
    path = (F.when(F.col("c_custkey") % 3 == 0, ', "microrregiao": {"mesorregiao": {"UF": {"sigla": "TO"}}}}')
            .when(F.col("c_custkey") % 3 == 1, ', "regiao-imediata": {"regiao-intermediaria": {"UF": {"sigla": "GO"}}}}').otherwise("}"))
    return io.gazetteer_rows(t.customer.select(F.from_json(F.concat(name, path), io.GAZETTEER_SCHEMA).alias("j")).select("j.*"))


@query("ring_centroids", """
WITH r AS (SELECT vec_id // 20 AS place_id, vec_id % 20 AS extra, list_concat(embedding[:], embedding[1:vec_id % 20]) AS e FROM embeddings),
b AS (SELECT place_id, arg_max(e, extra) AS e FROM r GROUP BY place_id)
SELECT place_id, round(list_avg(list_transform(e[2:], lambda x: CAST(x AS DOUBLE))) + 1e-9, 6) AS lat,
       round(list_avg(list_transform(e[:len(e) - 1], lambda x: CAST(x AS DOUBLE))) + 1e-9, 6) AS lon FROM b
""")
def ring_centroids(t: Tables):
    """Rings over all components of a vector, some of which are run through again."""
    whole = F.concat("embedding", F.slice("embedding", F.lit(1), (F.col("vec_id") % 20).cast("int")))
    ring = F.zip_with(F.slice("e", F.lit(1), F.size("e") - 1), F.slice("e", F.lit(2), F.size("e") - 1),
                      lambda x, y: F.array(x.cast("double"), y.cast("double")))
    rings = t.embeddings.select(F.floor(F.col("vec_id") / 20).alias("place_id"), whole.alias("e")).select("place_id", ring.alias("ring"))
    out = io.ring_centroid(rings)
    return out.select("place_id", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("lat", "lon")])


@query("registration_rows", "SELECT o_orderkey AS registro, o_custkey AS obra_id FROM orders")
def registration_rows(t: Tables):
    return io.registration_map(t.orders, "o_orderkey", "o_custkey").withColumnRenamed("o_custkey", "obra_id")


# one load from raw tables to the published mart: documents as publications, orders as projects, parts as technologies
FLOW_SQL = """
raw AS (SELECT doc_id AS id, 'A title of ' || lang || ' that came from ' || source AS title, 2000 + doc_id % 3 AS year, trim(regexp_replace(text, '[ \\n\\t]+', ' ', 'g')) AS a,
               list_distinct([chr(CAST(65 + doc_id % 5 AS INTEGER)) || 'MAR', chr(CAST(75 + doc_id % 7 AS INTEGER)) || 'NUN']) AS w, lang,
               CASE WHEN doc_id % 3 < 2 THEN doc_id % 25 END AS unit_id FROM documents),
p AS (SELECT a.id AS a, b.id AS b FROM raw a JOIN raw b ON a.title = b.title AND a.year = b.year AND a.id <> b.id AND len(list_intersect(a.w, b.w)) >= 1),
reach(id, c) AS (SELECT id, id FROM raw UNION SELECT p.b, reach.c FROM reach JOIN p ON p.a = reach.id),
g AS (SELECT id, min(c) AS work FROM reach GROUP BY id),
k AS (SELECT raw.*, work, CASE WHEN length(a) >= 30 THEN a END AS abstract, CASE lang WHEN 'en' THEN 'livro' WHEN 'fr' THEN 'artigo' ELSE 'nao_classificado' END AS kind_group FROM raw JOIN g USING (id)),
best AS (SELECT *, count(*) OVER (PARTITION BY work) AS n FROM k QUALIFY row_number() OVER (PARTITION BY work ORDER BY coalesce(length(abstract), 0) DESC, id) = 1)
"""


@query("load_flow", f"""
WITH RECURSIVE {FLOW_SQL}
SELECT 'B:' || work AS doc_uid, 'publicacao' AS kind, title, md5(abstract) AS abstract, year, kind_group AS category, unit_id, 'B:' || id AS representative, n AS n_records FROM best
UNION ALL SELECT 'P:' || o_orderkey, 'projeto', 'Projeto ' || o_orderkey, md5('Resumo ' || o_orderpriority), year(o_orderdate), o_orderstatus, CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey % 25 END, NULL, NULL FROM orders
UNION ALL SELECT 'T:' || p_partkey, 'tecnologia', p_name, NULL, 1990 + p_size, p_brand, CASE WHEN p_partkey % 3 < 2 THEN p_partkey % 25 END, NULL, NULL FROM part
""")
def load_flow(t: Tables):
    """Raw exports to typed sources, records to works, works to the document mart, and its published columns."""
    from foliograph.plans import flow

    o, d, p = F.col("o_orderkey"), F.col("doc_id"), F.col("p_partkey")
    projects = t.orders.select(
        o.cast("string").alias("id"), F.concat(F.lit("Projeto  "), o.cast("string")).alias("titulo"), F.concat(F.lit(" Resumo "), "o_orderpriority").alias("resumo"),
        F.date_format("o_orderdate", "MM/yyyy").alias("mes_ano_de_inicio"), F.lit(None).cast("string").alias("mes_ano_de_finalizacao"),
        _unit_name(o).alias("unidade_lider"), F.lit("A B").alias("lider_do_projeto"), F.lit("a").alias("palavras_chave"), F.col("o_orderstatus").alias("situacao"))
    signature = F.concat(F.char((65 + d % 5).cast("bigint")), F.lit("MAR, M.; "), F.char((75 + d % 7).cast("bigint")), F.lit("NUN, N. B."))
    publications = t.documents.select(
        d.cast("string").alias("id"), F.concat(F.lit("A title of "), "lang", F.lit("  that came from "), "source").alias("titulo"), F.col("text").alias("resumo"),
        (2000 + d % 3).cast("string").alias("ano_de_publicacao"), F.col("lang").alias("tipo_de_publicacao"), _unit_name(d).alias("unidade"),
        signature.alias("autores"), F.lit("x").alias("palavras_chave"))
    technologies = t.part.select(
        p.cast("string").alias("id"), F.col("p_name").alias("nome"), F.lit(None).cast("string").alias("descricao"), F.col("p_brand").alias("tipo"),
        F.col("p_type").alias("subtipo"), (1990 + F.col("p_size")).cast("string").alias("ano_de_lancamento"), F.lit("Cerrado").alias("bioma"),
        _unit_name(p).alias("unidade_responsavel"), F.lit("").alias("onde_encontrar"), F.lit("").alias("palavras_chave"))
    kinds = t.spark.createDataFrame([("en", "livro"), ("fr", "artigo")], "type string, kind_group string")
    tables = flow.load(projects, publications, technologies, _units(t).select("key", "unit_id"), kinds)
    shown = ("doc_uid", "kind", "title", "abstract", "year", "category", "unit_id", "representative", "n_records")
    out = flow.publish_load(tables, {"documents": io.Published(columns=shown)})["documents"]
    return out.withColumn("abstract", F.md5("abstract"))
