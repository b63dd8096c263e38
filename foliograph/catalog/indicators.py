"""Marts and indicators: orders are documents, supplier nations their units, suppliers their people, part types their
themes, brands their products and part names their keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query, r6, s6
from foliograph.functions import scalars as sc
from foliograph.operators import indicators as ind
from foliograph.plans import shapes as sh
from foliograph.sources import io

BASE = """
docs AS (SELECT o_orderkey AS doc_uid, CASE o_orderpriority WHEN '1-URGENT' THEN 'projeto' WHEN '5-LOW' THEN 'tecnologia' ELSE 'publicacao' END AS kind,
         CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(year(o_orderdate) + o_custkey % 4 AS INTEGER) END AS year_end,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE c_nationkey END AS unit_id FROM orders JOIN customer ON c_custkey = o_custkey),
line AS (SELECT l_orderkey AS doc_uid, s_nationkey AS unit_id, CASE l_returnflag WHEN 'A' THEN 'depositante' WHEN 'R' THEN 'afiliacao_autor' ELSE 'responsavel' END AS role,
         'PE' || l_suppkey AS person_id, l_linenumber, l_partkey, l_suppkey, p_type, p_brand, p_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey),
du AS (SELECT DISTINCT doc_uid, unit_id, role FROM line),
prod AS (SELECT DISTINCT doc_uid, p_brand AS axis FROM line),
theme AS (SELECT doc_uid, arg_min(p_type, (l_linenumber, l_partkey, l_suppkey)) AS axis FROM line GROUP BY 1),
kw AS (SELECT DISTINCT doc_uid, p_name AS keyword FROM line),
lk AS (SELECT DISTINCT doc_uid, person_id, CASE l_linenumber WHEN 1 THEN 'lider' WHEN 2 THEN 'tecnologia' WHEN 3 THEN 'membro' ELSE 'autor' END AS role FROM line),
"""


class Base:
    """The same tables for Spark."""

    def __init__(self, t: Tables):
        kind = F.when(F.col("o_orderpriority") == "1-URGENT", "projeto").when(
            F.col("o_orderpriority") == "5-LOW", "tecnologia").otherwise("publicacao")
        year = F.year("o_orderdate")
        self.docs = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("doc_uid"), kind.alias("kind"), year.alias("year"),
            F.when(F.col("o_custkey") % 5 != 0, (year + F.col("o_custkey") % 4).cast("int")).alias("year_end"),
            F.when(F.col("o_orderkey") % 10 != 0, F.col("c_nationkey")).alias("unit_id"))
        flag = F.col("l_returnflag")
        self.line = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
            t.part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("doc_uid"), F.col("s_nationkey").alias("unit_id"),
            F.when(flag == "A", "depositante").when(flag == "R", "afiliacao_autor").otherwise("responsavel").alias("role"),
            F.concat(F.lit("PE"), F.col("l_suppkey").cast("string")).alias("person_id"), "l_linenumber", "l_partkey",
            "l_suppkey", "p_type", "p_brand", "p_name")
        self.doc_units = self.line.select("doc_uid", "unit_id", "role").distinct()
        self.products = self.line.select("doc_uid", F.col("p_brand").alias("axis")).distinct()
        self.themes = self.line.groupBy("doc_uid").agg(
            F.min_by("p_type", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("axis"))
        self.keywords = self.line.select(
            "doc_uid", F.col("p_name").alias("keyword"), F.upper("p_name").alias("raw")).distinct()
        n = F.col("l_linenumber")
        self.links = self.line.select(
            "doc_uid", "person_id",
            F.when(n == 1, "lider").when(n == 2, "tecnologia").when(n == 3, "membro").otherwise("autor").alias("role")).distinct()


# --- marts -----------------------------------------------------------------------------------------------------------


@query("document_mart", """
WITH w AS (SELECT source AS work, arg_max(doc_id, (n_chars, -doc_id)) AS rep, count(*) AS n FROM documents GROUP BY source)
SELECT 'P:' || o_orderkey AS doc_uid, 'projeto' AS kind, o_orderpriority AS title, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(year(o_orderdate) + 2 AS INTEGER) AS year_end,
       o_orderstatus AS category, o_orderstatus AS detail, CAST(o_custkey % 20 AS VARCHAR) AS unit_id, NULL AS representative, NULL AS n_records FROM orders
UNION ALL SELECT 'OB:' || work, 'publicacao', work, 2024, 2024, 'grupo', d.lang, d.source, CAST(rep AS VARCHAR), n FROM w JOIN documents d ON d.doc_id = rep
UNION ALL SELECT 'T:' || event_id, 'tecnologia', event_type, CAST(year(ts) AS INTEGER), CAST(year(ts) AS INTEGER), event_type, 'x', CAST(user_id % 20 AS VARCHAR), NULL, NULL FROM events
""")
def document_mart(t: Tables):
    year = F.year("o_orderdate")
    projects = t.orders.select(
        F.concat(F.lit("P:"), F.col("o_orderkey").cast("string")).alias("doc_uid"), F.col("o_orderpriority").alias("title"),
        F.lit(None).cast("string").alias("abstract"), year.alias("year"), (year + 2).alias("year_end"),
        F.col("o_orderstatus").alias("state"), (F.col("o_custkey") % 20).cast("string").alias("unit_id"), F.lit("").alias("url"))
    grouped = t.documents.groupBy("source").agg(
        F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("rep"), F.count("*").alias("n_records"))
    works = grouped.select(
        F.concat(F.lit("OB:"), "source").alias("work"), F.col("rep").cast("string").alias("representative"),
        F.col("source").alias("title"), F.lit(2024).alias("year"), F.lit("grupo").alias("kind_group"), "n_records")
    records = t.documents.select(
        F.col("doc_id").cast("string").alias("doc_uid"), F.lit("").alias("abstract"), F.col("lang").alias("type"),
        F.col("source").alias("unit_id"), F.lit("").alias("url"))
    technologies = t.events.select(
        F.concat(F.lit("T:"), F.col("event_id").cast("string")).alias("doc_uid"), F.col("event_type").alias("title"),
        F.lit("").alias("abstract"), F.year("ts").alias("year"), F.col("event_type").alias("type"), F.lit("x").alias("subtype"),
        (F.col("user_id") % 20).cast("string").alias("unit_id"), F.lit("").alias("url"))
    return ind.document_mart(projects, works, records, technologies).drop("abstract", "url")


@query("work_lift", f"""
WITH {BASE} m AS (SELECT o_orderkey AS doc_uid, o_orderkey // 3 + 10000000 AS work FROM orders WHERE o_orderstatus <> 'P'),
pl AS (SELECT doc_uid, person_id, role, CASE WHEN role = 'autor' THEN 'B' WHEN role = 'membro' THEN 'C' ELSE 'A' END AS level FROM lk)
SELECT coalesce(work, doc_uid) AS doc_uid, person_id, role, min(level) AS level FROM pl LEFT JOIN m USING (doc_uid) WHERE level <> 'C' GROUP BY ALL
""")
def work_lift(t: Tables):
    """IN-2, J-15 for people."""
    level = F.when(F.col("role") == "autor", "B").when(F.col("role") == "membro", "C").otherwise("A")
    return ind.person_mart(Base(t).links.withColumn("level", level), record_work(t))


def record_work(t: Tables):
    return t.orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("doc_uid"), (F.floor(F.col("o_orderkey") / 3) + 10000000).alias("work"))


@query("unit_and_keyword_lift", f"""
WITH {BASE} m AS (SELECT o_orderkey AS doc_uid, o_orderkey // 3 + 10000000 AS work FROM orders WHERE o_orderstatus <> 'P')
SELECT DISTINCT 'unit' AS what, coalesce(work, doc_uid) AS doc_uid, unit_id || ' ' || role AS value FROM du LEFT JOIN m USING (doc_uid)
UNION ALL SELECT DISTINCT 'keyword', coalesce(work, doc_uid), keyword FROM kw LEFT JOIN m USING (doc_uid)
""")
def unit_and_keyword_lift(t: Tables):
    b, m = Base(t), record_work(t)
    rows = lambda df, what, value: df.select(F.lit(what).alias("what"), "doc_uid", value.alias("value"))
    return rows(ind.unit_mart(b.doc_units, m), "unit", F.concat_ws(" ", F.col("unit_id").cast("string"), "role")).unionByName(
        rows(ind.keyword_mart(b.keywords, m), "keyword", F.col("keyword")))


# --- totals and series -----------------------------------------------------------------------------------------------


@query("kpis", f"""
WITH {BASE} i AS (SELECT * FROM docs WHERE year BETWEEN 1996 AND 1999),
u AS (SELECT doc_uid, count(DISTINCT unit_id) AS k FROM du WHERE role IN ('depositante', 'afiliacao_autor') GROUP BY 1)
SELECT count(*) FILTER (WHERE kind = 'projeto') AS n_projeto, count(*) FILTER (WHERE kind = 'publicacao') AS n_publicacao,
       count(*) FILTER (WHERE kind = 'tecnologia') AS n_tecnologia, (SELECT count(DISTINCT person_id) FROM lk JOIN i USING (doc_uid)) AS n_people,
       {s6("(SELECT avg(CASE WHEN k > 1 THEN 1.0::DOUBLE ELSE 0 END) FROM u JOIN i USING (doc_uid))")} AS collaboration_rate FROM i
""")
def kpis(t: Tables):
    b = Base(t)
    return ind.institution_kpis(b.docs, b.links, b.doc_units, 1996, 1999).withColumn(
        "collaboration_rate", r6(F.col("collaboration_rate")))


@query("totals_by_kind", f"WITH {BASE} z AS (SELECT 1) SELECT kind, count(*) AS n FROM docs WHERE year BETWEEN 1997 AND 2000 GROUP BY 1")
def totals_by_kind(t: Tables):
    return ind.totals(Base(t).docs, 1997, 2000)


@query("annual_series", f"""
WITH {BASE} z AS (SELECT 1)
SELECT year, kind, unit_id, count(*) AS n, CASE WHEN count(*) >= 15 THEN count(*) END AS shown FROM docs GROUP BY ALL
""")
def annual_series(t: Tables):
    return ind.annual_series(Base(t).docs, ["kind", "unit_id"], 15)


@query("collaboration_rate", f"""
WITH {BASE} u AS (SELECT doc_uid, count(DISTINCT unit_id) AS k FROM du WHERE role IN ('depositante', 'afiliacao_autor') GROUP BY 1)
SELECT year, count(*) AS n, count(*) FILTER (WHERE k > 1) AS n_collaborative,
       {s6("CASE WHEN count(*) >= 30 THEN 100.0 * count(*) FILTER (WHERE k > 1) / count(*) END")} AS pct FROM u JOIN docs USING (doc_uid) GROUP BY year
""")
def collaboration_rate(t: Tables):
    b = Base(t)
    return ind.collaboration_rate(b.doc_units, b.docs, by_year=True).withColumn("pct", r6(F.col("pct")))


@query("corpus_span", f"WITH {BASE} z AS (SELECT 1) SELECT min(year) AS first, max(year) AS last FROM docs")
def corpus_span(t: Tables):
    return ind.span(Base(t).docs)


@query("units_with_counts", f"""
WITH {BASE} z AS (SELECT 1)
SELECT n.n_nationkey AS unit_id, n_name, count(DISTINCT doc_uid) AS n_docs FROM nation n LEFT JOIN du ON du.unit_id = n_nationkey GROUP BY ALL
""")
def units_with_counts(t: Tables):
    units = t.nation.select(F.col("n_nationkey").alias("unit_id"), "n_name")
    return ind.units_with_counts(units, Base(t).doc_units)


@query("roles_in_document", f"WITH {BASE} z AS (SELECT 1) SELECT doc_uid, unit_id, string_agg(role, ', ' ORDER BY role) AS roles FROM du GROUP BY ALL")
def roles_in_document(t: Tables):
    return ind.roles(Base(t).doc_units)


# --- specialisation, growth, gaps ------------------------------------------------------------------------------------


@query("specialisation", f"""
WITH {BASE} m AS (SELECT DISTINCT doc_uid, unit_id FROM du), p AS (SELECT unit_id, axis, count(*) AS n_unit FROM m JOIN prod USING (doc_uid) GROUP BY ALL),
a AS (SELECT axis, count(*) AS n_all FROM prod GROUP BY 1), s AS (SELECT unit_id, sum(n_unit) AS nu FROM p GROUP BY 1)
SELECT unit_id, axis, n_unit, n_all, {s6("(n_unit / nu) / (n_all / (SELECT sum(n_all) FROM a))")} AS specialisation FROM p JOIN a USING (axis) JOIN s USING (unit_id) WHERE n_unit >= 3
""")
def specialisation(t: Tables):
    b = Base(t)
    return ind.specialisation(b.doc_units, b.products).withColumn("specialisation", r6(F.col("specialisation")))


@query("growth_keywords", f"""
WITH {BASE} x AS (SELECT keyword AS item, doc_uid, year <= 1998 AS early FROM kw JOIN docs USING (doc_uid) WHERE year BETWEEN 1995 AND 2001),
tt AS (SELECT count(DISTINCT CASE WHEN early THEN doc_uid END) AS t0, count(DISTINCT CASE WHEN NOT early THEN doc_uid END) AS t1 FROM x),
p AS (SELECT item, count(DISTINCT CASE WHEN early THEN doc_uid END) AS before, count(DISTINCT CASE WHEN NOT early THEN doc_uid END) AS after FROM x GROUP BY 1)
SELECT item, before, after, {s6("1000 * before / t0")} AS share_before, {s6("1000 * after / t1")} AS share_after,
       {s6("log2((1000 * after / t1 + 0.5) / (1000 * before / t0 + 0.5))")} AS change FROM p, tt WHERE before + after >= 15
""")
def growth_keywords(t: Tables):
    b = Base(t)
    rows = b.keywords.select(F.col("keyword").alias("item"), "doc_uid").join(b.docs.select("doc_uid", "year"), "doc_uid")
    out = ind.growth(rows, 1995, 2001, 15, 0.5)
    return out.select("item", "before", "after", *[r6(F.col(c)).alias(c) for c in ("share_before", "share_after", "change")])


@query("growth_themes", f"""
WITH {BASE} x AS (SELECT axis AS item, year <= 1998 AS early FROM theme JOIN docs USING (doc_uid) WHERE year BETWEEN 1996 AND 2000),
tt AS (SELECT count(*) FILTER (WHERE early) AS t0, count(*) FILTER (WHERE NOT early) AS t1 FROM x),
p AS (SELECT item, count(*) FILTER (WHERE early) AS before, count(*) FILTER (WHERE NOT early) AS after FROM x WHERE item <> 'ECONOMY' GROUP BY 1)
SELECT item, before, after, {s6("1000 * before / t0")} AS share_before, {s6("1000 * after / t1")} AS share_after,
       {s6("log2((1000 * after / t1 + 0.1) / (1000 * before / t0 + 0.1))")} AS change FROM p, tt WHERE before + after >= 30
""")
def growth_themes(t: Tables):
    b = Base(t)
    rows = b.themes.select(F.col("axis").alias("item"), "doc_uid").join(b.docs.select("doc_uid", "year"), "doc_uid")
    out = ind.growth(rows, 1996, 2000, 30, 0.1, distinct=False, subset=F.col("item") != "ECONOMY")
    return out.select("item", "before", "after", *[r6(F.col(c)).alias(c) for c in ("share_before", "share_after", "change")])


@query("gap_index", f"""
WITH {BASE} x AS (SELECT keyword AS item, doc_uid, kind FROM kw JOIN docs USING (doc_uid)),
n AS (SELECT count(DISTINCT CASE WHEN kind = 'projeto' THEN doc_uid END) AS a, count(DISTINCT CASE WHEN kind = 'publicacao' THEN doc_uid END) AS b,
      count(DISTINCT CASE WHEN kind = 'tecnologia' THEN doc_uid END) AS c FROM x),
p AS (SELECT item, count(DISTINCT CASE WHEN kind = 'projeto' THEN doc_uid END) AS projeto, count(DISTINCT CASE WHEN kind = 'publicacao' THEN doc_uid END) AS publicacao,
      count(DISTINCT CASE WHEN kind = 'tecnologia' THEN doc_uid END) AS tecnologia FROM x GROUP BY 1),
q AS (SELECT item, projeto, publicacao, tecnologia, 1000.0 * projeto / greatest(a, 1) AS pp, 1000.0 * publicacao / greatest(b, 1) AS pu, 1000.0 * tecnologia / greatest(c, 1) AS pt FROM p, n)
SELECT item, projeto, publicacao, tecnologia, {s6('pp')} AS p_projeto, {s6('pu')} AS p_publicacao, {s6('pt')} AS p_tecnologia,
       {s6("log2((pp + 0.5) / (pu + 0.5))")} AS gap FROM q WHERE projeto + publicacao + tecnologia >= 10
""")
def gap_index(t: Tables):
    b = Base(t)
    rows = b.keywords.select(F.col("keyword").alias("item"), "doc_uid").join(b.docs.select("doc_uid", "kind"), "doc_uid")
    out = ind.gap(rows, "projeto", "publicacao", 0.5, min_total=10)
    return out.select("item", *ind.KINDS, *[r6(F.col(c)).alias(c) for c in out.columns if c.startswith("p_") or c == "gap"])


@query("dominant_category", f"""
WITH {BASE} c AS (SELECT unit_id, axis, count(DISTINCT doc_uid) AS n FROM du JOIN theme USING (doc_uid) GROUP BY ALL)
SELECT unit_id, axis, n FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, axis) AS rn FROM c) WHERE rn = 1
""")
def dominant_category(t: Tables):
    b = Base(t)
    return ind.dominant(b.doc_units.join(b.themes, "doc_uid"), "unit_id", "axis")


@query("top_keywords", f"""
WITH {BASE} z AS (SELECT 1)
SELECT keyword, count(DISTINCT doc_uid) AS n, lower(keyword) AS label FROM kw JOIN docs USING (doc_uid) WHERE kind = 'projeto' GROUP BY keyword ORDER BY n DESC, keyword LIMIT 15
""")
def top_keywords(t: Tables):
    b = Base(t)
    return ind.keyword_counts(b.keywords, b.docs.where(F.col("kind") == "projeto"), 15)


@query("top_axes", f"WITH {BASE} z AS (SELECT 1) SELECT axis, count(*) AS n FROM prod JOIN docs USING (doc_uid) WHERE year = 1998 GROUP BY 1 ORDER BY n DESC, axis LIMIT 5")
def top_axes(t: Tables):
    b = Base(t)
    return ind.top_axes(b.products, b.docs.where(F.col("year") == 1998), 5)


@query("axis_share_by_year", f"""
WITH {BASE} z AS (SELECT 1) SELECT year, {s6("1000.0 * count(*) FILTER (WHERE axis = 'PROMO') / count(*)")} AS per_mille FROM theme JOIN docs USING (doc_uid) GROUP BY 1
""")
def axis_share_by_year(t: Tables):
    b = Base(t)
    return ind.axis_share(b.themes, b.docs, "PROMO").withColumn("per_mille", r6(F.col("per_mille")))


# --- people ----------------------------------------------------------------------------------------------------------


@query("person_profile", f"""
WITH {BASE} m AS (SELECT * FROM lk JOIN docs USING (doc_uid) WHERE person_id = 'PE7')
SELECT count(DISTINCT CASE WHEN role = 'lider' THEN doc_uid END) AS n_led, count(DISTINCT CASE WHEN kind = 'publicacao' THEN doc_uid END) AS n_publications,
       min(year) AS first, max(year) AS last FROM m
""")
def person_profile(t: Tables):
    b = Base(t)
    return ind.person_profile(b.links, b.docs, "PE7")


@query("theme_heat", f"""
WITH {BASE} m AS (SELECT DISTINCT doc_uid FROM lk WHERE person_id = 'PE7'), r AS (SELECT axis, year FROM m JOIN prod USING (doc_uid) JOIN docs USING (doc_uid)),
b AS (SELECT axis FROM r GROUP BY axis ORDER BY count(*) DESC, axis LIMIT 12)
SELECT axis, CAST(floor(year / 5) * 5 AS INTEGER) AS start, CAST(floor(year / 5) * 5 AS INTEGER) || '–' || CAST(floor(year / 5) * 5 + 4 AS INTEGER) AS period, count(*) AS n
FROM r WHERE axis IN (SELECT axis FROM b) GROUP BY ALL
""")
def theme_heat(t: Tables):
    b = Base(t)
    return ind.theme_heat(b.links, b.docs, b.products, "PE7")


@query("people_of_unit", f"""
WITH {BASE} z AS (SELECT 1)
SELECT person_id, count(DISTINCT CASE WHEN kind = 'publicacao' THEN doc_uid END) AS works, count(DISTINCT CASE WHEN role = 'lider' THEN doc_uid END) AS led,
       min(year) AS since, max(year) AS until FROM lk JOIN docs USING (doc_uid) JOIN supplier ON 'PE' || s_suppkey = person_id WHERE s_nationkey IN (3, 4, 5)
GROUP BY 1 ORDER BY works DESC, led DESC, person_id LIMIT 100
""")
def people_of_unit(t: Tables):
    b = Base(t)
    people = t.supplier.where(F.col("s_nationkey").isin(3, 4, 5)).select(
        F.concat(F.lit("PE"), F.col("s_suppkey").cast("string")).alias("person_id"))
    return ind.people_of(b.links, b.docs, people)


# --- territory and programme -----------------------------------------------------------------------------------------

LOC = BASE + """
loc AS (SELECT DISTINCT doc_uid, CASE role WHEN 'depositante' THEN 'municipio_citado' WHEN 'afiliacao_autor' THEN 'estado_citado' ELSE 'sede_unidade' END AS source,
        'S' || (unit_id % 9) AS state, CASE WHEN role <> 'afiliacao_autor' THEN unit_id END AS place_id FROM du),
"""


def locations(b: Base):
    role = F.col("role")
    return b.doc_units.select(
        "doc_uid", F.when(role == "depositante", "municipio_citado").when(role == "afiliacao_autor", "estado_citado")
        .otherwise("sede_unidade").alias("source"), F.concat(F.lit("S"), (F.col("unit_id") % 9).cast("string")).alias("state"),
        F.when(role != "afiliacao_autor", F.col("unit_id")).alias("place_id")).distinct()


@query("territorial_rollup", f"""
WITH {LOC} g AS (SELECT state, count(DISTINCT doc_uid) AS documents, count(DISTINCT doc_uid) FILTER (WHERE source <> 'sede_unidade') AS cited
      FROM loc JOIN docs USING (doc_uid) WHERE year BETWEEN 1996 AND 2000 GROUP BY 1)
SELECT state, documents, cited, documents - cited AS by_seat, round(100.0 * cited / documents + 1e-9, 0) AS pct_cited FROM g
""")
def territorial_rollup(t: Tables):
    b = Base(t)
    return ind.by_state(locations(b), b.docs.where(sc.in_period("year", 1996, 2000)))


@query("municipal_rollup", f"""
WITH {LOC} g AS (SELECT place_id, count(DISTINCT doc_uid) FILTER (WHERE source <> 'sede_unidade') AS cited, count(DISTINCT doc_uid) FILTER (WHERE source = 'sede_unidade') AS by_seat
      FROM loc JOIN docs USING (doc_uid) JOIN theme USING (doc_uid) WHERE place_id IS NOT NULL AND axis = 'PROMO' AND kind = 'publicacao' GROUP BY 1)
SELECT *, cited + by_seat AS documents FROM g
""")
def municipal_rollup(t: Tables):
    """IN-14 with the optional theme and kind filters of PF-7."""
    b = Base(t)
    chosen = ind.apply_filters(b.docs, F.col("kind") == "publicacao", ind.by_id(b.themes, "axis", "PROMO"), None)
    return ind.by_municipality(locations(b), chosen)


@query("location_sources", f"""
WITH {LOC} o AS (SELECT doc_uid, min(CASE source WHEN 'municipio_citado' THEN 1 WHEN 'estado_citado' THEN 2 ELSE 3 END) AS r FROM loc GROUP BY 1)
SELECT CASE r WHEN 1 THEN 'municipio_citado' WHEN 2 THEN 'estado_citado' ELSE 'sede_unidade' END AS source, count(*) AS n,
       {s6("100.0 * count(*) / (SELECT count(*) FROM o)")} AS pct FROM o GROUP BY r
""")
def location_sources(t: Tables):
    return ind.location_sources(locations(Base(t))).withColumn("pct", r6(F.col("pct")))


@query("exclusive_rollup", f"""
WITH {BASE} bm AS (SELECT DISTINCT doc_uid, 'B' || (unit_id % 6) AS biome FROM du WHERE role = 'depositante'),
nb AS (SELECT *, count(*) OVER (PARTITION BY doc_uid) AS n_biomes FROM bm), r AS (SELECT * FROM nb JOIN docs USING (doc_uid) WHERE n_biomes < 6)
SELECT biome, count(DISTINCT doc_uid) AS documents, {s6("100.0 * count(DISTINCT doc_uid) / (SELECT count(DISTINCT doc_uid) FROM r)")} AS pct FROM r GROUP BY 1
""")
def exclusive_rollup(t: Tables):
    b = Base(t)
    biomes = b.doc_units.where(F.col("role") == "depositante").select(
        "doc_uid", F.concat(F.lit("B"), (F.col("unit_id") % 6).cast("string")).alias("biome")).distinct()
    tagged = sh.attach_group(biomes, ["doc_uid"], n_biomes=F.count("*")).withColumn("source", F.lit("declarado"))
    return ind.by_biome(tagged, b.docs, "declarado", False).withColumn("pct", r6(F.col("pct")))


REFS = BASE + """
refs AS (SELECT DISTINCT p_type || '/' || p_size AS reference, p_type AS portfolio, 'O' || (p_size % 4) AS objective FROM part),
dr AS (SELECT doc_uid, arg_min(line.p_type || '/' || p_size, (l_linenumber, l_partkey, l_suppkey)) AS reference FROM line JOIN part ON p_partkey = l_partkey GROUP BY 1),
"""


def references(t: Tables, b: Base):
    refs = t.part.select(
        F.concat_ws("/", "p_type", F.col("p_size").cast("string")).alias("reference"), F.col("p_type").alias("portfolio"),
        F.concat(F.lit("O"), (F.col("p_size") % 4).cast("string")).alias("objective")).distinct()
    sized = b.line.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    best = sized.groupBy("doc_uid").agg(F.min_by(
        F.concat_ws("/", "p_type", F.col("p_size").cast("string")), F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("reference"))
    return refs, best.join(b.docs.select("doc_uid", "kind"), "doc_uid")


@query("programme_rollup", f"WITH {REFS} z AS (SELECT 1) SELECT objective, kind, count(*) AS n FROM dr JOIN docs USING (doc_uid) JOIN refs USING (reference) GROUP BY ALL")
def programme_rollup(t: Tables):
    refs, ref = references(t, Base(t))
    return ind.by_programme(ref, refs, "objective")


OBJECTIVES = ["O0", "O1", "O2", "O3"]


@query("programme_matrix", f"""
WITH {REFS} m AS (SELECT DISTINCT doc_uid, unit_id, objective FROM dr JOIN refs USING (reference) JOIN du USING (doc_uid)),
g AS (SELECT unit_id, {', '.join(f"count(*) FILTER (WHERE objective = '{o}') AS {o}" for o in OBJECTIVES)}, count(*) AS n_docs FROM m GROUP BY 1)
SELECT unit_id, {', '.join(f"round(100.0 * {o} / n_docs + 1e-9, 0) AS {o}" for o in OBJECTIVES)}, n_docs FROM g WHERE n_docs >= 10
""")
def programme_matrix(t: Tables):
    b = Base(t)
    refs, ref = references(t, b)
    items = ref.join(refs.select("reference", F.col("objective").alias("item")), "reference").join(
        b.doc_units.select("doc_uid", "unit_id"), "doc_uid")
    return ind.unit_item_matrix(items, OBJECTIVES)


@query("programme_structure", f"""
WITH {REFS} a AS (SELECT objective, portfolio, count(DISTINCT reference) AS n_references FROM refs GROUP BY ALL),
d AS (SELECT objective, portfolio, count(DISTINCT doc_uid) AS n_docs FROM dr JOIN refs USING (reference) JOIN docs USING (doc_uid) WHERE kind = 'projeto' GROUP BY ALL)
SELECT objective, portfolio, n_references, coalesce(n_docs, 0) AS n_docs FROM a LEFT JOIN d USING (objective, portfolio)
""")
def programme_structure(t: Tables):
    b = Base(t)
    refs, ref = references(t, b)
    some = ref.join(b.docs.where(F.col("kind") == "projeto").select("doc_uid"), "doc_uid", "left_semi")
    return ind.programme_structure(refs, some, ["objective", "portfolio"])


@query("item_units", f"""
WITH {REFS} m AS (SELECT DISTINCT doc_uid, unit_id, objective AS item FROM dr JOIN refs USING (reference) JOIN du USING (doc_uid)),
o AS (SELECT avg(CASE WHEN item = 'O1' THEN 1.0::DOUBLE ELSE 0 END) AS o FROM (SELECT DISTINCT doc_uid, item FROM m)),
g AS (SELECT unit_id, count(*) AS t, count(*) FILTER (WHERE item = 'O1') AS documents FROM m GROUP BY 1)
SELECT unit_id, documents, {s6("100.0 * documents / t")} AS pct_unit, {s6("(documents / t) / o")} AS specialisation FROM g, o WHERE documents > 0
""")
def item_units(t: Tables):
    b = Base(t)
    refs, ref = references(t, b)
    items = ref.join(refs.select("reference", F.col("objective").alias("item")), "reference").join(
        b.doc_units.select("doc_uid", "unit_id"), "doc_uid")
    out = ind.item_units(items, "O1")
    return out.select("unit_id", "documents", r6(F.col("pct_unit")).alias("pct_unit"), r6(F.col("specialisation")).alias("specialisation"))


@query("inheritance_flag", f"""
WITH {BASE} mp AS (SELECT DISTINCT p_type AS axis, 'I' || (length(p_type) % 3) AS i1, CASE WHEN length(p_type) % 2 = 0 THEN 'I' || (length(p_type) % 4) END AS i2 FROM part),
r AS (SELECT doc_uid, i1, i2, CASE WHEN kind = 'projeto' THEN coalesce(year_end, 9999) >= 2000 ELSE year >= 2000 END AS recent FROM theme JOIN mp USING (axis) JOIN docs USING (doc_uid)),
p AS (SELECT i1 AS item, count(*) AS n_primary, count(*) FILTER (WHERE recent) AS n_recent FROM r GROUP BY 1),
s AS (SELECT i2 AS item, count(DISTINCT doc_uid) AS n_secondary FROM r WHERE i2 IS NOT NULL AND i2 <> i1 GROUP BY 1)
SELECT item, coalesce(n_primary, 0) AS n_primary, coalesce(n_recent, 0) AS n_recent, coalesce(n_secondary, 0) AS n_secondary FROM p FULL JOIN s USING (item)
""")
def inheritance_flag(t: Tables):
    b = Base(t)
    size = F.length("p_type")
    mapping = t.part.select("p_type").distinct().select(
        F.col("p_type").alias("theme"), F.concat(F.lit("I"), (size % 3).cast("string")).alias("item_1"),
        F.when(size % 2 == 0, F.concat(F.lit("I"), (size % 4).cast("string"))).alias("item_2"))
    return ind.inherit(b.themes.withColumnRenamed("axis", "theme"), mapping, b.docs, sc.in_scope("kind", "year", "year_end", 2000))


# --- who works on what -----------------------------------------------------------------------------------------------

WHO = BASE + """
mx AS (SELECT max(year) AS y FROM docs),
v AS (SELECT person_id, doc_uid, max(CASE role WHEN 'lider' THEN 3 WHEN 'tecnologia' THEN 2 ELSE 1 END) AS w, bool_or(role = 'lider') AS led, bool_or(role = 'tecnologia') AS tec FROM lk GROUP BY ALL),
vw AS (SELECT v.*, year, year >= (SELECT y FROM mx) - 4 + 1 AS recent, w * CASE WHEN year >= (SELECT y FROM mx) - 4 + 1 THEN 1.0::DOUBLE ELSE 0.5 END AS weight FROM v JOIN docs USING (doc_uid)),
sz AS (SELECT person_id, count(*) AS n_all, max(year) AS last_year FROM vw GROUP BY 1),
x AS (SELECT * FROM vw JOIN prod USING (doc_uid)),
g AS (SELECT person_id, axis, count(*) AS n_docs, count(*) FILTER (WHERE recent) AS n_recent, count(*) FILTER (WHERE led) AS n_led, count(*) FILTER (WHERE tec) AS n_technologies, sum(weight) AS weight
      FROM x GROUP BY ALL HAVING count(*) >= 3 AND count(*) FILTER (WHERE recent) >= 1),
ev AS (SELECT person_id, axis, doc_uid, row_number() OVER (PARTITION BY person_id, axis ORDER BY recent DESC, weight DESC, year DESC, doc_uid) AS rk FROM x),
el AS (SELECT person_id, axis, string_agg(CAST(doc_uid AS VARCHAR), ';' ORDER BY rk) AS evidence FROM ev WHERE rk <= 5 GROUP BY ALL),
who AS (SELECT person_id, axis, n_docs, n_recent, n_led, n_technologies, round(weight, 2) AS weight, round(n_docs / n_all + 1e-9, 3) AS focus, evidence FROM g JOIN sz USING (person_id) JOIN el USING (person_id, axis)),
"""


def who(b: Base):
    weights = ind.role_weights(b.links, b.docs, years=4)
    return weights, ind.who_works(weights, b.products)


@query("who_works_on_it", f"WITH {WHO} z AS (SELECT 1) SELECT * FROM who")
def who_works_on_it(t: Tables):
    return who(Base(t))[1]


@query("units_on_it", f"""
WITH {WHO} pu AS (SELECT person_id, axis, s_nationkey AS unit_id FROM who JOIN supplier ON 'PE' || s_suppkey = person_id),
n AS (SELECT axis, unit_id, count(DISTINCT person_id) AS n_people FROM pu GROUP BY ALL),
u AS (SELECT axis, unit_id, count(*) AS n_docs, count(*) FILTER (WHERE year >= (SELECT y FROM mx) - 10 + 1) AS n_recent, count(*) FILTER (WHERE kind = 'projeto') AS n_projeto,
      count(*) FILTER (WHERE kind = 'publicacao') AS n_publicacao, count(*) FILTER (WHERE kind = 'tecnologia') AS n_tecnologia FROM prod JOIN docs USING (doc_uid) WHERE unit_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 3)
SELECT u.*, coalesce(n_people, 0) AS n_people FROM u LEFT JOIN n USING (axis, unit_id)
""")
def units_on_it(t: Tables):
    b = Base(t)
    people = t.supplier.select(F.concat(F.lit("PE"), F.col("s_suppkey").cast("string")).alias("person_id"),
                               F.col("s_nationkey").alias("unit_id"))
    listed = who(b)[1].select("person_id", "axis").join(people, "person_id")
    return ind.which_units(b.docs, b.products, ["axis"], listed)


@query("top_units_per_pair", f"""
WITH {BASE} pr AS (SELECT prod.doc_uid, prod.axis AS a, theme.axis AS b FROM prod JOIN theme USING (doc_uid)),
u AS (SELECT a, b, unit_id, count(*) AS n_docs FROM pr JOIN docs USING (doc_uid) WHERE unit_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY n_docs DESC, unit_id) AS rk FROM u)
SELECT a, b, unit_id, n_docs FROM r WHERE rk <= 5
""")
def top_units_per_pair(t: Tables):
    b = Base(t)
    pairs = b.products.withColumnRenamed("axis", "a").join(b.themes.withColumnRenamed("axis", "b"), "doc_uid")
    return ind.top_units(ind.which_units(b.docs, pairs, ["a", "b"]), ["a", "b"]).select("a", "b", "unit_id", "n_docs")


@query("product_theme_network", f"""
WITH {BASE} mx AS (SELECT max(year) AS y FROM docs), pr AS (SELECT prod.doc_uid, prod.axis AS a, theme.axis AS b, kind, year FROM prod JOIN theme USING (doc_uid) JOIN docs USING (doc_uid)),
p0 AS (SELECT a, b, count(*) AS n_docs, count(*) FILTER (WHERE year >= (SELECT y FROM mx) - 9) AS n_recent FROM pr GROUP BY ALL HAVING count(*) >= 3),
p AS (SELECT a, b, n_docs, n_recent FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n_docs DESC, b) AS rk FROM p0) WHERE rk <= 12),
df AS (SELECT keyword, count(*) AS df FROM kw GROUP BY 1),
c AS (SELECT a, b, keyword, count(*) AS n FROM pr JOIN p USING (a, b) JOIN kw USING (doc_uid) GROUP BY ALL HAVING count(*) >= 2),
w AS (SELECT a, b, keyword, n, round(n * ln((SELECT count(*) FROM docs) / df), 9) AS w FROM c JOIN df USING (keyword) WHERE NOT starts_with(keyword, 'red')),
wl AS (SELECT a, b, string_agg(lower(keyword) || ':' || n, ';' ORDER BY rk) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY w DESC, keyword) AS rk FROM w) WHERE rk <= 8 GROUP BY ALL),
e AS (SELECT pr.*, row_number() OVER (PARTITION BY a, b, kind ORDER BY year DESC, doc_uid) AS rk FROM pr),
el AS (SELECT a, b, string_agg(CAST(doc_uid AS VARCHAR), ';' ORDER BY year DESC, doc_uid) AS docs FROM e WHERE rk <= CASE kind WHEN 'publicacao' THEN 12 ELSE 4 END GROUP BY ALL)
SELECT p.*, coalesce(keywords, '') AS keywords, el.docs FROM p LEFT JOIN wl USING (a, b) JOIN el USING (a, b)
""")
def product_theme_network(t: Tables):
    b = Base(t)
    own = t.part.select(F.col("p_brand").alias("a")).distinct().select("a", F.lit("red").alias("term"), F.lit(True).alias("prefix"))
    return ind.axis_network(b.products.withColumnRenamed("axis", "a"), b.themes.withColumnRenamed("axis", "b"), b.docs,
                            b.keywords, own)


# --- extracts and reports --------------------------------------------------------------------------------------------


@query("enrichment_row", f"""
WITH {BASE} a AS (SELECT doc_uid, string_agg(axis, ';' ORDER BY axis) AS products FROM prod GROUP BY 1),
u AS (SELECT doc_uid, array_to_string(list_sort(list(DISTINCT CAST(unit_id AS VARCHAR))), ';') AS units FROM du WHERE role = 'depositante' GROUP BY 1),
h AS (SELECT doc_uid, axis AS theme FROM theme WHERE axis <> 'PROMO')
SELECT doc_uid, products, units, theme FROM docs LEFT JOIN a USING (doc_uid) LEFT JOIN u USING (doc_uid) LEFT JOIN h USING (doc_uid)
WHERE products IS NOT NULL OR units IS NOT NULL OR theme IS NOT NULL
""")
def enrichment_row(t: Tables):
    b = Base(t)
    return ind.enrichment(b.docs, {
        "products": (b.products, "axis"), "units": (b.doc_units.where(F.col("role") == "depositante"), "unit_id"),
        "theme": (b.themes.where(F.col("axis") != "PROMO"), "axis")})


@query("public_extract", f"""
WITH {WHO} z AS (SELECT 1)
SELECT 'PS' || substr(sha1('PE' || s_suppkey), 1, 10) AS person, s_name AS display_name, s_nationkey AS unit_id, n_all AS n_docs, last_year
FROM supplier JOIN sz ON person_id = 'PE' || s_suppkey WHERE person_id IN (SELECT person_id FROM who)
""")
def public_extract(t: Tables):
    weights, rows = who(Base(t))
    people = t.supplier.select(F.concat(F.lit("PE"), F.col("s_suppkey").cast("string")).alias("person_id"),
                               F.col("s_name").alias("display_name"), F.col("s_nationkey").alias("unit_id"))
    return ind.people_extract(people, weights, rows)


@query("referenced_documents", f"""
WITH {WHO} r AS (SELECT DISTINCT unnest(string_split(evidence, ';')) AS d FROM who) SELECT doc_uid, kind, year FROM docs WHERE CAST(doc_uid AS VARCHAR) IN (SELECT d FROM r)
""")
def referenced_documents(t: Tables):
    b = Base(t)
    return ind.referenced_docs(who(b)[1], "evidence", b.docs.select("doc_uid", "kind", "year"))


@query("published_tables", f"""
WITH {BASE} z AS (SELECT 1) SELECT doc_uid, role, level FROM (SELECT doc_uid, person_id, role, CASE WHEN role = 'autor' THEN 'baixa' WHEN role = 'lider' THEN 'alta' ELSE 'media' END AS level FROM lk)
WHERE level IN ('alta', 'media')
""")
def published_tables(t: Tables):
    """IO-12: the columns and rows a published table shows."""
    level = F.when(F.col("role") == "autor", "baixa").when(F.col("role") == "lider", "alta").otherwise("media")
    return io.published(Base(t).links.withColumn("level", level),
                        io.Published(("doc_uid", "role", "level"), "level IN ('alta', 'media')"))


@query("quality_metrics", f"""
WITH {BASE} c AS (SELECT role, CASE WHEN person_id < 'PE5' THEN 'A' ELSE 'B' END AS level, count(*) AS n FROM lk GROUP BY ALL)
SELECT 'rows documents' AS metric, CAST(count(*) AS DOUBLE) AS value FROM docs UNION ALL SELECT 'rows links', count(*) FROM lk
UNION ALL SELECT 'links ' || role || ' ' || level, n FROM c
UNION ALL SELECT 'pct ' || role || ' ' || level, {s6("100.0 * n / (sum(n) OVER (PARTITION BY role))")} FROM c
UNION ALL SELECT 'share open', {s6("avg(CASE WHEN year_end IS NULL THEN 1.0::DOUBLE ELSE 0 END)")} FROM docs
UNION ALL SELECT 'first ' || kind, min(year) FROM docs GROUP BY kind UNION ALL SELECT 'last ' || kind, max(year) FROM docs GROUP BY kind
UNION ALL SELECT 'count open', count(*) FROM docs WHERE year_end IS NULL
UNION ALL SELECT 'count several roles', count(*) FROM (SELECT doc_uid FROM lk GROUP BY 1 HAVING count(DISTINCT role) > 1)
UNION ALL SELECT 'count links in base', count(*) FROM lk WHERE doc_uid IN (SELECT doc_uid FROM docs)
""")
def quality_metrics(t: Tables):
    b = Base(t)
    links = b.links.withColumn("level", F.when(F.col("person_id") < "PE5", "A").otherwise("B"))
    still_open = F.col("year_end").isNull()
    known = links.join(b.docs.select("doc_uid"), "doc_uid", "left_semi")
    out = ind.quality_metrics(
        {"documents": b.docs, "links": links}, links, {"open": (b.docs, still_open)},
        {k: (b.docs.where(F.col("kind") == k), "year") for k in ind.KINDS},
        {"open": (b.docs, still_open), "several roles": (ind.several(links, "doc_uid", "role"), F.lit(True)),
         "links in base": (known, F.lit(True))})
    return out.withColumn("value", F.when(F.floor("value") == F.col("value"), F.col("value")).otherwise(r6(F.col("value"))))


@query("theme_table", f"""
WITH {BASE} z AS (SELECT 1)
SELECT axis AS theme, count(*) FILTER (WHERE kind = 'projeto') AS projeto, count(*) FILTER (WHERE kind = 'publicacao') AS publicacao, count(*) FILTER (WHERE kind = 'tecnologia') AS tecnologia,
       lower(axis) AS label FROM theme JOIN docs USING (doc_uid) GROUP BY axis
""")
def theme_table(t: Tables):
    b = Base(t)
    labels = t.part.select(F.col("p_type").alias("theme"), F.lower("p_type").alias("label")).distinct()
    return ind.theme_table(b.themes.withColumnRenamed("axis", "theme"), b.docs, labels)


@query("theme_sheet", f"""
WITH {BASE} low AS (SELECT axis AS theme, 2 AS level, 'M ' || split_part(axis, ' ', 1) AS parent, lower(axis) AS label, count(*) AS n_documents FROM theme JOIN docs USING (doc_uid) GROUP BY axis),
top AS (SELECT parent AS theme, 1 AS level, CAST(NULL AS VARCHAR) AS parent, 'grupo ' || parent AS label, sum(n_documents) AS n_documents FROM low GROUP BY parent)
SELECT l.theme, l.level, t.label AS parent_label, l.label AS automatic_label, CAST(l.n_documents AS BIGINT) AS n_documents, '' AS label
FROM (SELECT * FROM low UNION ALL SELECT * FROM top) l LEFT JOIN top t ON t.theme = l.parent
""")
def theme_sheet(t: Tables):
    b = Base(t)
    counts = b.themes.join(b.docs.select("doc_uid"), "doc_uid").groupBy(F.col("axis").alias("theme")).agg(F.count("*").alias("n_documents"))
    low = counts.select("theme", F.lit(2).alias("level"), F.concat(F.lit("M "), F.split("theme", " ")[0]).alias("parent"), F.lower("theme").alias("label"), "n_documents")
    top = low.groupBy(F.col("parent").alias("theme")).agg(F.sum("n_documents").alias("n_documents")).select(
        "theme", F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent"), F.concat(F.lit("grupo "), "theme").alias("label"), "n_documents")
    return ind.theme_sheet(low.unionByName(top))


@query("curation_sheet", """
WITH r AS (SELECT source, doc_id, substr(split_part(text, chr(10), 1), 1, 90) AS title, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rk FROM documents)
SELECT source AS theme, string_agg(title, ' || ' ORDER BY rk) AS examples, '' AS decision FROM r WHERE rk <= 3 GROUP BY 1
""")
def curation_sheet(t: Tables):
    themes = t.documents.select(F.col("source").alias("theme")).distinct()
    scored = t.documents.select(F.col("doc_id").alias("doc_uid"), F.col("source").alias("theme"), F.col("n_chars").alias("score"))
    titles = t.documents.select(F.col("doc_id").alias("doc_uid"), F.substring_index("text", "\n", 1).alias("title"))
    return ind.curation_sheet(themes, scored, titles)


@query("checked_mapping", """
SELECT DISTINCT p_type AS theme, 'I' || (length(p_type) % 3) AS item_1, CASE WHEN length(p_type) % 2 = 0 THEN 'I' || (length(p_type) % 4) END AS item_2 FROM part
""")
def checked_mapping(t: Tables):
    size = F.length("p_type")
    themes = t.part.select(F.col("p_type").alias("theme")).distinct()
    mapping = t.part.select("p_type").distinct().select(
        F.col("p_type").alias("theme"), F.concat(F.lit("I"), (size % 3).cast("string")).alias("item_1"),
        F.when(size % 2 == 0, F.concat(F.lit("I"), (size % 4).cast("string"))).alias("item_2"))
    codes = t.region.select(F.concat(F.lit("I"), F.col("r_regionkey").cast("string")).alias("item"))
    return ind.check_mapping(mapping, themes, codes)


@query("items_in_parent", f"""
WITH {BASE} x AS (SELECT theme.axis AS parent, prod.axis AS item, doc_uid FROM prod JOIN theme USING (doc_uid)),
s AS (SELECT parent, count(DISTINCT doc_uid) AS t FROM x GROUP BY 1)
SELECT parent, item, count(DISTINCT doc_uid) AS n FROM x JOIN s USING (parent) GROUP BY parent, item, t HAVING count(DISTINCT doc_uid) >= greatest(5, 0.18 * t)
""")
def items_in_parent(t: Tables):
    b = Base(t)
    rows = b.products.withColumnRenamed("axis", "item").join(b.themes.withColumnRenamed("axis", "parent"), "doc_uid")
    return ind.items_in_parent(rows, share=0.18)


@query("citations", """
SELECT DISTINCT l_orderkey // 2 AS work, l_partkey AS origin, CAST(year(o_orderdate) AS INTEGER) AS year FROM lineitem JOIN orders ON o_orderkey = l_orderkey // 2
""")
def citations(t: Tables):
    links = t.lineitem.select(F.col("l_partkey").alias("origin"), F.col("l_orderkey").alias("target"))
    works = t.orders.select(F.col("o_orderkey").alias("doc_uid"), F.floor(F.col("o_orderkey") / 2).alias("work"))
    return ind.citations(links, works, t.orders.select(F.col("o_orderkey").alias("doc_uid"), F.year("o_orderdate").alias("year")))


@query("reconciled_totals", f"""
WITH {BASE} a AS (SELECT year, count(*) AS n FROM docs GROUP BY 1), b AS (SELECT year, count(DISTINCT doc_uid) AS n FROM docs JOIN du USING (doc_uid) GROUP BY 1)
SELECT year, a.n AS a, b.n AS b FROM a FULL JOIN b USING (year) WHERE a.n IS DISTINCT FROM b.n
""")
def reconciled_totals(t: Tables):
    """IN-29: years in which documents and documents with a unit differ (orders without lines)."""
    b = Base(t)
    left = b.docs.groupBy("year").agg(F.count("*").alias("n"))
    right = b.docs.join(b.doc_units.select("doc_uid"), "doc_uid").groupBy("year").agg(F.countDistinct("doc_uid").alias("n"))
    return ind.reconcile(left, right, ["year"], "n")
