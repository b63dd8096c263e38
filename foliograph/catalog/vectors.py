"""Vector operators on the embeddings: three kinds and two languages from label and id."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query, r6, s6
from foliograph.functions import scalars as sc
from foliograph.operators import graph as g
from foliograph.operators import vectors as vc
from foliograph.plans import shapes as sh
from foliograph.plans.session import cut_lineage
from foliograph.streaming import incremental as inc

KINDS = ["projeto", "publicacao", "tecnologia"]

CAL_SQL = """
x AS (SELECT vec_id AS id, label, CASE label % 3 WHEN 0 THEN 'projeto' WHEN 1 THEN 'publicacao' ELSE 'tecnologia' END AS kind,
      CASE WHEN vec_id % 2 = 0 THEN 'pt' ELSE 'en' END AS lang, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
mu AS (SELECT kind, lang, i, avg(v) AS m FROM x GROUP BY ALL),
ce AS (SELECT id, label, kind, lang, i, v - m AS v FROM x JOIN mu USING (kind, lang, i)),
nr AS (SELECT id, sqrt(sum(v * v)) + 1e-12 AS n FROM ce GROUP BY id),
un AS (SELECT id, label, kind, lang, i, v / n AS v FROM ce JOIN nr USING (id)),
cal AS (SELECT id, label, kind, lang, list(v ORDER BY i) AS vec FROM un GROUP BY ALL),
"""


def rows(t: Tables):
    kind = F.array(*[F.lit(k) for k in KINDS])[F.col("label") % 3]
    return t.embeddings.select(
        F.col("vec_id").alias("id"), "label", kind.alias("kind"),
        F.when(F.col("vec_id") % 2 == 0, "pt").otherwise("en").alias("lang"), F.col("embedding").alias("vec"))


def calibrated(t: Tables):
    return vc.calibrate(rows(t), ["kind", "lang"])


@query("vector_calibrate", f"""
WITH {CAL_SQL} z AS (SELECT 1) SELECT id, CAST(i - 1 AS INTEGER) AS pos, {s6('v')} AS v FROM un
""")
def vector_calibrate(t: Tables):
    return calibrated(t).select("id", F.posexplode("vec").alias("pos", "v")).withColumn("v", r6(F.col("v")))


@query("group_mean_vectors", f"""
WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT label, CAST(i - 1 AS INTEGER) AS pos, {s6('avg(v)')} AS v FROM x GROUP BY ALL
""")
def group_mean_vectors(t: Tables):
    return sh.mean_vector(t.embeddings, ["label"], "embedding").select(
        "label", F.posexplode("embedding").alias("pos", "v")).withColumn("v", r6(F.col("v")))


@query("topk_similarity", f"""
WITH {CAL_SQL} p AS (SELECT a.id AS source, b.id AS target, a.kind AS source_kind, b.kind AS target_kind,
      round(list_dot_product(a.vec, b.vec), 9) AS score FROM cal a JOIN cal b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY source, target_kind ORDER BY score DESC, target) AS rk FROM p)
SELECT source, target, source_kind, target_kind, round(score, 4) AS cos, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 10
""")
def topk_similarity(t: Tables):
    return vc.top_k_by_kind(cut_lineage(calibrated(t)), "kind", KINDS).drop("score")


HASH_SQL = "CAST(('0x' || substr(md5({0}), 1, 8)) AS BIGINT)"


@query("similarity_percentile", f"""
WITH {CAL_SQL} c AS (SELECT kind, count(*) AS n FROM cal GROUP BY kind),
kp AS (SELECT x.kind AS ka, y.kind AS kb, x.n AS na, y.n AS nb, 20000.0::DOUBLE / x.n AS share FROM c x, c y),
dr AS (SELECT ka, kb, nb, a.id, a.vec, CAST(floor(share) AS BIGINT)
       + CAST({HASH_SQL.format("a.id || '|draw|42'")} < (share - floor(share)) * 4294967296 AS BIGINT) AS draws
       FROM kp JOIN cal a ON a.kind = ka),
l AS (SELECT ka, kb, vec, {HASH_SQL.format("id || '|' || r || '|42'")} % nb AS bk
      FROM (SELECT ka, kb, nb, id, vec, unnest(range(1, draws + 1)) AS r FROM dr)),
q AS (SELECT ka, kb, b.vec, {HASH_SQL.format("b.id || '|b|42'")} % nb AS bk FROM kp JOIN cal b ON b.kind = kb),
nul AS (SELECT ka, kb, round(list_dot_product(l.vec, q.vec), 9) AS score FROM l JOIN q USING (ka, kb, bk)),
hist AS (SELECT ka, kb, score, count(*) AS c FROM nul GROUP BY ALL),
p AS (SELECT a.kind AS ka, b.kind AS kb, a.id AS source, b.id AS target, round(list_dot_product(a.vec, b.vec), 9) AS score
      FROM cal a JOIN cal b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY source, kb ORDER BY score DESC, target) AS rk FROM p),
t AS (SELECT * FROM r WHERE rk <= 10),
tot AS (SELECT ka, kb, sum(c) AS total FROM hist GROUP BY ALL),
run AS (SELECT ka, kb, score, sum(c) OVER (PARTITION BY ka, kb ORDER BY score) AS upto FROM hist)
SELECT source, target, t.ka AS source_kind, t.kb AS target_kind, round(t.score, 4) AS cos, CAST(rk AS INTEGER) AS rank,
       round(100.0 * CAST(coalesce(upto, 0) AS DOUBLE) / CAST(total AS DOUBLE), 2) AS percentile
FROM t ASOF LEFT JOIN run ON run.ka = t.ka AND run.kb = t.kb AND run.score < t.score
JOIN tot ON tot.ka = t.ka AND tot.kb = t.kb
""")
def similarity_percentile(t: Tables):
    return vc.similarity_table(cut_lineage(calibrated(t)), "kind", KINDS, n=20_000).drop("score")


PROX_SQL = CAL_SQL + """
mem AS (SELECT DISTINCT id, id % 12 AS g FROM un UNION SELECT DISTINCT id, label FROM un),
gm AS (SELECT g, i, avg(v) AS v FROM mem JOIN un USING (id) GROUP BY ALL),
gg AS (SELECT i, avg(v) AS m FROM gm GROUP BY i),
gc AS (SELECT g, i, gm.v - m AS v FROM gm JOIN gg USING (i)),
gn AS (SELECT g, sqrt(sum(v * v)) + 1e-12 AS n FROM gc GROUP BY g),
gv AS (SELECT g, list(v / n ORDER BY i) AS vec FROM gc JOIN gn USING (g) GROUP BY g),
gp AS (SELECT a.g AS node1, b.g AS node2, round(list_dot_product(a.vec, b.vec), 4) AS cos FROM gv a JOIN gv b ON a.g < b.g),
prox AS (SELECT node1, node2, cos, round(100 * ((rank() OVER (ORDER BY cos)) + (count(*) OVER (PARTITION BY cos) - 1) / 2.0) / (count(*) OVER ()), 1) AS percentile FROM gp),
"""


def proximity(t: Tables):
    vecs = cut_lineage(calibrated(t))
    member = vecs.select("id", (F.col("id") % 12).alias("g")).unionByName(
        vecs.select("id", F.col("label").cast("bigint").alias("g")))
    return vc.group_proximity(vecs, member, "id", "g")


@query("unit_proximity", f"WITH {PROX_SQL} z AS (SELECT 1) SELECT node1, node2, cos, percentile FROM prox")
def unit_proximity(t: Tables):
    return proximity(t)


@query("knn_graph", f"""
WITH {PROX_SQL} s AS (SELECT node1 AS a, node2 AS b, cos FROM prox UNION ALL SELECT node2, node1, cos FROM prox),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY cos DESC, b) AS rk FROM s)
SELECT DISTINCT least(a, b) AS node1, greatest(a, b) AS node2, cos FROM r WHERE rk <= 3
""")
def knn_graph(t: Tables):
    return g.knn_edges(proximity(t), 3)


COLLAB_SQL = """
m AS (SELECT DISTINCT l_orderkey AS doc_uid, (l_suppkey * l_suppkey) % 12 AS node FROM lineitem),
k AS (SELECT doc_uid, count(*) AS k FROM m GROUP BY 1),
agg AS (SELECT a.node AS node1, b.node AS node2, sum(1.0::DOUBLE / greatest(k - 1, 1)) AS weight, count(DISTINCT a.doc_uid) AS n_docs
        FROM m a JOIN m b ON a.doc_uid = b.doc_uid AND a.node < b.node JOIN k ON k.doc_uid = a.doc_uid GROUP BY ALL),
st AS (SELECT node, sum(weight) AS s FROM (SELECT node1 AS node, weight FROM agg UNION ALL SELECT node2, weight FROM agg) GROUP BY 1),
force AS (SELECT agg.node1, agg.node2, n_docs, 2 * (SELECT sum(weight) FROM agg) * weight / (a.s * b.s) AS force
          FROM agg JOIN st a ON a.node = node1 JOIN st b ON b.node = node2),
"""


@query("potential_pairs", f"""
WITH {PROX_SQL} {COLLAB_SQL} z AS (SELECT 1)
SELECT node1, node2, cos, percentile, coalesce(n_docs, 0) AS n_docs, {s6("coalesce(force, 0)")} AS force
FROM prox LEFT JOIN force USING (node1, node2) WHERE percentile >= 60 AND coalesce(force, 0) < 1
""")
def potential_pairs(t: Tables):
    rows_ = t.lineitem.select(F.col("l_orderkey").alias("doc_uid"), (F.col("l_suppkey") * F.col("l_suppkey") % 12).alias("node"))
    layer = g.project_pairs(rows_, "doc_uid", "node")
    out = g.potential_pairs(proximity(t), g.aggregate_edges(layer), 60.0)
    return out.select("node1", "node2", "cos", "percentile", "n_docs", r6(F.col("force")).alias("force"))


CENT_SQL = CAL_SQL + """
cm AS (SELECT label, i, avg(v) AS v FROM un GROUP BY ALL),
cn AS (SELECT label, sqrt(sum(v * v)) + 1e-12 AS n FROM cm GROUP BY 1),
cent AS (SELECT CAST(label AS BIGINT) AS theme, list(v / n ORDER BY i) AS vec FROM cm JOIN cn USING (label) GROUP BY 1),
"""


def centroids(vecs):
    return vc.normalised(sh.mean_vector(vecs, ["label"], "vec"), "vec").select(
        F.col("label").cast("bigint").alias("theme"), "vec")


@query("nearest_centroid", f"""
WITH {CENT_SQL} p AS (SELECT id, theme, round(list_dot_product(cal.vec, cent.vec), 9) AS s FROM cal, cent),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, theme) AS rk FROM p)
SELECT id, theme, theme % 3 AS parent, round(s, 4) AS score FROM r WHERE rk = 1
""")
def nearest_centroid(t: Tables):
    vecs = cut_lineage(calibrated(t))
    cents = cut_lineage(centroids(vecs))
    return vc.nearest(vecs, cents, parent=cents.select("theme", (F.col("theme") % 3).alias("parent")))


@query("top3_reference_confidence", f"""
WITH {CENT_SQL} ci AS (SELECT theme, generate_subscripts(vec, 1) AS i, unnest(vec) AS v FROM cent),
cg AS (SELECT i, avg(v) AS m FROM ci GROUP BY i), c2 AS (SELECT theme, i, v - m AS v FROM ci JOIN cg USING (i)),
c3 AS (SELECT theme, sqrt(sum(v * v)) AS n FROM c2 GROUP BY theme),
ref AS (SELECT theme, list(v / n ORDER BY i) AS vec FROM c2 JOIN c3 USING (theme) GROUP BY theme),
p AS (SELECT id, kind, theme, round(list_dot_product(cal.vec, ref.vec), 9) AS s FROM cal, ref
      WHERE CASE WHEN kind = 'projeto' THEN label >= 3 ELSE label >= 2 END),
r AS (SELECT id, kind, theme AS reference, CAST(row_number() OVER (PARTITION BY id ORDER BY s DESC, theme) AS INTEGER) AS rank, round(s, 4) AS sim FROM p),
lim AS (SELECT kind, quantile_cont(sim, 1.0 / 3) AS lo, quantile_cont(sim, 2.0 / 3) AS hi FROM r WHERE rank = 1 GROUP BY kind)
SELECT id, kind, reference, rank, sim, CASE WHEN sim >= hi THEN 'alta' WHEN sim >= lo THEN 'media' ELSE 'baixa' END AS confidence
FROM r JOIN lim USING (kind) WHERE rank <= 3
""")
def top3_reference_confidence(t: Tables):
    vecs = cut_lineage(calibrated(t))
    refs = cut_lineage(centroids(vecs)).withColumnRenamed("theme", "id")
    scope = F.when(F.col("kind") == "projeto", F.col("label") >= 3).otherwise(F.col("label") >= 2)
    return vc.top_reference(vecs, refs, "kind", scope=scope)


@query("similar_lookup", f"""
WITH {CAL_SQL} p AS (SELECT b.id AS target, b.kind, b.label, round(list_dot_product(a.vec, b.vec), 9) AS s
      FROM cal a JOIN cal b ON a.id <> b.id WHERE a.id = 11),
r AS (SELECT *, row_number() OVER (ORDER BY s DESC, target) AS rk FROM p)
SELECT target, label, round(s, 4) AS cos, CAST(rk AS INTEGER) AS rank, CASE WHEN round(s, 4) <= 0.25 THEN 'baixa' WHEN round(s, 4) <= 0.4 THEN 'moderada'
       WHEN round(s, 4) <= 0.6 THEN 'alta' ELSE 'muito alta' END AS level FROM r WHERE rk <= 10
""")
def similar_lookup(t: Tables):
    vecs = cut_lineage(calibrated(t))
    sim = vc.top_k(vecs.where(F.col("id") == 11), vecs, 10, exclude_self=True)
    return vc.similar_docs(sim, vecs.select("id", "label"), 11).select("target", "label", "cos", "rank", "level")


@query("retrieval_eval", f"""
WITH {CAL_SQL} gd AS (SELECT a.id AS source, b.id AS target FROM cal a JOIN cal b ON b.id = a.id + 1 WHERE a.kind = 'tecnologia'),
cited AS (SELECT DISTINCT target AS id FROM gd),
pool AS (SELECT * FROM cal WHERE id IN (SELECT id FROM cited) UNION ALL
         (SELECT * FROM cal WHERE id NOT IN (SELECT id FROM cited) ORDER BY md5(id || '|42'), id LIMIT 200)),
own AS (SELECT source, target, a.vec, round(list_dot_product(a.vec, b.vec), 9) AS s FROM gd JOIN cal a ON a.id = source JOIN cal b ON b.id = target),
rk AS (SELECT source, target, count(*) FILTER (WHERE o > s OR (o = s AND id < target)) + 1 AS rank FROM (
       SELECT source, target, s, pool.id, round(list_dot_product(own.vec, pool.vec), 9) AS o FROM own, pool) GROUP BY ALL)
SELECT count(*) AS n, {s6("avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE ELSE 0 END)")} AS recall_10, {s6("avg(CASE WHEN rank <= 50 THEN 1.0::DOUBLE ELSE 0 END)")} AS recall_50,
       {s6("avg(1.0 / rank)")} AS mrr, {s6("quantile_cont(rank, 0.5)")} AS median_rank FROM rk
""")
def retrieval_eval(t: Tables):
    vecs = cut_lineage(calibrated(t))
    cited = vecs.select(F.col("id").alias("target"), (F.col("id") - 1).alias("source"))
    gold = vecs.where(F.col("kind") == "tecnologia").select(F.col("id").alias("source")).join(cited, "source")
    ranks = vc.gold_ranks(vecs, vc.retrieval_pool(vecs, gold, 200), gold)
    out = vc.evaluate(ranks)
    return out.select("n", *[r6(F.col(c)).alias(c) for c in out.columns if c != "n"])


@query("cluster_refit")
def cluster_refit(t: Tables):
    """VC-8: themes and parents from a balanced sample, every vector then assigned to its theme."""
    vecs = cut_lineage(calibrated(t))
    themes = vc.refit_themes(vecs, "kind", ["projeto", "tecnologia"], "publicacao", 40_000, k=10, parents=4)
    cents = themes.select(F.col("theme").cast("bigint").alias("theme"), "vec")
    return vc.nearest(vecs, cents, parent=themes.select(F.col("theme").cast("bigint").alias("theme"), "parent"))


CACHE_SQL = """
tx AS (SELECT doc_id AS doc_uid, sha1('m|512|query: ' || text) AS hash FROM documents),
old AS (SELECT sha1('m|512|query: ' || CASE WHEN lang = 'de' THEN upper(text) ELSE text END) AS hash, min(n_chars) AS v
        FROM documents WHERE lang <> 'es' GROUP BY 1),
imp AS (SELECT hash, -1 AS v FROM (SELECT DISTINCT hash FROM tx JOIN labels ON labels.doc_id = doc_uid WHERE quality = 1)),
merged AS (SELECT hash, v FROM imp UNION ALL SELECT hash, v FROM old WHERE hash NOT IN (SELECT hash FROM imp)),
kept AS (SELECT * FROM merged WHERE hash IN (SELECT hash FROM tx)),
"""


def cache_inputs(t: Tables):
    """The cache of an earlier load: one language not seen yet, one written differently; labelled texts come as a batch."""
    base = t.texts.select(F.col("doc_id").alias("doc_uid"), "text", "n_chars", "lang")
    texts = base.select("doc_uid", sc.text_hash("m", 512, F.concat(F.lit("query: "), "text")).alias("hash"))
    before = F.when(F.col("lang") == "de", F.upper("text")).otherwise(F.col("text"))
    old = base.where(F.col("lang") != "es").select(
        sc.text_hash("m", 512, F.concat(F.lit("query: "), before)).alias("hash"), "n_chars").groupBy("hash").agg(
        F.array(F.min("n_chars").cast("double")).alias("vec"))
    batch = t.labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("doc_uid"))
    imported = texts.join(batch, "doc_uid", "left_semi").select("hash", F.array(F.lit(-1.0)).alias("vec")).distinct()
    return texts, old, imported


@query("hash_cache_refresh", f"WITH {CACHE_SQL} z AS (SELECT 1) SELECT hash, CAST(v AS DOUBLE) AS v FROM kept")
def hash_cache_refresh(t: Tables):
    return inc.refreshed_cache(*cache_inputs(t)).select("hash", F.col("vec")[0].alias("v"))


@query("hash_cache_missing", f"""
WITH {CACHE_SQL} z AS (SELECT 1)
SELECT hash, min(doc_uid) AS doc_uid FROM tx WHERE hash NOT IN (SELECT hash FROM kept) GROUP BY hash
""")
def hash_cache_missing(t: Tables):
    texts, old, imported = cache_inputs(t)
    return inc.missing_texts(texts, inc.refreshed_cache(texts, old, imported))


@query("hash_cache_report", f"""
WITH {CACHE_SQL} z AS (SELECT 1)
SELECT count(*) AS n_texts, count(DISTINCT hash) AS n_hashes, count(*) FILTER (WHERE k) AS n_covered,
       {s6("avg(CASE WHEN k THEN 1.0::DOUBLE ELSE 0 END)")} AS coverage FROM (SELECT hash, hash IN (SELECT hash FROM kept) AS k FROM tx)
""")
def hash_cache_report(t: Tables):
    texts, old, imported = cache_inputs(t)
    return inc.cache_report(texts, inc.refreshed_cache(texts, old, imported)).withColumn("coverage", r6(F.col("coverage")))
