"""Networks on orders: an order is a document, its suppliers (or their nations) are the participants."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query, r6, s6
from foliograph.operators import graph as g
from foliograph.plans.shapes import attach_group, position_of

# the orders as documents, with their year; suppliers as participants
MEMBERS = """
m AS (SELECT DISTINCT l_orderkey AS doc_uid, l_suppkey AS node FROM lineitem),
k AS (SELECT doc_uid, count(*) AS k FROM m GROUP BY doc_uid),
"""
PAIRS = MEMBERS + """
e AS (SELECT a.doc_uid, a.node AS node1, b.node AS node2, 1.0::DOUBLE / greatest(k - 1, 1) AS weight_frac,
             CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS layer
      FROM m a JOIN m b ON a.doc_uid = b.doc_uid AND a.node < b.node JOIN k ON k.doc_uid = a.doc_uid
      JOIN orders ON o_orderkey = a.doc_uid),
"""
AGG = PAIRS + """
agg AS (SELECT node1, node2, sum(weight_frac) AS weight, count(DISTINCT doc_uid) AS n_docs FROM e GROUP BY ALL),
sym AS (SELECT node1 AS node, node2 AS other, weight, n_docs FROM agg
        UNION ALL SELECT node2, node1, weight, n_docs FROM agg),
st AS (SELECT node, sum(weight) AS s, count(*) AS degree FROM sym GROUP BY node),
"""


def members(t: Tables):
    return t.lineitem.select(F.col("l_orderkey").alias("doc_uid"), F.col("l_suppkey").alias("node"))


def years(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("doc_uid"), F.year("o_orderdate").alias("year"),
                           F.col("o_orderstatus").alias("layer"))


def edges(t: Tables):
    return g.project_pairs(members(t), "doc_uid", "node").join(years(t), "doc_uid")


def nation_members(t: Tables):
    seats = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("node"))
    return t.lineitem.select("l_orderkey", "l_suppkey").join(seats, "l_suppkey").select(
        F.col("l_orderkey").alias("doc_uid"), "node")


@query("edge_strength_by_year", f"""
WITH {PAIRS}
a AS (SELECT year, node1, node2, sum(weight_frac) AS weight, count(*) AS n_docs FROM e GROUP BY ALL),
s AS (SELECT year, node, sum(weight) AS s FROM (SELECT year, node1 AS node, weight FROM a
      UNION ALL SELECT year, node2, weight FROM a) GROUP BY ALL),
w AS (SELECT year, sum(weight) AS w FROM a GROUP BY year)
SELECT a.year, a.node1, a.node2, round(a.weight, 6) AS weight, a.n_docs,
       {s6("2 * w.w * a.weight / (s1.s * s2.s)")} AS force
FROM a JOIN w ON w.year = a.year JOIN s s1 ON s1.year = a.year AND s1.node = a.node1
JOIN s s2 ON s2.year = a.year AND s2.node = a.node2
""")
def edge_strength_by_year(t: Tables):
    all_layers = edges(t).withColumn("layer", F.lit("orders"))
    agg = g.aggregate_edges(all_layers, layers=["orders"], by=["year"])
    return g.association_strength(agg, by=["year"]).select(
        "year", "node1", "node2", F.round("weight", 6).alias("weight"), "n_docs", r6(F.col("force")).alias("force"))


@query("fractional_projection_total_k", """
WITH m AS (SELECT DISTINCT l_orderkey AS doc_uid, l_suppkey AS node FROM lineitem),
k AS (SELECT l_orderkey AS doc_uid, count(*) AS k FROM lineitem
      WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') GROUP BY 1)
SELECT a.doc_uid, a.node AS node1, b.node AS node2, 1.0::DOUBLE AS weight,
       round(CASE WHEN k.k IS NOT NULL THEN 1.0::DOUBLE / greatest(k.k - 1, 1) END, 6) AS weight_frac
FROM m a JOIN m b ON a.doc_uid = b.doc_uid AND a.node < b.node LEFT JOIN k ON k.doc_uid = a.doc_uid
""")
def fractional_projection_total_k(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("doc_uid"), F.col("l_suppkey").alias("node"), "l_returnflag")
    known = lines.where(F.col("l_returnflag") == "A").select("doc_uid")
    k = lines.join(known, "doc_uid", "left_semi").groupBy("doc_uid").agg(F.count("*").alias("k"))
    return g.project_pairs(lines, "doc_uid", "node", k_total=k).withColumn("weight_frac", F.round("weight_frac", 6))


@query("unit_layer_by_period", """
WITH du AS (SELECT DISTINCT l_orderkey AS doc_uid, s_nationkey AS node FROM lineitem
            JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag IN ('A', 'R')),
k AS (SELECT doc_uid, count(*) AS k FROM du GROUP BY 1),
e AS (SELECT a.doc_uid, a.node AS node1, b.node AS node2, 1.0::DOUBLE / greatest(k.k - 1, 1) AS w,
             o_orderstatus AS layer FROM du a JOIN du b ON a.doc_uid = b.doc_uid AND a.node < b.node
      JOIN k ON k.doc_uid = a.doc_uid JOIN orders ON o_orderkey = a.doc_uid
      WHERE year(o_orderdate) BETWEEN 1996 AND 1999 AND o_orderstatus IN ('F', 'O'))
SELECT node1, node2, round(sum(w), 6) AS weight, count(DISTINCT doc_uid) AS n_docs FROM e GROUP BY ALL
""")
def unit_layer_by_period(t: Tables):
    seats = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("unit_id"))
    du = t.lineitem.select(F.col("l_orderkey").alias("doc_uid"), "l_suppkey", F.col("l_returnflag").alias("role"))
    layer = g.unit_layer(du.join(seats, "l_suppkey"), roles=["A", "R"]).drop("layer")
    agg = g.aggregate_edges(layer.join(years(t), "doc_uid"), 1996, 1999, ["F", "O"])
    return agg.withColumn("weight", F.round("weight", 6))


@query("indirect_layer", """
WITH links AS (SELECT DISTINCT l_partkey AS origin, l_orderkey AS work FROM lineitem),
resp AS (SELECT l_partkey AS origin, arg_min(s_nationkey, l_suppkey) AS u1 FROM lineitem
         JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1),
wu AS (SELECT DISTINCT l_orderkey AS work, s_nationkey AS u2 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
p AS (SELECT DISTINCT origin, u1, u2 FROM links JOIN resp USING (origin) JOIN wu USING (work) WHERE u1 <> u2),
k AS (SELECT origin, count(*) AS k FROM p GROUP BY 1)
SELECT DISTINCT origin AS doc_uid, least(u1, u2) AS node1, greatest(u1, u2) AS node2, 1.0::DOUBLE AS weight,
       round(1.0::DOUBLE / k, 6) AS weight_frac, 'tecnologias_indireta' AS layer
FROM p JOIN k USING (origin)
""")
def indirect_layer(t: Tables):
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_suppkey")
    seats = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    placed = lines.join(seats, "l_suppkey")
    responsible = placed.groupBy(F.col("l_partkey").alias("origin")).agg(
        F.min_by("s_nationkey", "l_suppkey").alias("u1"))
    layer = g.citation_layer(
        lines.select(F.col("l_partkey").alias("origin"), F.col("l_orderkey").alias("work")), responsible,
        placed.select(F.col("l_orderkey").alias("work"), F.col("s_nationkey").alias("u2")))
    return layer.withColumn("weight_frac", F.round("weight_frac", 6))


@query("person_layer", """
WITH authors AS (SELECT DISTINCT l_orderkey AS doc_uid, l_suppkey AS node FROM lineitem),
k AS (SELECT l_orderkey AS doc_uid, count(*) AS k FROM lineitem GROUP BY 1)
SELECT a.doc_uid, a.node AS node1, b.node AS node2, round(1.0::DOUBLE / greatest(k.k - 1, 1), 6) AS weight_frac,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM authors a JOIN authors b ON a.doc_uid = b.doc_uid AND a.node < b.node JOIN k ON k.doc_uid = a.doc_uid
JOIN orders ON o_orderkey = a.doc_uid
""")
def person_layer(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("doc_uid"), F.col("l_suppkey").alias("person_id"))
    return g.person_layer(lines, lines.groupBy("doc_uid").agg(F.count("*").alias("k"))).join(years(t).drop("layer"), "doc_uid").select(
        "doc_uid", "node1", "node2", F.round("weight_frac", 6).alias("weight_frac"), "year")


@query("person_technology", """
SELECT DISTINCT l2.l_suppkey AS person_id, l1.l_partkey AS technology, l1.l_orderkey AS work, 'declarado' AS link
FROM lineitem l1 JOIN lineitem l2 ON l1.l_orderkey = l2.l_orderkey
""")
def person_technology(t: Tables):
    cited = t.lineitem.select(F.col("l_partkey").alias("origin"), F.col("l_orderkey").alias("work"))
    people = t.lineitem.select(F.col("l_orderkey").alias("work"), F.col("l_suppkey").alias("person_id"))
    return g.person_technology(cited, people)


@query("node_ranking", f"""
WITH {AGG} r AS (SELECT node, degree, round(s, 9) AS strength FROM st)
SELECT node, degree, round(strength, 6) AS strength, row_number() OVER (ORDER BY strength DESC, node) AS position FROM r
""")
def node_ranking(t: Tables):
    ranked = g.node_ranking(g.aggregate_edges(edges(t)))
    return ranked.withColumn("strength", F.round("strength", 6))


@query("ranking_position", f"""
WITH {AGG} r AS (SELECT node, round(s, 9) AS strength, degree FROM st),
p AS (SELECT *, row_number() OVER (ORDER BY strength DESC, node) AS position FROM r)
SELECT node, degree, round(strength, 6) AS strength, position FROM p WHERE node = 7
""")
def ranking_position(t: Tables):
    metrics = g.node_metrics(g.aggregate_edges(edges(t))).withColumn("_down", -F.round("strength", 9))
    return position_of(metrics, ["_down", "node"], "node", 7).select(
        "node", "degree", F.round("strength", 6).alias("strength"), "position")


@query("ego_network", f"""
WITH {PAIRS}
x AS (SELECT *, CASE WHEN node1 = 7 THEN node2 ELSE node1 END AS partner FROM e
      WHERE (node1 = 7 OR node2 = 7) AND year BETWEEN 1996 AND 2000),
p AS (SELECT partner, count(DISTINCT doc_uid) AS n_docs, sum(weight_frac) AS weight FROM x GROUP BY 1),
top AS (SELECT partner, n_docs, weight FROM p ORDER BY round(weight, 9) DESC, partner LIMIT 15),
n AS (SELECT partner AS node FROM top UNION SELECT 7)
SELECT node1, node2, round(sum(weight_frac), 6) AS weight, count(DISTINCT doc_uid) AS n_docs
FROM e WHERE node1 IN (SELECT node FROM n) AND node2 IN (SELECT node FROM n) AND year BETWEEN 1996 AND 2000
GROUP BY ALL
""")
def ego_network(t: Tables):
    rows = edges(t).where(F.col("year").between(1996, 2000))
    top = g.ego(rows, 7, n=15).select(F.col("partner").alias("node"))
    nodes = top.unionByName(t.spark.range(7, 8).select(F.col("id").alias("node")))
    return g.edges_among(rows, nodes).withColumn("weight", F.round("weight", 6))


@query("ego_partners", f"""
WITH {PAIRS}
x AS (SELECT *, CASE WHEN node1 = 7 THEN node2 ELSE node1 END AS partner FROM e WHERE node1 = 7 OR node2 = 7)
SELECT partner, count(DISTINCT doc_uid) AS n_docs, round(sum(weight_frac), 6) AS weight FROM x GROUP BY 1
""")
def ego_partners(t: Tables):
    return g.ego(edges(t), 7).withColumn("weight", F.round("weight", 6))


@query("shared_topics", f"""
WITH {PAIRS}
x AS (SELECT DISTINCT doc_uid, CASE WHEN node1 = 7 THEN node2 ELSE node1 END AS partner FROM e
      WHERE node1 = 7 OR node2 = 7),
topics AS (SELECT DISTINCT l_orderkey AS doc_uid, p_type AS topic FROM lineitem JOIN part ON p_partkey = l_partkey),
c AS (SELECT partner, topic, count(*) AS n FROM x JOIN topics USING (doc_uid) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY partner ORDER BY n DESC, topic) AS rk FROM c)
SELECT partner, string_agg(topic, ' · ' ORDER BY rk) AS topics FROM r WHERE rk <= 3 GROUP BY 1
""")
def shared_topics(t: Tables):
    topics = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("doc_uid"), F.col("p_type").alias("topic")).distinct()
    return g.shared_topics(g.ego_rows(edges(t), 7), topics)


@query("partner_units", f"""
WITH {PAIRS}
x AS (SELECT doc_uid, weight_frac, CASE WHEN node1 = 7 THEN node2 ELSE node1 END AS partner FROM e
      WHERE node1 = 7 OR node2 = 7)
SELECT s_nationkey AS unit_id, count(DISTINCT partner) AS coauthors, round(sum(weight_frac), 6) AS weight,
       count(DISTINCT doc_uid) AS works
FROM x JOIN supplier ON s_suppkey = partner GROUP BY 1
""")
def partner_units(t: Tables):
    people = t.supplier.select(F.col("s_suppkey").alias("partner"), F.col("s_nationkey").alias("unit_id"))
    return g.partner_units(g.ego_rows(edges(t), 7), people).withColumn("weight", F.round("weight", 6))


@query("relation_docs", f"""
WITH {PAIRS} z AS (SELECT 1)
SELECT DISTINCT doc_uid FROM e WHERE node1 = 7 AND node2 = 11 AND year BETWEEN 1995 AND 2000 AND layer IN ('F', 'O')
""")
def relation_docs(t: Tables):
    return g.relation_docs(edges(t), 11, 7, 1995, 2000, ["F", "O"])


@query("network_evolution", f"""
WITH {PAIRS} x AS (SELECT CAST(floor(year / 3) * 3 AS INTEGER) AS w, * FROM e)
SELECT w AS "window", count(DISTINCT doc_uid) AS docs, count(DISTINCT (node1, node2)) AS pairs,
       (SELECT count(DISTINCT n) FROM (SELECT w AS v, unnest([node1, node2]) AS n FROM x) y WHERE y.v = x.w) AS nodes
FROM x GROUP BY w
""")
def network_evolution(t: Tables):
    return g.network_evolution(edges(t), 3)


@query("cooccurrence_matrix", """
WITH m AS (SELECT DISTINCT l_orderkey AS doc_uid, s_nationkey AS node FROM lineitem
           JOIN supplier ON s_suppkey = l_suppkey),
k AS (SELECT doc_uid, count(*) AS k FROM m GROUP BY 1),
agg AS (SELECT a.node AS node1, b.node AS node2, sum(1.0::DOUBLE / greatest(k.k - 1, 1)) AS weight,
               count(*) AS n_docs FROM m a JOIN m b ON a.doc_uid = b.doc_uid AND a.node < b.node
        JOIN k ON k.doc_uid = a.doc_uid GROUP BY ALL),
sym AS (SELECT node1 AS a, node2 AS b, weight, n_docs FROM agg UNION ALL SELECT node2, node1, weight, n_docs FROM agg),
st AS (SELECT a AS node, round(sum(weight), 9) AS s FROM sym GROUP BY 1),
r AS (SELECT node, CAST(row_number() OVER (ORDER BY s DESC, node) AS INTEGER) AS pos FROM st),
c AS (SELECT r1.node, r1.pos AS "row", r2.pos AS col, n_docs FROM sym JOIN r r1 ON r1.node = a JOIN r r2 ON r2.node = b
      WHERE r1.pos <= 5 AND r2.pos <= 5)
SELECT r.node, r.pos AS "row", """ + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN col = {i} THEN n_docs END), 0) AS BIGINT) AS c{i}" for i in range(1, 6)) + """
FROM r LEFT JOIN c ON c.node = r.node WHERE r.pos <= 5 GROUP BY r.node, r.pos
""")
def cooccurrence_matrix(t: Tables):
    layer = g.project_pairs(nation_members(t), "doc_uid", "node").withColumn("layer", F.lit("all"))
    return g.cooccurrence_matrix(g.aggregate_edges(layer, layers=["all"]), 5)


@query("item_neighbours", """
WITH m AS (SELECT DISTINCT l_orderkey AS doc, p_brand AS brand FROM lineitem JOIN part ON p_partkey = l_partkey),
c AS (SELECT a.brand, b.brand AS neighbour, count(*) AS n FROM m a JOIN m b ON a.doc = b.doc AND a.brand <> b.brand
      GROUP BY ALL HAVING count(*) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY n DESC, neighbour) AS rk FROM c)
SELECT brand, neighbour, n FROM r WHERE rk <= 8
""")
def item_neighbours(t: Tables):
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    tagged = t.lineitem.select(F.col("l_orderkey").alias("doc"), "l_partkey").join(brands, "l_partkey")
    return g.item_neighbours(tagged, "doc", "brand")


@query("connected_components", """
WITH RECURSIVE hub AS (SELECT l_partkey, l_suppkey, l_linenumber, min(l_orderkey) AS h FROM lineitem GROUP BY ALL),
e AS (SELECT DISTINCT l_orderkey AS a, h AS b FROM lineitem JOIN hub USING (l_partkey, l_suppkey, l_linenumber)
      WHERE l_orderkey <> h),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS id, a AS reach FROM s UNION SELECT r.id, s.b FROM r JOIN s ON s.a = r.reach)
SELECT o_orderkey AS id, coalesce(c.component, o_orderkey) AS component
FROM orders LEFT JOIN (SELECT id, min(reach) AS component FROM r GROUP BY id) c ON c.id = o_orderkey
""")
def connected_components(t: Tables):
    key = ["l_partkey", "l_suppkey", "l_linenumber"]
    lines = t.lineitem.select(*key, "l_orderkey")
    hubs = lines.groupBy(*key).agg(F.min("l_orderkey").alias("b"))
    links = lines.join(hubs, key).select(F.col("l_orderkey").alias("a"), "b")
    return g.components(links, t.orders.select(F.col("o_orderkey").alias("id")))


SETTLED = 9  # more rounds than the labels of any given table need


def _propagation(rounds: int) -> str:
    """The label rounds as chained subqueries."""
    steps = ["l0 AS (SELECT node, node AS label FROM own)"]
    for i in range(1, rounds + 1):
        steps.append(f"""
v{i} AS (SELECT node, label, round(sum(weight), 6) AS weight FROM (
      SELECT s.node, l.label, s.weight FROM w s JOIN l{i - 1} l ON l.node = s.other
      UNION ALL SELECT own.node, l.label, own.weight FROM own JOIN l{i - 1} l ON l.node = own.node) GROUP BY ALL),
l{i} AS (SELECT node, label FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, label) AS rn
      FROM v{i}) WHERE rn = 1)""")
    return ", ".join(steps)


@query("label_communities", f"""
WITH {AGG} w AS (SELECT node, other, round(weight, 6) AS weight FROM sym),
own AS (SELECT node, max(weight) AS weight FROM w GROUP BY node), {_propagation(SETTLED)},
z AS (SELECT label, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS community
      FROM l{SETTLED} GROUP BY label)
SELECT node, community, size FROM l{SETTLED} JOIN z USING (label)
""")
def label_communities(t: Tables):
    return g.communities(g.aggregate_edges(edges(t)))


@query("backbone", f"""
WITH {AGG} a AS (SELECT node1, node2, round(weight, 9) AS weight, n_docs FROM agg),
x AS (SELECT * FROM a ORDER BY weight DESC, node1, node2 LIMIT 120),
n AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, node1, node2) AS rn
      FROM (SELECT *, unnest([node1, node2]) AS node FROM a))
SELECT node1, node2, round(weight, 6) AS weight, n_docs
FROM (SELECT * FROM x UNION SELECT node1, node2, weight, n_docs FROM n WHERE rn <= 2)
""")
def backbone(t: Tables):
    return g.backbone(g.aggregate_edges(edges(t)), 120).withColumn("weight", F.round("weight", 6))


@query("document_pair_totals", """
WITH m AS (SELECT DISTINCT l_orderkey AS doc_uid, l_suppkey AS node FROM lineitem),
k AS (SELECT doc_uid, count(*) AS k FROM m GROUP BY 1)
SELECT doc_uid, k AS n_nodes, round(CASE WHEN k > 1 THEN k / 2.0::DOUBLE ELSE 0 END, 6) AS total FROM k
""")
def document_pair_totals(t: Tables):
    """The weights of one document add up to half its participants, whatever their number."""
    base = members(t).distinct()
    sums = g.project_pairs(base, "doc_uid", "node").groupBy("doc_uid").agg(F.sum("weight_frac").alias("total"))
    counted = attach_group(base, ["doc_uid"], n_nodes=F.count("*")).select("doc_uid", "n_nodes").distinct()
    return counted.join(sums, "doc_uid", "left").select(
        "doc_uid", "n_nodes", F.round(F.coalesce("total", F.lit(0.0)), 6).alias("total"))
