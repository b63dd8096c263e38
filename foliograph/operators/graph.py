"""Networks: projections with fractional counting, layers, association strength, components, communities, egos.

Edges are rows ``(doc, node1, node2, weight, weight_frac, layer, year)`` with ``node1 < node2``; an aggregated network
has one row per pair with ``weight`` and ``n_docs``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.functions.scalars import year_bin
from foliograph.plans.session import cut_lineage
from foliograph.plans.shapes import (
    as_list, block_pairs, global_numbered, keep_first, pair_stats, pivot_fill, symmetrise, top_n,
    with_totals,
)

A, B = "node1", "node2"


def fraction(k: Column) -> Column:
    """Weight of one pair of a document with ``k`` participants; unknown ``k`` gives no weight."""
    return F.when(k.isNotNull(), 1.0 / F.greatest(k - 1, F.lit(1)))


def project_pairs(df: DataFrame, doc: str, node: str, k_total: DataFrame | None = None) -> DataFrame:
    """NW-1: participants of each document to weighted pairs.

    ``k_total`` (doc, k) replaces the number of listed participants when outsiders count too.
    """
    members = df.select(doc, node).distinct()
    k = members.groupBy(doc).agg(F.count("*").alias("k")) if k_total is None else k_total.select(doc, "k")
    pairs = block_pairs(members, [doc], node, names=(A, B)).join(k, doc, "left")
    return pairs.select(doc, A, B, F.lit(1.0).alias("weight"), fraction(F.col("k")).alias("weight_frac"))


def unit_layer(doc_units: DataFrame, roles: Sequence[str], doc: str = "doc_uid", unit: str = "unit_id",
               role: str = "role", layer: str = "publicacoes") -> DataFrame:
    """NW-2: units taking part in one work, in the given roles."""
    members = doc_units.where(F.col(role).isin(list(roles)))
    return project_pairs(members, doc, unit).withColumn("layer", F.lit(layer))


def citation_layer(links: DataFrame, responsible: DataFrame, work_units: DataFrame,
                   layer: str = "tecnologias_indireta") -> DataFrame:
    """NW-3: the unit behind an origin and the units behind the work it cites.

    ``links(origin, work)``, ``responsible(origin, u1)``, ``work_units(work, u2)``. The weight of an origin is shared
    equally by its (u1, u2) pairs, before opposite directions fold into one undirected pair.
    """
    reach = links.select("origin", "work").distinct().join(responsible.distinct(), "origin").join(
        work_units.distinct(), "work")
    pairs = reach.where(F.col("u1") != F.col("u2")).select("origin", "u1", "u2").distinct()
    size = pairs.groupBy("origin").agg(F.count("*").alias("k"))
    return (
        pairs.join(size, "origin")
        .select(
            F.col("origin").alias("doc_uid"), F.least("u1", "u2").alias(A), F.greatest("u1", "u2").alias(B),
            F.lit(1.0).alias("weight"), (1.0 / F.col("k")).alias("weight_frac"), F.lit(layer).alias("layer"),
        )
        .distinct()
    )


def person_layer(doc_people: DataFrame, authors_total: DataFrame, doc: str = "doc_uid", person: str = "person_id",
                 ) -> DataFrame:
    """NW-4: co-authorship, weighted by all authors of the representative record (outsiders included)."""
    return project_pairs(doc_people, doc, person, k_total=authors_total)


def person_technology(links: DataFrame, doc_people: DataFrame, kind: str = "declarado") -> DataFrame:
    """NW-5: ``links(origin, work)`` and ``doc_people(work, person_id)`` to person and technology."""
    pairs = links.select("origin", "work").distinct().join(doc_people.select("work", "person_id").distinct(), "work")
    return pairs.select("person_id", F.col("origin").alias("technology"), "work").distinct().withColumn(
        "link", F.lit(kind))


def aggregate_edges(edges: DataFrame, first: int | None = None, last: int | None = None,
                    layers: Sequence[str] | None = None, by: Sequence[str] = (), doc: str = "doc_uid") -> DataFrame:
    """NW-6: fractional weight and documents per pair, in a period and a set of layers."""
    rows = edges
    if first is not None:
        rows = rows.where(F.col("year").between(first, last))
    if layers is not None:
        rows = rows.where(F.col("layer").isin(list(layers)))
    # inside one layer a document gives a pair one row, so distinct documents are rows
    docs = F.count("*") if layers is not None and len(layers) == 1 else F.countDistinct(doc)
    return rows.groupBy(*as_list(by), A, B).agg(F.sum("weight_frac").alias("weight"), docs.alias("n_docs"))


def node_strength(agg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weighted degree of every node."""
    return symmetrise(agg, A, B).groupBy(*as_list(by), F.col(A).alias("node")).agg(F.sum("weight").alias("strength"))


def association_strength(agg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """NW-7: observed weight over the weight expected from both strengths, ``2 W w / (s1 s2)``."""
    by = as_list(by)
    s = node_strength(agg, by)
    joined = (
        agg.join(s.withColumnsRenamed({"node": A, "strength": "_s1"}), by + [A])
        .join(s.withColumnsRenamed({"node": B, "strength": "_s2"}), by + [B])
    )
    total = agg.groupBy(*by).agg(F.sum("weight").alias("_w")) if by else agg.agg(F.sum("weight").alias("_w"))
    joined = joined.join(total, by) if by else with_totals(joined, total)
    force = 2 * F.col("_w") * F.col("weight") / (F.col("_s1") * F.col("_s2"))
    return joined.withColumn("force", force).drop("_s1", "_s2", "_w")


def potential_pairs(proximity: DataFrame, agg: DataFrame, cut: float = 80.0) -> DataFrame:
    """NW-8: pairs close in content whose association strength is below 1 (no relation counts as 0)."""
    known = association_strength(agg).select(A, B, "n_docs", "force")
    joined = proximity.where(F.col("percentile") >= cut).join(known, [A, B], "left").na.fill(0, ["n_docs", "force"])
    return joined.where(F.col("force") < 1)


def knn_edges(proximity: DataFrame, k: int, score: str = "cos") -> DataFrame:
    """NW-9: undirected union of the ``k`` nearest neighbours of every node."""
    near = top_n(symmetrise(proximity, A, B), [A], [F.col(score).desc(), F.col(B)], k)
    return near.select(F.least(A, B).alias(A), F.greatest(A, B).alias(B), score).distinct()


def node_metrics(agg: DataFrame) -> DataFrame:
    """NW-10: partners and weighted degree."""
    return symmetrise(agg, A, B).groupBy(F.col(A).alias("node")).agg(
        F.count("*").alias("degree"), F.sum("weight").alias("strength"))


def node_ranking(agg: DataFrame, digits: int = 9) -> DataFrame:
    """NW-10, W-8: node metrics with the position by weighted degree."""
    metrics = node_metrics(agg).withColumn("strength", F.round("strength", digits))
    return global_numbered(metrics, [F.col("strength").desc(), F.col("node").asc()])


def components(edges: DataFrame, vertices: DataFrame, a: str = "a", b: str = "b", vertex: str = "id",
               out: str = "component") -> DataFrame:
    """ER-4: connected components; every vertex gets the smallest vertex id of its component.

    Alternates two steps until the edges form stars around minima: larger neighbours of a vertex move to its smallest
    neighbour, then smaller ones do. The number of rounds grows with the logarithm of the component size, each round is
    a combined minimum and a join, and the edges are materialised once per round. Vertices without edges keep
    themselves.
    """
    current = cut_lineage(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or state[0] == 0:
            break
        mark = tuple(state)
        both = symmetrise(current, "u", "v")
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        outward = both.where(F.col("v") > F.col("u")).join(lowest, "u").where(F.col("v") != F.col("m"))
        large = outward.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        inward = large.join(floor, "u")
        small = inward.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = cut_lineage(small.union(floor.select("u", F.col("m").alias("v"))).distinct())
    roots = current.select(F.col("u").alias(vertex), F.col("v").alias(out))
    return vertices.select(vertex).distinct().join(roots, vertex, "left").withColumn(out, F.coalesce(out, vertex))


def communities(agg: DataFrame, digits: int = 6) -> DataFrame:
    """NW-11: communities by weighted label propagation, numbered from 0 by size.

    Every round a node takes the label with most weight among its neighbours and itself (its own label weighs as much
    as its strongest edge, which stops two-node swaps); the smallest label wins a tie. Rounds go on until no label
    changes. On some networks labels swing for ever: when a state of all labels comes back, nodes take smaller labels only from
    then on, so that labels fall until they rest.
    """
    both = cut_lineage(symmetrise(agg.select(A, B, F.round("weight", digits).alias("weight")), A, B))
    own = both.groupBy(F.col(A).alias("node")).agg(F.max("weight").alias("weight"))
    labels = own.select("node", F.col("node").alias("label"))
    seen, falling = set(), False
    while True:
        before = labels.select("node", F.col("label").alias("_before"))
        votes = both.join(labels.select(F.col("node").alias(B), "label"), B).select(F.col(A).alias("node"), "label", "weight")
        votes = votes.unionByName(own.join(labels.select("node", "label"), "node").select("node", "label", "weight"))
        sums = votes.groupBy("node", "label").agg(F.round(F.sum("weight"), digits).alias("weight"))
        ranked = top_n(sums, ["node"], [F.col("weight").desc(), "label"], 1).select("node", "label").join(before, "node")
        if falling:
            ranked = ranked.withColumn("label", F.least("label", "_before"))
        labels = cut_lineage(ranked)
        changed, state = labels.agg(
            F.count_if(F.col("label") != F.col("_before")), F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first()
        if not changed:
            break
        falling = falling or state in seen
        seen.add(state)
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    ids = global_numbered(sizes, [F.col("size").desc(), F.col("label").asc()], "_pos")
    return labels.join(ids, "label").select("node", (F.col("_pos") - 1).alias("community"), "size")


def ego_rows(edges: DataFrame, node) -> DataFrame:
    """Edge rows of one node with the other endpoint as ``partner``."""
    touching = edges.where((F.col(A) == node) | (F.col(B) == node))
    return touching.withColumn("partner", F.when(F.col(A) == node, F.col(B)).otherwise(F.col(A)))


def ego(edges: DataFrame, node, n: int | None = None, doc: str = "doc_uid") -> DataFrame:
    """NW-12: partners of a node with documents and weight, the strongest ``n`` if asked."""
    partners = ego_rows(edges, node).groupBy("partner").agg(
        F.countDistinct(doc).alias("n_docs"), F.sum("weight_frac").alias("weight"))
    if n is None:
        return partners
    return partners.orderBy(F.round("weight", 9).desc(), "partner").limit(n)


def edges_among(edges: DataFrame, nodes: DataFrame, doc: str = "doc_uid") -> DataFrame:
    """NW-12: aggregated edges whose two ends are both in ``nodes(node)``."""
    kept = edges.join(nodes.select(F.col("node").alias(A)), A, "left_semi").join(
        nodes.select(F.col("node").alias(B)), B, "left_semi")
    return kept.groupBy(A, B).agg(F.sum("weight_frac").alias("weight"), F.countDistinct(doc).alias("n_docs"))


def shared_topics(ego_docs: DataFrame, doc_topics: DataFrame, n: int = 3, sep: str = " · ") -> DataFrame:
    """NW-13: the ``n`` most frequent topics of the documents shared with each partner.

    ``ego_docs(partner, doc_uid)``, ``doc_topics(doc_uid, topic)``.
    """
    hits = ego_docs.select("partner", "doc_uid").distinct().join(doc_topics, "doc_uid")
    counts = hits.groupBy("partner", "topic").agg(F.count("*").alias("n"))
    best = top_n(counts, ["partner"], [F.col("n").desc(), "topic"], n, out="_rk")
    listed = F.array_sort(F.collect_list(F.struct("_rk", "topic")))
    return best.groupBy("partner").agg(F.array_join(F.transform(listed, lambda x: x["topic"]), sep).alias("topics"))


def partner_units(ego_docs: DataFrame, people: DataFrame) -> DataFrame:
    """NW-14: units of the co-authors of a person, with people, weight and works.

    ``ego_docs(partner, doc_uid, weight_frac)``, ``people(partner, unit_id)``.
    """
    return ego_docs.join(people, "partner").groupBy("unit_id").agg(
        F.countDistinct("partner").alias("coauthors"), F.sum("weight_frac").alias("weight"),
        F.countDistinct("doc_uid").alias("works"))


def relation_docs(edges: DataFrame, x, y, first: int, last: int, layers: Sequence[str], doc: str = "doc_uid",
                  ) -> DataFrame:
    """NW-15: documents behind one relation."""
    low, high = sorted((x, y))
    return edges.where(
        (F.col(A) == low) & (F.col(B) == high) & F.col("year").between(first, last)
        & F.col("layer").isin(list(layers))
    ).select(doc).distinct()


def network_evolution(edges: DataFrame, width: int, doc: str = "doc_uid") -> DataFrame:
    """NW-16: documents, pairs and nodes per window of ``width`` years."""
    return pair_stats(edges, year_bin("year", width), A, B, doc)


def cooccurrence_matrix(agg: DataFrame, n: int) -> DataFrame:
    """NW-17: documents in common among the ``n`` strongest nodes; columns ``c1..cn`` follow the row positions."""
    strongest = (
        node_metrics(agg).withColumn("strength", F.round("strength", 9))
        .orderBy(F.col("strength").desc(), "node").limit(n)
    )
    order = W.orderBy(F.col("strength").desc(), "node")  # over at most n rows
    ranked = strongest.select("node", F.row_number().over(order).alias("pos"))
    both = symmetrise(agg.select(A, B, "n_docs"), A, B)
    cells = (
        both.join(ranked.withColumnsRenamed({"node": A, "pos": "row"}), A)
        .join(ranked.withColumnsRenamed({"node": B, "pos": "col"}), B)
    )
    wide = pivot_fill(cells, [A, "row"], "col", list(range(1, n + 1)), F.sum("n_docs"))
    full = ranked.withColumnsRenamed({"node": A, "pos": "row"}).join(wide, [A, "row"], "left")
    names = [str(i) for i in range(1, n + 1)]
    return full.na.fill(0, names).select(
        F.col(A).alias("node"), "row", *[F.col(f"`{i}`").alias(f"c{i}") for i in names])


def item_neighbours(df: DataFrame, doc: str, item: str, min_n: int = 3, n: int = 8) -> DataFrame:
    """NW-18: items found in the same documents, the ``n`` most frequent per item."""
    pairs = block_pairs(df.select(doc, item).distinct(), [doc], item, names=(A, B))
    counts = pairs.groupBy(A, B).agg(F.count("*").alias("n")).where(F.col("n") >= min_n)
    best = top_n(symmetrise(counts, A, B), [A], [F.col("n").desc(), F.col(B)], n)
    return best.select(F.col(A).alias(item), F.col(B).alias("neighbour"), "n")


def backbone(agg: DataFrame, n: int, per_node: int = 2, weight: str = "weight") -> DataFrame:
    """SL-6: the ``n`` strongest edges and the strongest ``per_node`` edges of every node."""
    rounded = agg.withColumn(weight, F.round(weight, 9))
    overall = rounded.orderBy(F.col(weight).desc(), A, B).limit(n)
    by_node = top_n(
        rounded.withColumn("_node", F.explode(F.array(A, B))), ["_node"], [F.col(weight).desc(), A, B], per_node,
    ).drop("_node")
    return keep_first(overall.unionByName(by_node), [A, B], [F.col(weight).desc()])
