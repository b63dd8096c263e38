"""Indicators and marts.

Common inputs: ``docs(doc_uid, kind, year, year_end, unit_id, ...)`` with one row per document, ``doc_units(doc_uid,
unit_id, role)``, ``doc_axis(doc_uid, axis)`` (a theme, a product), ``links(doc_uid, person_id, role)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions.scalars import log_ratio, public_id, safe_ratio, year_bin, year_bin_label
from foliograph.functions.text import fold
from foliograph.operators.tagging import pair_keywords
from foliograph.plans.shapes import (
    as_list, count_where, join_sorted, keep_first, lift, modal_distinct, pivot_fill, top_n, top_n_by_kind, union_by_name,
    with_totals,
)

# Fixed values -------------------------------------------------------------------------------------------------------
KINDS = ["projeto", "publicacao", "tecnologia"]
ROLE_WEIGHT = {"lider": 3, "tecnologia": 2, "autor": 1, "membro": 1}
OLD_FACTOR, RECENT_YEARS = 0.5, 10
EXAMPLE_CAPS = {"publicacao": 12, "projeto": 4, "tecnologia": 4}
COLLABORATION_ROLES = ["depositante", "afiliacao_autor"]
SEAT = "sede_unidade"
SOURCE_ORDER = ["municipio_citado", "estado_citado", "sede_unidade"]
ALL_BIOMES = 6
# --------------------------------------------------------------------------------------------------------------------


def search(df: DataFrame, col: str, term: str, kind: str, kinds: Sequence[str], newest: str, key: str, n: int = 300,
           ) -> DataFrame:
    """PF-5: accent- and case-insensitive substring search, newest first, at most ``n`` hits."""
    hits = df.where(F.col(kind).isin(list(kinds))).where(F.contains(fold(F.col(col)), fold(F.lit(term))))
    return hits.orderBy(F.col(newest).desc(), key).limit(n)


def apply_filters(df: DataFrame, *filters, on: str = "doc_uid") -> DataFrame:
    """PF-7: optional restrictions; a Column filters rows, a DataFrame keeps the documents it lists, None does nothing."""
    for f in filters:
        if isinstance(f, Column):
            df = df.where(f)
        elif f is not None:
            df = df.join(f.select(on), on, "left_semi")
    return df


def by_id(df: DataFrame, key: str, value) -> DataFrame:
    """PF-10."""
    return df.where(F.col(key) == value)


# --- marts -----------------------------------------------------------------------------------------------------------


def document_mart(projects: DataFrame, works: DataFrame, records: DataFrame, technologies: DataFrame) -> DataFrame:
    """IN-1: one table of projects, works (with the texts of their representative record) and technologies.

    ``projects(doc_uid, title, abstract, year, year_end, state, unit_id, url)``,
    ``works(work, representative, title, year, kind_group, n_records)``,
    ``records(doc_uid, abstract, type, unit_id, url)``,
    ``technologies(doc_uid, title, abstract, year, type, subtype, unit_id, url)``.
    """
    best = records.select(F.col("doc_uid").alias("representative"), "abstract", "type", "unit_id", "url")
    return union_by_name(
        projects.select("doc_uid", F.lit("projeto").alias("kind"), "title", "abstract", "year", "year_end",
                        F.col("state").alias("category"), F.col("state").alias("detail"), "unit_id", "url"),
        works.join(best, "representative", "left").select(
            F.col("work").alias("doc_uid"), F.lit("publicacao").alias("kind"), "title", "abstract", "year",
            F.col("year").alias("year_end"), F.col("kind_group").alias("category"), F.col("type").alias("detail"),
            "unit_id", "url", "representative", "n_records"),
        technologies.select("doc_uid", F.lit("tecnologia").alias("kind"), "title", "abstract", "year",
                            F.col("year").alias("year_end"), F.col("type").alias("category"),
                            F.col("subtype").alias("detail"), "unit_id", "url"))


def unit_mart(doc_units: DataFrame, record_work: DataFrame) -> DataFrame:
    """IN-2: unit links lifted from record to work, then one per (document, unit, role)."""
    lifted = lift(doc_units, record_work, "doc_uid", "doc_uid", "work")
    rest = [c for c in lifted.columns if c not in ("doc_uid", "unit_id", "role")]
    return keep_first(lifted, ["doc_uid", "unit_id", "role"], rest or ["role"])


def person_mart(links: DataFrame, record_work: DataFrame, levels: Sequence[str] = ("A", "B", "M")) -> DataFrame:
    """IN-2: resolved person links lifted to the work, with the best level."""
    sure = links.where(F.col("level").isin(list(levels))).select("doc_uid", "person_id", "role", "level")
    return lift(sure, record_work, "doc_uid", "doc_uid", "work").groupBy("doc_uid", "person_id", "role").agg(
        F.min("level").alias("level"))


def keyword_mart(keywords: DataFrame, record_work: DataFrame) -> DataFrame:
    """IN-2: keywords lifted to the work, one per normalised form (lowest spelling kept)."""
    return keep_first(lift(keywords, record_work, "doc_uid", "doc_uid", "work"), ["doc_uid", "keyword"], ["raw"])


# --- totals and series -----------------------------------------------------------------------------------------------


def span(docs: DataFrame, year: str = "year") -> DataFrame:
    """IN-32: first and last year."""
    return docs.agg(F.min(year).alias("first"), F.max(year).alias("last"))


def totals(docs: DataFrame, first: int, last: int, kind: str = "kind") -> DataFrame:
    """IN-3: documents per kind in a period."""
    return docs.where(F.col("year").between(first, last)).groupBy(kind).agg(F.count("*").alias("n"))


def institution_kpis(docs: DataFrame, links: DataFrame, doc_units: DataFrame, first: int, last: int) -> DataFrame:
    """IN-3: documents by kind, people with output and collaboration rate in a period, as one row."""
    inside = docs.where(F.col("year").between(first, last))
    counts = inside.agg(*[count_where(F.col("kind") == k).alias("n_" + k) for k in KINDS])
    people = links.join(inside.select("doc_uid"), "doc_uid", "left_semi").agg(
        F.countDistinct("person_id").alias("n_people"))
    return with_totals(with_totals(counts, people), collaboration_rate(doc_units, inside))


def annual_series(docs: DataFrame, by: Sequence[str], min_n: int = 30) -> DataFrame:
    """IN-4: documents per year and category; ``shown`` hides years with fewer than ``min_n``."""
    counts = docs.groupBy("year", *as_list(by)).agg(F.count("*").alias("n"))
    return counts.withColumn("shown", F.when(F.col("n") >= min_n, F.col("n")))


def unit_counts(doc_units: DataFrame, roles: Sequence[str] | None = None) -> DataFrame:
    """Distinct units per document."""
    rows = doc_units if roles is None else doc_units.where(F.col("role").isin(list(roles)))
    return rows.select("doc_uid", "unit_id").distinct().groupBy("doc_uid").agg(F.count("*").alias("n_units"))


def collaboration_rate(doc_units: DataFrame, docs: DataFrame, by_year: bool = False, min_n: int = 30,
                       roles: Sequence[str] = COLLABORATION_ROLES) -> DataFrame:
    """IN-5: share of documents with two or more units among those with one, overall or per year."""
    rows = unit_counts(doc_units, roles).join(docs.select("doc_uid", "year"), "doc_uid")
    several = F.count_if(F.col("n_units") > 1)
    if not by_year:
        return rows.agg((several / F.count("*")).alias("collaboration_rate"))
    return rows.groupBy("year").agg(F.count("*").alias("n"), several.alias("n_collaborative")).withColumn(
        "pct", F.when(F.col("n") >= min_n, 100.0 * F.col("n_collaborative") / F.col("n")))


def units_with_counts(units: DataFrame, doc_units: DataFrame) -> DataFrame:
    """IN-31: every unit with its documents, 0 without any."""
    counts = doc_units.groupBy("unit_id").agg(F.countDistinct("doc_uid").alias("n_docs"))
    return units.join(counts, "unit_id", "left").na.fill(0, ["n_docs"])


def roles(doc_units: DataFrame) -> DataFrame:
    """IN-33: roles of each unit in a document."""
    return doc_units.groupBy("doc_uid", "unit_id").agg(join_sorted("role", ", ").alias("roles"))


# --- specialisation, growth, gaps ------------------------------------------------------------------------------------


def specialisation(doc_units: DataFrame, doc_axis: DataFrame, min_n: int = 3) -> DataFrame:
    """IN-6: weight of an axis in a unit over its weight overall, for pairs with at least ``min_n`` documents."""
    rows = doc_axis.select("doc_uid", "axis").distinct()
    overall = rows.groupBy("axis").agg(F.count("*").alias("n_all"))
    members = doc_units.select("doc_uid", "unit_id").distinct()
    pairs = members.join(rows, "doc_uid").groupBy("unit_id", "axis").agg(F.count("*").alias("n_unit"))
    size = pairs.groupBy("unit_id").agg(F.sum("n_unit").alias("_nu"))
    joined = with_totals(
        pairs.where(F.col("n_unit") >= min_n).join(size, "unit_id").join(overall, "axis"),
        overall.agg(F.sum("n_all").alias("_n")))
    lq = (F.col("n_unit") / F.col("_nu")) / (F.col("n_all") / F.col("_n"))
    return joined.select("unit_id", "axis", "n_unit", "n_all", lq.alias("specialisation"))


def growth(df: DataFrame, first: int, last: int, min_n: int, smooth: float, distinct: bool = True,
           subset: Column | None = None) -> DataFrame:
    """IN-7: per-mille share of an item in each half of the period and the log2 of their ratio.

    ``df(item, doc_uid, year)``. The halves meet at the integer midpoint, which belongs to the first. ``distinct`` counts
    documents (keywords), otherwise rows (themes). ``subset`` restricts the items; the totals stay those of all.
    """
    middle = (first + last) // 2
    rows = df.where(F.col("year").between(first, last))
    early, late = F.col("year") <= middle, F.col("year") > middle
    counted = "doc_uid" if distinct else None
    total = rows.agg(count_where(early, counted).alias("_t0"), count_where(late, counted).alias("_t1"))
    kept = rows if subset is None else rows.where(subset)
    per = kept.groupBy("item").agg(count_where(early, counted).alias("before"), count_where(late, counted).alias("after"))
    joined = with_totals(per.where(F.col("before") + F.col("after") >= min_n), total)
    return joined.withColumn("share_before", 1000 * F.col("before") / F.col("_t0")).withColumn(
        "share_after", 1000 * F.col("after") / F.col("_t1")).withColumn(
        "change", log_ratio("share_after", "share_before", smooth)).drop("_t0", "_t1")


def gap(df: DataFrame, num: str, den: str, smooth: float, min_total: int = 0, min_num: int = 0, distinct: bool = True,
        kinds: Sequence[str] = KINDS, subset: Column | None = None) -> DataFrame:
    """IN-8: log2 of the share of an item among documents of kind ``num`` over that among ``den``.

    ``df(item, doc_uid, kind)``; totals are those of all items.
    """
    counted = "doc_uid" if distinct else None
    counts = [count_where(F.col("kind") == k, counted).alias(k) for k in kinds]
    total = df.agg(*[c.alias("_" + k) for c, k in zip(counts, kinds)])
    kept = df if subset is None else df.where(subset)
    per = kept.groupBy("item").agg(*counts)
    enough = (sum((F.col(k) for k in kinds), F.lit(0)) >= min_total) & (F.col(num) >= min_num)
    joined = with_totals(per.where(enough), total)
    for k in kinds:
        joined = joined.withColumn("p_" + k, safe_ratio(1000.0 * F.col(k), "_" + k))
    return joined.withColumn("gap", log_ratio("p_" + num, "p_" + den, smooth)).drop(*["_" + k for k in kinds])


def dominant(df: DataFrame, key: str, category: str, doc: str = "doc_uid") -> DataFrame:
    """IN-9: category with most documents per key."""
    return modal_distinct(df, [key], category, doc)


def keyword_counts(keywords: DataFrame, docs: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """IN-10: documents per keyword with its usual spelling, the ``n`` most frequent if asked."""
    rows = keywords if docs is None else keywords.join(docs.select("doc_uid"), "doc_uid", "left_semi")
    counts = rows.groupBy("keyword").agg(F.countDistinct("doc_uid").alias("n"), F.mode(F.lower("raw"), True).alias("label"))
    return counts if n is None else counts.orderBy(F.col("n").desc(), "keyword").limit(n)


def top_axes(doc_axis: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """IN-11: most frequent axis values of a set of documents."""
    rows = doc_axis.join(docs.select("doc_uid"), "doc_uid", "left_semi")
    return rows.groupBy("axis").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "axis").limit(n)


def axis_share(doc_axis: DataFrame, docs: DataFrame, axis) -> DataFrame:
    """IN-11: per-mille of each year's documents in one axis value."""
    rows = doc_axis.join(docs.select("doc_uid", "year"), "doc_uid")
    return rows.groupBy("year").agg((1000.0 * F.count_if(F.col("axis") == axis) / F.count("*")).alias("per_mille"))


# --- people ----------------------------------------------------------------------------------------------------------


def person_profile(links: DataFrame, docs: DataFrame, person) -> DataFrame:
    """IN-12: led projects, publications, years of one person, as one row."""
    mine = links.where(F.col("person_id") == person).join(docs.select("doc_uid", "kind", "year"), "doc_uid")
    return mine.agg(
        F.countDistinct(F.when(F.col("role") == "lider", F.col("doc_uid"))).alias("n_led"),
        F.countDistinct(F.when(F.col("kind") == "publicacao", F.col("doc_uid"))).alias("n_publications"),
        F.min("year").alias("first"), F.max("year").alias("last"))


def theme_heat(links: DataFrame, docs: DataFrame, doc_axis: DataFrame, person, width: int = 5, n: int = 12) -> DataFrame:
    """IN-12: documents of one person per window of years and axis value, for the ``n`` most frequent values."""
    mine = links.where(F.col("person_id") == person).select("doc_uid").distinct()
    rows = mine.join(doc_axis, "doc_uid").join(docs.select("doc_uid", "year"), "doc_uid")
    best = rows.groupBy("axis").agg(F.count("*").alias("_n")).orderBy(F.col("_n").desc(), "axis").limit(n)
    return rows.join(best.select("axis"), "axis", "left_semi").groupBy(
        "axis", year_bin("year", width).alias("start"), year_bin_label("year", width).alias("period")).agg(
        F.count("*").alias("n"))


def people_of(links: DataFrame, docs: DataFrame, people: DataFrame, n: int = 100) -> DataFrame:
    """IN-13: the given people with their works, led projects and years, most works first."""
    rows = links.join(people.select("person_id"), "person_id", "left_semi").join(
        docs.select("doc_uid", "kind", "year"), "doc_uid")
    counts = rows.groupBy("person_id").agg(
        count_where(F.col("kind") == "publicacao", "doc_uid").alias("works"),
        count_where(F.col("role") == "lider", "doc_uid").alias("led"),
        F.min("year").alias("since"), F.max("year").alias("until"))
    return counts.orderBy(F.col("works").desc(), F.col("led").desc(), "person_id").limit(n)


# --- territory and programme -----------------------------------------------------------------------------------------


def by_state(locations: DataFrame, docs: DataFrame) -> DataFrame:
    """IN-14: documents per state, cited and by the seat of the unit; one with both origins counts as cited."""
    rows = locations.join(docs.select("doc_uid"), "doc_uid", "left_semi")
    counts = rows.groupBy("state").agg(
        F.countDistinct("doc_uid").alias("documents"), count_where(F.col("source") != SEAT, "doc_uid").alias("cited"))
    return counts.withColumn("by_seat", F.col("documents") - F.col("cited")).withColumn(
        "pct_cited", F.round(100.0 * F.col("cited") / F.col("documents") + 1e-9, 0))


def by_municipality(locations: DataFrame, docs: DataFrame) -> DataFrame:
    """IN-14: documents per place, cited and by seat counted apart and added up."""
    rows = locations.where(F.col("place_id").isNotNull()).join(docs.select("doc_uid"), "doc_uid", "left_semi")
    counts = rows.groupBy("place_id").agg(
        count_where(F.col("source") != SEAT, "doc_uid").alias("cited"),
        count_where(F.col("source") == SEAT, "doc_uid").alias("by_seat"))
    return counts.withColumn("documents", F.col("cited") + F.col("by_seat"))


def location_sources(locations: DataFrame) -> DataFrame:
    """IN-14: documents by the source of their first location, best source first, with percentages."""
    order = F.array_position(F.array(*[F.lit(s) for s in SOURCE_ORDER]), F.col("source"))
    one = locations.groupBy("doc_uid").agg(F.min_by("source", order).alias("source"))
    counts = one.groupBy("source").agg(F.count("*").alias("n"))
    return with_totals(counts, counts.agg(F.sum("n").alias("_t"))).withColumn(
        "pct", 100.0 * F.col("n") / F.col("_t")).drop("_t")


def by_biome(doc_biome: DataFrame, docs: DataFrame, source: str, include_all: bool) -> DataFrame:
    """IN-15: documents per biome and their share of all documents with one (shares may add up to over 100)."""
    rows = doc_biome.where(F.col("source") == source).join(docs.select("doc_uid"), "doc_uid", "left_semi")
    if not include_all:
        rows = rows.where(F.col("n_biomes") < ALL_BIOMES)
    counts = rows.groupBy("biome").agg(F.countDistinct("doc_uid").alias("documents"))
    return with_totals(counts, rows.agg(F.countDistinct("doc_uid").alias("_t"))).withColumn(
        "pct", 100.0 * F.col("documents") / F.col("_t")).drop("_t")


def by_programme(doc_ref: DataFrame, refs: DataFrame, level: str, kind: str = "kind") -> DataFrame:
    """IN-16: documents per value of one programme level and kind. ``doc_ref(doc_uid, reference, kind)``."""
    return doc_ref.join(refs.select("reference", level), "reference").groupBy(level, kind).agg(F.count("*").alias("n"))


def unit_item_matrix(members: DataFrame, items: Sequence, min_docs: int = 10, percent: bool = True) -> DataFrame:
    """IN-16: units x items, as documents or as the rounded percentage of the unit, for units with enough documents.

    ``members(doc_uid, unit_id, item)``.
    """
    wide = pivot_fill(members.select("doc_uid", "unit_id", "item").distinct(), ["unit_id"], "item", items,
                      F.count(F.lit(1)))
    total = sum((F.col(f"`{i}`") for i in items), F.lit(0))
    kept = wide.withColumn("n_docs", total).where(F.col("n_docs") >= min_docs)
    if not percent:
        return kept
    return kept.select("unit_id", *[F.round(100.0 * F.col(f"`{i}`") / F.col("n_docs") + 1e-9, 0).alias(str(i)) for i in items],
                       "n_docs")


def programme_structure(refs: DataFrame, doc_ref: DataFrame, levels: Sequence[str]) -> DataFrame:
    """IN-16: references and documents per combination of levels, 0 without documents."""
    n_refs = refs.groupBy(*levels).agg(F.countDistinct("reference").alias("n_references"))
    n_docs = doc_ref.join(refs, "reference").groupBy(*levels).agg(F.countDistinct("doc_uid").alias("n_docs"))
    return n_refs.join(n_docs, list(levels), "left").na.fill(0, ["n_docs"])


def item_units(members: DataFrame, item) -> DataFrame:
    """IN-16: units working on one item, their share of it and their specialisation."""
    rows = members.select("doc_uid", "unit_id", "item").distinct()
    per = rows.groupBy("unit_id").agg(F.count("*").alias("_t"), F.count_if(F.col("item") == item).alias("documents"))
    overall = rows.select("doc_uid", "item").distinct().agg(F.avg((F.col("item") == item).cast("double")).alias("_o"))
    joined = with_totals(per.where(F.col("documents") > 0), overall)
    return joined.select("unit_id", "documents", (100.0 * F.col("documents") / F.col("_t")).alias("pct_unit"),
                         ((F.col("documents") / F.col("_t")) / F.col("_o")).alias("specialisation"))


def inherit(doc_theme: DataFrame, mapping: DataFrame, docs: DataFrame, recent: Column) -> DataFrame:
    """IN-17: documents per programme item through their theme: primary, recent among them, secondary.

    ``doc_theme(doc_uid, theme)``, ``mapping(theme, item_1, item_2)``; ``recent`` is a condition on ``docs``.
    """
    rows = doc_theme.join(mapping, "theme").join(docs.select("doc_uid", recent.alias("_recent")), "doc_uid")
    primary = rows.where(F.col("item_1").isNotNull()).groupBy(F.col("item_1").alias("item")).agg(
        F.count("*").alias("n_primary"), F.count_if("_recent").alias("n_recent"))
    second = rows.where(F.col("item_2").isNotNull() & ~F.col("item_2").eqNullSafe(F.col("item_1"))).groupBy(
        F.col("item_2").alias("item")).agg(F.countDistinct("doc_uid").alias("n_secondary"))
    return primary.join(second, "item", "full").na.fill(0, ["n_primary", "n_recent", "n_secondary"])


# --- who works on what -----------------------------------------------------------------------------------------------


def role_weights(links: DataFrame, docs: DataFrame, years: int = RECENT_YEARS, ref_year: int | None = None) -> DataFrame:
    """One row per person and document with the largest role weight, halved when older than ``years``."""
    table = F.create_map(*[F.lit(x) for kv in ROLE_WEIGHT.items() for x in kv])
    best = links.groupBy("person_id", "doc_uid").agg(
        F.max(F.coalesce(table[F.col("role")], F.lit(1))).alias("_w"),
        F.bool_or(F.col("role") == "lider").alias("led"), F.bool_or(F.col("role") == "tecnologia").alias("technology"))
    rows = best.join(docs.select("doc_uid", "year"), "doc_uid")
    last = F.lit(ref_year) if ref_year is not None else docs.agg(F.max("year")).scalar()
    recent = F.coalesce(F.col("year") >= last - years + 1, F.lit(False))
    return rows.withColumn("recent", recent).withColumn(
        "weight", F.col("_w") * F.when(F.col("recent"), 1.0).otherwise(OLD_FACTOR)).drop("_w")


def who_works(weights: DataFrame, doc_axis: DataFrame, min_docs: int = 3, min_recent: int = 1, n_evidence: int = 5,
              ) -> DataFrame:
    """IN-18: people on each axis value with focus and ranked evidence. ``weights`` from :func:`role_weights`.

    Every row has its total and its evidence, so they are joined from the left: where they are not read, Spark leaves them out.
    """
    rows = weights.join(doc_axis.select("doc_uid", "axis").distinct(), "doc_uid")
    keys = ["person_id", "axis"]
    counts = rows.groupBy(*keys).agg(
        F.count("*").alias("n_docs"), F.count_if("recent").alias("n_recent"), F.count_if("led").alias("n_led"),
        F.count_if("technology").alias("n_technologies"), F.sum("weight").alias("weight"))
    named = F.col("person_id").isNotNull() & F.col("axis").isNotNull()
    kept = counts.where(named & (F.col("n_docs") >= min_docs) & (F.col("n_recent") >= min_recent))
    size = weights.groupBy("person_id").agg(F.count("*").alias("_all"))
    order = [F.col("recent").desc(), F.col("weight").desc(), F.col("year").desc(), F.col("doc_uid").asc()]
    best = top_n(rows.join(kept.select(*keys), keys, "left_semi"), keys, order, n_evidence, out="_rk")
    listed = F.array_sort(F.collect_list(F.struct("_rk", "doc_uid")))
    evidence = best.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["doc_uid"]), ";").alias("evidence"))
    return kept.join(size, "person_id", "left").join(evidence, keys, "left").select(
        *keys, "n_docs", "n_recent", "n_led", "n_technologies", F.round(F.col("weight"), 2).alias("weight"),
        F.round(F.col("n_docs") / F.col("_all") + 1e-9, 3).alias("focus"), "evidence")


def which_units(docs: DataFrame, doc_axis: DataFrame, cols: Sequence[str], listed: DataFrame | None = None,
                min_docs: int = 3, years: int = RECENT_YEARS) -> DataFrame:
    """IN-19: units on each axis value (or pair of values) with documents by kind and listed people.

    ``listed(<cols>, unit_id, person_id)`` are the people shown for the unit.
    """
    last = docs.agg(F.max("year")).scalar()
    keys = [*cols, "unit_id"]
    rows = doc_axis.select("doc_uid", *cols).distinct().join(
        docs.where(F.col("unit_id").isNotNull()).select("doc_uid", "kind", "year", "unit_id"), "doc_uid")
    counts = rows.groupBy(*keys).agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("year") >= last - years + 1).alias("n_recent"),
        *[count_where(F.col("kind") == k).alias("n_" + k) for k in KINDS]).where(F.col("n_docs") >= min_docs)
    if listed is None:
        return counts
    people = listed.groupBy(*keys).agg(F.countDistinct("person_id").alias("n_people"))
    return counts.join(people, keys, "left").na.fill(0, ["n_people"])


def top_units(units: DataFrame, cols: Sequence[str], n: int = 5) -> DataFrame:
    """IN-19: the ``n`` units with most documents per pair."""
    return top_n(units, cols, [F.col("n_docs").desc(), "unit_id"], n)


def axis_network(doc_a: DataFrame, doc_b: DataFrame, docs: DataFrame, keywords: DataFrame, own: DataFrame,
                 min_docs: int = 3, per_a: int = 12, years: int = RECENT_YEARS, caps: Mapping[str, int] = EXAMPLE_CAPS,
                 ) -> DataFrame:
    """IN-20: pairs of two axes with counts, typical keywords and example documents.

    ``doc_a(doc_uid, a)``, ``doc_b(doc_uid, b)``; at most ``per_a`` values of b per value of a.
    """
    last = docs.agg(F.max("year")).scalar()
    rows = doc_a.select("doc_uid", "a").distinct().join(doc_b.select("doc_uid", "b").distinct(), "doc_uid").join(
        docs.select("doc_uid", "kind", "year"), "doc_uid")
    counts = rows.groupBy("a", "b").agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("year") >= last - years + 1).alias("n_recent"))
    pairs = top_n(counts.where(F.col("n_docs") >= min_docs), ["a"], [F.col("n_docs").desc(), "b"], per_a)
    kept = rows.join(pairs.select("a", "b"), ["a", "b"], "left_semi")
    words = pair_keywords(kept, keywords, own, docs.agg(F.countDistinct("doc_uid")).scalar())
    order = [F.col("year").desc(), F.col("doc_uid").asc()]
    best = top_n_by_kind(kept, ["a", "b"], "kind", caps, order)
    example = F.array_sort(F.collect_list(F.struct((-F.col("year")).alias("y"), "doc_uid")))
    examples = best.groupBy("a", "b").agg(F.array_join(F.transform(example, lambda x: x["doc_uid"]), ";").alias("docs"))
    return pairs.join(words, ["a", "b"], "left").join(examples, ["a", "b"], "left").na.fill("", ["keywords", "docs"])


# --- extracts and reports --------------------------------------------------------------------------------------------


def enrichment(docs: DataFrame, tags: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """IN-21: one row per document with sorted ``;`` lists; a document without any tag is left out.

    The tag tables are stacked before the one aggregation, so there is one shuffle and no chain of joins.
    """
    stacked = union_by_name(*[
        df.select("doc_uid", F.lit(name).alias("_tag"), F.col(col).cast("string").alias("_v")) for name, (df, col) in tags.items()])
    lists = stacked.where(F.col("_v").isNotNull()).groupBy("doc_uid").agg(*[
        F.array_sort(F.collect_set(F.when(F.col("_tag") == name, F.col("_v")))).alias(name) for name in tags])
    shown = lists.select("doc_uid", *[F.when(F.size(n) > 0, F.array_join(n, ";")).alias(n) for n in tags])
    return shown.join(docs.select("doc_uid"), "doc_uid", "left_semi")


def people_extract(people: DataFrame, weights: DataFrame, listed: DataFrame) -> DataFrame:
    """IN-22: listed people with a public id, documents and last year. ``people(person_id, display_name, unit_id)``."""
    total = weights.groupBy("person_id").agg(F.count("*").alias("n_docs"), F.max("year").alias("last_year"))
    return people.join(listed.select("person_id").distinct(), "person_id", "left_semi").join(total, "person_id").select(
        public_id(F.col("person_id")).alias("person"), "display_name", "unit_id", "n_docs", "last_year")


def referenced_docs(lists: DataFrame, col: str, docs: DataFrame, sep: str = ";") -> DataFrame:
    """IN-23: documents named in any of the lists."""
    named = lists.select(F.explode(F.split(col, sep)).alias("_d")).where(F.col("_d") != "").distinct()
    return docs.join(named, F.col("doc_uid").cast("string") == F.col("_d"), "left_semi")


def several(df: DataFrame, group: str, item: str) -> DataFrame:
    """Groups with two or more different items, as works with several depositing units."""
    return df.groupBy(group).agg(F.countDistinct(item).alias("n")).where(F.col("n") > 1)


def quality_metrics(tables: Mapping[str, DataFrame], links: DataFrame, shares: Mapping[str, tuple[DataFrame, Column]],
                    spans: Mapping[str, tuple[DataFrame, str]] | None = None,
                    counts: Mapping[str, tuple[DataFrame, Column]] | None = None) -> DataFrame:
    """IN-24: (metric, value): rows per table, links per role and level with their percentage, shares of rows, first and
    last year per kind, and counts of rows that meet a condition (works of several units, links into the base, types without
    a group)."""
    rows = [df.agg(F.count("*").cast("double").alias("value")).select(F.lit("rows " + n).alias("metric"), "value")
            for n, df in tables.items()]
    graded = links.groupBy("role", "level").agg(F.count("*").alias("n"))
    sizes = graded.groupBy("role").agg(F.sum("n").alias("_t"))
    levels = graded.join(sizes, "role").select(
        F.explode(F.array(
            F.struct(F.concat_ws(" ", F.lit("links"), "role", "level").alias("metric"), F.col("n").cast("double").alias("value")),
            F.struct(F.concat_ws(" ", F.lit("pct"), "role", "level").alias("metric"), (100.0 * F.col("n") / F.col("_t")).alias("value")),
        )).alias("m")).select("m.*")
    parts = [df.agg(F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias("value")).select(
        F.lit("share " + n).alias("metric"), "value") for n, (df, c) in shares.items()]
    for n, (df, year) in (spans or {}).items():
        ends = df.agg(F.min(year).cast("double").alias("first"), F.max(year).cast("double").alias("last"))
        parts.append(ends.select(F.explode(F.array(
            F.struct(F.lit("first " + n).alias("metric"), F.col("first").alias("value")),
            F.struct(F.lit("last " + n).alias("metric"), F.col("last").alias("value")))).alias("m")).select("m.*"))
    parts += [df.agg(F.count_if(c).cast("double").alias("value")).select(F.lit("count " + n).alias("metric"), "value")
              for n, (df, c) in (counts or {}).items()]
    return union_by_name(*rows, levels, *parts)


def theme_table(doc_theme: DataFrame, docs: DataFrame, labels: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """IN-25: themes with label and documents per kind. ``doc_theme(doc_uid, theme)``, ``labels(theme, label)``."""
    rows = doc_theme.join(docs.select("doc_uid", "kind"), "doc_uid")
    return pivot_fill(rows, ["theme"], "kind", kinds, F.count(F.lit(1))).join(labels, "theme", "left")


def theme_sheet(themes: DataFrame) -> DataFrame:
    """IN-25: themes with the label of their parent, their own as the automatic one, and an empty label to fill in.

    ``themes(theme, level, parent, label, ...)``; terms and counts per kind pass through.
    """
    above = themes.select(F.col("theme").alias("parent"), F.col("label").alias("parent_label"))
    rest = [c for c in themes.columns if c not in ("theme", "level", "parent", "label")]
    return themes.join(above, "parent", "left").select(
        "theme", "level", "parent_label", F.col("label").alias("automatic_label"), *rest, F.lit("").alias("label"))


def curation_sheet(themes: DataFrame, doc_theme: DataFrame, titles: DataFrame, n: int = 3, width: int = 90) -> DataFrame:
    """IN-25: themes with their most typical titles, cut, and an empty column for the decision.

    ``doc_theme(doc_uid, theme, score)``, ``titles(doc_uid, title)``.
    """
    best = top_n(doc_theme, ["theme"], [F.col("score").desc(), "doc_uid"], n, out="_rk").join(titles, "doc_uid")
    listed = F.array_sort(F.collect_list(F.struct("_rk", F.substring("title", 1, width).alias("t"))))
    examples = best.groupBy("theme").agg(F.array_join(F.transform(listed, lambda x: x["t"]), " || ").alias("examples"))
    return themes.join(examples, "theme", "left").withColumn("decision", F.lit(""))


def items_in_parent(df: DataFrame, min_n: int = 5, share: float = 0.005) -> DataFrame:
    """IN-26: items of each parent with at least max(``min_n``, ``share`` of its documents) documents.

    ``df(parent, item, doc_uid)``.
    """
    size = df.groupBy("parent").agg(F.countDistinct("doc_uid").alias("_t"))
    counts = df.groupBy("parent", "item").agg(F.countDistinct("doc_uid").alias("n"))
    return counts.join(size, "parent").where(F.col("n") >= F.greatest(F.lit(float(min_n)), share * F.col("_t"))).drop("_t")


def citations(links: DataFrame, record_work: DataFrame, docs: DataFrame) -> DataFrame:
    """IN-27: technology and cited work with the year of the work, for lookups both ways.

    ``links(origin, target)`` on records, ``record_work(doc_uid, work)``, ``docs(doc_uid, year)`` on works.
    """
    works = record_work.select(F.col("doc_uid").alias("target"), "work")
    return links.join(works, "target").select("origin", "work").distinct().join(
        docs.select(F.col("doc_uid").alias("work"), "year"), "work")


def check_mapping(mapping: DataFrame, themes: DataFrame, codes: DataFrame) -> DataFrame:
    """IN-28: every theme mapped, every code known, else an error naming up to 20 of each.

    ``mapping(theme, item_1, item_2)``, ``themes(theme)``, ``codes(item)``.
    """
    unmapped = themes.select("theme").distinct().join(mapping, "theme", "left_anti").limit(20).collect()
    used = mapping.select(F.explode(F.array("item_1", "item_2")).alias("item")).where(
        F.coalesce(F.col("item"), F.lit("")) != "")
    unknown = used.distinct().join(codes, "item", "left_anti").limit(20).collect()
    if unmapped or unknown:
        raise ValueError(f"themes without a row: {sorted(str(r[0]) for r in unmapped)}; "
                         f"unknown codes: {sorted(r[0] for r in unknown)}")
    return mapping


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """IN-29: rows in which two independent computations differ (none when they agree)."""
    keys = as_list(keys)
    left = a.select(*keys, F.col(value).alias("a"))
    right = b.select(*keys, F.col(value).alias("b"))
    return left.join(right, keys, "full").where(~F.col("a").eqNullSafe(F.col("b")))
