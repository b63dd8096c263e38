"""People: consolidation of records, leaders, signatures, overrides, review.

Levels of a link: A certain, B clear, C ambiguous, D no candidate, M decided by hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.functions.text import (
    COMPATIBLE, EXACT, display_name, initials_compat, name_key, name_tokens, names_compatible, parse_signature,
    signature_of, squish,
)
from foliograph.operators.graph import components
from foliograph.plans.session import cut_lineage, written
from foliograph.plans.shapes import (
    attach_group, block_pairs, join_sorted, keep_first, many_to_many, modal, symmetrise, top_n, union_by_name,
)

# Fixed values -------------------------------------------------------------------------------------------------------
RESOLVED = ["A", "B", "M"]
HEAD_OFFICE = "sede"
EXTERNAL = "EXTERNO"
LEADER, AUTHOR = "lider", "autor"
NO_CANDIDATE, BY_SIGNATURE, BY_HAND = "sem_candidato", "assinatura", "manual"
FROM_DEPOSIT, FROM_PERSON = "depositante_conhecida", "referencia_pessoa"
BY_AFFILIATION, BY_OUTPUT, BY_CENTRAL = "afiliacao", "inferida_producao", "afiliacao_central"
LABEL_AMBIGUOUS, LABEL_EXTERNAL = " (identificação ambígua)", " (autor externo)"
LABEL_UNKNOWN = " (não identificado na base de pessoas)"
# evidence points
POINTS_EXACT, POINTS_COMPATIBLE, POINTS_UNIT, POINTS_COAUTHOR, MAX_COAUTHORS = 3, 1, 3, 2, 2
RARE_SURNAME, UNIQUE_SURNAME = 3, 1
LEARNED_WORKS = 2
# what settles the candidates of a mention, and with the units of its work their points but those for co-authors; numbers stand for both
SPELLING = ["surname", "initials"]
CELL = ["form", "unit_set"]
SHARES = 8  # parts of the cells of a spelling
# --------------------------------------------------------------------------------------------------------------------


def alias_table(*sources: tuple[DataFrame, str, str, str]) -> DataFrame:
    """ER-1: (table, alias column, id column, kind) in order of precedence to one alias key per row."""
    parts = [
        df.select(F.col(alias).alias("alias"), F.col(key).alias("unit_id"), F.lit(kind).alias("kind"),
                  F.lit(i).alias("_source"))
        for i, (df, alias, key, kind) in enumerate(sources)
    ]
    keyed = union_by_name(*parts).withColumn("key", name_key(F.col("alias"))).where(F.col("key").isNotNull())
    return keep_first(keyed, ["key"], ["_source", "unit_id", "alias"]).drop("_source")


# --- people ----------------------------------------------------------------------------------------------------------


def person_records(raw: DataFrame) -> DataFrame:
    """ER-5, first step: records of one name and signature surname get the person id of the lowest record.

    ``raw(record_id, name, previous_name, signature, unit_id, active)``.
    """
    sign = parse_signature(F.col("signature"))
    rows = raw.select(
        "record_id", squish("name").alias("name"), squish("previous_name").alias("previous_name"),
        squish("signature").alias("signature"), "unit_id", "active",
    ).select(
        "*", name_key(F.col("name")).alias("name_norm"), sign["surname"].alias("surname"),
        sign["initials"].alias("initials"))
    return attach_group(rows, ["name_norm", "surname"], person=F.min("record_id"))


def merge_variants(records: DataFrame, head: str = HEAD_OFFICE) -> DataFrame:
    """ER-6: people of one signature with compatible names are one, in the same unit or with one at head office.

    Compatible names share their first and last token, so both are part of the block key.
    """
    records = cut_lineage(records)
    forms = records.select("person", "surname", "initials", "unit_id", name_tokens(F.col("name_norm")).alias("tokens"))
    forms = forms.where(F.size("tokens") >= 2).select(
        "*", F.element_at("tokens", 1).alias("first"), F.element_at("tokens", -1).alias("last")).distinct()
    near = block_pairs(
        forms, ["surname", "initials", "first", "last"], "person", ["tokens", "unit_id"],
        residual=lambda: (F.col("unit_id1") == F.col("unit_id2")) | (F.col("unit_id1") == head)
        | (F.col("unit_id2") == head))
    edges = near.where(names_compatible("tokens1", "tokens2")).select(
        F.col("person1").alias("a"), F.col("person2").alias("b"))
    groups = components(edges, records.select(F.col("person").alias("id")))
    return records.join(groups.withColumnRenamed("id", "person"), "person").drop("person").withColumnRenamed(
        "component", "person")


def consolidate_people(records: DataFrame, centres: DataFrame, prefix: str = "PE") -> DataFrame:
    """ER-5: one row per person, attributes from the active, newest record.

    ``centres(unit_id)`` are the research centres among the units.
    """
    order = [F.col("active").desc(), F.col("record_id").desc()]
    first = keep_first(records, ["person"], order).select(
        "person", "name_norm", display_name(F.col("name")).alias("base_name"), "signature", "unit_id")
    totals = records.groupBy("person").agg(F.bool_or("active").alias("active"), F.count("*").alias("n_records"))
    flagged = first.join(centres.select("unit_id").distinct().withColumn("in_centre", F.lit(True)), "unit_id", "left")
    return flagged.join(totals, "person").select(
        F.concat(F.lit(prefix), "person").alias("person_id"), "name_norm", "base_name", "signature", "unit_id",
        "active", "n_records", F.coalesce("in_centre", F.lit(False)).alias("in_centre"))


def name_forms(records: DataFrame, prefix: str = "PE") -> DataFrame:
    """ER-7: names a person is known by; the current name wins over an equal previous one."""
    person = F.concat(F.lit(prefix), "person").alias("person_id")
    current = records.select(person, "name_norm", F.lit("nome").alias("origin"), F.lit(0).alias("_p"))
    before = records.where(F.col("previous_name").isNotNull()).select(
        person, name_key(F.col("previous_name")).alias("name_norm"), F.lit("nome_anterior").alias("origin"),
        F.lit(1).alias("_p"))
    return keep_first(current.unionByName(before), ["person_id", "name_norm"], ["_p"]).drop("_p")


def signature_forms(records: DataFrame, names: DataFrame, prefix: str = "PE") -> DataFrame:
    """ER-7: signatures a person may use, given ones first, then those derived from each name."""
    given = records.select(F.concat(F.lit(prefix), "person").alias("person_id"), "surname", "initials",
                           F.lit("autoria").alias("origin"), F.lit(0).alias("_p"))
    sign = signature_of(F.col("name_norm"))
    derived = names.select("person_id", sign["surname"].alias("surname"), sign["initials"].alias("initials"),
                           F.concat(F.lit("derivada_"), "origin").alias("origin"),
                           F.when(F.col("origin") == "nome", 1).otherwise(2).alias("_p"))
    forms = given.unionByName(derived).where(F.coalesce(F.col("surname"), F.lit("")) != "")
    return keep_first(forms, ["person_id", "surname", "initials"], ["_p"]).drop("_p")


def surname_rarity(signatures: DataFrame) -> DataFrame:
    """ER-22: people per surname."""
    return signatures.groupBy("surname").agg(F.countDistinct("person_id").alias("people"))


# --- leaders ---------------------------------------------------------------------------------------------------------


def _leader_candidates(raw: DataFrame, names: DataFrame) -> DataFrame:
    """People for every spelling: those with the same normalised name, else those with a compatible one."""
    spelled = cut_lineage(raw.where(F.col("raw").isNotNull()).select("raw").distinct().select(
        "raw", name_key(F.col("raw")).alias("name_norm"), name_tokens(F.col("raw")).alias("ta")))
    exact = keep_first(
        spelled.select("raw", "name_norm").join(names, "name_norm"), ["raw", "person_id"],
        [F.when(F.col("origin") == "nome", 0).otherwise(1)],
    ).select("raw", "person_id", F.lit(True).alias("exact"), F.lit(99).alias("min_tokens"),
             F.concat(F.lit("exato_"), "origin").alias("method"))
    exact = cut_lineage(exact)

    def ends(df: DataFrame, tokens: str) -> DataFrame:
        return df.where(F.size(tokens) > 0).withColumn("_first", F.element_at(tokens, 1)).withColumn(
            "_last", F.element_at(tokens, -1))

    rest = ends(spelled.join(exact.select("raw").distinct(), "raw", "left_anti").select("raw", "ta"), "ta")
    # of the names of a person the first compatible one counts, the current name before previous ones
    place = F.struct((F.col("origin") != "nome").alias("later"), "name_norm")
    known = ends(names.groupBy("person_id", name_tokens(F.col("name_norm")).alias("tb")).agg(F.min(place).alias("place")), "tb")
    near = many_to_many(rest, known, ["_first", "_last"]).where(names_compatible("ta", "tb"))
    near = near.groupBy("raw", "person_id").agg(F.min_by(F.least(F.size("ta"), F.size("tb")), "place").alias("min_tokens"))
    return exact.unionByName(near.select(
        "raw", "person_id", F.lit(False).alias("exact"), "min_tokens", F.lit("tokens").alias("method")))


def resolve_leaders(docs: DataFrame, names: DataFrame, person_unit: DataFrame) -> DataFrame:
    """ER-8: the person behind a full name.

    ``docs(doc_uid, unit_id, raw)``, ``names(person_id, name_norm, origin)``, ``person_unit(person_id, unit_id)`` with
    one unit per person and one row per document. Candidates depend on the spelling alone, and the evidence of a unit on the
    spelling and the unit: both are summed up before documents join them, so a document meets one row of each and never
    its candidates.
    """
    units = person_unit.select("person_id", F.col("unit_id").alias("_unit"))
    found = _leader_candidates(docs, names.select("person_id", "name_norm", "origin")).join(units, "person_id", "left")
    spelled = found.groupBy("raw").agg(
        F.count("*").alias("n"),
        F.min_by(F.struct("person_id", "min_tokens", "method", "exact"), "person_id").alias("f"),
        F.array_sort(F.collect_list(F.struct("person_id", F.lit(None).cast("int").alias("score")))).alias("candidates"))
    of_unit = found.where(F.col("_unit").isNotNull()).groupBy("raw", F.col("_unit").alias("unit_id")).agg(
        F.count("*").alias("n_unit"), F.min("person_id").alias("by_unit"))
    grouped = docs.select("doc_uid", "unit_id", "raw").join(of_unit, ["raw", "unit_id"], "left").na.fill(0, ["n_unit"]).join(spelled, "raw", "left")
    sure = F.when(F.col("f.exact"), "A").otherwise("B")
    alone = (F.col("n") == 1) & (F.col("f.exact") | (F.col("n_unit") == 1) | (F.col("f.min_tokens") >= 3))
    level = F.when(F.col("n").isNull(), "D").when(alone | ((F.col("n") > 1) & (F.col("n_unit") == 1)), sure).otherwise("C")
    return grouped.withColumn("level", level).select(
        "doc_uid",
        F.when(F.col("level").isin("C", "D"), None).when(F.col("n") == 1, F.col("f.person_id")).otherwise(F.col("by_unit"))
        .alias("person_id"),
        F.lit(LEADER).alias("role"), F.lit(1).alias("ord"), "raw", "level",
        F.coalesce("f.method", F.lit(NO_CANDIDATE)).alias("method"),
        F.lit(None).cast("int").alias("score"), F.when(F.col("level") == "C", F.col("candidates")).alias("candidates"))


def person_units(people: DataFrame, leaders: DataFrame, docs: DataFrame) -> DataFrame:
    """ER-17: units that speak for a person: affiliation to a centre, and units of led projects."""
    led = leaders.where(F.col("level").isin(RESOLVED)).join(docs.select("doc_uid", "unit_id"), "doc_uid")
    return people.where("in_centre").select("person_id", "unit_id").unionByName(
        led.select("person_id", "unit_id")).distinct()


# --- signatures ------------------------------------------------------------------------------------------------------


def explode_mentions(df: DataFrame, doc: str, work: str, authors: str, sep: str = ";") -> DataFrame:
    """ER-9: one row per signature with its 1-based place in the list (blank entries keep theirs).

    The rows are a table, and a signature is parsed once for all mentions that spell it alike.
    """
    rows = df.select(F.col(doc).alias("doc_uid"), F.col(work).alias("work"),
                     F.posexplode(F.split(F.col(authors), sep)).alias("_p", "raw"))
    rows = written(rows.withColumn("raw", squish("raw")).where(F.col("raw") != ""))
    sign = parse_signature(F.col("raw"))
    parsed = written(rows.select("raw").distinct().select(
        F.col("raw").alias("_raw"), sign["surname"].alias("surname"), sign["initials"].alias("initials")))
    return rows.join(parsed, F.col("raw") == F.col("_raw")).select("doc_uid", "work", (F.col("_p") + 1).alias("ord"), "raw", "surname", "initials")


def form_candidates(mentions: DataFrame, signatures: DataFrame) -> DataFrame:
    """ER-10 per distinct signature: people whose signature has the same surname and compatible initials."""
    head = F.substring("initials", 1, 1).alias("_head")
    # a table, as the join reads it for its rows and for its counts, and behind it are all mentions
    forms = written(mentions.where(F.col("initials") != "").select("surname", "initials").distinct().select("*", head))
    known = signatures.where(F.col("initials") != "").select(
        "person_id", "surname", F.col("initials").alias("_known"), head)
    met = many_to_many(forms, known, ["surname", "_head"]).withColumn("_c", initials_compat("initials", "_known"))
    return met.where(F.col("_c").isin(EXACT, COMPATIBLE)).groupBy("surname", "initials", "person_id").agg(
        F.bool_or(F.col("_c") == EXACT).alias("exact"))


def candidates(mentions: DataFrame, signatures: DataFrame) -> DataFrame:
    """ER-10: (doc_uid, ord, work, person_id, exact, n_ini, people), ``people`` being those with the surname.

    What depends on the spelling alone is worked out per spelling and joins the mentions as numbers.
    """
    forms = form_candidates(mentions, signatures).join(surname_rarity(signatures), "surname").withColumn(
        "n_ini", F.length("initials"))
    return mentions.select("doc_uid", "ord", "work", "surname", "initials").join(
        forms, ["surname", "initials"]).drop("surname", "initials")


def learned_units(resolved: DataFrame, work_units: DataFrame) -> DataFrame:
    """Units in which a person is already resolved in at least two works."""
    seen = resolved.select("work", "person_id").distinct().join(work_units, "work")
    counts = seen.groupBy("person_id", "unit_id").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= LEARNED_WORKS).select("person_id", "unit_id")


def unit_evidence(forms: DataFrame, units: DataFrame) -> DataFrame:
    """``forms`` with ``speaking``, the units that speak for the person; null for a person without one."""
    return forms.join(units.groupBy("person_id").agg(F.collect_set("unit_id").alias("speaking")), "person_id", "left")


def _of_unit() -> Column:
    return F.coalesce(F.arrays_overlap("units", "speaking"), F.lit(False))


def coauthor_evidence(signed: DataFrame, forms: DataFrame, resolved: DataFrame, unit_sets: DataFrame) -> DataFrame:
    """``(doc_uid, ord, work, form, unit_set, person_id, exact, unit, n_coauthors)``: candidates who signed another work with a resolved co-signer.

    The works of a pair are needed only as "some work other than this one", so each pair keeps a count and a minimum, and so does
    a co-signer of a work for "some mention other than this one". Mentions meet the partners of their co-signers by spelling, so
    no row is made for a candidate without evidence. ``unit_sets(unit_set, units)`` are the units of works, ``forms`` has those of the person.
    """
    works = resolved.select("work", "person_id").distinct()
    pairs = block_pairs(works, ["work"], "person_id").groupBy("person_id1", "person_id2").agg(
        F.count("*").alias("n_works"), F.min("work").alias("one_work"))
    partners = symmetrise(pairs, "person_id1", "person_id2").join(forms.withColumnRenamed("person_id", "person_id1"), "person_id1")
    others = resolved.groupBy("work", F.col("person_id").alias("person_id2")).agg(
        F.count("*").alias("n_mentions"), F.min(F.struct("doc_uid", "ord")).alias("one_mention"))
    near = signed.join(others, "work").where((F.col("n_mentions") > 1) | (F.col("one_mention") != F.struct("doc_uid", "ord")))
    met = near.join(partners, ["person_id2", "form"]).where((F.col("n_works") > 1) | (F.col("one_work") != F.col("work")))
    return met.join(unit_sets, "unit_set").groupBy("doc_uid", "ord", "work", *CELL, F.col("person_id1").alias("person_id")).agg(
        F.bool_or("exact").alias("exact"), F.bool_or(_of_unit()).alias("unit"), F.count("*").cast("int").alias("n_coauthors"))


def _score(exact: Column, unit: Column, n_coauthors: Column) -> Column:
    return (F.when(exact, POINTS_EXACT).otherwise(POINTS_COMPATIBLE) + F.when(unit, POINTS_UNIT).otherwise(0)
            + POINTS_COAUTHOR * F.least(n_coauthors, F.lit(MAX_COAUTHORS)))


def score(cand: DataFrame) -> DataFrame:
    """ER-11: points of candidates with ``exact``, ``unit`` and ``n_coauthors``."""
    return cand.withColumn("score", _score(F.col("exact"), F.col("unit"), F.col("n_coauthors")))


def _ranking() -> Column:
    return F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "person_id", "exact", "unit", "n_coauthors")))


def _points(ranking) -> Column:
    return F.transform(ranking, lambda x: F.struct(x["person_id"].alias("person_id"), (-x["down"]).alias("score")))


def cell_candidates(cells: DataFrame, forms: DataFrame) -> DataFrame:
    """Candidates of each cell, a spelling in works of the same units, without co-authors: the best two and all of them.

    Spelling and units settle everything else, so this is worked out per cell and not per mention. The candidates of a spelling
    are one row that its cells meet, and no row is made of a candidate of a cell. ``cells(form, unit_set, units, ...)``.
    """
    people = forms.groupBy("form").agg(F.collect_list(F.struct("person_id", "exact", "speaking")).alias("_people")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))).select("form", F.col("_part").cast("long").alias("_part"), "_people")
    none = F.lit(0)

    def placed(c) -> Column:
        unit = F.coalesce(F.arrays_overlap("units", c["speaking"]), F.lit(False))
        return F.struct((-_score(c["exact"], unit, none)).alias("down"), c["person_id"].alias("person_id"), c["exact"].alias("exact"),
                        unit.alias("unit"), none.alias("n_coauthors"))

    # few bytes that take long: a fixed number of partitions, as AQE would put them into one task
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = cells.withColumn("_part", F.pmod("unit_set", F.lit(SHARES).cast("long"))).repartition(parts, "form", "_part")
    ranked = shared.join(people.repartition(parts, "form", "_part"), ["form", "_part"]).withColumn("r", F.sort_array(F.transform("_people", placed)))
    best = F.transform(F.slice("r", 1, 2), lambda x: F.struct(*[x[c].alias(c) for c in ("person_id", "exact", "unit", "n_coauthors")]))
    return ranked.select(*[c for c in cells.columns if c != "units"], best.alias("best"), _points("r").alias("listed"))


def telling_candidates(of_cell: DataFrame, evidence: DataFrame) -> DataFrame:
    """Candidates of a mention with co-authors that may decide it: those with co-authors and the best two of its cell.

    Co-authors only add points, so whoever is not among them has two before them in any case.
    """
    named = evidence.groupBy("doc_uid", "ord", "work", *CELL).agg(
        F.collect_list(F.struct("person_id", "exact", "unit", "n_coauthors")).alias("_near"))
    joined = named.join(of_cell, CELL)
    near = F.transform("_near", lambda x: x["person_id"])
    rows = F.concat("_near", F.filter("best", lambda x: ~F.array_contains(near, x["person_id"])))
    return joined.select("doc_uid", "ord", "work", "n_ini", "people", "n", "n_exact", F.explode(rows).alias("_c")).select("*", "_c.*").drop("_c")


def decide(scored: DataFrame) -> DataFrame:
    """ER-13: one decision per mention, or per cell of mentions; the lowest person id wins a tie in points.

    Rows with ``n`` and ``n_exact``, the numbers of all candidates, may leave out candidates behind the best two.
    """
    key = CELL if "form" in scored.columns else ["doc_uid", "ord", "work"]
    mention = [*key, "n_ini", "people"]
    if "n" in scored.columns:
        grouped = scored.groupBy(*mention, "n", "n_exact").agg(_ranking().alias("r"))
    else:
        grouped = scored.groupBy(*mention).agg(F.count("*").alias("n"), F.count_if("exact").alias("n_exact"), _ranking().alias("r"))
    one = grouped.select(
        "*", F.col("r")[0].alias("b"), (-F.col("r")[0]["down"]).alias("s1"),
        F.coalesce(-F.get("r", F.lit(1))["down"], F.lit(0)).alias("s2"))
    single, several = F.col("n") == 1, F.col("n") > 1
    margin = F.col("s1") - F.col("s2")
    telling = (
        (F.col("n_ini") >= 3) | ((F.col("n_ini") >= 2) & (F.col("people") <= RARE_SURNAME))
        | (F.col("people") <= UNIQUE_SURNAME))
    level = (
        F.when(single & F.col("b.exact") & F.col("b.unit"), "A")
        .when(single & F.col("b.exact") & telling, "B")
        .when(single & (F.col("b.unit") | (F.col("b.n_coauthors") >= 1)), "B")
        .when(several & F.col("b.exact") & (F.col("n_exact") == 1) & (F.col("n_ini") >= 2) & (margin >= 2), "B")
        .when(several & (F.col("s1") >= 5) & (margin >= 3), "B")
        .otherwise("C"))
    return one.select(
        *key, F.col("b.person_id").alias("person_id"), level.alias("level"),
        F.col("s1").alias("score"), _points("r").alias("candidates"))


def demote_conflicts(decided: DataFrame) -> DataFrame:
    """ER-14: one person resolved twice in a record makes all those mentions ambiguous.

    A window over (record, person), whose groups are a few mentions: joining a count back would work out the whole round
    twice.
    """
    sure = F.col("level").isin("A", "B")
    n = F.count_if(sure).over(W.partitionBy("doc_uid", "person_id"))
    return decided.withColumn("level", F.when(sure & (n > 1), "C").otherwise(F.col("level")))


def _numbered(df: DataFrame, out: str) -> DataFrame:
    """Rows with a number of their own, which travels in their place."""
    return written(df.withColumn(out, F.monotonically_increasing_id()))


def _same(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with the further columns of ``other``; null keys are equal."""
    named = other.withColumnsRenamed({k: "_" + k for k in keys})
    same = [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys]
    return df.join(named, same).drop(*["_" + k for k in keys])


def resolve_mentions(mentions: DataFrame, signatures: DataFrame, known_units: DataFrame, work_units: DataFrame,
                     rounds: int = 3) -> DataFrame:
    """ER-12: signatures to people in rounds; each round learns units and co-authors from the one before.

    ``mentions`` from :func:`explode_mentions`, ``signatures(person_id, surname, initials)``,
    ``known_units(person_id, unit_id)``, ``work_units(work, unit_id)``. What spelling and units settle is worked out and decided per
    cell (:func:`cell_candidates`); only mentions of which a candidate has co-authors are decided by themselves. Mentions carry numbers for
    their spelling and units, and a list of all candidates meets them once, at the end, if they are ambiguous. Every round but the
    last materialises the mentions it resolved, in the shared checkpoint folder.
    """
    deposits = cut_lineage(work_units.where(F.col("unit_id").isNotNull()).select("work", "unit_id").distinct())
    of_work = deposits.groupBy("work").agg(F.array_sort(F.collect_set("unit_id")).alias("units"))
    nowhere = F.array().cast(of_work.schema["units"].dataType)
    # tables and not checkpoints: they are small as columns, and a checkpoint holds rows in many times their size
    mentions = written(mentions.select("doc_uid", "ord", "work", "raw", *SPELLING))
    spelt = _numbered(mentions.select(*SPELLING).distinct(), "form")
    raws = _numbered(_same(mentions.select("raw", *SPELLING).distinct(), spelt, SPELLING), "spelling")
    unit_sets = _numbered(of_work.select("units").unionByName(of_work.sparkSession.range(1).select(nowhere.alias("units"))).distinct(), "unit_set")
    set_of_work = of_work.join(unit_sets, "units").select("work", "unit_set")
    empty = unit_sets.where(F.size("units") == 0).select("unit_set").scalar()
    signed = _same(mentions, raws, ["raw", *SPELLING]).select("doc_uid", "ord", "work", "spelling", "form")
    signed = written(signed.join(set_of_work, "work", "left").withColumn("unit_set", F.coalesce("unit_set", empty)))
    forms = cut_lineage(form_candidates(spelt, signatures).join(spelt, SPELLING).drop(*SPELLING))
    known = forms.groupBy("form").agg(F.count("*").alias("n"), F.count_if("exact").alias("n_exact")).join(spelt, "form").join(
        surname_rarity(signatures), "surname").withColumn("n_ini", F.length("initials")).drop(*SPELLING)
    cells = written(signed.select(*CELL).distinct().join(known, "form").join(unit_sets, "unit_set"))
    rows = signed.select("doc_uid", "ord", "work", *CELL)
    resolved = rows.select("doc_uid", "ord", "work", F.lit(None).cast(forms.schema["person_id"].dataType).alias("person_id")).where(F.lit(False))
    for i in range(rounds):
        units = known_units.select("person_id", "unit_id").unionByName(learned_units(resolved, deposits))
        speaking = cut_lineage(unit_evidence(forms, units))
        listed = cell_candidates(cells, speaking)
        of_cell = written(listed.drop("listed"))
        judged = written(decide(score(of_cell.withColumn("_c", F.explode("best")).select("*", "_c.*").drop("best", "_c"))))
        evidence = written(telling_candidates(of_cell, coauthor_evidence(rows, speaking, resolved, unit_sets)))
        alone = decide(score(evidence))
        sure = rows.join(judged.where(F.col("level").isin("A", "B")), CELL).drop(*CELL)
        sure = sure.join(evidence.select("doc_uid", "ord").distinct(), ["doc_uid", "ord"], "left_anti")
        decided = demote_conflicts(alone.unionByName(sure))
        if i < rounds - 1:
            kept = decided.where(F.col("level").isin("A", "B"))
            resolved = written(kept.select("doc_uid", "ord", "work", "person_id"))
    # what the cell does not say: mentions decided by themselves, and sure ones, which may have lost a conflict
    outcome = decided.select("doc_uid", "ord", F.struct("person_id", "level", "score", "candidates").alias("_own"))
    of_all = judged.select(*CELL, F.struct("person_id", "level", "score", "candidates").alias("_cell")).join(listed.select(*CELL, "listed"), CELL)
    joined = signed.drop("work").join(outcome, ["doc_uid", "ord"], "left").join(of_all, CELL, "left").join(raws.select("spelling", "raw"), "spelling")
    said = F.coalesce("_own", "_cell")
    level = F.coalesce(said["level"], F.lit("D"))
    joined = joined.select("doc_uid", "ord", "raw", "listed", level.alias("level"), said["person_id"].alias("person_id"), said["score"].alias("score"),
                           F.col("_own.candidates").alias("candidates"))
    ids = F.transform("candidates", lambda x: x["person_id"])
    order = lambda c: F.transform(c, lambda x: F.struct((-x["score"]).alias("down"), x["person_id"].alias("person_id")))
    behind = F.filter("listed", lambda x: ~F.array_contains(ids, x["person_id"]))
    whole = F.when(F.col("candidates").isNull() | (F.col("candidates") == F.slice("listed", 1, 2)), F.col("listed")).otherwise(
        _points(F.array_sort(F.concat(order("candidates"), order(behind)))))
    return joined.select(
        "doc_uid", F.when(F.col("level").isin("A", "B"), F.col("person_id")).alias("person_id"), F.lit(AUTHOR).alias("role"),
        "ord", "raw", "level",
        F.when(F.col("level") == "D", NO_CANDIDATE).otherwise(BY_SIGNATURE).alias("method"), "score",
        F.when(F.col("level") == "C", whole).alias("candidates"))


# --- after resolution ------------------------------------------------------------------------------------------------


def apply_overrides(links: DataFrame, overrides: DataFrame, doc_units: DataFrame) -> DataFrame:
    """ER-15: manual decisions win; among several on one mention the last row wins.

    ``overrides(row, context, doc_uid, raw, unit_doc, person_id)``; blank document and unit mean everywhere.
    """
    blank = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c))
    rules = overrides.where(F.coalesce(F.col("person_id"), F.lit("")) != "").select(
        "row", F.when(F.col("context") == LEADER, LEADER).otherwise(AUTHOR).alias("role"), "raw",
        blank("doc_uid").alias("_doc"), blank("unit_doc").alias("unit_id"), F.col("person_id").alias("_person"))
    inside = doc_units.select("doc_uid", "unit_id").distinct()
    everywhere, by_doc, by_unit = F.col("_doc").isNull(), F.col("_doc").isNotNull(), F.col("unit_id").isNotNull()
    bound = rules.where(by_doc).withColumnRenamed("_doc", "doc_uid")
    placed = bound.where(by_unit).join(inside, ["doc_uid", "unit_id"], "left_semi").unionByName(bound.where(~by_unit))

    def winner(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.max(F.struct("row", "_person")).alias(out))

    # the last row of each scope is found among the rules alone, so that a mention meets one rule a scope
    spelled = links.select("doc_uid", "role", "ord", "raw")
    in_unit = winner(rules.where(everywhere & by_unit), ["role", "raw", "unit_id"], "_rule")
    in_units = spelled.select("doc_uid", "role", "raw").distinct().join(inside, "doc_uid").join(in_unit, ["role", "raw", "unit_id"])
    met = (spelled.join(winner(placed, ["doc_uid", "role", "raw"], "_here"), ["doc_uid", "role", "raw"], "left")
           .join(in_units.groupBy("doc_uid", "role", "raw").agg(F.max("_rule").alias("_unit")), ["doc_uid", "role", "raw"], "left")
           .join(winner(rules.where(everywhere & ~by_unit), ["role", "raw"], "_all"), ["role", "raw"], "left")
           .withColumn("_rule", F.greatest("_here", "_unit", "_all")).where(F.col("_rule").isNotNull()))
    last = met.groupBy("doc_uid", "role", "ord").agg(F.max("_rule").alias("_rule")).select(
        "doc_uid", "role", "ord", F.col("_rule._person").alias("_person"))
    joined = links.join(last, ["doc_uid", "role", "ord"], "left")
    hit, outside = F.col("_person").isNotNull(), F.col("_person") == EXTERNAL
    return joined.select(
        *[c for c in links.columns if c not in ("person_id", "level", "method")],
        F.when(~hit, F.col("person_id")).when(~outside, F.col("_person")).alias("person_id"),
        F.when(~hit, F.col("level")).when(outside, "D").otherwise("M").alias("level"),
        F.when(hit, BY_HAND).otherwise(F.col("method")).alias("method"),
    ).select(*links.columns)


def finalise_people(people: DataFrame, links: DataFrame, doc_units: DataFrame, record_work: DataFrame) -> DataFrame:
    """ER-16: display name, unit by output, reference unit and its origin, counts.

    ``doc_units(doc_uid, unit_id)`` has one unit per document, ``record_work(doc_uid, work)``.
    """
    given = links.where(F.col("level").isin(RESOLVED))
    by_output = modal(given.join(doc_units, "doc_uid").where(F.col("unit_id").isNotNull()), ["person_id"], "unit_id")
    spelling = modal(given.where(F.col("role") == LEADER), ["person_id"], "raw")
    counts = given.join(record_work, "doc_uid", "left").groupBy("person_id").agg(
        F.countDistinct(F.when(F.col("role") == LEADER, F.col("doc_uid"))).alias("n_projects"),
        F.countDistinct(F.when(F.col("role") == AUTHOR, F.col("work"))).alias("n_works"))
    joined = (
        people.join(by_output.select("person_id", F.col("unit_id").alias("unit_output")), "person_id", "left")
        .join(spelling.select("person_id", F.col("raw").alias("_leader")), "person_id", "left")
        .join(counts, "person_id", "left").na.fill(0, ["n_projects", "n_works"]))
    known = F.col("unit_output").isNotNull()
    return joined.withColumns({
        "display_name": F.coalesce("_leader", "base_name"),
        "unit_ref": F.when(F.col("in_centre"), F.col("unit_id")).when(known, F.col("unit_output"))
        .otherwise(F.col("unit_id")),
        "unit_ref_origin": F.when(F.col("in_centre"), BY_AFFILIATION).when(known, BY_OUTPUT).otherwise(BY_CENTRAL),
    }).drop("_leader", "base_name", "in_centre")


def mention_label(links: DataFrame, people: DataFrame) -> DataFrame:
    """ER-19: what is shown for a mention."""
    named = links.join(people.select("person_id", "display_name"), "person_id", "left")
    label = (
        F.when(F.col("display_name").isNotNull(), F.col("display_name"))
        .when(F.col("level") == "C", F.concat("raw", F.lit(LABEL_AMBIGUOUS)))
        .when(F.col("role") == AUTHOR, F.concat("raw", F.lit(LABEL_EXTERNAL)))
        .otherwise(F.concat("raw", F.lit(LABEL_UNKNOWN))))
    return named.withColumn("label", label).drop("display_name")


def author_units(links: DataFrame, people: DataFrame, records: DataFrame) -> DataFrame:
    """ER-18: unit of an author at the time of the work.

    A depositing unit known for the person (affiliation, or two works) is preferred to the reference unit.
    ``people(person_id, unit_id, unit_ref)``, ``records(doc_uid, work, unit_id)``.
    """
    authors = links.where((F.col("role") == AUTHOR) & F.col("level").isin(RESOLVED)).select(
        "doc_uid", "person_id").distinct().join(records.select("doc_uid", "work"), "doc_uid")
    deposits = records.where(F.col("unit_id").isNotNull()).select("work", "unit_id").distinct()
    known = learned_units(authors, deposits).unionByName(people.select("person_id", "unit_id")).distinct()
    at = authors.join(deposits, "work").join(known, ["person_id", "unit_id"], "left_semi")
    then = at.groupBy("doc_uid", "person_id").agg(F.min("unit_id").alias("_then"))
    joined = authors.join(then, ["doc_uid", "person_id"], "left").join(
        people.select("person_id", "unit_ref"), "person_id", "left")
    origin = F.when(F.col("_then").isNotNull(), FROM_DEPOSIT).otherwise(FROM_PERSON)
    rows = joined.select("doc_uid", F.coalesce("_then", "unit_ref").alias("unit_id"), origin.alias("origin"))
    kept = keep_first(rows.where(F.col("unit_id").isNotNull()), ["doc_uid", "unit_id"], ["origin"])
    return kept.select("doc_uid", "unit_id", F.lit("afiliacao_autor").alias("role"),
                       F.concat(F.lit("resolvida_"), "origin").alias("source"))


def format_candidates(links: DataFrame, people: DataFrame, keys: Sequence[str], out: str = "candidates") -> DataFrame:
    """ER-21: candidate arrays as ``Name [unit] (id) n pts | ...`` per key; a missing score shows nothing."""
    rows = links.where(F.col("candidates").isNotNull()).select(
        *keys, F.posexplode("candidates").alias("_at", "_c")).select(*keys, "_at", "_c.*")
    named = rows.join(people.select("person_id", "display_name", "unit_ref"), "person_id", "left")
    text = F.concat(
        F.coalesce("display_name", F.lit("")), F.lit(" ["), F.coalesce("unit_ref", F.lit("")), F.lit("] ("),
        "person_id", F.lit(")"),
        F.coalesce(F.concat(F.lit(" "), F.col("score").cast("string"), F.lit(" pts")), F.lit("")))
    listed = F.array_sort(F.collect_list(F.struct("_at", text.alias("_t"))))
    return named.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["_t"]), " | ").alias(out))


def review_queue(links: DataFrame, people: DataFrame, doc_units: DataFrame, titles: DataFrame) -> DataFrame:
    """ER-20: open mentions per signature and unit, most frequent first.

    ``doc_units(doc_uid, unit_id)`` and ``titles(doc_uid, title)`` have one row per document. The two sample titles are
    the first in alphabetical order.
    """
    keys = ["role", "raw", "unit_doc"]
    waiting = links.where((F.col("level") == "C") | ((F.col("role") == LEADER) & (F.col("level") == "D")))
    waiting = waiting.join(doc_units.select("doc_uid", F.coalesce("unit_id", F.lit("")).alias("unit_doc")), "doc_uid", "left")
    waiting = waiting.join(titles, "doc_uid", "left").withColumn("unit_doc", F.coalesce("unit_doc", F.lit("")))
    counts = waiting.groupBy(*keys).agg(F.count("*").alias("n_mentions"))
    samples = top_n(waiting.where(F.col("title").isNotNull()).select(*keys, "title").distinct(), keys, ["title"], 2)
    samples = samples.groupBy(*keys).agg(join_sorted("title", " || ").alias("examples"))
    best = waiting.where(F.col("candidates").isNotNull()).select(*keys, F.explode("candidates").alias("_c")).groupBy(
        *keys, F.col("_c.person_id").alias("person_id")).agg(F.max("_c.score").alias("score"))
    order = F.struct((-F.coalesce("score", F.lit(0))).alias("d"), "person_id", "score")
    merged = best.groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("_l")).select(
        *keys, F.transform("_l", lambda x: F.struct(x["person_id"].alias("person_id"), x["score"].alias("score")))
        .alias("candidates"))
    listed = format_candidates(merged, people, keys)
    return counts.join(samples, keys, "left").join(listed, keys, "left")
