"""One load, from raw exports to the published document mart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.operators.indicators import document_mart
from foliograph.operators.works import author_keys, group_works, summarise_works
from foliograph.plans.session import cut_lineage
from foliograph.sources.io import Published, published
from foliograph.sources.project import PROJECTS, PUBLICATIONS, TECHNOLOGIES, project_source


def load(projects: DataFrame, publications: DataFrame, technologies: DataFrame, units: DataFrame, kinds: DataFrame) -> dict[str, DataFrame]:
    """Typed sources, works and the document mart of one load: PF-1, ER-2, ER-3, IN-1.

    The exports are all-string tables as :func:`read_export` gives them, ``units(key, unit_id)`` and ``kinds(type, kind_group)`` the
    reference tables of :func:`project_source`. Records of one publication are grouped by title, year and authors; a work has the
    id of its lowest record, ``record_work(doc_uid, work)`` lifts links from records to works. Each source is typed once and
    stored, as several tables read it.
    """
    typed = {
        "projects": cut_lineage(project_source(projects, PROJECTS, units)),
        "records": cut_lineage(project_source(publications, PUBLICATIONS, units, kinds)),
        "technologies": cut_lineage(project_source(technologies, TECHNOLOGIES, units)),
    }
    records = typed["records"]
    grouped = cut_lineage(group_works(records, "id", F.col("title"), F.col("year"), author_keys(F.col("authors_raw"))))
    uid = lambda c: F.concat(F.lit("B:"), F.col(c).cast("string"))
    works = summarise_works(records.join(grouped, "id"), "work", "id", "abstract", "unit_id", ("title", "year", "kind_group"))
    works = works.withColumns({"work": uid("work"), "representative": uid("representative")})
    record_work = grouped.select(uid("id").alias("doc_uid"), uid("work").alias("work"))
    documents = document_mart(typed["projects"], works, records, typed["technologies"])
    return typed | {"works": works, "record_work": record_work, "documents": documents}


def publish_load(tables: Mapping[str, DataFrame], spec: Mapping[str, Published]) -> dict[str, DataFrame]:
    """IO-12 on the tables of a load: the published columns and rows of those that the specification names."""
    return {name: published(tables[name], s) for name, s in spec.items() if name in tables}
