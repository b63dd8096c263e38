"""PF-1: typed projections of the four source tables, from all-string exports to the columns the operators read."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.functions.scalars import flag, format_id, month_year
from foliograph.functions.text import name_key, short_to_null, squish
from foliograph.plans.shapes import lookup
from foliograph.sources.io import require_columns

# The kind of a publication whose type is not listed, and the lengths and marks of the exports.
UNCLASSIFIED = "nao_classificado"
SHORT_ABSTRACT = 30
ACTIVE = "S"


@dataclass(frozen=True)
class Source:
    """How a source table becomes typed: its columns, the raw unit name, and what is derived from the rest.

    ``columns`` maps each result to an expression over the raw columns; ``unit`` is the raw column with a unit's name and
    ``group`` the one with a type that the table of kinds groups. ``page`` is how the name of the column with the web page
    starts.
    """

    name: str
    required: tuple[str, ...]
    columns: Mapping[str, Callable[[], Column]]
    unit: str
    unit_id: str = "unit_id"
    group: str | None = None
    page: str | None = None
    optional: tuple[str, ...] = field(default=())


def _raw(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _clean(name: str) -> Callable[[], Column]:
    return lambda: squish(name)


def _whole(name: str) -> Callable[[], Column]:
    return lambda: F.col(name).try_cast("int")


def _uid(prefix: str) -> Callable[[], Column]:
    return lambda: format_id(prefix, F.col("id"))


def _date(name: str, part: str) -> Callable[[], Column]:
    return lambda: month_year(F.col(name))[part]


# The columns of the exports.
PROJECTS = Source(
    "projetos",
    ("id", "titulo", "resumo", "mes_ano_de_inicio", "mes_ano_de_finalizacao", "unidade_lider", "lider_do_projeto", "palavras_chave",
     "situacao"),
    {"doc_uid": _uid("P:"), "id": _whole("id"), "title": _clean("titulo"), "abstract": _clean("resumo"),
     "year": _date("mes_ano_de_inicio", "year"), "month": _date("mes_ano_de_inicio", "month"),
     "year_end": _date("mes_ano_de_finalizacao", "year"), "state": _raw("situacao"), "unit_raw": _raw("unidade_lider"),
     "leader_raw": _clean("lider_do_projeto"), "keywords_raw": _raw("palavras_chave")},
    unit="unidade_lider", page="pagina_do_projeto")
PUBLICATIONS = Source(
    "publicacoes",
    ("id", "titulo", "resumo", "ano_de_publicacao", "tipo_de_publicacao", "unidade", "autores", "palavras_chave"),
    {"doc_uid": _uid("B:"), "id": _whole("id"), "title": _clean("titulo"),
     "abstract": lambda: short_to_null(squish("resumo"), SHORT_ABSTRACT), "year": _whole("ano_de_publicacao"),
     "type": _raw("tipo_de_publicacao"), "unit_raw": _raw("unidade"), "authors_raw": _clean("autores"),
     "keywords_raw": _raw("palavras_chave"), "url_repository": _raw("mais_informacoes"), "url_file": _raw("url_do_arquivo"),
     "short_text": lambda: short_to_null(squish("resumo"), SHORT_ABSTRACT).isNull()},
    unit="unidade", group="tipo_de_publicacao",
    page="pagina_da_publicacao", optional=("mais_informacoes", "url_do_arquivo"))
TECHNOLOGIES = Source(
    "tecnologias",
    ("id", "nome", "descricao", "tipo", "subtipo", "ano_de_lancamento", "bioma", "unidade_responsavel", "onde_encontrar",
     "palavras_chave"),
    {"doc_uid": _uid("T:"), "id": _whole("id"), "title": _clean("nome"), "abstract": _clean("descricao"), "type": _raw("tipo"),
     "subtype": _raw("subtipo"), "year": _whole("ano_de_lancamento"), "biomes": _raw("bioma"), "unit_raw": _raw("unidade_responsavel"),
     "where_found": _raw("onde_encontrar"), "keywords_raw": _raw("palavras_chave")},
    unit="unidade_responsavel", page="pagina_da_tecnologia")
PEOPLE = Source(
    "autores", ("id_autor", "nome", "nome_anterior", "autoria", "afiliacao", "ativado"),
    {"record_id": _whole("id_autor"), "name": _clean("nome"), "previous_name": _clean("nome_anterior"),
     "signature": _clean("autoria"), "unit_raw": _clean("afiliacao"),
     "active": lambda: flag(F.col("ativado"), ACTIVE)},
    unit="afiliacao")


def project_source(df: DataFrame, source: Source, units: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """PF-1: one typed table of a source, in the order of its columns, then the unit and the kind group.

    ``units(key, unit_id)`` has a row per normalised unit name; a name that it lacks raises. ``kinds(type, kind_group)``
    groups the types of publications; a type that it lacks is unclassified. Missing required columns raise before any work,
    missing optional ones are null.
    """
    require_columns(df, source.required, source.name)
    nothing = F.lit(None).cast("string")
    full = df.withColumns({c: nothing for c in source.optional if c not in df.columns})
    pages = [F.col(c) for c in df.columns if source.page and c.startswith(source.page)]
    url = [F.coalesce(*pages, nothing).alias("url")] if source.page else []
    typed = full.select(*[build().alias(out) for out, build in source.columns.items()], *url, F.col(source.unit).alias("_unit"),
                        *([F.col(source.group).alias("_type")] if source.group else []))
    typed = lookup(typed, name_key(F.col("_unit")), units, "key", "unit_id", source.unit_id).drop("_unit")
    if source.group:
        listed = kinds.groupBy(F.col("type").alias("_type")).agg(F.min("kind_group").alias("kind_group"))
        typed = typed.join(listed, "_type", "left").drop("_type").withColumn("kind_group", F.coalesce("kind_group", F.lit(UNCLASSIFIED)))
    return typed
