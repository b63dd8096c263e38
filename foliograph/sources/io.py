"""IO: delimited exports with integrity checks, dictionaries, gazetteers, and the published set.

Files are read and written by Spark. An export file is quoted CSV whose records may hold line breaks; its lines are read in splits
and put together to records by the parity of the quotes before them, so files of any size and number are read alike.
"""

from __future__ import annotations

import csv
import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.plans.session import cut_lineage
from foliograph.plans.shapes import keep_first

NULL_TOKENS = ("", "NA")
# Signs that a column name spells out.
SIGNS = {"%": "percent", "#": "number"}
TAIL = 20  # characters at the end of a file in which the closing quote must be


class TruncatedFile(ValueError):
    """An export that ends inside a record."""


def clean_name(name: str) -> str:
    """IO-3: snake case without accents; signs that mean a word become it, and a name starts with a letter."""
    plain = "".join(c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn")
    for sign, word in SIGNS.items():
        plain = plain.replace(sign, f" {word} ")
    base = re.sub(r"[^a-z0-9]+", "_", plain.strip().lower()).strip("_")
    return f"x{base}" if base[:1].isdigit() else base


def clean_all(names: Sequence[str]) -> list[str]:
    """IO-3 on the names of a table; repeated ones get a number."""
    seen: dict[str, int] = {}
    out = []
    for c in names:
        base = clean_name(c) or "x"
        seen[base] = seen.get(base, 0) + 1
        out.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_all(df.columns))


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    return df.select(*[F.when(F.col(f"`{c}`").isin(list(tokens)), None).otherwise(F.col(f"`{c}`")).alias(c)
                       for c in df.columns])


def ends_inside(text: Column) -> Column:
    """IO-2: whether the text of an export was cut: a quote is open, or none stands near the end."""
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    closed = F.right(text, F.lit(TAIL)).rlike(r'"\s*\z')
    return ~(closed & (quotes % 2 == 0))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, size, block, at, line, quotes): the lines of files, with their place, read in splits."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))


def _records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, first, text) of the records of exports, and (path, truncated, ended) of the files.

    A line break inside quotes belongs to its record, so a record starts at a line before which the number of quotes is even. The
    quotes of a split are added up in the split; what a split takes over from those before it, whether a quote is open and where
    the last record began, is one row a split. No task holds a file, and only records are put together.
    """
    place = F.struct("block", "at")
    inside = W.partitionBy("path", "block").orderBy("at")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = lines.groupBy("path", "block").agg(F.sum("quotes").alias("n")).withColumn(
        "open", F.coalesce(F.sum("n").over(earlier), F.lit(0)) % 2).select("path", "block", "open")
    counted = lines.join(splits, ["path", "block"]).withColumn("before", F.sum("quotes").over(upto) - F.col("quotes") + F.col("open"))
    # a table, as what follows reads it three times
    marked = cut_lineage(counted.withColumn("start", F.when(F.col("before") % 2 == 0, place)))
    last = marked.groupBy("path", "block").agg(F.max("start").alias("l")).withColumn("taken", F.max("l").over(earlier)).drop("l")
    owned = marked.withColumn("own", F.max("start").over(upto)).join(last, ["path", "block"]).withColumn("first", F.coalesce("own", "taken"))
    pieces = F.sort_array(F.collect_list(F.struct(place.alias("p"), "line")))
    records = owned.groupBy("path", "first").agg(F.array_join(F.transform(pieces, lambda x: x["line"]), "\n").alias("text"), F.sum("quotes").alias("quotes"))
    end = F.max(F.struct(place.alias("p"), F.col("line").alias("line"))).alias("end")
    shown = F.max(F.when(F.trim(F.regexp_replace("line", r"\s+", " ")) != "", F.struct(place.alias("p"), F.col("line").alias("line")))).alias("shown")
    behind = F.sum(F.octet_length("line").cast("long") + 1).alias("bytes")
    files = marked.groupBy("path").agg(F.sum("quotes").alias("quotes"), behind, F.first("size").alias("size"), end, shown)
    # the quote that closes the file stands within its last characters
    closed = F.coalesce(F.right(F.col("shown.line"), F.lit(TAIL)).rlike(r'"\s*\z'), F.lit(False))
    states = files.select("path", (~(closed & (F.col("quotes") % 2 == 0))).alias("truncated"), (F.col("size") == F.col("bytes")).alias("ended"))
    return records, states


def file_state(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """IO-2: one row per file with ``truncated``, from lines read in splits: a quote is open, or none closes the last line."""
    return _records(_lines(spark, path))[1].select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "truncated")


def check_integrity(spark: SparkSession, path: str, allow_truncated: bool = False) -> list[str]:
    """IO-2: names of the truncated files; raises unless they are allowed."""
    bad = [r["file"] for r in file_state(spark, path).where("truncated").orderBy("file").collect()]
    if bad and not allow_truncated:
        raise TruncatedFile(f"truncated export: {', '.join(bad)}")
    return bad


def complete_records(text: Column) -> Column:
    """The text of an export up to the last line break that stands outside quotes."""
    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series) -> pd.Series:
        def one(whole: str) -> str:
            parts = whole.split('"')  # every second part, from the first one, stands outside quotes
            for i in range((len(parts) - 1) // 2 * 2, -1, -2):
                at = parts[i].rfind("\n")
                if at >= 0:
                    return '"'.join([*parts[:i], parts[i][: at + 1]])
            return ""

        return texts.map(one)

    return cut(text)


def read_export(spark: SparkSession, path: str | list[str], allow_truncated: bool = False) -> DataFrame:
    """IO-1, IO-2: all-string read with clean names; an allowed truncated file loses its last, incomplete record.

    Files are read in splits of any number and their records put together (:func:`_records`), so an export may be larger than a
    task. Every file starts with the header; columns go by their position in the first file's, records with fewer fields end
    in nulls. Blank lines between records are none.
    """
    records, states = _records(_lines(spark, path))
    records, states = cut_lineage(records.where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")), cut_lineage(states)
    bad = [r["path"].rsplit("/", 1)[-1] for r in states.where("truncated").select("path").orderBy("path").collect()]
    if bad and not allow_truncated:
        raise TruncatedFile(f"truncated export: {', '.join(bad)}")
    places = records.groupBy("path").agg(F.min("first").alias("head"), F.max("first").alias("tail"))
    headers = records.join(places, "path").where("first = head").orderBy("path").limit(1).select("text").collect()
    if not headers:
        return spark.createDataFrame([], "x string")
    names = next(csv.reader([headers[0]["text"].rstrip("\r")]))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    # a truncated file whose last record ends with a line break outside quotes has it whole
    kept = records.join(places, "path").join(states, "path").where(
        (F.col("first") != F.col("head")) & ~(F.col("truncated") & (F.col("first") == F.col("tail")) & ~(F.col("ended") & (F.col("quotes") % 2 == 0))))
    fields = F.from_csv(F.regexp_replace("text", r"\r\z", ""), schema, {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    return null_tokens(kept.select(fields.alias("r")).select("r.*").toDF(*clean_all(names)))


def require_columns(df: DataFrame, cols: Iterable[str], name: str = "table") -> DataFrame:
    """IO-4: fail before any work when a column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns in {name}: {', '.join(missing)}")
    return df


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """IO-5."""
    return df.drop(*cols)


def read_ref(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """IO-6: reference CSV with stated types; the columns are matched by position, a byte-order mark is ignored."""
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True, enforceSchema=True)


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """IO-7: one entry per line, ``#`` starts a comment line."""
    return word_entries(spark.read.text(path), F.col("value"))


def word_entries(lines: DataFrame, line: Column) -> DataFrame:
    """IO-7 on lines that are there already."""
    words = lines.select(F.trim(line).alias("word"))
    return words.where((F.col("word") != "") & ~F.startswith("word", F.lit("#"))).distinct()


GAZETTEER_SCHEMA = """
    id string, nome string,
    microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>,
    `regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string>>>
"""


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """IO-8: nested JSON list of places; the state comes from whichever of two paths is filled."""
    return gazetteer_rows(spark.read.schema(GAZETTEER_SCHEMA).json(path, multiLine=True))


def gazetteer_rows(places: DataFrame) -> DataFrame:
    """IO-8 on parsed places, columns of ``GAZETTEER_SCHEMA``."""
    return places.select(
        F.col("id").alias("place_id"),
        F.col("nome").alias("place"),
        F.coalesce("microrregiao.mesorregiao.UF.sigla", "`regiao-imediata`.`regiao-intermediaria`.UF.sigla")
        .alias("state"),
    )


GEOJSON_SCHEMA = """
    features array<struct<properties: struct<codarea: string>, geometry: struct<type: string, coordinates: string>>>
"""


def read_rings(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON areas to (place_id, ring) with the outer ring of every polygon."""
    text = spark.read.schema(GEOJSON_SCHEMA).json(path, multiLine=True).select(F.explode("features").alias("f"))
    polygon = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.array(polygon[0])).otherwise(
        F.transform(multi, lambda p: p[0])
    )
    return text.select(F.col("f.properties.codarea").alias("place_id"), F.explode(rings).alias("ring"))


def ring_centroid(rings: DataFrame, key: str = "place_id", ring: str = "ring") -> DataFrame:
    """IO-9: mean of the vertices of the ring with most vertices, as lat / lon; the first ring wins a tie."""
    largest = rings.groupBy(key).agg(F.max_by(ring, F.size(ring)).alias("_r"))

    def mean(i: int) -> Column:
        total = F.aggregate("_r", F.lit(0.0), lambda acc, p: acc + p[i])
        return total / F.size("_r")

    return largest.select(key, mean(1).alias("lat"), mean(0).alias("lon"))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """IO-10: Parquet scan reduced to ``columns``."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan that Spark cuts into fewer tasks than there are cores, dealt over the cores before per-row text work.

    Only a table of a few row groups is dealt anew; large files are cut by ``spark.sql.files.maxPartitionBytes``.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def write_tables(tables: Mapping[str, DataFrame], directory: str, compression: str = "zstd") -> list[str]:
    """IO-11: one Parquet directory per table."""
    paths = []
    for name, df in tables.items():
        paths.append(f"{directory.rstrip('/')}/{name}")
        df.write.mode("overwrite").option("compression", compression).parquet(paths[-1])
    return paths


@dataclass(frozen=True)
class Published:
    """What one table shows to outside readers: its columns (None for all) and an optional row condition."""

    columns: tuple[str, ...] | None = None
    where: str | None = None


# The published tables and the columns each of them shows.
PUBLISHED = {
    "meta": Published(),
    "unidade": Published(),
    "unidade_localizacao": Published(("unidade_id", "municipio", "uf", "lat", "lon")),
    "documento": Published(),
    "documento_unidade": Published(),
    "documento_pessoa": Published(),
    "documento_keyword": Published(),
    "aresta_unidade": Published(),
    "aresta_pessoa": Published(),
    "pessoa_tecnologia": Published(),
    "doc_link": Published(),
    "pessoa": Published(("pessoa_id", "nome_exibicao", "assinatura_principal", "unidade_ref_id", "n_obras",
                         "n_projetos_lider")),
    "doc_pessoa": Published(("doc_uid", "papel", "ordem", "rotulo_exibicao", "nivel", "pessoa_id")),
    "publicacao": Published(("doc_uid", "obra_id", "unidade_id", "tipo", "url_repositorio")),
    "similaridade": Published(),
    "proximidade_unidade": Published(),
    "tema": Published(),
    "doc_tema": Published(),
    "doc_municipio": Published(("doc_uid", "cod_ibge", "municipio", "uf", "confianca"),
                               "confianca IN ('alta', 'media')"),
    "doc_estado": Published(),
    "municipio_centroide": Published(),
    "doc_bioma": Published(),
    "doc_produto": Published(),
    "desafio": Published(("desafio_id", "portfolio", "objetivo_id", "objetivo", "meta_id", "meta", "ods_num", "ods",
                          "desafio")),
    "doc_desafio": Published(),
    "doc_localizacao": Published(),
    "tema_programacao": Published(),
    "portfolio": Published(("portfolio_id", "portfolio", "nome_portal", "caracterizacao", "n_desafios", "fonte")),
    "especificacao": Published(),
}


def published(df: DataFrame, spec: Published) -> DataFrame:
    """One table as outside readers see it."""
    rows = df if spec.where is None else df.where(spec.where)
    return rows if spec.columns is None else rows.select(*spec.columns)


def publish(tables: Mapping[str, DataFrame], spec: Mapping[str, Published], directory: str) -> list[str]:
    """IO-12: write the published columns and rows of each table; tables not given are left out."""
    shown = {name: published(tables[name], s) for name, s in spec.items() if name in tables}
    return write_tables(shown, directory)


def write_csv_gz(df: DataFrame, path: str) -> str:
    """IO-13."""
    df.write.mode("overwrite").option("compression", "gzip").option("header", True).csv(path)
    return path


def registration_map(records: DataFrame, record: str = "doc_uid", work: str = "obra_id") -> DataFrame:
    """IO-14: record to work."""
    return records.select(F.col(record).alias("registro"), work)


def build_meta(spark: SparkSession, export: str, truncated: Mapping[str, Sequence[str]]) -> DataFrame:
    """IO-15: one row with export id, load time and the inputs that were truncated."""
    names = ";".join(name for name, files in truncated.items() if files)
    return spark.range(1).select(
        F.lit(export).alias("exportacao"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm").alias("gerado_em"),
        F.lit(names).alias("arquivos_truncados"),
    )


def write_parts(df: DataFrame, path: str, max_records: int) -> str:
    """IO-16: Parquet files of at most ``max_records`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).option("compression", "zstd").parquet(path)
    return path


def replace_export(df: DataFrame, path: str, export: str, column: str = "exportacao") -> str:
    """Monthly replacement: rewrite only the partition of one export."""
    (df.withColumn(column, F.lit(export)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))
    return path


def latest_per_key(df: DataFrame, keys: Sequence[str], column: str = "exportacao") -> DataFrame:
    """Newest export of every key."""
    return keep_first(df, keys, [F.col(column).desc()])
