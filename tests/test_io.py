"""Files written by the tests: exports, dictionaries, published tables."""

import gzip
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from foliograph.sources import io

GOOD = '"Id","Título do Projeto","Resumo"\n"1","A ""b""","linha 1\nlinha 2"\n"2","NA",""\n'
CUT = '"Id","Título do Projeto","Resumo"\n"1","A","linha 1\nlinha 2"\n"2","B","meio do regis'


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_export(spark, tmp_path):
    df = io.read_export(spark, put(tmp_path / "a.csv", GOOD))
    assert df.columns == ["id", "titulo_do_projeto", "resumo"]
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows == [("1", 'A "b"', "linha 1\nlinha 2"), ("2", None, None)]
    assert io.check_integrity(spark, str(tmp_path / "a.csv")) == []


def test_truncated_export(spark, tmp_path):
    path = put(tmp_path / "cut.csv", CUT)
    with pytest.raises(io.TruncatedFile, match="cut.csv"):
        io.read_export(spark, path)
    assert io.check_integrity(spark, path, allow_truncated=True) == ["cut.csv"]
    rows = [tuple(r) for r in io.read_export(spark, path, allow_truncated=True).collect()]
    assert rows == [("1", "A", "linha 1\nlinha 2")]


def test_intact_files_beside_a_cut_one(spark, tmp_path):
    put(tmp_path / "a.csv", '"Id","T"\n"1","x"\n"2","""y""\n""z"""\n"3","last"\n')
    put(tmp_path / "b.csv", '"Id","T"\n"4","in ""q"" and\nmore"\n"5","cut off in the mid')
    put(tmp_path / "c.csv", 'Id,T\n6,plain\n7,"end"\n8,no qu')
    rows = [tuple(r) for r in io.read_export(spark, str(tmp_path), allow_truncated=True).orderBy("id").collect()]
    assert rows == [("1", "x"), ("2", '"y"\n"z"'), ("3", "last"), ("4", 'in "q" and\nmore'), ("6", "plain"), ("7", "end")]


def test_no_closing_quote(spark, tmp_path):
    path = put(tmp_path / "open.csv", '"a"\n"1"\n"2" tail that is not quoted at all')
    with pytest.raises(io.TruncatedFile):
        io.check_integrity(spark, path)


def plain_records(raw):
    """Records of a file by a walk over its characters; the last one without a line break behind it is apart."""
    out, at, quoted = [], 0, False
    for i, c in enumerate(raw):
        quoted ^= c == '"'
        if c == "\n" and not quoted:
            out.append(raw[at:i])
            at = i + 1
    return out, raw[at:]


def test_export_of_many_splits(spark, tmp_path):
    """Line breaks inside quotes on the borders of splits, and a record longer than several splits."""
    import csv
    import random

    rng = random.Random(5)
    want = [["id", "text", "more"]]
    for i in range(400):
        words = [rng.choice(['a "b" c', "x,y", "line\nbreak", "", "NA?", "é" * rng.randint(0, 9)]) for _ in range(rng.randint(0, 30))]
        want.append([str(i), " ".join(words) or None, "\n".join(["z"] * (3000 if i == 200 else 1))])
    path = tmp_path / "large.csv"
    with path.open("w", newline="", encoding="utf-8") as f:
        csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([x or "" for x in r] for r in want)
    raw = path.read_text(encoding="utf-8")
    (tmp_path / "cut.csv").write_text(raw[: len(raw) // 2], encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
        df = io.read_export(spark, str(path))
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want[1:]))
        whole, rest = plain_records(raw[: len(raw) // 2])
        assert rest
        cut = io.read_export(spark, str(tmp_path / "cut.csv"), allow_truncated=True)
        assert cut.count() == len(whole) - 1
        assert io.check_integrity(spark, str(tmp_path), allow_truncated=True) == ["cut.csv"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_windows_line_ends(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_bytes(b'"Id","T"\r\n"1","a\r\nb"\r\n\r\n"2","c"\r\n')
    assert sorted(tuple(r) for r in io.read_export(spark, str(path)).collect()) == [("1", "a\r\nb"), ("2", "c")]


def test_names_that_start_with_signs():
    assert [io.clean_name(x) for x in ("2020", "% total", "#", "Ação 1")] == ["x2020", "percent_total", "number", "acao_1"]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="c"):
        io.require_columns(df, ["a", "c"], "projects")
    assert io.drop_if_present(df, ["b", "zzz"]).columns == ["a"]
    assert io.clean_names(df.toDF("Ação 1", "ação-1")).columns == ["acao_1", "acao_1_2"]
    assert io.clean_name("Mês/Ano de Início") == "mes_ano_de_inicio"


def test_dictionaries(spark, tmp_path):
    words = io.read_wordlist(spark, put(tmp_path / "w.txt", "# note\n de \n\nda\nde\n"))
    assert sorted(r["word"] for r in words.collect()) == ["da", "de"]
    ref = io.read_ref(spark, put(tmp_path / "r.csv", "﻿k,lat,ok\na,1.5,2\n"), "k string, lat double, ok int")
    assert [tuple(r) for r in ref.collect()] == [("a", 1.5, 2)]


def test_gazetteer_and_rings(spark, tmp_path):
    places = [
        {"id": 1, "nome": "A", "microrregiao": {"mesorregiao": {"UF": {"sigla": "SP"}}}},
        {"id": 2, "nome": "B", "microrregiao": None,
         "regiao-imediata": {"regiao-intermediaria": {"UF": {"sigla": "MT"}}}},
    ]
    got = io.read_gazetteer(spark, put(tmp_path / "g.json", json.dumps(places))).orderBy("place_id").collect()
    assert [tuple(r) for r in got] == [("1", "A", "SP"), ("2", "B", "MT")]
    square = [[[0, 0], [2, 0], [2, 2], [0, 2]]]
    shapes = {"type": "FeatureCollection", "features": [
        {"properties": {"codarea": "1"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"properties": {"codarea": "2"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[9, 9], [8, 8]]], square]}},
    ]}
    rings = io.read_rings(spark, put(tmp_path / "s.json", json.dumps(shapes)))
    out = {r["place_id"]: (r["lat"], r["lon"]) for r in io.ring_centroid(rings).collect()}
    assert out == {"1": (1.0, 1.0), "2": (1.0, 1.0)}


def test_written_tables(spark, tmp_path):
    tables = {"doc_municipio": spark.createDataFrame(
        [("d", "1", "x", "SP", "alta", "r"), ("e", "2", "y", "SP", "baixa", "r")],
        "doc_uid string, cod_ibge string, municipio string, uf string, confianca string, motivo string"),
        "interna": spark.range(3)}
    io.publish(tables, io.PUBLISHED, str(tmp_path / "out"))
    shown = io.read_parquet(spark, str(tmp_path / "out" / "doc_municipio"))
    assert shown.columns == ["doc_uid", "cod_ibge", "municipio", "uf", "confianca"] and shown.count() == 1
    assert not (tmp_path / "out" / "interna").exists()
    path = io.write_csv_gz(spark.range(3), str(tmp_path / "z"))
    text = "".join(gzip.open(p, "rt").read() for p in sorted(pathlib.Path(path).glob("*.csv.gz")))
    assert text.count("id") >= 1 and {"0", "1", "2"} <= set(text.split())
    io.write_parts(spark.range(10).coalesce(1), str(tmp_path / "parts"), 4)
    assert len(list((tmp_path / "parts").glob("*.parquet"))) == 3


def test_monthly_replacement(spark, tmp_path):
    path = str(tmp_path / "by_export")
    io.replace_export(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, "2026-09")
    io.replace_export(spark.createDataFrame([("a", 2)], "k string, v int"), path, "2026-10")
    io.replace_export(spark.createDataFrame([("a", 3)], "k string, v int"), path, "2026-10")
    df = spark.read.parquet(path).withColumn("exportacao", F.col("exportacao").cast("string"))
    latest = io.latest_per_key(df, ["k"]).orderBy("k").collect()
    assert df.count() == 3 and [(r["k"], r["v"]) for r in latest] == [("a", 3), ("b", 1)]


def test_meta_and_map(spark):
    row = io.build_meta(spark, "2026-10", {"projects": [], "records": ["x.csv"]}).first()
    assert row["exportacao"] == "2026-10" and row["arquivos_truncados"] == "records"
    df = spark.createDataFrame([("B:1", "OB:1", 5)], "doc_uid string, obra_id string, x int")
    assert io.registration_map(df).columns == ["registro", "obra_id"]
