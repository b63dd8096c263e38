"""The queries on whole texts read past the start of a text."""

from foliograph.catalog import load

QUERIES, _ = load()


def folder(spark, tmp_path, texts):
    rows = [(i, t, "en", "s") for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_whole_exports(spark, tmp_path):
    long_ = "a record, " * 400
    d = folder(spark, tmp_path, [(1, long_ + "end"), (2, long_ + 'an "open quote'), (3, long_ + "one. two"), (4, long_ + "one. three")])
    got = {r.doc_id: r.truncated for r in QUERIES["export_integrity_whole"](spark, d).collect()}
    assert got == {1: False, 2: True, 3: True, 4: False}
    kept = {r.doc_id: r.kept for r in QUERIES["export_complete_records_whole"](spark, d).collect()}
    assert len(set(kept.values())) == 4  # all begin alike


def test_whole_abstracts(spark, tmp_path):
    names = "nation.parquet"
    spark.createDataFrame([(i,) for i in range(25)], "n_nationkey long").write.parquet(str(tmp_path / names))
    long_ = "a word " * 400
    d = folder(spark, tmp_path, [(2, long_ + "x"), (3, long_ + "y"), (4, long_ + "x"), (5, "short text"), (7, long_), (8, long_)])
    got = {r.doc_id: (r.abstract, r.short_text) for r in QUERIES["project_source_publications_whole"](spark, d).selectExpr("id AS doc_id", "*").collect()}
    assert got[2] == got[4] != got[3] and got[2][0] and not got[2][1]
    assert got[5] == got[7] == got[8] == (None, True)
