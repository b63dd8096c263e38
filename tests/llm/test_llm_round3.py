"""Cases of the third review: repeated ids with other words, notices one behind the other, clashing columns and ids in the stages."""

from llm_cases import documents, near_components, words

import corpus_pipeline
from foliograph.llm import licenses, near_dedup


def text(seed, n=60):
    return " ".join(words(n, seed))


def test_repeated_ids_with_other_words(spark):
    a, b, c, d = (text(s) for s in (1, 2, 3, 4))
    near_b = b.replace(b.split()[30], "other", 1)
    rows = [(3, a), (5, a), (5, b), (9, c), (3, d), (8, d), (8, near_b), (None, a), (None, b)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    n = len(a.split()) - 3
    assert got == sorted([(3, n, 3, True), (5, n, 3, False), (5, n, 5, True), (9, n, 9, True), (3, n, 3, True), (8, n, 3, False),
                          (8, n, 5, False), (None, n, None, True), (None, n, None, True)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.without_near_copies(docs).collect()), key=str)
    assert kept == sorted([(3, a), (5, b), (9, c), (3, d), (None, a), (None, b)], key=str)


def test_many_classes_of_one_id(spark):
    """Rows of one id only: each text is linked by its own words."""
    texts = [text(s) for s in range(20)]
    docs = documents(spark, [*texts, *texts[:5]], [1] * 20 + [2, 3, 4, 5, 6])
    rows = near_dedup.near_duplicates(docs).collect()
    assert {r.component_id for r in rows} == {1} and sum(r.kept for r in rows) == 20
    assert near_dedup.without_near_copies(docs).count() == 20


def test_adjacent_notices():
    notice = "Released under the MIT license."
    scanner = licenses.Scanner(base=())
    for n in range(1, 5):
        found = scanner.scan(licenses.words_of(" ".join([notice] * n)))[1]
        assert [(x, y) for _, x, y, _ in found] == [(5 * i, 5 * i + 4) for i in range(n)]
    # other words between and around, and a notice that breaks off
    mixed = f"see {notice} {notice} and more {notice} Released under the"
    assert [(x, y) for _, x, y, _ in scanner.scan(licenses.words_of(mixed))[1]] == [(1, 5), (6, 10), (13, 17)]


def test_stages_with_hard_rows(spark):
    """Null and repeated ids, null and very long texts, and columns with the operators' names pass through every stage."""
    long_ = text(9, 60_000)
    rows = [(1, text(1)), (1, text(2)), (None, text(3)), (2, None), (4, long_), (5, long_.upper()), (6, ""), (7, text(1))]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).selectExpr("*", "0L AS n_chars")
    kept = corpus_pipeline.drop_exact_copies(spark, docs, "")
    assert kept.columns == docs.columns
    left = corpus_pipeline.drop_near_copies(spark, kept, "")
    assert left.columns == docs.columns
    texts = sorted(((r.doc_id, len(r.text or "")) for r in left.collect()), key=str)
    assert (5, len(long_)) in texts and (4, len(long_)) not in texts
    hidden = corpus_pipeline.hide_personal_data(spark, left, "")
    assert hidden.columns == docs.columns and hidden.count() == len(texts)
    pieces = corpus_pipeline.pack_sequences(spark, hidden, "").collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in texts}
