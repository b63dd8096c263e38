"""Collocations against counting every run of words, whatever the sample proposes."""

import random
import re
from collections import Counter

import pytest
from llm_cases import UP, documents, hard_texts

from foliograph.llm import collocations


def plain(rows, support, longest=5, most=2000):
    """(lang, rank, phrase, a, l, r, n, score) for (lang, text) rows."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        rows = []
        frequent = {p: a for p, a in f.items() if a >= support and len(p) > 1}
        around = Counter()
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], a)
        for p, a in frequent.items():
            if around[p] >= a:
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, le, ri, totals[lang], s) for i, (s, a, p, le, ri) in enumerate(rows[:most])]
    return sorted(out)


def corpus(seed=3, n=150):
    """Texts with planted phrases, some of them next to each other, in three languages and none."""
    rng = random.Random(seed)
    phrases = ["New York City Hall today", "on the other hand", "machine learning", "é ß", "in spite of", "ab ab ab"]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(0, 40)):
            out += rng.choice(phrases).split() if rng.random() < 0.3 else [f"w{rng.randint(0, 30)}"]
            out[-1] += rng.choice(["", "", "", ".", "\t", "\n", " ,"])
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), " ".join(out)))
    return rows + [("en", rows[0][1])] * 30


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string").selectExpr(
        "*", "'own' AS phrase", "'own' AS n", "1 AS rank", "2 AS total")
    out = collocations.collocations(df, **more)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(tuple(r) for r in out.collect())


# share 1: the sample is everything; a large share: the sample is almost nothing, and all lengths come by further passes
@pytest.mark.parametrize("share", [1, 8, 10**9])
def test_plain_counts(spark, share, monkeypatch):
    monkeypatch.setattr(collocations, "PART", 700)  # many parts, and pieces that are longer
    rows = [*corpus(), *(("en", t) for t in hard_texts()[:9])]
    assert found(spark, rows, support=12, share=share) == plain(rows, 12)


def test_few_best_and_short(spark):
    rows = corpus(4, 60)
    assert found(spark, rows, support=5, most=3, longest=3) == plain(rows, 5, 3, 3)


def test_full_filter(spark, monkeypatch):
    """A filter that is too small lets everything pass and changes no result."""
    monkeypatch.setattr(collocations, "MOST_BYTES", 64)
    rows = corpus(5, 80)
    assert found(spark, rows, support=8) == plain(rows, 8)


def test_repeated_word_and_long_text(spark):
    """One word only, in one text without stops: overlapping places all count."""
    rows = [("x", "a " * 300_000), ("y", " ".join(f"b{i % 7}" for i in range(100_000)))]
    assert found(spark, rows, support=100) == plain(rows, 100)


def test_wide_products(spark):
    """Scores of products beyond 64 bits."""
    big = 10**13
    frame = spark.createDataFrame([("en", b"", 4 * big), ("en", b"a", big), ("en", b"b", 3 * big), ("en", b"a b", big - 1)], "lang string, phrase binary, n long")
    real = collocations.frequent_phrases
    collocations.frequent_phrases = lambda *a, **b: frame
    try:
        row, = collocations.collocations(frame).collect()
    finally:
        collocations.frequent_phrases = real
    assert row.score == 1000 * (big - 1) * 4 * big // (3 * big * big)


def test_empty(spark):
    assert found(spark, [("en", None)]) == []
    assert collocations.collocations(documents(spark, ["x"]).selectExpr("*", "'en' AS lang").where("doc_id < 0")).collect() == []
