"""Quality rules against a plain version, and the verdicts on planted junk."""

import re
from collections import Counter
from math import log, log2, sqrt
from statistics import median
from unicodedata import category

from llm_cases import SPLIT, documents, hard_texts, words

from foliograph.llm import divergence

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base(text):
    text = text or ""
    w = SPLIT.findall(text)
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if n[r] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def letters(text):
    return "".join(c if category(c)[0] == "L" else " " for c in text.lower()).split()


def histograms(text, common):
    kinds = [0] * 6
    for c in text:
        kinds[0 if category(c) == "Ll" else 1 if category(c) == "Lu" else 2 if category(c) == "Nd" else 3 if c in " \t\n\v\f\r" else 4 if c in ".,;:'\"()-" else 5] += 1
    n = Counter(letters(text))
    h = [n[w] for w in common]
    return kinds, h + [sum(n.values()) - sum(h)]


def distance(own, of):
    if not sum(own) or not sum(of):
        return 0
    out = 0
    for c, r in zip(own, of, strict=True):
        p, q = c / sum(own), r / sum(of)
        out += (p * log2(2 * p / (p + q)) if p else 0) + (q * log2(2 * q / (p + q)) if q else 0)
    return sqrt(max(0, out / 2))


def half_up(x):
    return int(x + 0.5)


def plain(rows, rare=1000):
    """[(id, counts, base_failed, kept)] of (id, text, lang) rows."""
    rows = [(i, t or "", x) for i, t, x in rows]
    held = {}
    for _, t, x in rows:
        held.setdefault(x, Counter()).update(set(letters(t)))
    every = sum(sum(c.values()) for c in held.values())
    own = {x for x, c in held.items() if sum(c.values()) * rare >= every and c}
    groups = {x: held[x] for x in own} | {"*": sum(held.values(), Counter())}
    common = {g: ([w for w, _ in sorted(c.items(), key=lambda wc: (-wc[1], wc[0].encode()))] + [None] * 24)[:24] for g, c in groups.items()}
    of = lambda x: x if x in own else "*"
    hist = [histograms(t, common[of(x)]) for _, t, x in rows]
    judged = [len(t) >= 200 and sum(h[1]) >= 50 for (_, t, _), h in zip(rows, hist, strict=True)]
    out = []
    for n, (i, t, x) in enumerate(rows):
        counts = base(t)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        bad = False
        for kind, limit in ((0, 0.15), (1, 0.3)):
            own_h = hist[n][kind]
            mates = [hist[m][kind] for m in range(len(rows)) if judged[m] and (of(x) == "*" or rows[m][2] == x)]
            if judged[n]:
                ref = [median(half_up(h[b] * 1000 / sum(h)) for h in mates) for b in range(len(own_h))]
                bad |= distance(own_h, ref) > limit + sqrt((len(own_h) - 1) / (8 * log(2)) / sum(own_h))
        out.append((i, *counts, failed, not failed and not bad))
    return sorted(out, key=str)


def found(df):
    out = df.select("doc_id", *COUNTS, "base_failed", "kept").collect()
    assert all(t == "bigint" for _, t in df.dtypes[:6])
    return sorted((tuple(r) for r in out), key=str)


def english(seed, n=150):
    filler = words(n, seed, 0, 400)
    return " ".join(x for i, w in enumerate(filler) for x in (("the", "of", "and", "to", "a")[i % 5], "".join(chr(97 + int(c)) for c in w[1:]) + "x")) + "."


def test_plain_version(spark):
    junk = ["A" * 900 + " B" * 60, " | ".join(words(120, 8)), "THE END IS NEAR! " * 40, "$$$ ".join(words(90, 9)), "same line\n" * 60,
            "a b c d\na b c\n\n \na b c d\n" + " ".join(words(60, 3)), "x y z " + " ".join(words(50, 4)) + " x y z x y z"]
    rows = [(i, english(i), ("en", "fr", None)[i % 3]) for i in range(45)]
    rows += [(100 + i, t, "en") for i, t in enumerate([*hard_texts(), *junk])] + [(None, english(90), "xx"), (5, english(5), "fr"), (5, english(91), "zz")]
    df = spark.createDataFrame([(i, t, x) for i, t, x in rows], "doc_id long, text string, lang string").selectExpr(
        "*", *(f"'own' AS {c}" for c in ("w", "h", "words", "classes", "length", "of", "word")))
    for rare in (1000, 4):  # with 4, small languages are compared with the corpus
        assert found(divergence.judge(df, rare=rare)) == plain(rows, rare)


def test_verdicts(spark):
    good = [(i, english(i), "en") for i in range(60)]
    bad = [(100, english(1).replace(" ", " | "), "en"), (101, english(2).upper(), "en"), (102, english(3).replace("x", "&&&"), "en"),
           (103, " ".join("".join(chr(97 + int(c)) for c in w[1:]) + "q" for w in words(200, 5)), "en")]
    df = spark.createDataFrame([*good, *bad], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in divergence.judge(df).collect()}
    assert all(kept[i] for i, _, _ in good) and not any(kept[i] for i, _, _ in bad)


def test_no_python_and_empty(spark):
    import io
    from contextlib import redirect_stdout

    df = documents(spark, hard_texts()).selectExpr("*", "'en' AS lang")
    out = divergence.judge(df)
    with redirect_stdout(io.StringIO()) as said:
        out.explain("formatted")
    assert not re.search("Python|Pandas|Arrow", said.getvalue())
    assert divergence.judge(df.where("doc_id < 0")).collect() == []
    assert {(r.base_failed, r.kept) for r in divergence.judge(df.where("text IS NULL")).collect()} == {(True, False)}


def test_long_text(spark):
    """A text of several million characters is judged whole; runs of one word are sorted like others."""
    rows = [(0, " ".join(words(300_000, 2)), "en"), (1, "x " * 200_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r[0]: r[1:6] for r in found(divergence.judge(df))}
    assert got == {i: base(t) for i, t, _ in rows}
