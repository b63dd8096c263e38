"""Operator 13: quality rules by distribution divergence, in column expressions only.

Every document has two histograms: its characters by class, and its words by the ``COMMON`` words that most documents of its
language hold, and all others. Both are compared with the language's reference, the median share of each bin over all of its
documents, by the Jensen-Shannon distance (base 2, from 0 to 1). A document whose distance exceeds a limit fails; the limit is
widened by the distance that a sample of the document's length is expected to have by chance, and documents below a length are
neither judged nor part of a reference.

A language is a reference of its own if it has at least one in ``RARE`` of all words, so there are at most ``RARE`` references,
and they are broadcast; documents of other languages are compared with the corpus as a whole. Texts never move: one pass counts
the documents of each word, combined before the shuffle, another makes the counts of each row where it is; references and
verdicts come from those.

Base rules: at least 50 words, and at most half of the words in three-word windows that the text repeats. Windows are sorted
inside their row, n log n in the words, and compared word by word.

Defined results: a null text is an empty one and has no words, so it fails the base rules; a null language is one of its own;
texts of any length are judged whole; repeated rows count and get the same verdict each; an empty table gives no rows; other
columns are not read and cannot clash.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliograph.llm.common import stored

COMMON, RARE = 24, 1000
FEWEST_WORDS, MOST_REPEATED = 50, 50
CHARACTER_LIMIT, WORD_LIMIT = 0.15, 0.3
SHORTEST_TEXT, FEWEST_JUDGED = 200, 50
# The classes of characters, as patterns; the last bin holds all others.
CLASSES = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "space": r"[\x20\x09-\x0D]", "mark": r"[.,;:'\"()-]"}
SPACES, SYMBOLS = r"[\x20\x09-\x0D]", r"[#*$%&|<>]"


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES + "+"), "")


def matching(text: Column, pattern: str) -> Column:
    """Characters of a text in a class."""
    return F.length(F.regexp_replace(text, f"[^{pattern.strip('[]')}]+", ""))


def sorted_windows(words: Column) -> Column:
    """The three-word windows with their places, equal ones side by side; null for fewer than two."""
    n = F.size(words) - 2
    run = lambda i: F.slice(words, i, n)
    windows = F.arrays_zip(run(1).alias("x"), run(2).alias("y"), run(3).alias("z"), F.sequence(F.lit(0), n - 1).alias("at"))
    return F.when(n > 1, F.sort_array(windows))


def equal_neighbours(windows: str) -> Column:
    """Windows that equal the one behind them, with that one."""
    both = F.arrays_zip(F.slice(windows, F.lit(1), F.size(windows) - 1).alias("one"), F.slice(windows, F.lit(2), F.size(windows) - 1).alias("next"))
    return F.filter(both, lambda b: (b["one"]["x"] == b["next"]["x"]) & (b["one"]["y"] == b["next"]["y"]) & (b["one"]["z"] == b["next"]["z"]))


def covered_words(equal: str) -> Column:
    """Words that lie in windows which occur twice or more."""
    at = F.sort_array(F.array_distinct(F.concat(F.col(equal)["one"]["at"], F.col(equal)["next"]["at"])))

    def total(x: Column) -> Column:
        steps = F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.least(F.lit(3), b - a))
        return F.aggregate(steps, F.lit(3), lambda n, step: n + step)

    return F.when(F.size(equal) > 0, let(at, total)).otherwise(0)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def letter_words(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), " "), "")


def times_in(words: Column, word: Column) -> Column:
    """How often a word occurs; 0 for a null word."""
    return F.coalesce(F.size(words) - F.size(F.array_remove(words, word)), F.lit(0))


def with_rest(counts: Column, total: Column) -> Column:
    """Counts and one bin more for what they leave of the total."""
    return F.concat(counts, F.array(total - F.aggregate(counts, F.lit(0), lambda a, b: a + b)))


def distance(own: Column, of: Column) -> Column:
    """Jensen-Shannon distance of two histograms; 0 if one is null or empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def shares(x: Column) -> Column:
        return let(total(x), lambda n: F.transform(x, lambda c: c / n))

    def half(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    between = F.zip_with(shares(own), shares(of), lambda p, q: let((p + q) / 2, lambda m: (half(p, m) + half(q, m)) / 2))
    return F.when((total(own) > 0) & (total(of) > 0), F.sqrt(F.greatest(F.lit(0.0), total(between)))).otherwise(0.0)


def chance(bins: int, n: Column) -> Column:
    """The distance that a sample of n from the reference itself is expected to have."""
    return F.sqrt(F.lit((bins - 1) / (8 * log(2))) / F.greatest(n, F.lit(1)))


def common_words(texts: DataFrame, common: int, rare: int) -> DataFrame:
    """(lang, words): the words of most documents, for languages with one in ``rare`` of all and, as whole, for the corpus."""
    words = texts.select("lang", F.explode(F.array_distinct(letter_words(F.col("text")))).alias("word"))
    counts = stored(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    large = totals.where(F.col("total") * rare >= counts.agg(F.sum("n").alias("n")).scalar()).select(F.col("lang").alias("of"))
    own = counts.join(large, F.expr("lang <=> of"), "left_semi").withColumn("whole", F.lit(False))
    every = counts.groupBy("word").agg(F.sum("n").alias("n")).select(
        F.lit(None).cast("string").alias("lang"), "word", "n", F.lit(True).alias("whole"))
    first = F.row_number().over(Window.partitionBy("whole", "lang").orderBy(F.desc("n"), "word"))
    top = own.unionByName(every).withColumn("k", first).where(F.col("k") <= common)
    top = top.groupBy("whole", "lang").agg(F.sort_array(F.collect_list(F.struct("k", "word"))).alias("w"))
    return stored(top.select("whole", "lang", F.col("w.word").alias("words")), "common-words")


def counted(texts: DataFrame, known: DataFrame, common: int) -> DataFrame:
    """One row of counts for each text; ``of`` is its language if that has a reference."""
    whole = known.where("whole").select("words").collect()  # one row, none for an empty table
    words = F.array(*map(F.lit, whole[0][0])) if whole else F.lit(None).cast("array<string>")
    own = known.where("NOT whole").select(F.col("lang").alias("of"), F.col("words").alias("own"), F.lit(True).alias("has_own"))
    # at most ``rare`` rows of ``common`` words
    met = texts.join(F.broadcast(own), F.expr("lang <=> of"), "left").select(
        "doc_id", "of", F.coalesce("has_own", F.lit(False)).alias("has_own"), "text", F.coalesce("own", words).alias("common"),
        words_of(F.col("text")).alias("w"), letter_words(F.col("text")).alias("l"))
    # each step works out what the next one uses more than once
    plain = met.select(
        "doc_id", "of", "has_own", F.size("w").alias("n_words"), F.length("text").alias("length"), F.size("l").alias("letters"),
        F.length(F.array_join("w", "")).alias("word_chars"), matching(F.col("text"), SYMBOLS).alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"), F.array(*(matching(F.col("text"), p) for p in CLASSES.values())).alias("c"),
        F.array(*(times_in(F.col("l"), F.get("common", F.lit(i))) for i in range(common))).alias("h"), sorted_windows(F.col("w")).alias("windows"))
    compared = plain.select("*", equal_neighbours("windows").alias("equal")).drop("windows")
    return compared.select(
        "doc_id", "of", "has_own", "length", "letters", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        covered_words("equal").alias("n_repeat_words"), with_rest(F.col("c"), F.col("length")).alias("classes"),
        with_rest(F.col("h"), F.col("letters")).alias("words"))


def medians(histogram: str, total: str, bins: int) -> Column:
    """The median share of each bin, in thousandths, so that a bin has a bounded number of different values."""
    share = lambda i: F.round(F.col(histogram)[i] * 1000 / F.col(total)).cast("int")
    return F.array(*(F.percentile(share(i), 0.5) for i in range(bins))).alias(histogram)


def references(rows: DataFrame, common: int, shortest: int, fewest_judged: int) -> DataFrame:
    """(ref_of, ref_own, ref_classes, ref_words): at most one row for each language of its own, and one for all documents."""
    judged = rows.where((F.col("length") >= shortest) & (F.col("letters") >= fewest_judged))
    columns = (medians("classes", "length", len(CLASSES) + 1), medians("words", "letters", common + 1))
    own = judged.where("has_own").groupBy("of").agg(*columns).withColumn("has_own", F.lit(True))
    every = judged.agg(*columns).select(F.lit(None).cast("string").alias("of"), "classes", "words", F.lit(False).alias("has_own"))
    return own.unionByName(every).select(*(F.col(c).alias(f"ref_{c}") for c in ("of", "has_own", "classes", "words")))


def judge(docs: DataFrame, character_limit: float = CHARACTER_LIMIT, word_limit: float = WORD_LIMIT, common: int = COMMON,
          rare: int = RARE, fewest: int = FEWEST_WORDS, repeated: int = MOST_REPEATED, shortest: int = SHORTEST_TEXT,
          fewest_judged: int = FEWEST_JUDGED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, counts of the base rules, base_failed, kept, both distances) of every document.

    ``repeated`` is the largest percentage of words in repeated windows; ``shortest`` characters and ``fewest_judged`` letter
    words are needed for a comparison.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    rows = stored(counted(texts, common_words(texts, common, rare), common), "text-counts")
    known = stored(references(rows, common, shortest, fewest_judged), "references")
    # at most ``rare`` rows and one
    met = rows.join(F.broadcast(known), F.expr("of <=> ref_of AND has_own = ref_has_own"), "left")
    scored = met.select(
        "*", F.coalesce(distance(F.col("classes"), F.col("ref_classes")), F.lit(0.0)).alias("character_distance"),
        F.coalesce(distance(F.col("words"), F.col("ref_words")), F.lit(0.0)).alias("word_distance"))
    failed = (F.col("n_words") < fewest) | (F.lit(100) * F.col("n_repeat_words") > F.lit(repeated) * F.col("n_words"))
    diverges = (F.col("length") >= shortest) & (F.col("letters") >= fewest_judged) & (
        (F.col("character_distance") > F.lit(character_limit) + chance(len(CLASSES) + 1, F.col("length")))
        | (F.col("word_distance") > F.lit(word_limit) + chance(common + 1, F.col("letters"))))
    longs = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return scored.select("doc_id", *longs, failed.alias("base_failed"), (~failed & ~diverges).alias("kept"), "character_distance", "word_distance")
