"""Text keys, personal names and bibliographic signatures as column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------------------------------------------------
# Particles left out of full names, and of the initials of a signature.
NAME_PARTICLES = ["DE", "DA", "DO", "DAS", "DOS", "E", "D", "DI", "DU", "DEL", "DELLA", "VAN", "VON", "DER", "LA", "LE"]
SIGNATURE_PARTICLES = ["DE", "DA", "DO", "DAS", "DOS", "DI", "DU", "DEL", "DELLA", "VAN", "VON", "DER"]
# Generation suffixes that belong to the surname, and their spellings.
SUFFIXES = ["JUNIOR", "FILHO", "NETO", "SOBRINHO"]
SUFFIX_SPELLING = {"JR": "JUNIOR", "FO": "FILHO", "NETTO": "NETO"}
# Particles written in lower case in a displayed name.
DISPLAY_PARTICLES = ["De", "Da", "Do", "Das", "Dos", "E"]
# Function words counted by the language guess.
PORTUGUESE_WORDS = "de da do das dos para com em na no nas nos que e os as um uma foi são pelo pela".split()
ENGLISH_WORDS = "the of and in to for with on is are from was were by this that".split()
# Labels of initials compatibility.
EXACT, COMPATIBLE, INCOMPATIBLE = "exata", "compativel", "incompativel"
# Letters without a decomposition, in the Latin-to-ASCII transliteration.
LATIN_LETTERS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "TH", "ł": "l", "Ł": "L", "ı": "i",
}
# --------------------------------------------------------------------------------------------------------------------


def _accent_table(form: str) -> tuple[str, str]:
    """Characters of the Latin blocks that normalise to one ASCII character plus marks, and that character."""
    source, target = [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        parts = [c for c in unicodedata.normalize(form, char) if unicodedata.category(c) != "Mn"]
        if len(parts) == 1 and parts[0] != char and ord(parts[0]) < 128:
            source.append(char)
            target.append(parts[0])
    return "".join(source), "".join(target)


_NFD, _NFKD = _accent_table("NFD"), _accent_table("NFKD")


def bind(value: Column, body) -> Column:
    """``body`` applied to ``value`` computed once: the value enters as a lambda variable, not as a repeated subtree."""
    return F.transform(F.array(value), body)[0]


def squish(c) -> Column:
    """SC-1: runs of white space to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_marks(c, form: str = "NFD") -> Column:
    source, target = _NFD if form == "NFD" else _NFKD
    return F.regexp_replace(F.translate(c, source, target), r"\p{Mn}+", "")


def fold(c, mode: str = "marks") -> Column:
    """SC-2: accent folding.

    ``latin``   Latin letters to ASCII letters, case kept (``ß`` becomes ``ss``)
    ``ascii``   compatibility decomposition, everything outside ASCII dropped, case kept
    ``marks``   marks dropped, lower case, other letters kept
    ``hyphen``  marks dropped, non-ASCII dropped, lower case, hyphen to blank, trimmed
    """
    if mode == "latin":
        plain = strip_marks(c)
        single = {k: v for k, v in LATIN_LETTERS.items() if len(v) == 1}
        plain = F.translate(plain, "".join(single), "".join(single.values()))
        double = [(k, v) for k, v in LATIN_LETTERS.items() if len(v) > 1]
        return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), double, plain)
    if mode == "ascii":
        return F.regexp_replace(strip_marks(c, "NFKD"), r"[^\x00-\x7F]", "")
    if mode == "marks":
        return strip_marks(F.lower(c))
    if mode == "hyphen":
        return F.trim(F.replace(F.lower(F.regexp_replace(strip_marks(c), r"[^\x00-\x7F]", "")), F.lit("-"), F.lit(" ")))
    raise ValueError(f"unknown folding: {mode}")


@F.pandas_udf(T.StringType())
def fold_exact(texts: pd.Series) -> pd.Series:
    """SC-2 for any script: NFD without marks, lower case. :func:`fold` covers the Latin blocks inside the JVM."""
    return texts.map(
        lambda s: None if s is None
        else "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")
    )


def name_key(c) -> Column:
    """SC-3: folded, upper case, letters and single blanks only."""
    return squish(F.regexp_replace(F.upper(fold(c, "latin")), "[^A-Z ]", " "))


def title_key(c) -> Column:
    """SC-4: folded, lower case, letters, digits and single blanks only."""
    return squish(F.regexp_replace(F.lower(fold(c, "latin")), "[^a-z0-9 ]", " "))


def name_tokens(c) -> Column:
    """SC-5: words of a full name without particles, suffix spellings unified."""
    spelling = F.create_map(*[F.lit(x) for kv in SUFFIX_SPELLING.items() for x in kv])
    words = F.filter(F.split(name_key(c), " "), lambda t: (t != "") & ~t.isin(NAME_PARTICLES))
    return F.transform(words, lambda t: F.coalesce(spelling[t], t))


def _initials(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda t: F.substring(t, 1, 1)), "")


def parse_signature(c) -> Column:
    """SC-6: ``SURNAME, I. I. de X`` to struct(surname, initials); particles give no initial, single letters do."""
    def parts(text: Column) -> Column:
        rest = F.when(F.contains(text, F.lit(",")), F.regexp_replace(text, "^[^,]*,", "")).otherwise("")
        words = F.filter(
            F.split(fold(rest, "latin"), r"[\s.\-]+"), lambda t: t.rlike("^[A-Z]") & ~F.upper(t).isin(SIGNATURE_PARTICLES)
        )
        return F.struct(name_key(F.substring_index(text, ",", 1)).alias("surname"), _initials(words).alias("initials"))

    return bind(squish(c), parts)


def signature_of(c) -> Column:
    """SC-7: the signature a full name would give; a generation suffix joins the surname of three or more words."""
    def parts(words: Column) -> Column:
        n = F.size(words)
        k = F.when((n >= 3) & F.element_at(words, -1).isin(SUFFIXES), 2).otherwise(1)
        surname = F.when(n > 0, F.array_join(F.slice(words, F.greatest(n - k, F.lit(0)) + 1, k), " "))
        initials = F.when(n > 0, _initials(F.slice(words, F.lit(1), F.greatest(n - k, F.lit(0)))))
        return F.struct(surname.alias("surname"), initials.alias("initials"))

    return bind(F.coalesce(name_tokens(c), F.array().cast("array<string>")), parts)


def initials_compat(a, b) -> Column:
    """SC-8: equal; or the shorter, starting with the same letter, is a subsequence of the longer; or neither."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    shorter = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    longer = F.when(F.length(a) <= F.length(b), b).otherwise(a)
    pattern = F.concat(F.lit("^"), F.regexp_replace(shorter, "(.)", "$1.*"))
    return (
        F.when(a == b, EXACT)
        .when((shorter != "") & F.regexp_like(longer, pattern), COMPATIBLE)
        .otherwise(INCOMPATIBLE)
    )


def names_compatible(a, b) -> Column:
    """SC-9: two token arrays may be one person.

    First and last tokens are equal, and the middle tokens of the shorter name occur in order in the longer one, in
    full or as an initial. The fold keeps the part of the longer middle not used yet; null means a token had no match.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    short = F.when(F.size(a) > F.size(b), b).otherwise(a)
    long = F.when(F.size(a) > F.size(b), a).otherwise(b)

    def middle(x: Column) -> Column:
        return F.slice(x, F.lit(2), F.greatest(F.size(x) - 2, F.lit(0)))

    def same(t: Column, u: Column) -> Column:
        return ((t == u) | ((F.length(t) == 1) & F.startswith(u, t)) | ((F.length(u) == 1) & F.startswith(t, u)))

    def step(left: Column, t: Column) -> Column:
        at = F.array_position(F.transform(left, lambda u: same(t, u)), True)
        return F.when(at > 0, F.slice(left, (at + 1).cast("int"), F.size(left)))

    walked = F.aggregate(middle(short), middle(long), step)
    ends = (F.element_at(a, 1) == F.element_at(b, 1)) & (F.element_at(a, -1) == F.element_at(b, -1))
    enough = (F.size(a) >= 2) & (F.size(b) >= 2)
    return F.when(enough, F.coalesce(ends & walked.isNotNull(), F.lit(False))).otherwise(False)


def display_name(c) -> Column:
    """SC-10: title case with lower-case particles."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}']+|[^\p{L}\p{M}']+"), F.lit(0))
    name = F.array_join(F.transform(parts, F.initcap), "")
    return reduce(lambda x, p: F.regexp_replace(x, rf"(?U)\b{p}\b", p.lower()), DISPLAY_PARTICLES, name)


def split_keywords(c) -> Column:
    """SC-11: ``a, b;; c`` to a clean array."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[,;]"), squish), lambda k: k != "")


def extract_all_distinct(c, pattern: str, group: int = 1) -> Column:
    """SC-12: distinct captured values in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(group)))


def word_count(c) -> Column:
    return F.regexp_count(c, F.lit(r"\S+"))


def eligible_title(c, words: int = 4, chars: int = 25) -> Column:
    """SC-13: long enough to identify a work."""
    return F.coalesce((word_count(c) >= words) & (F.length(c) >= chars), F.lit(False))


def guess_language(c) -> Column:
    """SC-17: ``en`` when English function words outnumber Portuguese ones, else ``pt``."""
    words = F.regexp_extract_all(F.lower(c), F.lit("[a-zà-ú]+"), F.lit(0))
    english = F.size(F.filter(words, lambda w: w.isin(ENGLISH_WORDS)))
    portuguese = F.size(F.filter(words, lambda w: w.isin(PORTUGUESE_WORDS)))
    return F.when(english > portuguese, "en").otherwise("pt")


def short_to_null(c, n: int = 30) -> Column:
    """PF-9: an abstract shorter than ``n`` characters counts as missing."""
    return F.when(F.length(c) >= n, c)


def shorten(c, n: int) -> Column:
    """SC-21: first ``n`` characters with an ellipsis when cut."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)
