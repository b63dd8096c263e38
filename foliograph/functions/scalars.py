"""Small scalar expressions: predicates, ids, bins, ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordinal levels of a cosine (right-closed bins) and the open end year of a running project.
LEVEL_CUTS = [-1.0, 0.25, 0.4, 0.6, 1.01]
LEVEL_LABELS = ["baixa", "moderada", "alta", "muito alta"]
OPEN_END = 9999
PUBLIC_PREFIX, PUBLIC_DIGITS = "PS", 10


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_period(year, first: int, last: int) -> Column:
    """PF-3."""
    return _col(year).between(first, last)


def in_scope(kind, year, end, cut: int, running: str = "projeto") -> Column:
    """PF-6: running kinds count by end year (null is still open), the others by year."""
    return F.when(_col(kind) == running, F.coalesce(_col(end), F.lit(OPEN_END)) >= cut).otherwise(
        F.coalesce(_col(year) >= cut, F.lit(False))
    )


def null_safe(flag) -> Column:
    """PF-8."""
    return F.coalesce(_col(flag), F.lit(False))


def flag(c, true: str = "TRUE") -> Column:
    """SC-23: text to boolean; blank and null are false."""
    return F.coalesce(F.upper(c) == true, F.lit(False))


def month_year(c) -> Column:
    """SC-14: ``mm/yyyy`` to struct(year, month)."""
    return F.struct(F.right(_col(c), F.lit(4)).try_cast("int").alias("year"),
                    F.left(_col(c), F.lit(2)).try_cast("int").alias("month"))


def format_id(prefix: str, n, width: int = 0) -> Column:
    """SC-15: prefix and zero-padded number."""
    text = _col(n).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, width, "0") if width else text)


def text_hash(model: str, limit: int, c) -> Column:
    """SC-16: content key of a text under one model and length limit."""
    return F.sha1(F.concat_ws("|", F.lit(model), F.lit(str(limit)), _col(c)))


def public_id(c) -> Column:
    """SC-16: stable id that does not show the internal one."""
    return F.concat(F.lit(PUBLIC_PREFIX), F.substring(F.sha1(_col(c)), 1, PUBLIC_DIGITS))


def year_bin(c, width: int) -> Column:
    """SC-18: first year of the window."""
    return (F.floor(_col(c) / width) * width).cast("int")


def year_bin_label(c, width: int) -> Column:
    start = year_bin(c, width)
    return F.concat(start.cast("string"), F.lit("–"), (start + width - 1).cast("string"))


def level(c, cuts: Sequence[float] = LEVEL_CUTS, labels: Sequence[str] = LEVEL_LABELS) -> Column:
    """SC-19: right-closed bins."""
    ladder = F.when(_col(c) <= cuts[0], None)
    for upper, label in zip(cuts[1:], labels, strict=True):
        ladder = ladder.when(_col(c) <= upper, label)
    return ladder


def log_ratio(a, b, smooth: float) -> Column:
    """SC-20: log2 of two rates with additive smoothing."""
    return F.log2((_col(a) + smooth) / (_col(b) + smooth))


def safe_ratio(a, b) -> Column:
    """SC-20: division with a denominator of at least 1."""
    return _col(a) / F.greatest(_col(b), F.lit(1))


def ladder(*cases: tuple[Column, object], default=None) -> Column:
    """PF-2: ordered conditions, first true wins."""
    (condition, value), *rest = cases
    out = F.when(condition, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(default)
