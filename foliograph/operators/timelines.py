"""Intervals and dates: interval joins, as-of joins, periods of affiliation, lags between stages, and trend tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.functions.text import bind
from foliograph.plans.session import cut_lineage, written
from foliograph.plans.shapes import as_list, keep_first, many_to_many, union_by_name

OPEN = 1 << 61  # stands for an end that is open; values lie inside it
OPEN_LEVEL = 62
PLAIN = 256  # pairs that a key compares for each of its rows, before bins cost less


# --- interval join ---------------------------------------------------------------------------------------------------


def _placed(df: DataFrame, low: str, high: str, on: Sequence[str]) -> DataFrame:
    """Bounds as numbers, and the level of each interval: it touches at most two bins of ``2 ** level``."""
    bounds = df.select("*", F.coalesce(F.col(low).cast("long"), F.lit(-OPEN)).alias("_lo"), F.coalesce(F.col(high).cast("long"), F.lit(OPEN)).alias("_hi"))
    kept = bounds.where(F.col("_lo") <= F.col("_hi"))
    for k in on:
        kept = kept.where(F.col(k).isNotNull())
    length = (F.col("_hi") - F.col("_lo") + 1).cast("double")
    level = F.when((F.col("_lo") == -OPEN) | (F.col("_hi") == OPEN), OPEN_LEVEL).otherwise(F.ceil(F.log2(length)).cast("int"))
    return kept.withColumn("_level", level)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str]) -> DataFrame:
    """Rows of equal ``on`` whose closed intervals overlap, as an equi join.

    Bounds are whole numbers (years, days) or null for an open end; a point has the same column twice. An interval that ends
    before it starts meets nothing, nor does a null key. Other columns of the two sides must differ in name.

    Where a key has few intervals on a side, all its pairs are compared: at most ``PLAIN`` for each of its rows. In the others, an
    interval lies in at most two bins of a width that is a power of two and not below its length. A pair meets at the wider one's
    width: each side is copied to its own width and to the wider ones that the other side has, which are few, and the bin
    where the overlap starts lets the pair through. Long and open intervals therefore cost no more copies than short ones,
    and groups of any size are cut into cells.
    """
    on = as_list(on)
    x, y = _placed(left, *left_bounds, on), _placed(right, *right_bounds, on)
    x = written(x.withColumnsRenamed({"_lo": "_lx", "_hi": "_hx", "_level": "_vx"}))
    y = written(y.withColumnsRenamed({"_lo": "_ly", "_hi": "_hy", "_level": "_vy"}))
    columns = [*left.columns, *[c for c in right.columns if c not in on]]
    count = lambda df, name: df.groupBy(*on).agg(F.count("*").alias(name))
    many = F.col("_nx") * F.col("_ny") > F.lit(PLAIN) * (F.col("_nx") + F.col("_ny"))
    wide = written(count(x, "_nx").join(count(y, "_ny"), on).where(many).select(*on))
    overlap = (F.col("_lx") <= F.col("_hy")) & (F.col("_ly") <= F.col("_hx"))
    if wide.isEmpty():
        return x.join(y, on).where(overlap).select(*columns)
    plain = x.join(wide, on, "left_anti").join(y, on).where(overlap).select(*columns)
    return plain.unionByName(_met_in_bins(x.join(wide, on, "left_semi"), y.join(wide, on, "left_semi"), on).select(*columns))


def _met_in_bins(x: DataFrame, y: DataFrame, on: Sequence[str]) -> DataFrame:
    x, y = written(x), written(y)
    levels = lambda df, c: sorted(r[0] for r in df.select(c).distinct().collect())  # noqa: E731  at most 63

    def copies(df: DataFrame, lo: str, hi: str, own: str, others: list[int]) -> DataFrame:
        wider = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda v: v > F.col(own))
        at = df.withColumn("_at", F.explode(F.concat(F.array(own), wider)))
        ends = [F.expr(f"shiftright({c}, _at)") for c in (lo, hi)]
        return at.withColumn("_bin", F.explode(F.array_distinct(F.array(*ends))))

    spread_x, spread_y = copies(x, "_lx", "_hx", "_vx", levels(y, "_vy")), copies(y, "_ly", "_hy", "_vy", levels(x, "_vx"))
    met = many_to_many(spread_x, spread_y, [*on, "_at", "_bin"])
    first = F.greatest("_lx", "_ly")
    return met.withColumn("_first", first).where(
        (F.col("_lx") <= F.col("_hy")) & (F.col("_ly") <= F.col("_hx")) & (F.greatest("_vx", "_vy") == F.col("_at"))
        & (F.expr("shiftright(_first, _at)") == F.col("_bin")))


# --- as-of join ------------------------------------------------------------------------------------------------------


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_at: str, right_at: str, carry: Mapping[str, str],
              strict: bool = False) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` at or before it (before it if ``strict``) with equal ``on``.

    ``carry`` maps columns of ``right`` to their names in the result; they are null where no row comes before. Of rows of one
    moment the one with the largest carried values counts. Rows with a null key or moment have no partner and are none.

    Both sides are sorted together by range, so one key may fill many partitions. Inside a partition the last value is a running
    maximum; what a partition takes over from those before is one row per key and partition.
    """
    on = as_list(on)
    value = F.struct(F.col(right_at).alias("_t"), *[F.col(c).alias(n) for c, n in carry.items()])
    known = right.where(F.col(right_at).isNotNull())
    for k in on:
        known = known.where(F.col(k).isNotNull())
    points = known.groupBy(*on, F.col(right_at).alias("_at")).agg(F.max(value).alias("_v")).withColumn("_side", F.lit(1 if strict else 0))
    rows = left.withColumn("_at", F.col(left_at)).withColumn("_row", F.struct(*left.columns)).select(*on, "_at", "_row").withColumn(
        "_side", F.lit(0 if strict else 1))
    both = union_by_name(points, rows)
    order = [*on, "_at", "_side"]
    placed = cut_lineage(both.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    inside = W.partitionBy("_pid", *on).orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = placed.withColumn("_own", F.max("_v").over(inside))
    last = placed.groupBy(*on, "_pid").agg(F.max("_v").alias("_last"))
    before = W.partitionBy(*on).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    taken = last.withColumn("_taken", F.max("_last").over(before)).drop("_last")
    out = running.where("_row IS NOT NULL").join(taken, [*on, "_pid"], "left").withColumn("_best", F.coalesce("_own", "_taken"))
    blank = F.col("_at").isNull()
    return out.select("_row.*", *[F.when(~blank, F.col("_best")[n]).alias(n) for n in carry.values()])


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """The exact median per key and the number of values, by selection from value counts; nulls do not count.

    Values are counted before the shuffle; a key's distinct values are in one window, however many rows it has.
    """
    keys = as_list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    below = W.partitionBy(*keys).orderBy(value)
    placed = counts.withColumn("_to", F.sum("_n").over(below)).withColumn("_all", F.sum("_n").over(W.partitionBy(*keys)))
    middle = lambda i: F.min(F.when(F.col("_to") >= i, F.col(value).cast("double")))
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return placed.groupBy(*keys).agg(((middle(low) + middle(high)) / 2).alias(out), F.max("_all").alias("n"))


def stage_lags(docs: DataFrame, theme: str, stage: str, at: str, key: str, stages: Sequence[str]) -> DataFrame:
    """``(theme, key, stage, after, lag)``: each document of a later stage with the last one of the stage before it in its theme.

    ``at`` is a date; ``lag`` counts days, and is null, like ``after``, where the theme has no earlier document of the stage before.
    """
    out = []
    for before, now in zip(stages, stages[1:], strict=False):
        later = docs.where(F.col(stage) == now).select(F.col(theme).alias("theme"), F.col(key).alias("key"), F.col(stage).alias("stage"), F.col(at).alias("_d"))
        earlier = docs.where(F.col(stage) == before).select(F.col(theme).alias("theme"), F.col(key).alias("_k"), F.col(at).alias("_s"))
        met = asof_join(later, earlier, ["theme"], "_d", "_s", {"_k": "after", "_s": "_since"})
        out.append(met.select("theme", "key", "stage", "after", F.datediff("_d", "_since").cast("long").alias("lag")))
    return union_by_name(*out)


# --- affiliation -----------------------------------------------------------------------------------------------------

INFERRED, REGISTERED = "inferida", "cadastro"


def unit_periods(evidence: DataFrame, registered: DataFrame, person: str = "person_id", unit: str = "unit_id", year: str = "year",
                 width: int = 3) -> DataFrame:
    """``(person, first, last, unit, source)``: periods in which a person belongs to a unit; they do not overlap.

    ``evidence(person, doc_uid, unit, year)`` has documents, ``registered(person, unit)`` at most one unit a person. Each year from a
    person's first to last document takes the unit with most documents in the ``width`` years around it; a tie goes to the unit
    seen last, then to the smaller one. A year without a document in reach, and the time before and after, which is open
    (null), take the registered unit, if there is one. Neighbouring years of one unit and source are a period.
    """
    half = width // 2
    seen = evidence.where(F.col(year).isNotNull() & F.col(unit).isNotNull() & F.col(person).isNotNull()).select(
        F.col(person).alias("person_id"), F.col(unit).alias("unit_id"), F.col(year).cast("int").alias("year"), "doc_uid").distinct()
    yearly = seen.groupBy("person_id", "unit_id", "year").agg(F.count("*").alias("n"))
    yearly = written(yearly)
    reach = yearly.select("person_id", "unit_id", "n", F.col("year").alias("_seen"), F.explode(F.sequence(F.col("year") - half, F.col("year") + half)).alias("year"))
    sums = reach.groupBy("person_id", "year", "unit_id").agg(F.sum("n").alias("n"), F.max("_seen").alias("_seen"))
    best = keep_first(sums, ["person_id", "year"], [F.col("n").desc(), F.col("_seen").desc(), F.col("unit_id")])
    span = yearly.groupBy("person_id").agg(F.min("year").alias("_first"), F.max("year").alias("_last"))
    named = registered.select(F.col(person).alias("person_id"), F.col(unit).alias("_unit")).where("person_id IS NOT NULL AND _unit IS NOT NULL")
    every = span.select("person_id", "_first", "_last", F.explode(F.sequence("_first", "_last")).alias("year"))
    known = every.join(best.select("person_id", "year", "unit_id"), ["person_id", "year"], "left").join(named, "person_id", "left")
    years = known.select("person_id", "year", F.coalesce("unit_id", "_unit").alias("unit_id"),
                         F.when(F.col("unit_id").isNotNull(), INFERRED).otherwise(REGISTERED).alias("source")).where("unit_id IS NOT NULL")
    # a year less its place among those of the same unit and source is constant inside a run
    run = W.partitionBy("person_id", "unit_id", "source").orderBy("year")
    runs = years.withColumn("_run", F.col("year") - F.row_number().over(run))
    inner = runs.groupBy("person_id", "unit_id", "source", "_run").agg(F.min("year").alias("first"), F.max("year").alias("last")).drop("_run")
    outer = named.join(span, "person_id", "left")
    none = F.lit(None).cast("int")
    ends = F.when(F.col("_first").isNull(), F.array(F.struct(none.alias("first"), none.alias("last")))).otherwise(F.array(
        F.struct(none.alias("first"), (F.col("_first") - 1).alias("last")), F.struct((F.col("_last") + 1).alias("first"), none.alias("last"))))
    around = outer.select("person_id", F.col("_unit").alias("unit_id"), F.lit(REGISTERED).alias("source"), F.explode(ends).alias("e")).select(
        "person_id", "unit_id", "source", "e.first", "e.last")
    columns = ["person_id", "first", "last", "unit_id", "source"]
    return inner.select(*columns).unionByName(around.select(*columns))


def units_at(rows: DataFrame, periods: DataFrame, at: str) -> DataFrame:
    """Rows ``(person_id, ..., at)`` with ``unit_id`` and ``source`` of the period their year lies in."""
    return interval_join(rows, periods.select("person_id", "first", "last", "unit_id", "source"), ["person_id"], (at, at), ("first", "last")).drop("first", "last")


def activity_spans(evidence: DataFrame, pause: int = 5, person: str = "person_id", year: str = "year") -> DataFrame:
    """``(person_id, first, last, n_years)``: stretches of activity; a break of more than ``pause`` years ends one."""
    years = evidence.select(F.col(person).alias("person_id"), F.col(year).cast("int").alias("year")).where(
        "person_id IS NOT NULL AND year IS NOT NULL").distinct()
    ordered = W.partitionBy("person_id").orderBy("year")
    new = F.coalesce(F.col("year") - F.lag("year").over(ordered) > pause, F.lit(True)).cast("int")
    numbered = years.withColumn("_new", new).withColumn("_span", F.sum("_new").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return numbered.groupBy("person_id", "_span").agg(
        F.min("year").alias("first"), F.max("year").alias("last"), F.count("*").alias("n_years")).drop("_span")


def active_candidates(candidates: DataFrame, spans: DataFrame, at: str, slack: int = 2) -> DataFrame:
    """Candidates ``(person_id, ..., at)`` with ``active``: whether the year lies in a stretch of activity or ``slack`` years beside it."""
    wide = spans.select("person_id", (F.col("first") - slack).alias("_first"), (F.col("last") + slack).alias("_last"))
    hits = interval_join(candidates.select("person_id", at).distinct(), wide, ["person_id"], (at, at), ("_first", "_last"))
    known = hits.select("person_id", at).distinct().withColumn("_hit", F.lit(True))
    return candidates.join(known, ["person_id", at], "left").withColumn("active", F.coalesce("_hit", F.lit(False))).drop("_hit")


# --- trends ----------------------------------------------------------------------------------------------------------


def _pairs(series: Column, use) -> Column:
    """``use(earlier, later)`` for all pairs of points of an ordered array."""
    return F.flatten(F.transform(series, lambda x, i: F.transform(F.slice(series, i + 2, F.size(series)), lambda y: use(x, y))))


def trend(series: Column, level: float = 1.96) -> Column:
    """Mann-Kendall trend test of an array of ``struct(year, value)``: struct(n, s, variance, z, direction, slope).

    ``s`` counts rising less falling pairs, the variance is corrected for ties, ``z`` for continuity; ``direction`` is 1 or -1 where
    ``z`` exceeds ``level``, else 0. The slope is the median of the slopes of all pairs of years, null below two points. Points with a
    null year or value do not count; years that are missing are no points, and a year must not be repeated.
    """
    def tested(points: Column) -> Column:
        n = F.size(points)
        signs = _pairs(points, lambda x, y: F.signum(y["value"] - x["value"]))
        slopes = F.array_sort(_pairs(points, lambda x, y: (y["value"] - x["value"]) / (y["year"] - x["year"])))
        values = F.transform(points, lambda p: p["value"])
        ties = F.transform(F.array_distinct(values), lambda v: F.size(F.filter(values, lambda w: w == v)).cast("double"))
        corrected = F.aggregate(ties, F.lit(0.0), lambda a, t: a + t * (t - 1) * (2 * t + 5))
        return F.struct(
            n.alias("n"), F.aggregate(signs, F.lit(0.0), lambda a, b: a + b).cast("long").alias("s"),
            ((n * (n - 1) * (2 * n + 5)).cast("double") - corrected).alias("v"), slopes.alias("slopes"))

    def summed(t: Column) -> Column:
        variance = t["v"] / 18
        z = F.when(variance > 0, (t["s"] - F.signum(t["s"].cast("double"))) / F.sqrt(variance)).otherwise(0.0)
        m = F.size(t["slopes"])
        half = lambda i: F.element_at(t["slopes"], i.cast("int"))
        slope = F.when(m > 0, (half(F.floor((m + 1) / 2)) + half(F.floor(m / 2) + 1)) / 2)
        return F.struct(t["n"].alias("n"), t["s"].alias("s"), variance.alias("variance"), z.alias("z"),
                        F.when(z > level, 1).when(z < -level, -1).otherwise(0).alias("direction"), slope.alias("slope"))

    clean = F.array_sort(F.filter(series, lambda p: p["year"].isNotNull() & p["value"].isNotNull()))
    return bind(bind(clean, tested), summed)


def trends(df: DataFrame, keys: Sequence[str], year: str, value: str, level: float = 1.96) -> DataFrame:
    """The trend test of each key's yearly values, one row a key and year: ``(keys, n, s, variance, z, direction, slope)``."""
    keys = as_list(keys)
    series = F.collect_list(F.struct(F.col(year).cast("double").alias("year"), F.col(value).cast("double").alias("value")))
    return df.groupBy(*keys).agg(series.alias("_s")).select(*keys, trend(F.col("_s"), level).alias("_t")).select(*keys, "_t.*")


def share_trends(docs: DataFrame, theme: str, year: str, level: float = 1.96) -> DataFrame:
    """The trend of each theme's share of a year's documents; years in which a theme has none count as 0."""
    counts = docs.where(F.col(year).isNotNull()).groupBy(F.col(theme).alias("theme"), F.col(year).alias("year")).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts)
    totals = counts.groupBy("year").agg(F.sum("n").alias("total"))
    # themes times years: both are dimensions of a report, and a theme's years come as one array
    years = totals.agg(F.collect_list(F.struct("year", "total")).alias("y"))
    grid = counts.select("theme").distinct().withColumn("_y", years.scalar()).select("theme", F.explode("_y").alias("y")).select("theme", "y.year", "y.total")
    shares = grid.join(counts, ["theme", "year"], "left").withColumn("share", F.coalesce("n", F.lit(0)) / F.col("total"))
    return trends(shares, ["theme"], "year", "share", level)
