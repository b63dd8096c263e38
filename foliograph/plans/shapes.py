"""Plan shapes shared by the operators: pairs, lookups, lifts, windows, samples, set operations.

Skew rules followed throughout
------------------------------
* group totals come from ``groupBy`` (map-side combine) joined back, never from an unordered window;
* "first / top n per group" uses ``row_number() <= n``, which Spark cuts to n rows per group before the shuffle;
* many-to-many joins cut large groups into cells (:func:`many_to_many`); other equi joins are left to AQE, which splits
  skewed partitions and broadcasts a side only when its measured size is small;
* totals enter as scalar subqueries, not as cross joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliograph.plans.session import cut_lineage

TILE = 4096  # rows of one side of a join group that one task takes


def as_list(value) -> list:
    return [value] if isinstance(value, (str, Column)) else list(value)


# --- joins -----------------------------------------------------------------------------------------------------------


def big_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Groups of more than ``limit`` rows with their size."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)


def many_to_many(left: DataFrame, right: DataFrame, on: Sequence[str], same: bool = False, tile: int = TILE,
                 ) -> DataFrame:
    """Inner join in which large groups are cut into cells of at most about ``tile`` x ``tile`` row pairs.

    A row of a large group picks its tile by the hash of its content and is copied to the tiles of the other side, so
    every pair meets in exactly one cell and no task takes a whole large group. ``same`` says that both sides have the
    same rows per group (a self join), which saves the second count. The sizes of large groups are joined on the group
    key like any table: they are at most one row per ``tile`` rows, and AQE splits the partition of a hot group.
    """
    on = as_list(on)

    def tiles(df: DataFrame, name: str) -> DataFrame:
        return big_groups(df, on, tile).select(*on, F.ceil(F.col("_n") / tile).cast("int").alias(name))

    if same:
        cells = tiles(left, "_ml").withColumn("_mr", F.col("_ml"))
    else:
        cells = tiles(left, "_ml").join(tiles(right, "_mr"), on, "full")

    def copies(df: DataFrame, own: str, other: str, at: str, across: str) -> DataFrame:
        sized = df.join(cells, on, "left")
        mine, theirs = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        return sized.select(
            *df.columns, F.pmod(F.xxhash64(*df.columns), mine).cast("int").alias(at),
            F.explode(F.sequence(F.lit(0), theirs - 1)).alias(across))

    spread = copies(left, "_ml", "_mr", "_i", "_j")
    joined = spread.join(copies(right, "_mr", "_ml", "_j", "_i"), on + ["_i", "_j"])
    return joined.drop("_i", "_j")


def block_pairs(
    df: DataFrame, block: Sequence[str], key: str, carry: Sequence[str] = (), residual=None,
    names: tuple[str, str] | None = None,
) -> DataFrame:
    """J-5 / J-7: unordered pairs ``key1 < key2`` inside equal blocks, with an optional residual condition.

    ``residual`` is a function of nothing returning a Column over ``<carry>1`` / ``<carry>2``. Rows must be unique per
    (block, key). The input is read three times: give it a table, a ``distinct`` or an aggregate, whose shuffle Spark
    reuses.
    """
    block = as_list(block)
    first, second = names or (key + "1", key + "2")
    left = df.select(*block, F.col(key).alias(first), *[F.col(c).alias(c + "1") for c in carry])
    right = df.select(*block, F.col(key).alias(second), *[F.col(c).alias(c + "2") for c in carry])
    pairs = many_to_many(left, right, block, same=True).where(F.col(first) < F.col(second))
    return pairs if residual is None else pairs.where(residual())


def co_pairs(df: DataFrame, group: str, item: str, other: str) -> DataFrame:
    """J-6: ordered pairs of different items of one group."""
    return symmetrise(block_pairs(df.select(group, item).distinct(), [group], item, names=(item, other)), item, other)


def keep_matching(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """J-2, J-14: semi join."""
    return df.join(other, as_list(on), "left_semi")


def keep_listed(df: DataFrame, column: str, values, most: int = 200) -> DataFrame:
    """PF-4: rows whose column has one of the values, which are a list or a one-column table.

    A list of more than ``most`` values becomes a table, and a table is met by a semi join, so the plan stays short whatever the
    number of values. Null matches nothing.
    """
    if not isinstance(values, DataFrame):
        values = [v for v in dict.fromkeys(values) if v is not None]
        if len(values) <= most:
            return df.where(F.col(column).isin(values))
        values = df.sparkSession.createDataFrame([(v,) for v in values], [column])
    listed = values.select(F.col(values.columns[0]).alias("_listed")).where("_listed IS NOT NULL")
    return df.join(listed, F.col(column) == F.col("_listed"), "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """J-3, SO-3: anti join."""
    return df.join(other, as_list(on), "left_anti")


key_difference = drop_matching


def expand(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """J-4: many-to-many inner join with large groups cut into cells."""
    return many_to_many(df, other, on)


def lookup(
    df: DataFrame, value: Column, dictionary: DataFrame, key: str, result: str, out: str, strict: bool = True,
) -> DataFrame:
    """J-8: dictionary lookup on a unique key; an unmatched non-null value raises when ``strict``.

    The check is an aggregate with at most 20 example values brought to the driver.
    """
    keyed = df.withColumn("_key", value)
    found = keyed.join(dictionary.select(F.col(key).alias("_key"), F.col(result).alias(out)), "_key", "left")
    if strict:
        missing = found.where(F.col("_key").isNotNull() & F.col(out).isNull()).select("_key").distinct().limit(20)
        values = sorted(r["_key"] for r in missing.collect())
        if values:
            raise ValueError(f"values without an entry for {out}: {' | '.join(values)}")
    return found.drop("_key")


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """J-9: put the columns of a one-row table beside every row, as one scalar subquery."""
    names = totals.columns
    wide = df.withColumn("_totals", totals.select(F.struct(*names)).scalar())
    return wide.select(*df.columns, *[F.col("_totals")[n].alias(n) for n in names])


def symmetrise(edges: DataFrame, a: str, b: str) -> DataFrame:
    """J-10: every edge in both directions, from one scan."""
    both = F.explode(F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")),
                             F.struct(F.col(b).alias("x"), F.col(a).alias("y"))))
    rest = [c for c in edges.columns if c not in (a, b)]
    return edges.select(both.alias("_e"), *rest).select(F.col("_e.x").alias(a), F.col("_e.y").alias(b), *rest)


def lift(df: DataFrame, mapping: DataFrame, key: str, source: str, target: str) -> DataFrame:
    """J-15: replace ``key`` by its group id where the map has one, keep it otherwise."""
    m = mapping.select(F.col(source).alias(key), F.col(target).alias("_to"))
    rest = [c for c in df.columns if c != key]
    return df.join(m, key, "left").select(F.coalesce("_to", key).alias(key), *rest)


# --- groups and windows ----------------------------------------------------------------------------------------------


def attach_group(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """W-1: group aggregates beside every row, as a combined aggregate joined back (null keys stay together)."""
    keys = as_list(keys)
    stats = df.groupBy(*[F.col(k).alias("_k_" + k) for k in keys]).agg(*[c.alias(n) for n, c in aggregates.items()])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col("_k_" + k)) for k in keys])
    return df.join(stats, same, "left").drop(*["_k_" + k for k in keys])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "rank") -> DataFrame:
    """W-3: 1-based position inside each group."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*as_list(keys)).orderBy(*as_list(order))))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, out: str | None = None) -> DataFrame:
    """W-4: the first ``n`` rows of each group under a total order."""
    kept = numbered(df, keys, order, "_rn").where(F.col("_rn") <= n)
    return kept.drop("_rn") if out is None else kept.withColumnRenamed("_rn", out)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """W-7, AG-4: one row per key, first under a total order."""
    return top_n(df, keys, order, 1)


first_by = keep_first


def top_n_by_kind(
    df: DataFrame, keys: Sequence[str], kind: str, caps: Mapping[str, int], order: Sequence, out: str | None = None,
) -> DataFrame:
    """W-5: like :func:`top_n` with one cap per value of ``kind``; kinds without a cap are left out."""
    cap = F.coalesce(*[F.when(F.col(kind) == k, F.lit(n)) for k, n in caps.items()], F.lit(0))
    most = max(caps.values(), default=0)
    kept = top_n(df.where(cap > 0), as_list(keys) + [kind], order, most, "_rk").where(F.col("_rk") <= cap)
    return kept.drop("_rk") if out is None else kept.withColumnRenamed("_rk", out)


def best_and_second(df: DataFrame, keys: Sequence[str], score: str, tie: str) -> DataFrame:
    """W-2: best row per key and the runner-up's score (0 when there is none)."""
    keys = as_list(keys)
    two = top_n(df, keys, [F.col(score).desc(), F.col(tie).asc()], 2, "_rk")
    best = F.max(F.when(F.col("_rk") == 1, F.struct(*[c for c in df.columns if c not in keys])))
    second = F.coalesce(F.max(F.when(F.col("_rk") == 2, F.col(score))), F.lit(0).cast(df.schema[score].dataType))
    out = two.groupBy(*keys).agg(best.alias("_best"), second.alias("second_" + score))
    return out.select(*keys, "_best.*", "second_" + score)


def pct_rank_avg(df: DataFrame, value: str, keys: Sequence[str] = (), digits: int = 4, out: str = "pct_rank",
                 ) -> DataFrame:
    """W-6: percentile rank with average ties, ``(rank + (ties - 1) / 2) / n``.

    The value is rounded first; ranks are taken over the histogram of rounded values, whose size is bounded by the
    rounding and not by the rows (a cosine with 4 digits has at most 20,001 values).
    """
    keys = as_list(keys)
    rounded = df.withColumn(value, F.round(value, digits))
    hist = rounded.groupBy(*keys, value).agg(F.count("*").alias("_ties"))
    below = W.partitionBy(*keys).orderBy(value)
    whole = W.partitionBy(*keys)
    ranked = hist.select(
        *keys, value,
        ((F.sum("_ties").over(below) - F.col("_ties") + (F.col("_ties") + 1) / 2) / F.sum("_ties").over(whole))
        .alias(out),
    )
    return rounded.join(ranked, [*keys, value])


def position_of(df: DataFrame, order: Sequence, key: str, value, out: str = "position") -> DataFrame:
    """W-8: position of one row in a ranking, by counting the rows before it (no global sort)."""
    cols = as_list(order)
    target = df.where(F.col(key) == value).select(F.struct(*cols).alias("_o"))
    ahead = df.where(F.struct(*cols) < target.scalar()).agg((F.count("*") + 1).alias(out))
    return with_totals(df.where(F.col(key) == value), ahead)


def modal(df: DataFrame, keys: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """AG-9, IN-9: most frequent value per key; the lowest value wins a tie."""
    keys = as_list(keys)
    counts = df.groupBy(*keys, value).agg(F.count("*").alias(count))
    return top_n(counts, keys, [F.col(count).desc(), F.col(value).asc()], 1)


def modal_distinct(df: DataFrame, keys: Sequence[str], value: str, counted: str, count: str = "n") -> DataFrame:
    """AG-9 on distinct ``counted`` values."""
    keys = as_list(keys)
    counts = df.groupBy(*keys, value).agg(F.countDistinct(counted).alias(count))
    return top_n(counts, keys, [F.col(count).desc(), F.col(value).asc()], 1)


# --- aggregates ------------------------------------------------------------------------------------------------------


def count_where(condition: Column, col: Column | str | None = None) -> Column:
    """AG-3: conditional count, or conditional distinct count of ``col``."""
    if col is None:
        return F.count_if(condition)
    return F.countDistinct(F.when(condition, F.col(col) if isinstance(col, str) else col))


def avg_where(condition: Column) -> Column:
    """AG-18: share of rows meeting a condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def join_sorted(col, sep: str = ";") -> Column:
    """AG-5: sorted distinct values joined; for value sets bounded by a dictionary."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def join_ordered(col, pos, sep: str = "; ") -> Column:
    """AG-6: distinct values in order of first position joined."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(col).alias("v"))))
    return F.array_join(F.array_distinct(F.transform(pairs, lambda x: x["v"])), sep)


def cut_points(df: DataFrame, keys: Sequence[str], col: str, qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """AG-10: exact quantiles with linear interpolation per group.

    ``percentile`` keeps value counts, so its buffer is bounded by the rounding of ``col``.
    """
    keys = as_list(keys)
    q = df.groupBy(*keys).agg(F.percentile(col, F.array(*[F.lit(float(x)) for x in qs])).alias("_q"))
    return q.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def shares(df: DataFrame, keys: Sequence[str], within: Sequence[str], count: str = "n", out: str = "pct") -> DataFrame:
    """AG-11: rows per key and their percentage within a coarser key."""
    keys, within = as_list(keys), as_list(within)
    counts = df.groupBy(*keys).agg(F.count("*").alias(count))
    if within:
        totals = counts.groupBy(*within).agg(F.sum(count).alias("_total"))
        joined = counts.join(totals, within)
    else:
        joined = with_totals(counts, counts.agg(F.sum(count).alias("_total")))
    return joined.withColumn(out, 100.0 * F.col(count) / F.col("_total")).drop("_total")


def pivot_fill(df: DataFrame, rows: Sequence[str], col: str, values: Sequence, aggregate: Column) -> DataFrame:
    """AG-12: pivot over stated values, so every column exists; empty cells are 0."""
    values = list(values)
    wide = df.groupBy(*as_list(rows)).pivot(col, values).agg(aggregate)
    return wide.na.fill(0, [str(v) for v in values])


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """AG-13."""
    return df.unpivot(as_list(ids), list(values), name, value)


def mean_vector(df: DataFrame, keys: Sequence[str], vec: str, out: str | None = None) -> DataFrame:
    """AG-16: element-wise mean of the vectors of a group, summed on the map side."""
    dense = df.select(*as_list(keys), array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    means = dense.groupBy(*as_list(keys)).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return means.select(*as_list(keys), vector_to_array("_m").alias(out or vec))


def pair_stats(df: DataFrame, window: Column, a: str, b: str, doc: str) -> DataFrame:
    """AG-17: documents, distinct pairs and distinct endpoints per window.

    Each count removes duplicates with its own combined aggregate, so no window value gathers all its rows in a task.
    """
    base = df.select(window.alias("window"), a, b, doc)
    docs = base.select("window", doc).distinct().groupBy("window").agg(F.count("*").alias("docs"))
    pairs = base.select("window", a, b).distinct().groupBy("window").agg(F.count("*").alias("pairs"))
    nodes = (
        base.select("window", F.explode(F.array(a, b)).alias("node")).distinct()
        .groupBy("window").agg(F.count("*").alias("nodes"))
    )
    return docs.join(pairs, "window").join(nodes, "window")


# --- sorts, samples, sets --------------------------------------------------------------------------------------------


def hash_order(key, seed: int) -> Column:
    """A reproducible random order: MD5 of key and seed."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string") if isinstance(key, str) else key, F.lit(str(seed))))


def stratified_sample(df: DataFrame, strata: Sequence[str], key: str, n: int, seed: int = 42) -> DataFrame:
    """SL-4: ``n`` rows per stratum in hash order."""
    return top_n(df, strata, [hash_order(key, seed), F.col(key)], n)


def balanced_sample(df: DataFrame, kind: str, key: str, full: Sequence[str], big: str, cap: int, seed: int = 42,
                    ) -> DataFrame:
    """SL-5: all rows of the small kinds and a capped hash sample of the big one."""
    part = df.where(F.col(kind) == big).orderBy(hash_order(key, seed), key).limit(cap)
    return df.where(F.col(kind).isin(list(full))).unionByName(part)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """SO-1: rows of several tables, missing columns null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), dfs)


def union_priority(dfs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """SO-5: union in which the earlier source wins a key."""
    parts = [df.withColumn("_priority", F.lit(i)) for i, df in enumerate(dfs)]
    return keep_first(union_by_name(*parts), keys, ["_priority"]).drop("_priority")


def overlap(a: Column, b: Column) -> Column:
    """SO-4: overlap coefficient of two arrays; an empty side overlaps fully."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / smaller)


def densify(df: DataFrame, year: str, start: int, value: str, end: int | None = None) -> DataFrame:
    """IN-30: one row per year from ``start`` to the last year present (or ``end``), missing years 0."""
    last = F.lit(end) if end is not None else F.max(year)
    bounds = df.agg(last.cast("int").alias("_last"))
    years = bounds.select(F.explode(F.sequence(F.lit(start), F.greatest(F.col("_last"), F.lit(start)))).alias(year))
    return years.join(df, year, "left").na.fill(0, [value])


def global_numbered(df: DataFrame, order: Sequence, out: str = "position") -> DataFrame:
    """W-3 over the whole table: 1-based position under a total order, from a range-partitioned sort.

    The sorted rows are materialised with their partition and place in it; the offsets are one row per partition.
    """
    placed = cut_lineage(
        df.orderBy(*as_list(order)).select(
            "*", F.spark_partition_id().alias("_pid"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
        )
    )
    sizes = placed.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return placed.join(offsets, "_pid").select(*df.columns, (F.col("_off") + F.col("_at") + 1).alias(out))
