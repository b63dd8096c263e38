"""Plan shapes: joins, aggregates, windows, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query, r6, s6
from foliograph.functions import text as tx
from foliograph.plans import shapes as sh


@query("block_pairs", """
SELECT a.l_orderkey, a.l_partkey AS part1, b.l_partkey AS part2, a.l_quantity AS quantity1, b.l_quantity AS quantity2
FROM (SELECT l_orderkey, l_partkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) a
JOIN (SELECT l_orderkey, l_partkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) b
  ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
WHERE a.l_quantity = b.l_quantity OR a.l_quantity >= 49 OR b.l_quantity >= 49
""")
def block_pairs(t: Tables):
    """J-5, J-7: pairs inside a block under a disjunctive residual."""
    rows = t.lineitem.groupBy("l_orderkey", F.col("l_partkey").alias("part")).agg(F.min("l_quantity").alias("quantity"))
    return sh.block_pairs(
        rows, ["l_orderkey"], "part", ["quantity"],
        residual=lambda: (F.col("quantity1") == F.col("quantity2")) | (F.col("quantity1") >= 49) | (F.col("quantity2") >= 49))


@query("co_pairs", """
WITH m AS (SELECT DISTINCT o_custkey, o_orderpriority AS item FROM orders)
SELECT a.item, b.item AS other, count(*) AS n FROM m a JOIN m b ON a.o_custkey = b.o_custkey AND a.item <> b.item
GROUP BY ALL
""")
def co_pairs(t: Tables):
    rows = t.orders.select("o_custkey", F.col("o_orderpriority").alias("item"))
    return sh.co_pairs(rows, "o_custkey", "item", "other").groupBy("item", "other").agg(F.count("*").alias("n"))


@query("semi_and_anti", """
SELECT 'with' AS side, c_custkey AS key FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL
SELECT 'without', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL
SELECT 'listed', o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL
SELECT 'in long list', o_orderkey FROM orders WHERE o_custkey % 3 = 0
""")
def semi_and_anti(t: Tables):
    """J-2, J-3, J-14, PF-4: rows of each side; the long list goes through a join."""
    known = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    rows = lambda df, side, key: df.select(F.lit(side).alias("side"), F.col(key).alias("key"))
    third = t.customer.where(F.col("c_custkey") % 3 == 0)
    return sh.union_by_name(
        rows(sh.keep_matching(t.customer, known, "c_custkey"), "with", "c_custkey"),
        rows(sh.drop_matching(t.customer, known, "c_custkey"), "without", "c_custkey"),
        rows(sh.keep_listed(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]), "listed", "o_orderkey"),
        rows(sh.keep_listed(t.orders, "o_custkey", third.select("c_custkey")), "in long list", "o_orderkey"))


@query("share_of_total", f"""
WITH tot AS (SELECT count(*) AS total, sum(o_totalprice) AS value FROM orders)
SELECT o_orderpriority, count(*) AS n, any_value(total) AS total, {s6("100.0 * count(*) / any_value(total)")} AS pct
FROM orders, tot GROUP BY 1
""")
def share_of_total(t: Tables):
    """J-9, AG-11: shares against a one-row total."""
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    both = sh.with_totals(counts, t.orders.agg(F.count("*").alias("total"), F.sum("o_totalprice").alias("value")))
    return both.select("o_orderpriority", "n", "total", r6(100.0 * F.col("n") / F.col("total")).alias("pct"))


@query("row_shares", f"""
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderstatus, o_orderpriority, n, {s6("100.0 * n / (sum(n) OVER (PARTITION BY o_orderstatus))")} AS pct FROM c
""")
def row_shares(t: Tables):
    return sh.shares(t.orders, ["o_orderstatus", "o_orderpriority"], ["o_orderstatus"]).withColumn("pct", r6(F.col("pct")))


@query("group_totals_beside_rows", """
SELECT l_orderkey, l_linenumber, count(*) OVER w AS n, min(l_suppkey) OVER w AS first_supplier,
       round(sum(l_quantity) OVER w, 2) AS quantity FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)
""")
def group_totals_beside_rows(t: Tables):
    """W-1."""
    return sh.attach_group(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"), ["l_orderkey"],
        n=F.count("*"), first_supplier=F.min("l_suppkey"), quantity=F.round(F.sum("l_quantity"), 2),
    ).select("l_orderkey", "l_linenumber", "n", "first_supplier", "quantity")


@query("best_and_second", """
WITH r AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS line, l_extendedprice AS score,
           row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) AS rk
           FROM lineitem)
SELECT l_suppkey, max(CASE WHEN rk = 1 THEN line END) AS line, max(CASE WHEN rk = 1 THEN score END) AS score,
       coalesce(max(CASE WHEN rk = 2 THEN score END), 0) AS second_score FROM r WHERE rk <= 2 GROUP BY 1
""")
def best_and_second(t: Tables):
    rows = t.lineitem.select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
                             F.col("l_extendedprice").alias("score"))
    return sh.best_and_second(rows, ["l_suppkey"], "score", "line")


@query("top_by_kind", """
WITH r AS (SELECT o_custkey, o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
           ORDER BY o_orderdate DESC, o_orderkey) AS rk FROM orders)
SELECT o_custkey, o_orderstatus, o_orderkey, CAST(rk AS INTEGER) AS rk FROM r
WHERE rk <= CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 ELSE 0 END
""")
def top_by_kind(t: Tables):
    """W-5."""
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate")
    return sh.top_n_by_kind(rows, ["o_custkey"], "o_orderstatus", {"F": 3, "O": 1},
                            [F.col("o_orderdate").desc(), F.col("o_orderkey")], out="rk").drop("o_orderdate")


@query("first_per_key", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1
""")
def first_per_key(t: Tables):
    """W-7, AG-4."""
    return sh.keep_first(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
                         ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("line_positions", """
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber)
       AS INTEGER) AS position FROM lineitem
""")
def line_positions(t: Tables):
    """W-3."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return sh.numbered(rows, ["l_orderkey"], [F.col("l_extendedprice").desc(), F.col("l_linenumber")], "position").drop(
        "l_extendedprice")


@query("whole_table_position", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders
""")
def whole_table_position(t: Tables):
    """W-3 without a partition."""
    return sh.global_numbered(t.orders.select("o_orderkey", "o_totalprice"),
                              [F.col("o_totalprice").desc(), F.col("o_orderkey")]).drop("o_totalprice")


@query("percentile_rank", f"""
WITH x AS (SELECT o_orderkey, o_orderstatus, round(o_totalprice / 500000, 2) AS v FROM orders),
r AS (SELECT *, rank() OVER (PARTITION BY o_orderstatus ORDER BY v) AS rk, count(*) OVER (PARTITION BY o_orderstatus, v) AS ties,
      count(*) OVER (PARTITION BY o_orderstatus) AS n FROM x)
SELECT o_orderkey, o_orderstatus, v, {s6("(rk + (ties - 1) / 2.0) / n")} AS pct_rank FROM r
""")
def percentile_rank(t: Tables):
    """W-6."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 500000).alias("v"))
    return sh.pct_rank_avg(rows, "v", ["o_orderstatus"], digits=2).withColumn("pct_rank", r6(F.col("pct_rank")))


@query("conditional_counts", f"""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
       count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS open_customers,
       {s6("avg(CASE WHEN o_totalprice > 200000 THEN 1.0::DOUBLE ELSE 0 END)")} AS large_share,
       bool_or(o_totalprice > 400000) AS any_large, max(o_totalprice) AS largest FROM orders GROUP BY 1 HAVING count(*) > 10
""")
def conditional_counts(t: Tables):
    """AG-1, AG-3, AG-14, AG-15, AG-18."""
    return t.orders.groupBy("o_orderpriority").agg(
        sh.count_where(F.col("o_orderstatus") == "F").alias("finished"),
        sh.count_where(F.col("o_orderstatus") == "O", "o_custkey").alias("open_customers"),
        r6(sh.avg_where(F.col("o_totalprice") > 200000)).alias("large_share"),
        F.bool_or(F.col("o_totalprice") > 400000).alias("any_large"), F.max("o_totalprice").alias("largest"),
        F.count("*").alias("_n"),
    ).where(F.col("_n") > 10).drop("_n")


@query("joined_lists", """
WITH x AS (SELECT l_orderkey, p_type, count(*) AS n, min(l_linenumber * 1000000 + l_partkey) AS pos
           FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, p_type) AS rn FROM x)
SELECT l_orderkey, string_agg(p_type, ';' ORDER BY p_type) AS types, string_agg(p_type, '; ' ORDER BY pos) AS ordered,
       max(CASE WHEN rn = 1 THEN p_type END) AS mode_type FROM m GROUP BY l_orderkey
""")
def joined_lists(t: Tables):
    """AG-5, AG-6, AG-7, AG-8."""
    typed = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "pos", F.col("l_linenumber") * 1000000 + F.col("l_partkey"))
    return typed.groupBy("l_orderkey").agg(
        sh.join_sorted("p_type").alias("types"), sh.join_ordered("p_type", "pos").alias("ordered"),
        F.mode("p_type", True).alias("mode_type"))


@query("modal_value", """
WITH c AS (SELECT l_suppkey, p_brand, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT l_suppkey, p_brand, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_brand) AS rn FROM c)
WHERE rn = 1
""")
def modal_value(t: Tables):
    """AG-9."""
    return sh.modal(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["l_suppkey"], "p_brand")


@query("tercile_limits", f"""
SELECT o_orderpriority, {s6("quantile_cont(v, 1.0 / 3)")} AS low, {s6("quantile_cont(v, 2.0 / 3)")} AS high
FROM (SELECT o_orderpriority, round(o_totalprice / 1000, 1) AS v FROM orders) GROUP BY 1
""")
def tercile_limits(t: Tables):
    """AG-10."""
    rows = t.orders.select("o_orderpriority", F.round(F.col("o_totalprice") / 1000, 1).alias("v"))
    return sh.cut_points(rows, ["o_orderpriority"], "v", [1 / 3, 2 / 3], ["low", "high"]).select(
        "o_orderpriority", r6(F.col("low")).alias("low"), r6(F.col("high")).alias("high"))


@query("pivot_with_zeros", """
SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
       count(*) FILTER (WHERE o_orderstatus = 'X') AS X FROM orders GROUP BY 1
""")
def pivot_with_zeros(t: Tables):
    """AG-12: a stated column exists even without rows."""
    return sh.pivot_fill(t.orders, ["o_custkey"], "o_orderstatus", ["F", "O", "X"], F.count(F.lit(1)))


@query("melted", """
SELECT s_suppkey, 'nation' AS name, CAST(s_nationkey AS DOUBLE) AS value FROM supplier
UNION ALL SELECT s_suppkey, 'balance', s_acctbal FROM supplier
""")
def melted(t: Tables):
    """AG-13."""
    wide = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"),
                             F.col("s_acctbal").alias("balance"))
    return sh.unpivot(wide, ["s_suppkey"], ["nation", "balance"], "name", "value")


@query("audit_sample", """
WITH r AS (SELECT o_orderpriority, o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
           ORDER BY md5(o_orderkey || '|42'), o_orderkey) AS rn FROM orders)
SELECT o_orderpriority, o_orderstatus, o_orderkey FROM r WHERE rn <= 20
""")
def audit_sample(t: Tables):
    """SL-4: a seeded sample per stratum."""
    return sh.stratified_sample(t.orders.select("o_orderpriority", "o_orderstatus", "o_orderkey"),
                                ["o_orderpriority", "o_orderstatus"], "o_orderkey", 20)


@query("balanced_sample", """
SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'de')
UNION ALL (SELECT doc_id, lang FROM documents WHERE lang = 'en' ORDER BY md5(doc_id || '|7'), doc_id LIMIT 100)
""")
def balanced_sample(t: Tables):
    """SL-5."""
    return sh.balanced_sample(t.documents.select("doc_id", "lang"), "lang", "doc_id", ["fr", "de"], "en", 100, seed=7)


@query("set_operations", """
SELECT o_custkey AS k, 'order' AS source, o_orderstatus AS status, NULL AS segment FROM orders WHERE o_custkey NOT IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
UNION ALL SELECT c_custkey, 'customer', NULL, c_mktsegment FROM customer
""")
def set_operations(t: Tables):
    """SO-1, SO-3."""
    skip = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("k"))
    placed = t.orders.select(F.col("o_custkey").alias("k"), F.lit("order").alias("source"),
                             F.col("o_orderstatus").alias("status"))
    return sh.union_by_name(
        sh.key_difference(placed, skip, "k"),
        t.customer.select(F.col("c_custkey").alias("k"), F.lit("customer").alias("source"),
                          F.col("c_mktsegment").alias("segment")))


@query("source_priority", """
WITH u AS (SELECT DISTINCT o_custkey AS k, 0 AS p, 'cited' AS source FROM orders WHERE o_orderstatus = 'P'
           UNION ALL SELECT c_custkey, 1, 'seat' FROM customer)
SELECT k, arg_min(source, p) AS source FROM u GROUP BY k
""")
def source_priority(t: Tables):
    """SO-5, SO-2."""
    cited = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("k")).distinct()
    return sh.union_priority([cited.withColumn("source", F.lit("cited")),
                              t.customer.select(F.col("c_custkey").alias("k"), F.lit("seat").alias("source"))], ["k"])


@query("word_overlap", f"""
WITH d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(strip_accents(split_part(text, chr(10), 1))), '[a-z]+')) AS a,
           list_distinct(regexp_extract_all(lower(strip_accents(substr(text, length(split_part(text, chr(10), 1)) + 1))), '[a-z]+')) AS b FROM documents)
SELECT doc_id, {s6("CASE WHEN least(len(a), len(b)) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / least(len(a), len(b))::DOUBLE END")} AS overlap FROM d
""")
def word_overlap(t: Tables):
    """SO-4 between the first line of a document and the rest."""
    def words(c):
        return F.array_distinct(F.regexp_extract_all(tx.fold(c), F.lit("[a-z]+"), F.lit(0)))

    first = F.substring_index("text", "\n", 1)
    both = t.texts.select("doc_id", words(first).alias("a"), words(F.substr("text", F.length(first) + 1)).alias("b"))
    return both.select("doc_id", r6(sh.overlap(F.col("a"), F.col("b"))).alias("overlap"))


@query("densified_series", """
SELECT CAST(y.y AS INTEGER) AS year, coalesce(n, 0) AS n
FROM range(1990, (SELECT max(year(o_orderdate)) + 1 FROM orders)) AS y(y)
LEFT JOIN (SELECT year(o_orderdate) AS yr, count(*) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY 1) s ON s.yr = y.y
""")
def densified_series(t: Tables):
    """IN-30."""
    series = t.orders.where(F.col("o_totalprice") > 400000).groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n"))
    return sh.densify(series, "year", 1990, "n")
