"""Intervals, lags, affiliations and trends on driver columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query, r6, s6
from foliograph.operators import timelines as tl

# stretches of days: an order is open from its date on, for a time that varies, for some without an end or without a start
SPANS_SQL = """
p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) END AS lo,
             CASE WHEN o_orderkey % 7 <> 0 THEN date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) + (o_orderkey % 13) * (o_orderkey % 17) END AS hi FROM orders),
q AS (SELECT o_custkey, l_orderkey AS line_order, l_linenumber, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS ship,
             date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) + l_linenumber * 3 AS ship_to FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def _day(c: str):
    return F.datediff(F.col(c).cast("date"), F.lit("1990-01-01").cast("date"))


def _spans(t: Tables):
    k, day = F.col("o_orderkey"), _day("o_orderdate")
    return t.orders.select("o_custkey", "o_orderkey", F.when(k % 11 != 0, day).alias("lo"), F.when(k % 7 != 0, day + (k % 13) * (k % 17)).alias("hi"))


@query("interval_overlaps", f"""
WITH {SPANS_SQL}
SELECT p.o_custkey, o_orderkey, line_order, l_linenumber FROM p JOIN q ON p.o_custkey = q.o_custkey
 AND coalesce(lo, -1000000) <= ship_to AND ship <= coalesce(hi, 1000000) AND coalesce(lo, -1000000) <= coalesce(hi, 1000000)
""")
def interval_overlaps(t: Tables):
    """Open orders of a customer and the deliveries that fall into them."""
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", F.col("l_orderkey").alias("line_order"), "l_linenumber", _day("l_shipdate").alias("ship"),
        (_day("l_shipdate") + F.col("l_linenumber") * 3).alias("ship_to"))
    out = tl.interval_join(_spans(t), lines, ["o_custkey"], ("lo", "hi"), ("ship", "ship_to"))
    return out.select("o_custkey", "o_orderkey", "line_order", "l_linenumber")


EVIDENCE_SQL = """
ev AS (SELECT DISTINCT o_custkey AS person_id, s_nationkey AS unit_id, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS doc_uid
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey),
reg AS (SELECT c_custkey AS person_id, c_nationkey AS unit_id FROM customer WHERE c_custkey % 3 > 0),
n AS (SELECT person_id, unit_id, year, count(*) AS n FROM ev GROUP BY ALL),
w AS (SELECT person_id, y, unit_id, sum(n) AS n, max(year) AS seen FROM (SELECT *, unnest([year - 1, year, year + 1]) AS y FROM n) GROUP BY ALL),
b AS (SELECT person_id, y AS year, unit_id FROM w QUALIFY row_number() OVER (PARTITION BY person_id, y ORDER BY n DESC, seen DESC, unit_id) = 1),
sp AS (SELECT person_id, min(year) AS f, max(year) AS l FROM n GROUP BY 1),
yr AS (SELECT person_id, CAST(unnest(generate_series(f, l)) AS INTEGER) AS year FROM sp),
k AS (SELECT yr.person_id, yr.year, coalesce(b.unit_id, reg.unit_id) AS unit_id, CASE WHEN b.unit_id IS NULL THEN 'cadastro' ELSE 'inferida' END AS source
      FROM yr LEFT JOIN b USING (person_id, year) LEFT JOIN reg USING (person_id) WHERE coalesce(b.unit_id, reg.unit_id) IS NOT NULL),
g AS (SELECT *, year - row_number() OVER (PARTITION BY person_id, unit_id, source ORDER BY year) AS run FROM k),
periods AS (SELECT person_id, min(year) AS first, max(year) AS last, unit_id, source FROM g GROUP BY person_id, unit_id, source, run
            UNION ALL SELECT reg.person_id, NULL, f - 1, unit_id, 'cadastro' FROM reg LEFT JOIN sp USING (person_id)
            UNION ALL SELECT person_id, l + 1, NULL, unit_id, 'cadastro' FROM reg JOIN sp USING (person_id))
"""


def _evidence(t: Tables):
    lines = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("l_orderkey").alias("doc_uid"), F.col("s_nationkey").alias("unit_id"))
    docs = t.orders.select(F.col("o_orderkey").alias("doc_uid"), F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("year"))
    return docs.join(lines, "doc_uid").select("person_id", "unit_id", "year", "doc_uid")


def _periods(t: Tables):
    registered = t.customer.where(F.col("c_custkey") % 3 > 0).select(F.col("c_custkey").alias("person_id"), F.col("c_nationkey").alias("unit_id"))
    return tl.unit_periods(_evidence(t), registered)


@query("unit_periods", f"WITH {EVIDENCE_SQL} SELECT person_id, first, last, unit_id, source FROM periods")
def unit_periods(t: Tables):
    """Affiliations by the unit most seen in three years."""
    return _periods(t)


@query("units_at_ship_year", f"""
WITH {EVIDENCE_SQL}
SELECT doc_uid, line, s.person_id, s.year, unit_id, source FROM (
  SELECT l_orderkey AS doc_uid, l_linenumber AS line, o_custkey AS person_id, CAST(year(l_shipdate) + l_linenumber - 3 AS INTEGER) AS year FROM lineitem JOIN orders ON o_orderkey = l_orderkey) s
JOIN periods p ON p.person_id = s.person_id AND s.year BETWEEN coalesce(first, -9999) AND coalesce(last, 9999)
""")
def units_at_ship_year(t: Tables):
    """The unit of a person at the time of each of their lines, also before and after their documents."""
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("l_orderkey").alias("doc_uid"), F.col("l_linenumber").alias("line"), F.col("o_custkey").alias("person_id"),
        (F.year("l_shipdate") + F.col("l_linenumber") - 3).cast("int").alias("year"))
    return tl.units_at(rows, _periods(t), "year")


@query("active_candidates", """
WITH y AS (SELECT DISTINCT o_custkey AS person_id, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderkey % 4 = 0),
m AS (SELECT *, coalesce(year - lag(year) OVER (PARTITION BY person_id ORDER BY year) > 1, true)::INT AS new FROM y),
s AS (SELECT person_id, min(year) AS f, max(year) AS l FROM (SELECT *, sum(new) OVER (PARTITION BY person_id ORDER BY year) AS k FROM m) GROUP BY person_id, k)
SELECT o_orderkey AS doc_uid, o_custkey AS person_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       EXISTS (SELECT 1 FROM s WHERE s.person_id = o_custkey AND year(o_orderdate) BETWEEN f - 1 AND l + 1) AS active FROM orders
""")
def active_candidates(t: Tables):
    """Whether a document's year lies in or beside a stretch of its person's activity, known from a quarter of the documents."""
    docs = t.orders.select(F.col("o_orderkey").alias("doc_uid"), F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("year"))
    spans = tl.activity_spans(docs.where(F.col("doc_uid") % 4 == 0), pause=1)
    return tl.active_candidates(docs, spans, "year", slack=1).select("doc_uid", "person_id", "year", "active")


LAG_SQL = """
d AS (SELECT o_orderkey AS key, o_orderpriority AS theme, o_orderstatus AS stage, CAST(o_orderdate AS DATE) AS d FROM orders),
e AS (SELECT theme, stage, d, max(key) AS after FROM d GROUP BY ALL),
lags AS (SELECT x.theme, x.key, x.stage, e.after, date_diff('day', e.d, x.d) AS lag
         FROM (SELECT *, CASE stage WHEN 'O' THEN 'P' ELSE 'O' END AS prior FROM d WHERE stage <> 'P') x
         ASOF LEFT JOIN e ON e.theme = x.theme AND e.stage = x.prior AND e.d <= x.d)
"""


def _lags(t: Tables):
    docs = t.orders.withColumn("d", F.col("o_orderdate").cast("date"))
    return tl.stage_lags(docs, "o_orderpriority", "o_orderstatus", "d", "o_orderkey", ["P", "O", "F"])


@query("stage_lags", f"WITH {LAG_SQL} SELECT theme, key, stage, after, lag FROM lags")
def stage_lags(t: Tables):
    """From project to publication to technology: the last document of the stage before in the same theme."""
    return _lags(t)


@query("stage_lag_medians", f"WITH {LAG_SQL} SELECT theme, stage, median(lag) AS median, count(lag) AS n FROM lags GROUP BY ALL")
def stage_lag_medians(t: Tables):
    return tl.group_median(_lags(t), ["theme", "stage"], "lag")


@query("share_trends", f"""
WITH c AS (SELECT p_type AS theme, year(o_orderdate) * 12 + month(o_orderdate) AS year, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL),
y AS (SELECT year, sum(n) AS total FROM c GROUP BY 1),
s AS (SELECT t.theme, y.year, coalesce(n, 0) / total AS v FROM (SELECT DISTINCT theme FROM c) t CROSS JOIN y LEFT JOIN c ON c.theme = t.theme AND c.year = y.year),
p AS (SELECT a.theme, sum(sign(b.v - a.v)) AS s, median((b.v - a.v) / (b.year - a.year)) AS slope FROM s a JOIN s b ON a.theme = b.theme AND a.year < b.year GROUP BY 1),
v AS (SELECT theme, count(*) AS n, (count(*) * (count(*) - 1) * (2 * count(*) + 5) - (SELECT sum(k * (k - 1) * (2 * k + 5)) FROM (SELECT count(*) AS k FROM s x WHERE x.theme = s.theme GROUP BY x.v))) / 18 AS variance
      FROM s GROUP BY theme),
z AS (SELECT theme, n, s, variance, CASE WHEN variance > 0 THEN (s - sign(s)) / sqrt(variance) ELSE 0 END AS z, slope FROM p JOIN v USING (theme))
SELECT theme, CAST(n AS INTEGER) AS n, CAST(s AS BIGINT) AS s, {s6('variance')} AS variance, {s6('z')} AS z, CASE WHEN z > 1.96 THEN 1 WHEN z < -1.96 THEN -1 ELSE 0 END AS direction, round(slope, 9) AS slope FROM z
""")
def share_trends(t: Tables):
    """Mann-Kendall test of the monthly shares of part types."""
    docs = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "p_type", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month"))
    out = tl.share_trends(docs, "p_type", "month")
    return out.select("theme", "n", "s", r6(F.col("variance")).alias("variance"), r6(F.col("z")).alias("z"), "direction", F.round("slope", 9).alias("slope"))
