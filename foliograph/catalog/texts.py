"""Text keys, names, signatures and small scalar functions.

The driver tables have numbered people only, so full names are built from the key by one expression, written once for
Spark and once for SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.catalog.registry import Tables, query, r6, s6
from foliograph.functions import scalars as sc
from foliograph.functions import text as tx
from foliograph.plans import shapes as sh

GIVEN = ["Ana", "João", "María", "Pedro", "Inês", "Luís", "Rosa", "Otávio", "Júlia", "Caio", "Márcia"]
MIDDLE = ["Alves", "de Souza", "Conceição", "da Costa", "A.", "dos Santos", "Müller"]
LAST = ["Silva", "Pereira", "Gonçalves", "Ramos Junior", "Araújo", "Lima Filho", "Sosa-Gomes", "Núñez", "Netto", "Strauß",
        "da Rocha", "Teixeira", "Barros", "Dias JR"]


def pick_sql(values: list[str], index: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST(1 + ({index}) % {len(values)} AS BIGINT))"


def pick(values: list[str], index):
    return F.array(*[F.lit(v) for v in values])[(index % len(values)).cast("int")]


def full_name(key):
    """A name with one given, one middle and one family part, from an integer key."""
    k = F.col(key)
    return F.concat_ws(" ", pick(GIVEN, k), pick(MIDDLE, F.floor(k / 11)), pick(LAST, F.floor(k / 7)))


def full_name_sql(key: str) -> str:
    return (f"{pick_sql(GIVEN, key)} || ' ' || {pick_sql(MIDDLE, f'{key} // 11')} || ' ' || "
            f"{pick_sql(LAST, f'{key} // 7')}")


# --- SQL counterparts of the text keys ---

def latin_sql(x: str) -> str:
    return f"replace(strip_accents({x}), 'ß', 'ss')"


def squish_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def name_key_sql(x: str) -> str:
    return squish_sql(f"regexp_replace(upper({latin_sql(x)}), '[^A-Z ]', ' ', 'g')")


def title_key_sql(x: str) -> str:
    return squish_sql(f"regexp_replace(lower({latin_sql(x)}), '[^a-z0-9 ]', ' ', 'g')")


PARTICLES_SQL = "[" + ", ".join(repr(p) for p in tx.NAME_PARTICLES) + "]"
SIGN_SQL = "[" + ", ".join(repr(p) for p in tx.SIGNATURE_PARTICLES) + "]"


def name_tokens_sql(x: str) -> str:
    return (f"list_transform(list_filter(string_split({name_key_sql(x)}, ' '), lambda t: t <> '' AND NOT "
            f"list_contains({PARTICLES_SQL}, t)), lambda t: CASE t WHEN 'JR' THEN 'JUNIOR' WHEN 'FO' THEN 'FILHO' "
            f"WHEN 'NETTO' THEN 'NETO' ELSE t END)")


def initials_sql(tokens: str) -> str:
    return f"array_to_string(list_transform({tokens}, lambda t: substr(t, 1, 1)), '')"


def parse_sql(x: str) -> tuple[str, str]:
    """Surname and initials of a signature."""
    surname = name_key_sql(f"regexp_replace({squish_sql(x)}, ',.*$', '')")
    rest = f"CASE WHEN contains({x}, ',') THEN {latin_sql(f'''regexp_replace({squish_sql(x)}, '^[^,]*,', '')''')} ELSE '' END"
    tokens = (f"list_filter(regexp_split_to_array({rest}, '[\\s.\\-]+'), lambda t: regexp_matches(t, '^[A-Z]') "
              f"AND NOT list_contains({SIGN_SQL}, upper(t)))")
    return surname, initials_sql(tokens)


def derived_sql(tokens: str) -> tuple[str, str]:
    """Surname and initials a full name would give; ``tokens`` is a column name."""
    k = (f"(CASE WHEN len({tokens}) >= 3 AND {tokens}[-1] IN ('JUNIOR', 'FILHO', 'NETO', 'SOBRINHO') THEN 2 ELSE 1 END)")
    surname = f"CASE WHEN len({tokens}) > 0 THEN array_to_string({tokens}[greatest(len({tokens}) - {k} + 1, 1):], ' ') END"
    initials = f"CASE WHEN len({tokens}) > 0 THEN {initials_sql(f'{tokens}[:greatest(len({tokens}) - {k}, 0)]')} END"
    return surname, initials


@query("text_keys", f"""
SELECT doc_id, md5({squish_sql('text')}) AS squished, md5({title_key_sql('text')}) AS title_key,
       md5({name_key_sql('text')}) AS name_key, md5(strip_accents(lower(text))) AS folded,
       md5(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')) AS ascii_folded,
       md5(trim(replace(lower(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), '-', ' '))) AS hyphen_folded,
       CAST(len(list_filter(string_split({title_key_sql('text')}, ' '), lambda w: w <> '')) AS INTEGER) AS words
FROM documents
""")
def text_keys(t: Tables):
    x = F.col("text")
    return t.texts.select(
        "doc_id", F.md5(tx.squish(x)).alias("squished"), F.md5(tx.title_key(x)).alias("title_key"),
        F.md5(tx.name_key(x)).alias("name_key"), F.md5(tx.fold(x, "marks")).alias("folded"),
        F.md5(tx.fold(x, "ascii")).alias("ascii_folded"), F.md5(tx.fold(x, "hyphen")).alias("hyphen_folded"),
        tx.word_count(tx.title_key(x)).alias("words"))


@query("fold_exact", "SELECT doc_id, md5(strip_accents(lower(text))) AS folded FROM documents")
def fold_exact(t: Tables):
    return t.texts.select("doc_id", F.md5(tx.fold_exact("text")).alias("folded"))


_TOK = name_tokens_sql("name")
_DS, _DI = derived_sql("toks")


@query("signature_derived", f"""
WITH n AS (SELECT c_custkey, {full_name_sql('c_custkey')} AS name FROM customer), x AS (SELECT *, {_TOK} AS toks FROM n)
SELECT c_custkey, name, {name_key_sql('name')} AS name_key, array_to_string(toks, '|') AS tokens,
       {_DS} AS surname, {_DI} AS initials FROM x
""")
def signature_derived(t: Tables):
    named = t.customer.select("c_custkey", full_name("c_custkey").alias("name"))
    sign = tx.signature_of(F.col("name"))
    return named.select(
        "c_custkey", "name", tx.name_key(F.col("name")).alias("name_key"),
        F.array_join(tx.name_tokens(F.col("name")), "|").alias("tokens"),
        sign["surname"].alias("surname"), sign["initials"].alias("initials"))


# signatures with particles, points, hyphens and missing commas, from the line keys
def signature(k, line):
    base = pick([s.upper() for s in LAST], k)
    first = F.substring(pick(GIVEN, F.floor(k / 3)), 1, 1)
    second = F.substring(pick(GIVEN, F.floor(k / 5)), 1, 1)
    form = line % 5
    return (F.when(form == 0, F.concat(base, F.lit(", "), first, F.lit(". "), second, F.lit(". de  H.")))
            .when(form == 1, F.concat(base, F.lit(", "), first, F.lit(". DOS")))
            .when(form == 2, F.concat(base, F.lit(" ,"), first, F.lit(".-"), second, F.lit(".")))
            .when(form == 3, base)
            .otherwise(F.concat(base, F.lit(", "), first, F.lit("."))))


def signature_sql(k: str, line: str) -> str:
    base = pick_sql([s.upper() for s in LAST], k)
    first = f"substr({pick_sql(GIVEN, f'{k} // 3')}, 1, 1)"
    second = f"substr({pick_sql(GIVEN, f'{k} // 5')}, 1, 1)"
    return (f"CASE {line} % 5 WHEN 0 THEN {base} || ', ' || {first} || '. ' || {second} || '. de  H.' "
            f"WHEN 1 THEN {base} || ', ' || {first} || '. DOS' WHEN 2 THEN {base} || ' ,' || {first} || '.-' || "
            f"{second} || '.' WHEN 3 THEN {base} ELSE {base} || ', ' || {first} || '.' END")


_PS, _PI = parse_sql("sig")


@query("signature_parsed", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, {signature_sql('l_suppkey', 'l_linenumber')} AS sig FROM lineitem)
SELECT l_orderkey, l_linenumber, sig, {_PS} AS surname, {_PI} AS initials FROM x
""")
def signature_parsed(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber",
                             signature(F.col("l_suppkey"), F.col("l_linenumber")).alias("sig"))
    parsed = tx.parse_signature(F.col("sig"))
    return rows.select("*", parsed["surname"].alias("surname"), parsed["initials"].alias("initials"))


@query("initials_compat", f"""
WITH x AS (SELECT DISTINCT {_PI} AS a FROM (SELECT {signature_sql('l_suppkey', 'l_linenumber')} AS sig FROM lineitem)),
n AS (SELECT {full_name_sql('c_custkey')} AS name FROM customer), y AS (SELECT {_TOK} AS toks FROM n),
z AS (SELECT DISTINCT {_DI} AS b FROM y),
p AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l
      FROM x JOIN z ON substr(a, 1, 1) = substr(b, 1, 1))
SELECT a, b, CASE WHEN a = b THEN 'exata' WHEN s <> '' AND regexp_matches(l, '^' || regexp_replace(s, '(.)', '\\1.*', 'g'))
       THEN 'compativel' ELSE 'incompativel' END AS compat FROM p
""")
def initials_compat(t: Tables):
    parsed = tx.parse_signature(signature(F.col("l_suppkey"), F.col("l_linenumber")))
    a = t.lineitem.select(parsed["initials"].alias("a")).distinct().withColumn("h", F.substring("a", 1, 1))
    b = t.customer.select(tx.signature_of(full_name("c_custkey"))["initials"].alias("b")).distinct()
    b = b.withColumn("h", F.substring("b", 1, 1))
    return a.join(b, "h").select("a", "b", tx.initials_compat("a", "b").alias("compat"))


@query("display_names", f"""
WITH n AS (SELECT c_custkey, {full_name_sql('c_custkey')} AS name FROM customer)
SELECT c_custkey, array_to_string(list_transform(string_split(lower(name), ' '), lambda w:
       CASE WHEN w IN ('de', 'da', 'do', 'das', 'dos', 'e') THEN w ELSE
       array_to_string(list_transform(string_split(w, '-'), lambda p: upper(p[1]) || p[2:]), '-') END), ' ') AS shown FROM n
""")
def display_names(t: Tables):
    return t.customer.select("c_custkey", tx.display_name(F.upper(full_name("c_custkey"))).alias("shown"))


_WORDS = "regexp_extract_all(lower(text), '[a-zà-ú]+')"


@query("language_guess", f"""
SELECT doc_id, CASE WHEN len(list_filter({_WORDS}, lambda w: w IN ({', '.join(repr(w) for w in tx.ENGLISH_WORDS)}))) >
       len(list_filter({_WORDS}, lambda w: w IN ({', '.join(repr(w) for w in tx.PORTUGUESE_WORDS)})))
       THEN 'en' ELSE 'pt' END AS language FROM documents
""")
def language_guess(t: Tables):
    return t.texts.select("doc_id", tx.guess_language(F.col("text")).alias("language"))


@query("keyword_lists", f"""
WITH k AS (SELECT doc_id, unnest(a) AS kw, generate_subscripts(a, 1) AS pos
           FROM (SELECT doc_id, regexp_split_to_array(text, '[,;]') AS a FROM documents)),
x AS (SELECT doc_id, {squish_sql('kw')} AS kw, pos FROM k)
SELECT doc_id, count(*) AS n, md5(string_agg(kw, ';' ORDER BY pos)) AS joined FROM x WHERE kw <> '' GROUP BY doc_id
""")
def keyword_lists(t: Tables):
    listed = t.texts.select("doc_id", tx.split_keywords(F.col("text")).alias("kws")).where(F.size("kws") > 0)
    return listed.select("doc_id", F.size("kws").cast("bigint").alias("n"),
                         F.md5(F.array_join("kws", ";")).alias("joined"))


@query("link_extract", """
SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="/([^"]+)"', 1))) AS target FROM pages
""")
def link_extract(t: Tables):
    return t.pages.select("page_id", F.explode(tx.extract_all_distinct(F.col("html"), 'href="/([^"]+)"')).alias("target"))


@query("link_in_base", """
WITH l AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="/([^"]+)"', 1))) AS target FROM pages),
w AS (SELECT DISTINCT unnest(regexp_extract_all(url, 'http.*/([a-z]+)/[0-9]+', 1)) AS word FROM pages)
SELECT l.page_id, 'B:' || l.target AS target, 'cita_publicacao' AS kind, l.target IN (SELECT word FROM w) AS in_base FROM l
""")
def link_in_base(t: Tables):
    """SC-12 with the flag that says whether the target is a known document."""
    known = t.pages.select(F.explode(tx.extract_all_distinct(F.col("url"), "http.*/([a-z]+)/[0-9]+")).alias("target"))
    links = t.pages.select("page_id", F.explode(tx.extract_all_distinct(F.col("html"), 'href="/([^"]+)"')).alias("target"))
    known = known.distinct().withColumn("_known", F.lit(True))
    return links.join(known, "target", "left").select(
        "page_id", F.concat(F.lit("B:"), "target").alias("target"), F.lit("cita_publicacao").alias("kind"),
        sc.null_safe("_known").alias("in_base"))


@query("eligible_titles", f"""
WITH x AS (SELECT doc_id, {title_key_sql("split_part(text, chr(10), 1)")} AS k FROM documents)
SELECT doc_id, k AS title_key, len(regexp_extract_all(k, '\\S+')) >= 4 AND length(k) >= 25 AS eligible FROM x
""")
def eligible_titles(t: Tables):
    keyed = t.texts.select("doc_id", tx.title_key(F.substring_index("text", "\n", 1)).alias("title_key"))
    return keyed.withColumn("eligible", tx.eligible_title(F.col("title_key")))


@query("scalar_functions", f"""
SELECT o_orderkey, CAST(right(d, 4) AS INTEGER) AS y, CAST(left(d, 2) AS INTEGER) AS m,
       'OB:' || o_orderkey AS uid, 'T' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS theme,
       sha1('m|512|' || o_orderpriority) AS text_hash, 'PS' || substr(sha1(CAST(o_custkey AS VARCHAR)), 1, 10) AS public,
       CAST(floor(yr / 5) * 5 AS INTEGER) AS bin, CAST(floor(yr / 5) * 5 AS INTEGER) || '–' || CAST(floor(yr / 5) * 5 + 4 AS INTEGER) AS label,
       CASE WHEN v <= -1 THEN NULL WHEN v <= 0.25 THEN 'baixa' WHEN v <= 0.4 THEN 'moderada' WHEN v <= 0.6 THEN 'alta'
            WHEN v <= 1.01 THEN 'muito alta' END AS lvl,
       {s6("log2((v + 0.5) / (0.3 + 0.5))")} AS ratio, {s6("o_totalprice / greatest(o_custkey, 1)")} AS safe,
       CASE WHEN length(o_orderpriority) > 5 THEN substr(o_orderpriority, 1, 5) || '…' ELSE o_orderpriority END AS cut,
       coalesce(upper(o_orderstatus) = 'F', false) AS flag,
       CASE WHEN length(o_orderpriority) < 6 THEN NULL ELSE o_orderpriority END AS short_null,
       CASE WHEN o_orderstatus = 'O' THEN coalesce(CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE yr + 2 END, 9999) >= 2000
            ELSE yr >= 2000 END AS in_scope,
       yr BETWEEN 1996 AND 1998 AS in_period
FROM (SELECT *, strftime(o_orderdate, '%m/%Y') AS d, CAST(year(o_orderdate) AS INTEGER) AS yr,
             (o_totalprice % 1000) / 1000 AS v FROM orders)
""")
def scalar_functions(t: Tables):
    base = t.orders.select(
        "*", F.date_format("o_orderdate", "MM/yyyy").alias("d"), F.year("o_orderdate").alias("yr"),
        ((F.col("o_totalprice") % 1000) / 1000).alias("v"))
    my = sc.month_year("d")
    end = F.when(F.col("o_custkey") % 3 != 0, F.col("yr") + 2)
    return base.select(
        "o_orderkey", my["year"].alias("y"), my["month"].alias("m"), sc.format_id("OB:", "o_orderkey").alias("uid"),
        sc.format_id("T", F.col("o_custkey") % 1000, 3).alias("theme"),
        sc.text_hash("m", 512, "o_orderpriority").alias("text_hash"),
        sc.public_id(F.col("o_custkey").cast("string")).alias("public"), sc.year_bin("yr", 5).alias("bin"),
        sc.year_bin_label("yr", 5).alias("label"), sc.level("v").alias("lvl"),
        r6(sc.log_ratio("v", F.lit(0.3), 0.5)).alias("ratio"), r6(sc.safe_ratio("o_totalprice", "o_custkey")).alias("safe"),
        tx.shorten(F.col("o_orderpriority"), 5).alias("cut"), sc.flag(F.col("o_orderstatus"), "F").alias("flag"),
        tx.short_to_null(F.col("o_orderpriority"), 6).alias("short_null"),
        sc.in_scope(F.col("o_orderstatus"), F.col("yr"), end, 2000, running="O").alias("in_scope"),
        sc.in_period("yr", 1996, 1998).alias("in_period"))


@query("array_functions", """
WITH a AS (SELECT l_orderkey, list_sort(list(l_suppkey)) AS s, list_sort(list(DISTINCT l_partkey % 10)) AS p
           FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(len(s) AS INTEGER) AS n, CAST(len(list_distinct(s)) AS INTEGER) AS n_distinct,
       array_to_string(list_sort(list_distinct(s))[:3], ';') AS head, list_has_all(p, [1, 2]) AS includes
FROM a
""")
def array_functions(t: Tables):
    arrays = t.lineitem.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("l_suppkey")).alias("s"), F.collect_set(F.col("l_partkey") % 10).alias("p"))
    return arrays.select(
        "l_orderkey", F.size("s").alias("n"), F.size(F.array_distinct("s")).alias("n_distinct"),
        F.array_join(F.slice(F.array_distinct("s"), 1, 3), ";").alias("head"),
        F.forall(F.array(F.lit(1), F.lit(2)), lambda x: F.array_contains("p", x)).alias("includes"))


@query("text_search", """
SELECT doc_id, lang, n_chars FROM documents
WHERE contains(strip_accents(lower(text)), strip_accents(lower('Réa'))) AND lang IN ('fr', 'es')
ORDER BY n_chars DESC, doc_id LIMIT 300
""")
def text_search(t: Tables):
    from foliograph.operators.indicators import search

    return search(t.texts, "text", "Réa", "lang", ["fr", "es"], "n_chars", "doc_id").select("doc_id", "lang", "n_chars")


@query("folded_order", """
SELECT word, n, row_number() OVER (ORDER BY strip_accents(lower(word)), word) AS position FROM (
  SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-zÀ-ú]+')) AS w FROM documents) GROUP BY 1)
""")
def folded_order(t: Tables):
    """SL-3: accent-insensitive order of the vocabulary."""
    words = t.texts.select(
        F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ú]+"), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return sh.global_numbered(counts.withColumn("_k", tx.fold(F.col("word"))), ["_k", "word"]).drop("_k")
