"""Registered queries of the operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import alignment, bpe, collocations, divergence, exact_dedup, licenses, near_dedup, packing, pii, quality, substrings, topk, url_filter

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
# The key of the registered queries; a real corpus takes a secret one.
PII_KEY = "foliograph-demonstration-key"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, directory: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, directory, "documents"), public_tokenizers.path(WORD_BPE))
    return coded.select(
        "doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op2_quality")
def op2_quality(spark: SparkSession, directory: str) -> DataFrame:
    return quality.classify(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op3_pii")
def op3_pii(spark: SparkSession, directory: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, directory, "documents"), PII_KEY, found_col="n_replaced")
    return out.select("doc_id", "n_replaced", "text")


@query("op4_substrings", """
    WITH d AS (SELECT row_number() OVER () AS n, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
         windows AS (SELECT n, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT *, unnest(generate_series(1, len(w) - 49)) AS i FROM d)),
         firsts AS (SELECT s, min(doc_id) AS f FROM windows GROUP BY s),
         covered AS (SELECT DISTINCT n, unnest(generate_series(i, i + 49)) AS p FROM windows JOIN firsts USING (s) WHERE f < doc_id),
         gone AS (SELECT n, list(p) AS gone FROM covered GROUP BY n),
         kept AS (SELECT d.*, coalesce(gone, []) AS gone FROM d LEFT JOIN gone USING (n))
    SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed,
           sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM kept""")
def op4_substrings(spark: SparkSession, directory: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, directory, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op5_exact_dedup", f"""
    WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
           sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)""")
def op5_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    out = exact_dedup.deduplicate(table(spark, directory, "documents"), exact_dedup.DigestIndex(spark))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op6_near_dedup", f"""
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
         sets AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')))
                                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
         sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
         links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id
                   JOIN sizes y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
         reach(id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT b, c FROM reach JOIN links ON a = id)
    SELECT id AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id, id = min(c) AS kept
    FROM reach LEFT JOIN sizes ON doc_id = id GROUP BY id""")
def op6_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, directory, "documents"))


# The listed rules as (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


@query("op7_url_filter", """
    WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
         u AS (SELECT row_number() OVER () AS n, page_id,
                      translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
         f AS (SELECT u.*, h || p AS rule, v, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, length(h) DESC) AS k
               FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM f WHERE k = 1""")
def op7_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, directory, "pages"), rules)


@query("op8_packing")
def op8_packing(spark: SparkSession, directory: str) -> DataFrame:
    pieces = packing.pack(table(spark, directory, "documents"), public_tokenizers.path(BYTE_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_topk", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
               FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
               FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
         r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op9_topk(spark: SparkSession, directory: str) -> DataFrame:
    return topk.top_k(table(spark, directory, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_licenses")
def op10_licenses(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, directory, "documents")))


PIECES = f"""
    WITH docs AS (SELECT coalesce(lang, 'und') AS lang, {LOWERED} AS t FROM documents),
         pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
         words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
         places AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k FROM
                    (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
                     FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k))),
         f AS (SELECT lang, phrase, k, count(*) AS c FROM places GROUP BY ALL HAVING count(*) >= 100),
         n AS (SELECT lang, count(*) AS n FROM places WHERE k = 1 GROUP BY lang)"""


@query("op11_collocations", PIECES + """,
         cuts AS (SELECT f.lang, f.phrase, f.c AS a, x.c AS l, y.c AS r, n.n, j,
                         CAST(1000::HUGEINT * f.c * n.n // (x.c::HUGEINT * y.c) AS BIGINT) AS score
                  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j, string_split(phrase, ' ') AS w FROM f WHERE k > 1) f
                  JOIN f x ON x.lang = f.lang AND x.phrase = array_to_string(w[1:j], ' ')
                  JOIN f y ON y.lang = f.lang AND y.phrase = array_to_string(w[j + 1:], ' ')
                  JOIN n ON n.lang = f.lang),
         best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
         kept AS (SELECT * FROM best b WHERE NOT EXISTS (
                  SELECT 1 FROM f WHERE f.lang = b.lang AND f.k > len(string_split(b.phrase, ' ')) AND f.c >= b.a
                                        AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= 2000""")
def op11_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations.collocations(table(spark, directory, "documents"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, directory: str) -> DataFrame:
    return alignment.align_documents(table(spark, directory, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


# Both engines: bins 1 to 6 are character classes, 1 to 25 words; shares are compared with medians in thousandths.
DIVERGENCE = """
    WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text, lang,
                      regexp_extract_all(lower(coalesce(text, '')), '\\p{L}+') AS l FROM documents),
         s AS (SELECT n, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
         windows AS (SELECT n, i, count(*) OVER (PARTITION BY n, w[i], w[i + 1], w[i + 2]) AS k
                     FROM (SELECT n, w, unnest(generate_series(1, len(w) - 2)) AS i FROM s)),
         repeats AS (SELECT n, count(DISTINCT p) AS k FROM (SELECT n, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE k > 1) GROUP BY n),
         base AS (SELECT n, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(k, 0) AS n_repeat_words,
                         length(text) AS size, len(l) AS letters
                  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
                        FROM d JOIN s USING (n) LEFT JOIN repeats USING (n))),
         df AS (SELECT lang, word, count(*) AS k FROM (SELECT lang, unnest(list_distinct(l)) AS word FROM d) GROUP BY ALL),
         large AS (SELECT lang FROM df GROUP BY lang HAVING sum(k) * 1000 >= (SELECT sum(k) FROM df)),
         g AS (SELECT n, CASE WHEN large.lang IS NULL AND l2 IS NULL THEN 'all' ELSE 'of ' || coalesce(d.lang, '') END AS g
               FROM d LEFT JOIN (SELECT lang, 1 AS l2 FROM large) large ON large.lang IS NOT DISTINCT FROM d.lang),
         ranked AS (SELECT 'of ' || coalesce(lang, '') AS g, word, k FROM df WHERE EXISTS (SELECT 1 FROM large WHERE large.lang IS NOT DISTINCT FROM df.lang)
                    UNION ALL SELECT 'all', word, sum(k) FROM df GROUP BY word),
         common AS (SELECT g, list(word ORDER BY k DESC, word) AS words
                    FROM (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY g ORDER BY k DESC, word) <= 24) GROUP BY g),
         h AS (SELECT n, g, size, letters,
                      list_resize(list_transform(words, lambda x: len(list_filter(l, lambda y: y = x))), 24, 0) AS h,
                      list_transform(['\\p{Ll}', '\\p{Lu}', '\\p{Nd}', '\\x20\\x09-\\x0D', '.,;:\'\'\"()-'],
                                     lambda x: length(regexp_replace(text, '[^' || x || ']+', '', 'g'))) AS c
               FROM d JOIN g USING (n) JOIN base USING (n) LEFT JOIN common USING (g)),
         bins AS (SELECT n, g, size, letters, 'c' AS kind, size AS total, unnest(list_append(c, size - list_sum(c))) AS v, generate_subscripts(list_append(c, 0), 1) AS i FROM h
                  UNION ALL
                  SELECT n, g, size, letters, 'w', letters, unnest(list_append(h, letters - list_sum(h))), generate_subscripts(list_append(h, 0), 1) FROM h),
         judged AS (SELECT * FROM bins WHERE size >= 200 AND letters >= 50),
         m AS (SELECT g, kind, i, quantile_cont(CAST(round(v * 1000 / total) AS INTEGER), 0.5) AS m FROM judged WHERE g <> 'all' GROUP BY ALL
               UNION ALL SELECT 'all', kind, i, quantile_cont(CAST(round(v * 1000 / total) AS INTEGER), 0.5) FROM judged GROUP BY ALL),
         q AS (SELECT g, kind, i, m / sum(m) OVER (PARTITION BY g, kind) AS q FROM m),
         p AS (SELECT n, kind, any_value(size) AS size, any_value(letters) AS letters,
                      sqrt(greatest(0, sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS x
               FROM (SELECT n, kind, size, letters, v / total AS p, q FROM judged JOIN q USING (g, kind, i)) GROUP BY n, kind),
         diverging AS (SELECT DISTINCT n FROM p WHERE x > CASE kind WHEN 'c' THEN 0.15 + sqrt(5 / (8 * ln(2)) / size) ELSE 0.3 + sqrt(24 / (8 * ln(2)) / letters) END)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n NOT IN (SELECT n FROM diverging) AS kept
    FROM base"""


@query("op13_quality_rules", DIVERGENCE)
def op13_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    return divergence.judge(table(spark, directory, "documents")).drop("character_distance", "word_distance")
