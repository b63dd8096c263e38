"""Operator 11: phrase collocations by Toivonen mining.

A phrase is a run of words inside a piece of text; its count is that of all its places. A phrase is never more frequent than
its parts, so the phrases above a support are closed under taking parts.

1. A pass counts the words. Phrases of frequent words only can be frequent.
2. A sample, one block of ``BLOCK`` bytes in ``share`` from all texts, is mined at a lowered support. What is frequent there is
   the proposal.
3. A pass over all documents counts every proposed phrase and the proposal's negative border: the phrases that are not
   proposed themselves though both their parts, without the last and without the first word, are. The border is long and nearly
   all of it rare, so this pass counts by 64-bit hashes; a hash never counts less than a phrase of it.
4. A last pass counts, by their words, the phrases whose hash reached the support. A border phrase that is frequent is a failure:
   longer phrases around it were not counted. So this pass also counts what the pass before did not and whose parts are frequent
   or counted now. The parts of a frequent phrase that are left are all of that kind, so it closes the mining.

The counts are exact whatever the sample was; it only decides how much the last pass has to do. What a pass needs to know of the
others reaches its tasks as blocked Bloom filters of at most ``MOST_BYTES``; a false hit counts a phrase more and changes no
result. A task combines its counts before they are shuffled, so frequent phrases and languages do not pile up anywhere.

A candidate is cut after each of its words; the part counts give a score to each cut and the lowest decides. Candidates inside a
longer one that is as frequent are dropped.

Defined results: null and empty texts have no words; a null language is ``und``; texts of any length count whole; repeated rows
count each; ties go to the smaller phrase by its bytes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import stored
from foliograph.llm.url_filter import SALTS, WORDS, places

SUPPORT, LONGEST, SHARE = 100, 5, 8
MOST_BYTES = 16 << 20
# A piece ends at each of these bytes.
STOPS = b".,;:!?\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C15
PART = 8 << 20  # bytes of text that are counted together, if a piece is not longer
BLOCK = 512  # bytes of a block of the sample


def pieces_of(text: bytes) -> Iterator[bytes]:
    """A text, lower-cased and with one sort of stop, in parts that end at stops."""
    text = text.lower().translate(bytes.maketrans(STOPS, b"." * len(STOPS)))
    at = 0
    while len(text) - at > PART:
        cut = text.rfind(b".", at, at + PART)
        cut = cut if cut >= 0 else text.find(b".", at + PART)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def blocks_of(text: bytes, seed: int, share: int) -> Iterator[bytes]:
    """One block in ``share`` of a text, without the words that it cuts."""
    for i in range(0, len(text), BLOCK):
        if ((seed * BASE + i // BLOCK) * 0xC4CEB9FE1A85EC53 & (1 << 64) - 1) >> 33 & (1 << 31) - 1 < (1 << 31) // share:
            block = text[i : i + BLOCK]
            block = block.partition(b" ")[2] if i else block
            yield block.rpartition(b" ")[0] if i + BLOCK < len(text) else block


def tokens_of(parts: list[bytes]) -> pa.DictionaryArray:
    """The words of the parts, with a stop between pieces and parts."""
    import numpy as np

    raw = np.frombuffer(b".".join(parts).replace(b".", b" . ") + b" ", np.uint8)
    inside = (raw != 32) & (raw != 9)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.append(0, edges) if inside[0] else edges
    ends = np.cumsum(edges[1::2] - edges[::2])
    buffers = [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(raw[inside])]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers).dictionary_encode()


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def longer_hash(hashes, words):
    """Hash of a phrase from that of its part without the last word, and that word's hash."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(BASE) + words
        return x ^ (x >> np.uint64(32))


def holds(words, hashes):
    """Which hashes the filter may hold."""
    block, bits = places(hashes, len(words))
    return ((words[block] & bits) == bits).all(axis=1)


def filter_of(hashes: DataFrame, bits_per_key: int = 16):
    """A blocked Bloom filter of the column ``hash`` as an array of at most MOST_BYTES: tasks fill blocks, equal blocks are or-ed."""
    import numpy as np

    blocks = int(max(1, min(MOST_BYTES // (8 * WORDS), hashes.count() * bits_per_key // (64 * WORDS) + 1)))
    names = [f"w{i}" for i in range(WORDS)]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((blocks, WORDS), np.uint64)
        for b in batches:
            block, bits = places(b.column(0).to_numpy().view(np.uint64), blocks)
            np.bitwise_or.at(own, block, bits)
        used = np.flatnonzero(own.any(axis=1))
        words = own[used].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *(pa.array(words[:, i].copy()) for i in range(WORDS))], names=["block", *names])

    made = hashes.select("hash").mapInArrow(fill, "block long, " + ", ".join(f"{n} long" for n in names))
    words = np.zeros((blocks, len(SALTS)), np.uint64)
    for r in made.groupBy("block").agg(*(F.bit_or(n).alias(n) for n in names)).toLocalIterator():  # at most MOST_BYTES
        words[r[0]] = np.array(r[1:], np.int64).view(np.uint64)
    return words


def numbered(keys):
    """The distinct keys, and for each key which of them it is."""
    held = pa.array(keys).dictionary_encode()
    return held.dictionary.to_numpy(), held.indices.to_numpy()


def counted(lang: str, parts: list[bytes], filters: list, shortest: int, longest: int, judged: int, last: bool) -> Iterator[tuple]:
    """(phrases, hashes, counts) of the parts of one language, three arrays for each length.

    A phrase takes part if the last filter holds both its parts. Parts longer than ``judged`` words only have to take part
    themselves. In the ``last`` pass the first filter is that of the pass before: what that let pass is counted if the last filter
    holds it, the rest in any case, and both are parts from then on. With words go those of all words together, under the empty
    phrase.
    """
    import numpy as np
    import pyarrow.compute as pc

    tokens = tokens_of(parts)
    names, code = tokens.dictionary, tokens.indices.to_numpy()
    if not len(code):
        return
    stop = pc.index(names, pa.scalar(b".", pa.binary())).as_py()
    is_word = code != stop
    word = np.array([word_hash(x) for x in names.to_pylist()], np.uint64)
    # by place: the number of the phrase of the present length that starts there, and whether each filter holds it
    number, hashes = code.astype(np.int64), longer_hash(np.full(len(word), word_hash(lang.encode()), np.uint64), word)
    if shortest == 1:
        n = np.bincount(code, minlength=len(names))
        kept = np.flatnonzero(np.arange(len(names)) != stop)
        yield names.take(pa.array(kept)), hashes[kept], n[kept]
        yield pa.array([b""], pa.binary()), np.zeros(1, np.uint64), np.array([int(is_word.sum())])
    if longest == 1:
        return
    held = [holds(f, hashes)[code] & is_word for f in filters]
    phrases = names
    for length in range(2, longest + 1):
        if len(number) < 2:
            return
        both = [h[:-1] & h[1:] for h in held]
        at = np.flatnonzero(both[-1])
        if not len(at):
            return
        distinct, which = numbered(number[at] * len(names) + code[at + length - 1])
        part, end = distinct // len(names), distinct % len(names)
        phrases = pc.binary_join_element_wise(phrases.take(pa.array(part)), names.take(pa.array(end)), pa.scalar(b" ", pa.binary()))
        hashes = longer_hash(hashes[part], word[end])
        found = [holds(f, hashes) if length <= judged else np.ones(len(distinct), bool) for f in filters]
        out = np.ones(len(distinct), bool)
        if last:
            out[which[both[0][at]]] = False
            found[-1] = out = out | found[-1]
        if length >= shortest and out.any():
            yield phrases.filter(pa.array(out)), hashes[out], np.bincount(which, minlength=len(distinct))[out]
        number = np.zeros(len(number) - 1, np.int64)
        number[at] = which
        held = []
        for here, of in zip(found, both, strict=True):
            places_ = np.zeros(len(number), bool)
            places_[at] = here[which] & of[at]  # a false hit is none where the parts did not pass
            held.append(places_)


def count(docs: DataFrame, filters: list, shortest: int, longest: int, judged: int = 1 << 30, last: bool = False, share: int = 1,
          by: str = "hash") -> DataFrame:
    """(hash, n), or (lang, phrase, hash, n) by ``phrase``: counts of a pass over (lang, text) or over a sample of its blocks."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kinds = {"lang": "string", "phrase": "binary", "hash": "long", "n": "long"}
    columns = ["hash", "n"] if by == "hash" else list(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        context = TaskContext.get()
        seed = (context.partitionId() if context else 0) << 32
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in waiting.items():
                for phrases, hashes, n in counted(lang, parts, shared.value, shortest, longest, judged, last):
                    made = {"hash": pa.array(hashes.view(np.int64)), "n": pa.array(n, pa.int64())}
                    if by == "phrase":
                        made |= {"lang": pa.repeat(pa.scalar(lang), len(n)), "phrase": phrases}
                    yield pa.RecordBatch.from_arrays([made[c] for c in columns], names=columns)
            waiting.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seed += 1
                for block in blocks_of(text.as_py(), seed, share) if share > 1 else (text.as_py(),):
                    for part in pieces_of(block):
                        waiting.setdefault(lang, []).append(part)
                        size += len(part) + 1
                        if size > PART:
                            yield from flush()
                            size = 0
        yield from flush()

    rows = docs.select("lang", "text").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))
    return rows.groupBy(*columns[:-1]).agg(F.sum("n").alias("n"))


def lowered(support: int, share: int) -> int:
    """The support in a sample of one in ``share``: its mean less two and a half standard deviations."""
    mean = support / share
    return max(2, int(mean - 2.5 * (mean * (1 - 1 / share)) ** 0.5))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, share: int = SHARE, text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, n) of every word and phrase with at least ``support`` places, and of the empty phrase, for all words."""
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    low, enough = F.col("n") >= lowered(support, share), F.col("n") >= support
    found = stored(count(texts, [], 1, 1, by="phrase").where(enough | (F.col("phrase") == F.lit(b""))), "words")
    if longest == 1:
        return found.select("lang", "phrase", "n")
    words = found.where("phrase <> X''").select("hash")
    proposed = stored(count(texts, [filter_of(words)], 2, 2, share=share).where(low).select("hash"), "sample-pairs")
    if longest > 2:
        more = count(texts, [filter_of(words.unionByName(proposed))], 3, longest, judged=2, share=share).where(low).select("hash")
        proposed = proposed.unionByName(stored(more, "sample-phrases"))
    first = filter_of(words.unionByName(proposed))
    reached = stored(count(texts, [first], 2, longest).where(enough).select("hash"), "hashes")
    filters = [first, filter_of(words.unionByName(reached))]
    phrases = stored(count(texts, filters, 2, longest, last=True, by="phrase").where(enough), "phrases")
    return found.unionByName(phrases).select("lang", "phrase", "n")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, share: int = SHARE, most: int = 2000,
                 covered: int = 100, **columns: str) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``most`` phrases of each language.

    ``covered``: a candidate goes if a longer one around it has at least that percentage of its places.
    """
    found = frequent_phrases(docs, support, longest, share, **columns).withColumn("phrase", F.col("phrase").cast("string"))
    found = stored(found, "frequent")
    totals = found.where("phrase = ''").select("lang", F.col("n").alias("total"))
    counts = found.where("phrase <> ''")
    named = counts.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w")).where("k > 1")
    inner = named.where("k > 2").select("lang", F.col("n").alias("around"), F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = named.join(around, ["lang", "phrase"], "left").where(F.coalesce(F.col("around"), F.lit(0)) * 100 < F.col("n") * covered)
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.expr(
        "transform(sequence(1, k - 1), c -> struct(c AS cut, array_join(slice(w, 1, c), ' ') AS left, array_join(slice(w, c + 1, k - c), ' ') AS right))")).alias("c"))
    part = lambda side, n: counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    met = (
        cuts.select("lang", "phrase", "a", "c.cut", "c.left", "c.right")
        .join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    )
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * CAST({wide('a')} * CAST(total AS DECIMAL(15, 0)) AS DECIMAL(34, 0))) DIV ({wide('l')} * {wide('r')})")
    best = met.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"), F.first("total").alias("n"))
    rows = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    return rows.withColumn("rank", rank).where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
