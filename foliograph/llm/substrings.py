"""Operator 4: substring deduplication by super-k-mer partitioning.

A window is ``length`` consecutive words. Its minimiser is the least hash of the ``gram``-word runs in it, so windows with
equal words have the same minimiser, and neighbouring windows mostly share one. Consecutive windows that share a minimiser are
a super-k-mer and travel as one packed string.

1. Every text is cut into super-k-mers; only their places and minimisers are kept.
2. Minimisers that no two documents share cannot hold a repeat; a combined count per minimiser finds the others.
3. The super-k-mers of shared minimisers are packed and sent to the bucket of their minimiser, where the windows of one
   minimiser are sorted, so that equal ones stand together, and the smallest document of each is found.
4. A minimiser with more than ``HOT`` super-k-mers is not gathered in one place: its super-k-mers are combined by a digest of
   their words before any shuffle, and so are their windows, and the smallest documents are joined back.
5. The covered words of each document are cut from its text.

Windows are compared by their words in 3 and by 128-bit digests in 4. Every window of every text takes part.

Defined results: a null text has no words, an empty one neither; texts of any length are cut whole; a row is known by its id
and its text, so repeated rows get the same result each and never remove each other; rows with a null id have no order, keep
their words and remove nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import stored

LENGTH, GRAM, HOT, HEAVY = 50, 8, 200, 20_000
BASE = 0x9E3779B97F4A7C15 | 1


def word_hashes(raw: bytes):
    """Hash, first byte and end of each word of ``raw``: a polynomial in the bytes, shifted to the word's start, then mixed."""
    import numpy as np

    a = np.frombuffer(raw, np.uint8)
    space = (a == 32) | ((a >= 9) & (a <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    inverse = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        power = np.full(len(a) + 1, BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        back = np.full(len(a) + 1, inverse, np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        return mixed((total[end] - total[first]) * back[first]), first, end


def mixed(x):
    """A finaliser that spreads all bits; wraps at 64 bits."""
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sliding_min(x, width: int):
    """Minimum of each run of ``width`` values."""
    import numpy as np

    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def gram_hashes(words, gram: int):
    """A hash of each run of ``gram`` word hashes, in order."""
    import numpy as np

    n = len(words) - gram + 1
    with np.errstate(over="ignore"):
        total = np.zeros(max(n, 0), np.uint64)
        for j in range(gram):
            total = total * np.uint64(BASE) + words[j : j + n]
        return mixed(total)


def super_kmers(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text, first word, windows, minimiser) of each super-k-mer of the texts, as four arrays."""
    import numpy as np

    empty = tuple(np.zeros(0, np.int64) for _ in range(4))
    raw = b" ".join(texts)
    if not raw:
        return empty
    words, first, _ = word_hashes(raw)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(first, starts)  # words of text i: bounds[i] to bounds[i + 1]
    if len(words) < length:
        return empty
    least = sliding_min(gram_hashes(words, gram), length - gram + 1)
    owner = np.searchsorted(bounds[1:], np.arange(len(least)), side="right")
    whole = np.arange(len(least)) + length <= bounds[owner + 1]
    at = np.flatnonzero(whole)
    if not len(at):
        return empty
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    at = at[head]
    return owner[at], at - bounds[owner[at]], count, least[at].view(np.int64)


def batched(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch in parts of about that many bytes, with the row they start at."""
    at, part, size = 0, [], 0
    for i, t in enumerate(batch.column(column)):
        x = (t.as_py() or "").encode()
        if part and size + len(x) > most:
            yield at, part
            at, part, size = i, [], 0
        part.append(x)
        size += len(x)
    if part:
        yield at, part


def ranges_of(flags: list[bool], length: int) -> list[tuple[int, int]]:
    """Word ranges covered by the flagged windows."""
    out: list[list[int]] = []
    for i, f in enumerate(flags):
        if f:
            if out and i <= out[-1][1]:
                out[-1][1] = i + length
            else:
                out.append([i, i + length])
    return [(a, b) for a, b in out]


def settle(rows: list[tuple], length: int) -> list[tuple]:
    """Removed ranges (doc_id, sig, first, last) among the packed super-k-mers (doc_id, sig, start, packed) of one minimiser."""
    holders: dict[bytes, list[tuple]] = {}
    for doc, sig, start, packed in rows:
        holders.setdefault(packed, []).append((doc, sig, start))
    smallest = {p: min(h[0] for h in hs) for p, hs in holders.items()}
    found = []
    if len(holders) == 1:
        (packed, hs), = holders.items()
        size = packed.count(b" ") + 1
        return [(d, s, at, at + size) for d, s, at in hs if d > smallest[packed]]
    if len(set(smallest.values())) == 1 and len({h[0] for hs in holders.values() for h in hs}) == 1:
        return []
    windows = []
    for n, packed in enumerate(holders):
        words = packed.split(b" ")
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends)]
        doc = smallest[packed]
        windows += [(packed[starts[i] : ends[i + length - 1]], doc, n, i) for i in range(len(words) - length + 1)]
    windows.sort()
    least: list[dict[int, int]] = [{} for _ in holders]
    last, doc = None, 0
    for w, d, n, i in windows:
        if w != last:
            last, doc = w, d
        least[n][i] = doc
    for (_, hs), low in zip(holders.items(), least, strict=True):
        low = [low[i] for i in range(len(low))]
        for d, s, start in hs:
            found += [(d, s, start + a, start + b) for a, b in ranges_of([x < d for x in low], length)]
    return found


RANGES = "doc_id long, sig long, first long, last long"
PLACES = "doc_id long, sig long, start long, windows long, minimiser long"


def as_ranges(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["doc_id", "sig", "first", "last"])


def repeated_ranges(base: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, sig, first, last): word ranges covered by windows that also start in a document with a smaller id.

    ``base`` has doc_id, sig and text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in batched(b, 2):
                owner, start, count, least = super_kmers(texts, length, gram)
                rows = pa.array(owner + at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), *(pa.array(x, pa.int64()) for x in (start, count, least))],
                    names=["doc_id", "sig", "start", "windows", "minimiser"])

    places = stored(base.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "sig", "text").mapInArrow(cut, PLACES), "super-kmers")
    shared = stored(
        places.groupBy("minimiser").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
        .where("low < high").select("minimiser", (F.col("n") > hot).alias("hot")), "shared-minimisers")
    wanted = (
        places.join(shared, "minimiser").groupBy("doc_id", "sig")
        .agg(F.collect_set(F.struct("start", "windows", "minimiser", "hot")).alias("places"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        fields = (("doc_id", pa.int64()), ("sig", pa.int64()), ("start", pa.int64()), ("minimiser", pa.int64()), ("hot", pa.bool_()),
                  ("packed", pa.binary()), ("digest", pa.binary()), ("digests", pa.list_(pa.binary())))
        short = lambda x: blake2b(x, digest_size=16).digest()
        for b in batches:
            for i in range(b.num_rows):
                doc, sig, text, where = (b.column(c)[i].as_py() for c in range(4))
                words, rows = text.encode().split(), []
                for p in where:
                    at, n = p["start"], p["windows"]
                    packed = b" ".join(words[at : at + n + length - 1])
                    each = [short(b" ".join(words[j : j + length])) for j in range(at, at + n)] if p["hot"] else None
                    rows.append((doc, sig, at, p["minimiser"], p["hot"], None if p["hot"] else packed, short(packed) if p["hot"] else None, each))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)],
                                                 names=[f for f, _ in fields])

    packed = stored(
        base.join(wanted, ["doc_id", "sig"]).select("doc_id", "sig", "text", "places").mapInArrow(
            pack, "doc_id long, sig long, start long, minimiser long, hot boolean, packed binary, digest binary, digests array<binary>"),
        "packed")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, out = [], None, []
        for b in batches:
            for key, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != of:
                    out += settle(held, length) if len(held) > 1 else []
                    held, of = [], key
                    if len(out) > 10_000:
                        yield as_ranges(out)
                        out = []
                held.append(tuple(row))
        yield as_ranges(out + (settle(held, length) if len(held) > 1 else []))

    usual = (
        packed.where("NOT hot").select("minimiser", "doc_id", "sig", "start", "packed")
        .repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(sort, RANGES)
    )
    return usual.unionByName(hot_ranges(packed.where("hot"), length, heavy))


def hot_ranges(packed: DataFrame, length: int, heavy: int = HEAVY) -> DataFrame:
    """The same for minimisers with many super-k-mers: equal super-k-mers and equal windows are combined before shuffles.

    Windows that make up more than 1 / ``heavy`` of all occurrences are fewer than ``heavy``; their smallest documents are
    broadcast. The other windows that occur more than once are joined.
    """
    places = packed.select("doc_id", "sig", "start", "digest")
    each = stored(packed.groupBy("digest").agg(F.min("doc_id").alias("low"), F.first("digests").alias("digests")), "hot-super-kmers")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[bytes, list[int]] = {}
            for low, digests in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for w in digests:
                    held = found.get(w)
                    if held is None:
                        found[w] = [low, 1]
                    else:
                        held[0] = min(held[0], low)
                        held[1] += 1
            columns = [list(found), [x for x, _ in found.values()], [x for _, x in found.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)],
                                             names=["window", "low", "n"])

    windows = each.select("low", "digests").mapInArrow(combine, "window binary, low long, n long")
    lowest = stored(windows.groupBy("window").agg(F.min("low").alias("lowest"), F.sum("n").alias("n")).where("n > 1"), "hot-windows")
    total = lowest.agg(F.sum("n")).first()[0] or 0
    most = {bytes(r["window"]): r["lowest"] for r in lowest.where(F.col("n") * heavy > total).collect()}
    shared = packed.sparkSession.sparkContext.broadcast(most)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, i, w) for d, ws in zip(*(c.to_pylist() for c in b.columns), strict=True) for i, w in enumerate(ws) if w not in shared.value]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary()), strict=True)],
                                             names=["digest", "at", "window"])

    rest = each.select("digest", "digests").mapInArrow(light, "digest binary, at long, window binary")
    known = rest.join(lowest.where(F.col("n") * heavy <= total), "window").groupBy("digest").agg(
        F.collect_list(F.struct("at", "lowest")).alias("known"))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lows = []
            for low, digests, known in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                own = [shared.value.get(w, low) for w in digests]
                for x in known or ():
                    own[x["at"]] = x["lowest"]
                lows.append(own)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lows, pa.list_(pa.int64()))], names=["digest", "lows"])

    lows = stored(each.join(known, "digest", "left").select("digest", "low", "digests", "known").mapInArrow(
        settled, "digest binary, lows array<long>"), "hot-lowest")

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, sig, start, low in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out += [(doc, sig, start + a, start + e) for a, e in ranges_of([x < doc for x in low], length)]
            yield as_ranges(out)

    return places.join(lows, "digest").select("doc_id", "sig", "start", "lows").mapInArrow(flag, RANGES)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, heavy: int = HEAVY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row's text without repeated windows, its words joined by one space."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("sig"),
                       F.col(text_col).alias("text"))
    ranges = repeated_ranges(base, length, gram, hot, heavy)
    removed = ranges.groupBy("doc_id", "sig").agg(F.collect_set(F.struct("first", "last")).alias("removed"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b, rows = whole.slice(at, 256), []
                for text, removed in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    kept, done = [], 0
                    for first, last in sorted((r["first"], r["last"]) for r in removed or ()):
                        kept += words[done:first]
                        done = max(done, last)
                    kept += words[done:]
                    rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
                columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))],
                                                 names=["doc_id", "n_words", "n_removed", "kept"])

    joined = base.join(removed, ["doc_id", "sig"], "left").select("doc_id", "text", "removed")
    return joined.mapInArrow(strip, "doc_id long, n_words long, n_removed long, kept string")
