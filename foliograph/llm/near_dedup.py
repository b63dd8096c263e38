"""Operator 6: near-duplicates by HyperMinHash.

A document is its set of distinct ``SHINGLE``-word shingles, as 64-bit hashes. The hash space is cut into ``REGISTERS`` buckets;
a register holds, of its bucket's least hash, the number of leading zeros and the mantissa bits that follow, 16 bits in all.

1. Documents with equal sets are one class, for which its smallest id stands.
2. Bands of four registers become keys; empty registers borrow from others in a fixed order. Sets of at most ``SMALL``
   shingles have too few full registers, so their keys are the first shingles in an order of all shingles, as many as it
   takes that similar sets share one; shingles that a count over all documents finds common come last in it. Between 0.8 * SMALL and SMALL shingles a set has both, so that no pair falls between.
3. Each class that shares a key meets the smallest and the largest class of the key, and the pair stays if the similarity that
   the registers estimate, less the equal registers that chance explains, may be high enough. The pairs form candidate groups.
   A key whose classes are in several groups is worked through once more: its classes of similar size, tile by tile of ``CELL``
   classes, are estimated against those of other groups, and what may match joins the groups.
4. Full sets are compared inside groups only: groups of at most ``TILE`` classes in one task.
   In larger ones the pairs of step 3 are confirmed first, and then the classes outside the group's largest confirmed component
   meet all classes of the group, tile by tile, which finds every link that could still connect something.
5. Confirmed links are contracted to components.

No pairs are emitted inside a key or a group but those that connect, and no task gathers more than some ``CELL`` registers or
``TILE`` sets at once.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; with fewer words than
a shingle the whole sequence is one; texts of any length are read whole; rows with a null id have a null component, are kept
and link with nothing; repeated rows are in one class; rows that repeat an id with other words are linked each by its own words;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import forget_worker_state, stored
from foliograph.llm.substrings import batched, gram_hashes, mixed, word_hashes

SHINGLE, PERCENT = 4, 80
REGISTERS, MANTISSA, BAND, ARRANGEMENTS = 128, 10, 4, 2
SMALL, TILE, CELL = 200, 256, 1024
EMPTY = 0xFFFF


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased."""
    import numpy as np

    raw = b" ".join(t.lower() for t in texts)
    words, first, _ = word_hashes(raw) if raw else (np.zeros(0, np.uint64),) * 3
    bounds = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    grams = gram_hashes(words, shingle)
    out = []
    for s, e in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if e - s >= shingle:
            out.append(np.unique(grams[s : e - shingle + 1]))
        else:
            out.append(gram_hashes(words[s:e], e - s) if e > s else np.zeros(0, np.uint64))
    return out


def registers_of(hashes):
    """Leading zeros and mantissa of the least hash of each bucket; EMPTY where a bucket has none. ``hashes`` are sorted."""
    import numpy as np

    width = REGISTERS.bit_length() - 1
    edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - width)
    at = np.searchsorted(hashes, edges)
    end = np.append(at[1:], len(hashes))
    out = np.full(REGISTERS, EMPTY, np.uint16)
    full = at < end
    rest = (hashes[at[full]] << np.uint64(width)) | np.uint64(1 << (width - 1))  # never 0
    # halves are exact as floating numbers, so the exponent is that of the leading bit
    high, low = rest >> np.uint64(32), rest & np.uint64(0xFFFFFFFF)
    zeros = np.where(high > 0, 32 - np.frexp(high.astype(np.float64))[1], 64 - np.frexp(low.astype(np.float64))[1]).astype(np.uint64)
    mantissa = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out[full] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    return out


class Banding:
    """Fixed random orders: where empty registers borrow, and how registers are put into bands."""

    def __init__(self):
        import numpy as np

        rng = np.random.default_rng(20_011)
        self.donors = np.stack([rng.permutation(REGISTERS) for _ in range(48)])
        self.orders = np.concatenate([rng.permutation(REGISTERS).reshape(-1, BAND) for _ in range(ARRANGEMENTS)])
        self.salt = rng.integers(1, 1 << 62, (len(self.orders), BAND + 1), dtype=np.uint64) | np.uint64(1)

    def keys(self, registers):
        """One key a band of the registers, after empty ones have borrowed."""
        import numpy as np

        r = registers.copy()
        for donor in self.donors:
            hole = r == EMPTY
            if not hole.any():
                break
            r[hole] = registers[donor[hole]]
        if (r == EMPTY).any():
            full = np.flatnonzero(registers != EMPTY)
            hole = np.flatnonzero(r == EMPTY)
            r[hole] = registers[full[np.searchsorted(full, hole) % len(full)]]
        with np.errstate(over="ignore"):
            return mixed(((r[self.orders].astype(np.uint64) + np.uint64(1)) * self.salt[:, :BAND]).sum(axis=1) ^ self.salt[:, BAND])


def chance(n: float) -> list[float]:
    """How likely the least of n random hashes has 0, 1, 2, ... leading zeros."""
    return [(1 - 2.0 ** -(i + 1)) ** n - (1 - 2.0**-i) ** n for i in range(40)]


def estimates(a, b, sizes_a, sizes_b):
    """Estimated similarity of register rows, corrected for registers that are equal by chance, and the registers compared."""
    import numpy as np

    either = (a != EMPTY) | (b != EMPTY)
    compared = np.maximum(either.sum(axis=1), 1)
    equal = ((a == b) & either).sum(axis=1) / compared
    lists = {}
    expected = np.zeros(len(a))
    for i, pair in enumerate(zip((np.log2(np.maximum(sizes_a, 1)) * 2).astype(int).tolist(), (np.log2(np.maximum(sizes_b, 1)) * 2).astype(int).tolist(), strict=True)):
        if pair not in lists:
            x, y = (chance(max(1.0, 2 ** (p / 2) / REGISTERS)) for p in pair)
            lists[pair] = sum(p * q for p, q in zip(x, y, strict=True)) / (1 << MANTISSA)
        expected[i] = lists[pair]
    return np.maximum(0.0, (equal - expected) / (1 - expected)), compared


def common_shingles(docs: DataFrame, shingle: int = SHINGLE, cells: int = 1 << 14, times: int = 4):
    """Flags of hash cells whose shingles occur in more than ``times`` as many documents as those of the mean cell.

    Counted over all rows of (doc_id, text); only ``cells`` sums reach the driver.
    """
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        counts = np.zeros(cells, np.int64)
        for b in batches:
            for _, texts in batched(b, 1):
                for h in shingle_sets(texts, shingle):
                    counts += np.bincount((h & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["cell", "n"])

    counts = np.zeros(cells, np.int64)
    for r in docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    return counts > times * max(1.0, counts.mean())


SIGNED = "doc_id long, sig long, n long, digest binary, registers binary, keys array<long>"


def signatures(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, sig, n, digest, registers, keys): set size, set digest, registers and candidate keys of each row of (doc_id, text, sig)."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        import numpy as np

        forget_worker_state()
        banding, late = Banding(), common.value
        mask = np.uint64(len(late) - 1)
        for b in batches:
            for at, texts in batched(b, 1):
                sizes, digests, registers, keys = [], [], [], []
                for h in shingle_sets(texts, shingle):
                    n, own = len(h), []
                    r = registers_of(h)
                    if 0 < n <= SMALL:
                        ordered = h[np.argsort(late[(h & mask).astype(np.int64)], kind="stable")]
                        own.append(mixed(ordered[: n - -(-n * percent // 100) + 1] ^ np.uint64(0x5BD1E995)))
                    if n * 100 > SMALL * percent:
                        own.append(banding.keys(r))
                    sizes.append(n)
                    digests.append(blake2b(h.tobytes(), digest_size=16).digest() if n else None)
                    registers.append(r.tobytes())
                    keys.append(np.unique(np.concatenate(own)).view(np.int64) if own else [])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), b.column(2).slice(at, len(texts)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(registers, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "sig", "n", "digest", "registers", "keys"])

    return docs.mapInArrow(run, SIGNED)


def may_match(pairs: DataFrame, registers: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose estimated similarity is within five standard deviations of the threshold, or above."""
    side = lambda x: registers.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        level = percent / 100
        for b in batches:
            if b.num_rows:
                r = [np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3)]
                guess, compared = estimates(*r, *(b.column(i).to_numpy() for i in (4, 5)))
                stay = pa.array(guess >= level - 5 * np.sqrt(level * (1 - level) / compared) - 1e-9)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(stay), b.column(1).filter(stay)], names=["a", "b"])

    return met.select("a", "b", "r_a", "r_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def roots(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each id of the edges (a, b) is connected with.

    In each round every id points to its smallest neighbour, or to itself if none is smaller; pointers are followed to their
    ends by doubling, and the edges are contracted to those ends. The rounds' steps are composed at the end. Rounds and
    doublings grow with the logarithm of the component. All joins meet stored tables, so Spark splits the partitions of ids
    with many edges.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("near")).union(edges.select("b", "a"))
        step = stored(both.groupBy("id").agg(F.min("near").alias("near")).select("id", F.least("id", "near").alias("to")), "steps")
        while True:
            further = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
            jumped = stored(step.join(further, "to").select("id", "to", "next"), "steps")
            step = jumped.select("id", F.col("next").alias("to"))
            if jumped.where("next <> to").isEmpty():
                break
        steps.append(step)
        end = lambda x: step.select(F.col("id").alias(x), F.col("to").alias(f"to_{x}"))  # noqa: B023, E731
        moved = edges.join(end("a"), "a").join(end("b"), "b").where("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    out = steps[-1].select("id", F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        later = out.select(F.col("id").alias("to"), "root")
        out = step.join(later, "to", "left").select("id", F.coalesce("root", "to").alias("root"))
    return stored(out, "roots")


def joined(ids, a, b) -> list[tuple[int, int]]:
    """(id, smallest connected id) for the ids that pairs of places (a, b) connect with a smaller one."""
    import numpy as np

    label = ids.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, least[a])
        if (least == label).all():
            break
        label = least
    moved = label != ids
    return list(zip(ids[moved].tolist(), label[moved].tolist(), strict=True))


def across_groups(keyed: DataFrame, grouped: DataFrame, registers: DataFrame, percent: int, cell: int) -> DataFrame:
    """(a, b): pairs that may match and connect different groups, of classes that share a key.

    ``keyed`` has doc_id and key, ``grouped`` id and grp; classes without a group are their own.
    """
    placed = keyed.join(grouped.select(F.col("id").alias("doc_id"), "grp"), "doc_id", "left").select(
        "key", "doc_id", F.coalesce("grp", "doc_id").alias("grp"))
    placed = stored(placed, "placed-keys")
    apart = lambda df, *keys: df.groupBy(*keys).agg(
        F.min("grp").alias("low"), F.max("grp").alias("high"), F.count("*").alias("size")).where("low < high")
    mixed_keys = stored(apart(placed, "key").select("key"), "mixed-keys")
    side = registers.select("doc_id", "n", "registers")
    members = stored(placed.join(mixed_keys, "key"), "mixed-members")
    # sizes that may match are in the same or in neighbouring classes; each class of sizes also takes the next one
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    classed = members.join(registers.select("doc_id", "n"), "doc_id").select(
        "key", "doc_id", "grp", F.explode(F.array(step, step + 1)).alias("sizes"))
    classed = stored(classed, "size-classes")
    wanted = stored(apart(classed, "key", "sizes").select("key", "sizes", F.ceil(F.col("size") / cell).cast("int").alias("tiles")), "mixed-classes")
    x, y = F.pmod(F.xxhash64("doc_id"), F.col("tiles").cast("long")).cast("int"), F.col("other")
    dealt = classed.join(wanted, ["key", "sizes"]).select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "key", "sizes", F.least(x, y).alias("x"), F.greatest(x, y).alias("y"), "doc_id", "grp")
    rows = stored(dealt, "cells").join(side, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        level = percent / 100

        def links(held: list[tuple]) -> list[tuple[int, int]]:
            ids, groups, sizes = (np.array(c, np.int64) for c in zip(*(r[:3] for r in held), strict=True))
            r = np.frombuffer(b"".join(h[3] for h in held), np.uint16).reshape(-1, REGISTERS)
            found_a, found_b = [], []
            for first in range(0, len(ids), 64):
                part = slice(first, first + 64)
                near = np.minimum(sizes[part, None], sizes[None, :]) * 100 >= np.maximum(sizes[part, None], sizes[None, :]) * percent
                a, b = np.nonzero(near & (groups[part, None] < groups[None, :]))
                a += first
                for at in range(0, len(a), 1 << 14):
                    i, j = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
                    guess, compared = estimates(r[i], r[j], sizes[i], sizes[j])
                    stay = guess >= level - 5 * np.sqrt(level * (1 - level) / compared) - 1e-9
                    found_a.append(i[stay])
                    found_b.append(j[stay])
            a, b = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_a, found_b))
            return joined(ids, a, b) if len(a) else []

        def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*out, strict=True) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        of, held, out = None, [], []
        for b in batches:
            for *key, doc, grp, n, registers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != of:
                    out += links(held) if held else []
                    of, held = key, []
                    if len(out) > 10_000:
                        yield batch(out)
                        out = []
                held.append((doc, grp, n, registers))
        yield batch(out + (links(held) if held else []))

    keys = ["key", "sizes", "x", "y"]
    spread = rows.select(*keys, "doc_id", "grp", "n", "registers").repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(run, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links_within(sets: list, percent: int, width: int = 8192):
    """Which sets match, as a square of flags: counts of common members, by products of membership columns."""
    import numpy as np

    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    all_, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(all_, kind="stable")
    all_, owner = all_[order], owner[order]
    new = np.ones(len(all_), bool)
    new[1:] = all_[1:] != all_[:-1]
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    owner, number = owner[shared], number[shared]
    _, number = np.unique(number, return_inverse=True)
    common = np.zeros((n, n), np.float32 if sizes.max(initial=0) < 1 << 24 else np.float64)
    top = int(number.max()) + 1 if len(number) else 0
    for first in range(0, top, width):
        s, e = np.searchsorted(number, [first, first + width])
        member = np.zeros((n, min(width, top - first)), common.dtype)
        member[owner[s:e], number[s:e] - first] = 1
        common += member @ member.T
    common = common.astype(np.int64)
    return common * 100 >= percent * (sizes[:, None] + sizes[None, :] - common)


def forest(ids: list[int], flags) -> list[tuple[int, int]]:
    """(id, smallest id connected with it) for the ids that have one."""
    import numpy as np

    ids = np.array(ids)
    label = ids.copy()
    while True:
        least = np.minimum(label, np.where(flags, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == label).all():
            break
        label = least
    return [(int(i), int(x)) for i, x in zip(ids, label, strict=True) if i != x]


def links_in_groups(rows: DataFrame, keys: list[str], shingle: int, percent: int) -> DataFrame:
    """(a, b): links that connect what is linked among the texts of each group of ``rows``, which has keys, id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()

        def links(held: dict[int, bytes]) -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            sets = []
            ids = list(held)
            for at in range(0, len(ids), 64):
                sets += shingle_sets([held[i] for i in ids[at : at + 64]], shingle)
            return forest(ids, links_within(sets, percent))

        def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*out, strict=True) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        of, held, out = None, {}, []
        for b in batches:
            for *key, number, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != of:
                    out += links(held)
                    of, held = key, {}
                    if len(out) > 10_000:
                        yield batch(out)
                        out = []
                held[number] = text.encode()
        yield batch(out + links(held))

    dealt = rows.select(*keys, "id", "text").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) that match on full sets; ``texts`` has id and text."""
    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                sets = [shingle_sets([t.encode() for t in b.column(i).to_pylist()], shingle) for i in (2, 3)]
                common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets, strict=True)]
                stay = pa.array([100 * c >= percent * (len(x) + len(y) - c) for c, x, y in zip(common, *sets, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0).filter(stay), b.column(1).filter(stay)], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long")


def links_of_large(groups: DataFrame, pairs: DataFrame, shingle: int, percent: int, tile: int) -> DataFrame:
    """Links inside large candidate groups; ``groups`` has grp, size, id and text, ``pairs`` are candidates inside groups."""
    sure = stored(confirmed(pairs, groups, shingle, percent), "confirmed")
    placed = groups.select("grp", "size", "id").join(roots(sure), "id", "left").select(
        "grp", "size", "id", F.coalesce("root", "id").alias("root"))
    placed = stored(placed, "placed")
    parts = placed.groupBy("grp", "root").agg(F.count("*").alias("members"))
    main = stored(parts.groupBy("grp").agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.max("members").alias("most")), "main")
    marked = placed.join(main, "grp").select(
        "grp", "id", (F.col("root") != F.col("main")).alias("outside"), F.ceil(F.col("size") / tile).cast("int").alias("tiles"),
        F.ceil((F.col("size") - F.col("most")) / tile).cast("int").alias("outer"))
    dealt = lambda n: F.pmod(F.xxhash64("id"), n.cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    marked = stored(marked.where("outer > 0"), "marked")
    all_ = marked.select("grp", every(F.col("outer")).alias("x"), dealt(F.col("tiles")).alias("y"), "id")
    outer = marked.where("outside").select("grp", dealt(F.col("outer")).alias("x"), every(F.col("tiles")).alias("y"), "id")
    places = all_.union(outer).distinct()
    rows = places.join(groups.select("id", "text"), "id")
    return sure.union(links_in_groups(rows, ["grp", "x", "y"], shingle, percent))


def classes_of(usable: DataFrame) -> DataFrame:
    """(digest, rep, sig, node): the classes of equal sets, the smallest row of each, and a number that no other class has.

    The number is the smallest id of the class. Where rows repeat an id with other words several classes may have the same one;
    all but the first get numbers below all ids.
    """
    first = F.min(F.struct("doc_id", "sig"))
    made = stored(usable.groupBy("digest").agg(first.alias("f")).select("digest", F.col("f.doc_id").alias("rep"), F.col("f.sig").alias("sig")), "sets")
    shared = made.groupBy("rep").agg(F.min("digest").alias("keep"), F.count("*").alias("held")).where("held > 1")
    low = made.agg(F.least(F.min("rep"), F.lit(0)).alias("low")).scalar()
    moved = made.join(shared, "rep").where("digest <> keep").select("digest", F.monotonically_increasing_id().alias("at"))
    moved = stored(moved, "moved-sets")
    return stored(made.join(moved, "digest", "left").select("digest", "rep", "sig", F.coalesce(low - 1 - F.col("at"), "rep").alias("node")), "classes")


def judged(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, tile: int = TILE, cell: int = CELL, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, sig, n_shingles, component_id, kept) of every row; ``sig`` tells rows apart that repeat an id with other words."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("sig"))
    signed = stored(signatures(base, shingle, percent), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND n > 0")
    classes = classes_of(usable)
    members = signed.join(classes.select("digest", "node"), "digest", "left").select("doc_id", "sig", "n", "node")
    members = stored(members, "members")

    stand = usable.join(classes.select(F.col("rep").alias("doc_id"), "sig", "digest", "node"), ["doc_id", "sig", "digest"]).dropDuplicates(["node"])
    stand = stored(stand.select(F.col("node").alias("doc_id"), "n", "registers", "keys"), "representatives")
    keyed = stand.select("doc_id", F.explode("keys").alias("key"))
    common = stored(keyed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high"), "common-keys")
    met = keyed.join(common, "key").select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("doc_id").alias("b")),
                                                           F.struct(F.col("doc_id").alias("a"), F.col("high").alias("b")))).alias("p"))
    pairs = stored(met.select("p.a", "p.b").where("a < b").distinct(), "candidates")
    pairs = stored(may_match(pairs, stand, percent), "pairs")
    more = across_groups(keyed.join(common.select("key"), "key"), roots(pairs).select("id", F.col("root").alias("grp")), stand, percent, cell)
    pairs = stored(pairs.union(more), "all-pairs")

    grouped = roots(pairs).select("id", F.col("root").alias("grp"))
    sizes = stored(grouped.groupBy("grp").agg(F.count("*").alias("size")), "group-sizes")
    grouped = stored(grouped.join(sizes, "grp"), "groups")
    named = grouped.join(classes.select(F.col("node").alias("id"), F.col("rep").alias("doc_id"), "sig"), "id")
    texts = stored(named.join(base, ["doc_id", "sig"]).where("text IS NOT NULL").select("id", "grp", "size", "text"), "group-texts")
    small = links_in_groups(texts.where(F.col("size") <= tile), ["grp"], shingle, percent)
    large = texts.where(F.col("size") > tile)
    inside = pairs.join(grouped.where(F.col("size") > tile).select(F.col("id").alias("a")), "a", "left_semi")
    links = small.union(links_of_large(large, inside, shingle, percent, tile))
    component = roots(links)
    ends = classes.join(component.select(F.col("id").alias("node"), "root"), "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    ends = stored(ends, "class-roots")
    least = ends.groupBy("root").agg(F.min("rep").alias("component"))
    out = members.join(ends.select("node", "root").join(least, "root").select("node", "component"), "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "sig", F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; settings as for :func:`judged`."""
    return judged(docs, **settings).drop("sig")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each component of ``docs``, that of the smallest id, with its columns; rows with a null id stay."""
    gone = judged(docs, id_col=id_col, text_col=text_col, **settings).where("NOT kept").select(
        F.col("doc_id").alias("gone_id"), F.col("sig").alias("gone_sig")).distinct()
    mine = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("sig"))
    return mine.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("sig") == F.col("gone_sig")), "left_anti").select("row.*")
