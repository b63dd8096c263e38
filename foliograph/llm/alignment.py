"""Operator 12: alignment of two tokenizers by whitespace-token anchors.

Both tokenizers encode every whole text. Where a token of each ends at the same byte and the next token of each starts with a
space, the document can be cut: such verified shared ends are anchors, and the tokens between two anchors are a window, a pair
of id tuples. Equal windows align alike, so a worker keeps the groups and links of the windows it met, by their ids, and aligns
the new windows of a batch together.

A document's row keeps its distinct links with their number; a task adds the links of its documents up to counts of id pairs.
The counts of the most frequent pairs, at most ``PAIRS``, are broadcast and summed over the links of each document where it is;
links of other pairs, if there are any, are joined with their counts. So frequent pairs never meet in one place.

Defined results: texts that are null or empty, or whose tokens do not spell a space and the text, have no tokens and zeros; texts
of any length are aligned whole; names of special tokens in a text are plain text; repeated rows and null ids give a row each and
all count; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.bpe import byte_alphabet
from foliograph.llm.common import Kept, slices, stored, worker_state
from foliograph.llm.packing import ChunkEncoder

PAIRS = 1 << 20  # pair counts that are broadcast at most, 17 bytes each
OF_B = 0x80000000  # marks the second tokenizer's ids in a window's key
KEPT_BYTES = 192 << 20  # alignments that a worker keeps
TALLY = 1 << 18  # pairs that a task adds up before it passes them on

ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, times binary, "
        "pair long, n long")
FIELDS = [(f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in ROWS.split(", ")]


def starts_of(sizes):
    """Where runs of these sizes start when they stand one behind the other, and where the last ends."""
    import numpy as np

    return np.append(0, np.cumsum(sizes))


class Aligner:
    """Tokens of both tokenizers, their windows and the windows' alignments."""

    def __init__(self, path_a: str, path_b: str):
        import numpy as np
        import sentencepiece

        self.a = ChunkEncoder(path_a)
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocab = self.a.tokenizer.get_vocab()
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.tokens = [pa.array(t, pa.binary()) for t in (bytes_a, bytes_b)]
        self.lengths = [np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b)]
        self.spaced = [np.array([x[:1] == b" " for x in t]) for t in (bytes_a, bytes_b)]
        # an id as text with what stands behind it: "," inside a group, "|" or ";" at the end of its half
        self.texts = [f"{i}{c}".encode() for t, end in ((bytes_a, "|"), (bytes_b, ";")) for i in range(len(t)) for c in (",", end)]
        self.first_b = 2 * len(bytes_a)
        self.kept = Kept(KEPT_BYTES)

    def ids_a(self, text: str) -> list[int]:
        if self.a.ranks and (text.isascii() or max(text) < "Ā"):
            return self.a.ranks.encode_ordinary(text)
        return self.a.tokenizer.encode(text, add_special_tokens=False).ids

    def spell(self, side: int, ids, sizes: list[int]) -> list[memoryview]:
        """The bytes of each run of ids."""
        import numpy as np

        made = self.tokens[side].take(pa.array(ids))
        data = memoryview(made.buffers()[2]).cast("B") if len(ids) and made.buffers()[2] else memoryview(b"")
        ends = starts_of(self.lengths[side][ids])[starts_of(sizes).astype(np.int64)].tolist()
        return [data[i:j] for i, j in zip(ends, ends[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both for each text, None where a text has no tokens."""
        from itertools import chain

        import numpy as np

        ids = [[self.ids_a(" " + t) if t else [] for t in texts], self.b.encode(texts, num_threads=1)]
        spelt = [self.spell(n, np.fromiter(chain.from_iterable(x), np.int64), [len(y) for y in x]) for n, x in enumerate(ids)]
        raw = [(" " + t).encode() if t else None for t in texts]
        return [(a, b) if r and x == r and y == r else None for a, b, r, x, y in zip(*ids, raw, *spelt, strict=True)]

    def align(self, a, b, sizes_a, sizes_b) -> list[tuple[bytes, bytes]]:
        """Groups as text and links as 64-bit pairs of each of many windows, whose ids stand one behind the other."""
        import numpy as np

        end_a, end_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        # each place where some token ends closes one link, of the tokens that reach it
        ends = np.union1d(end_a, end_b)
        links = (a[np.searchsorted(end_a, ends)] << 32) | b[np.searchsorted(end_b, ends)]
        # tokens in the order of their text: by group, first a's then b's; a token belongs to the first shared end from its own
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + last_a
        codes[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = self.first_b + 2 * b + last_b
        window_ends = end_a[starts_of(sizes_a)[1:] - 1]
        of_links = (8 * np.append(0, np.searchsorted(ends, window_ends) + 1)).tolist()
        of_codes = starts_of(sizes_a + sizes_b).tolist()
        texts, packed = list(map(self.texts.__getitem__, codes.tolist())), links.tobytes()
        return [(b"".join(texts[i:j])[:-1], packed[k:m])
                for i, j, k, m in zip(of_codes, of_codes[1:], of_links, of_links[1:], strict=False)]

    def learn(self, keys: list[bytes]) -> None:
        """Aligns windows that are not kept."""
        import numpy as np

        ids = np.frombuffer(b"".join(keys), np.uint32).astype(np.int64)
        of_b = ids >= OF_B
        bounds = starts_of([len(k) // 4 for k in keys])
        sizes_b = np.diff(starts_of(of_b)[bounds])
        for key, found in zip(keys, self.align(ids[~of_b], ids[of_b] - OF_B, np.diff(bounds) - sizes_b, sizes_b), strict=True):
            self.kept.add(key, found)

    def windows(self, tokens: list[tuple[list[int], list[int]]]) -> list[list[bytes]]:
        """The windows of each document, by their ids."""
        from itertools import chain

        import numpy as np

        ids = [np.fromiter(chain.from_iterable(x[n] for x in tokens), np.int64) for n in (0, 1)]
        start_a, start_b = (starts_of(length[x])[:-1] for length, x in zip(self.lengths, ids, strict=True))
        # places where both have a token that starts with a space: the tokens before end there together
        at_a, at_b = (np.flatnonzero(spaced[x]) for spaced, x in zip(self.spaced, ids, strict=True))
        found = np.searchsorted(start_b[at_b], start_a[at_a])
        same = np.append(start_b[at_b], -1)[found] == start_a[at_a]
        cut_a, cut_b = at_a[same], at_b[found[same]]
        bytes_a, bytes_b = ids[0].astype(np.uint32).tobytes(), (ids[1] | OF_B).astype(np.uint32).tobytes()
        p, q = (4 * cut_a).tolist(), (4 * cut_b).tolist()
        keys = [bytes_a[i:j] + bytes_b[k:m] for i, j, k, m in zip(p, [*p[1:], len(bytes_a)], q, [*q[1:], len(bytes_b)], strict=True)]
        first = np.searchsorted(cut_a, starts_of([len(x[0]) for x in tokens])).tolist()
        return [keys[i:j] for i, j in zip(first, first[1:], strict=False)]

    def documents(self, texts: list[str]) -> list[tuple[int, int, bytes, bytes] | None]:
        """(n_a, n_b, groups, links) of each text, None where it has no tokens."""
        tokens = self.encode(texts)
        held = [x for x in tokens if x]
        windows = self.windows(held) if held else []
        missing = self.kept.missing(set().union(*windows))
        if missing:
            self.learn(list(missing))
        get, out = self.kept.new.__getitem__, []
        for (a, b), keys in zip(held, windows, strict=True):
            found = list(map(get, keys))
            out.append((len(a), len(b), b";".join([x[0] for x in found]), b"".join([x[1] for x in found])))
        each = iter(out)
        return [x and next(each) for x in tokens]


def aligner(path_a: str, path_b: str) -> Aligner:
    return worker_state(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))


def rows_of(columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f], t) if f in columns else pa.nulls(n, t) for f, t in FIELDS], names=[f for f, _ in FIELDS])


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each document with its distinct links, and rows (pair, n) that add up the links of a task's documents."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        from pyspark import TaskContext

        held = aligner(path_a, path_b)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 36
        tally: dict[int, int] = {}

        for whole in batches:
            for part in slices(whole, most=1 << 20):
                out: dict[str, list] = {f: [] for f, _ in FIELDS[:9]}
                pairs, counts = [], []
                for doc_id, found in zip(part.column(0).to_pylist(), held.documents([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    n_a, n_b, groups, links = found or (0, 0, b"", b"")
                    pair, times = np.unique(np.frombuffer(links, np.int64), return_counts=True)
                    pairs.append(pair)
                    counts.append(times)
                    row = (number, doc_id, n_a, n_b, groups.count(b";") + 1 if groups else 0, len(links) // 8,
                           sha256(groups).hexdigest() if groups else "", pair.tobytes(), times.astype(np.int32).tobytes())
                    for x, v in zip(out.values(), row, strict=True):
                        x.append(v)
                    number += 1
                yield rows_of(out)
                distinct, of = np.unique(np.concatenate(pairs), return_inverse=True)
                sums = np.zeros(len(distinct), np.int64)
                np.add.at(sums, of, np.concatenate(counts))
                for pair, n in zip(distinct.tolist(), sums.tolist(), strict=True):
                    tally[pair] = tally.get(pair, 0) + n
                if len(tally) > TALLY:
                    yield rows_of({"pair": list(tally), "n": list(tally.values())})
                    tally = {}
        if tally:
            yield rows_of({"pair": list(tally), "n": list(tally.values())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


DOCUMENT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def summed(docs: DataFrame, pairs, counts, best) -> DataFrame:
    """Documents with the sums over their links of the given pairs, which are in order."""
    shared = docs.sparkSession.sparkContext.broadcast((pairs, counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known, count, top = shared.value
        for whole in batches:
            for b in slices(whole, whole.schema.get_field_index("links"), 8 << 20):
                links, times = (b.column(c).to_pylist() for c in ("links", "times"))
                ends = starts_of([len(x) // 8 for x in links])
                pair, n = np.frombuffer(b"".join(links), np.int64), np.frombuffer(b"".join(times), np.int32).astype(np.int64)
                at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                n = np.where(known[at] == pair, n, 0) if len(known) else np.zeros(len(n), np.int64)
                sums = [starts_of(n * of[at]) if len(known) else np.zeros(len(n) + 1, np.int64) for of in (top, count)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in DOCUMENT), *(pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums)],
                    names=[*DOCUMENT, "n_best", "count_sum"])

    return docs.select(*DOCUMENT, "links", "times").mapInArrow(
        run, ", ".join(f"{f} {'string' if 'sha' in f else 'long'}" for f in DOCUMENT) + ", n_best long, count_sum long")


def links_of(docs: DataFrame) -> DataFrame:
    """(row, pair, times): the distinct links of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for b in slices(whole, 1, 1 << 20):
                links, times = (b.column(c).to_pylist() for c in (1, 2))
                rows = np.repeat(b.column(0).to_numpy(), [len(x) // 8 for x in links])
                columns = (rows, np.frombuffer(b"".join(links), np.int64), np.frombuffer(b"".join(times), np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "pair", "times"])

    return docs.select("row", "links", "times").mapInArrow(run, "row long, pair long, times int")


def split(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The pairs above a power of two that at most ``most`` pairs reach, and the others."""
    level = F.floor(F.log2(F.col("count"))).cast("int")
    sizes = sorted((r for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)  # at most 63 rows
    least, held = 63, 0
    for at, n in sizes:
        held += n
        if held > most:
            break
        least = at
    return counts.where(level >= least), counts.where(level < least)


def align_documents(docs: DataFrame, path_a: str, path_b: str, pairs: int = PAIRS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    import numpy as np

    rows = stored(aligned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b), "aligned")
    documents = rows.where("pair IS NULL")
    counts = rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    counts = stored(counts.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best")), "pair-counts")
    frequent, others = split(counts, pairs)
    held = frequent.toPandas().sort_values("pair")  # at most ``pairs``
    out = summed(documents, *(held[c].to_numpy(np.int64) for c in ("pair", "count", "best")))
    if not others.isEmpty():
        rest = links_of(documents).join(others, "pair").groupBy("row").agg(
            F.sum(F.col("times") * F.col("best")).alias("best"), F.sum(F.col("times") * F.col("count")).alias("total"))
        more = lambda c, t: (F.col(c) + F.coalesce(F.col(t), F.lit(0))).alias(c)
        out = out.join(rest, "row", "left").select(*DOCUMENT, more("n_best", "best"), more("count_sum", "total"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
