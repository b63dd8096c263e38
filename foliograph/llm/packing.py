"""Operator 8: packing into sequences by Karmarkar-Karp multiway differencing.

Every document becomes its ids and one end id. Whole sequences are cut off first; the rest of each document, in pieces of
at most ``piece`` ids, goes to a group. In a group each piece starts as a partial partition into k windows with one window
filled. The two partial partitions with the largest differences are merged again and again, the fullest window of one with
the emptiest of the other, so that opposing imbalances cancel. k starts at the least possible number and rises by one while
a window exceeds the capacity. Groups are formed inside each partition of the input, so nothing is shuffled and a task holds
one group.

Defined results: a null or empty text is one end id; a text of any length is packed whole; repeated rows are packed each;
an empty table gives no rows; rows with a null id are packed like others; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.bpe import byte_alphabet
from foliograph.llm.common import Kept, slices, worker_state

# Fixed value: how byte-level tokenizers cut text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], k: int) -> list[int]:
    """The window of each size in the k-way partition that differencing finds."""
    import numpy as np

    n = len(sizes)
    if k == 1:
        return [0] * n
    # A partial partition: rising sums less the least of them, and for each window the tree of its pieces (-1: none).
    heap, trees = [], []
    for i, size in enumerate(sizes):
        sums, windows = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[-1], windows[-1] = size, i
        heap.append((-size, i, sums, windows))
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, a, wa = heapq.heappop(heap)
        _, _, b, wb = heapq.heappop(heap)
        sums, wb = a + b[::-1], wb[::-1]
        windows = np.where(wa < 0, wb, wa)
        for j in np.flatnonzero((wa >= 0) & (wb >= 0)):
            trees.append((int(wa[j]), int(wb[j])))
            windows[j] = n + len(trees) - 1
        order = np.argsort(sums, kind="stable")
        sums, windows = sums[order], windows[order]
        sums -= sums[0]
        heapq.heappush(heap, (-int(sums[-1]), count, sums, windows))
        count += 1
    window = [0] * n
    for w, root in enumerate(heap[0][3].tolist()):
        todo = [root] if root >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                window[x] = w
            else:
                todo += trees[x - n]
    return window


def windows_of(sizes: list[int], capacity: int) -> list[int]:
    """The window of each size; no window exceeds the capacity, and there are as few windows as differencing allows."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        window, filled = differencing(sizes, k), [0] * k
        for w, size in zip(window, sizes, strict=True):
            filled[w] += size
        if max(filled, default=0) <= capacity:
            return window
        k += 1


class ChunkEncoder:
    """Ids of whole texts by a byte-level tokenizer file.

    A space between two visible characters starts a new pre-token, so the chunks between such spaces are encoded once and
    their ids kept, at most ``remember`` bytes of them. Texts with other white space beside spaces, or with special tokens, go to the
    tokenizer whole. If ids rise with the merges, as usual, they are ranks too, and a rank encoder does the Latin chunks.
    """

    def __init__(self, path: str, remember: int = 128 << 20):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Kept(remember)
        with open(path, encoding="utf-8") as f:
            self.ranks = self.rank_encoder(json.load(f))

    def rank_encoder(self, spec: dict):
        """An encoder by token ranks that gives the same ids, or None if the file does not allow one."""
        import tiktoken

        model, pre = spec["model"], spec["pre_tokenizer"]
        vocab = {k: v for k, v in model["vocab"].items() if k not in self.special}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made) or len(vocab) != 256 + len(set(made)) or spec["normalizer"] or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"]:
            return None
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in k): v for k, v in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def learn(self, chunks: set[str]) -> None:
        """Encodes chunks, each but a text's first with the space before it; those with white space at an end stay unknown."""
        from array import array

        new, rest, size = self.known.new, [], 0
        ranked = self.ranks.encode_ordinary if self.ranks else None
        for c in chunks:
            b = c[1:] if c[:1] == " " else c
            if b and b.strip() == b:
                if ranked and (c.isascii() or max(c) < "\u0100"):
                    ids = new[c] = array("I", ranked(c)).tobytes()
                    size += len(c) + len(ids)
                else:
                    rest.append(c)
        for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            ids = new[c] = array("I", e.ids).tobytes()
            size += 4 * len(c) + len(ids)
        self.known.size += size + 180 * len(chunks)  # and what the objects take

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        from array import array

        out = []
        for at in range(0, len(texts), 512):
            part = texts[at : at + 512]
            whole = [any(s in t for s in self.special) or "\0" in t for t in part]
            chunks = [[] if w else t.replace(" ", "\0 ").split("\0") for t, w in zip(part, whole, strict=True)]
            self.learn(self.known.missing(set().union(*chunks)))
            get = self.known.new.__getitem__
            for t, w, p in zip(part, whole, chunks, strict=True):
                try:
                    out.append(b"".join(map(get, [t] if w else p)))
                except KeyError:  # white space that the split does not cover
                    out.append(array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes())
        return out


def cut(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences first, then pieces of at most ``piece``."""
    full = n // capacity
    out = [(i * capacity, capacity) for i in range(full)]
    return out + [(s, min(piece, n - s)) for s in range(full * capacity, n, piece)]


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, piece: int = 512, group: int = 768,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, where it starts there, its ids, and its sequence and offset in it.

    ``group`` is the number of pieces that are packed together, ``piece`` the longest piece of a document's rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_state(("chunks", path), lambda: ChunkEncoder(path))
        context = TaskContext.get()
        number = ((context.partitionId() if context else 0) << 36) - 1
        end, waiting = end_id.to_bytes(4, "little"), []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            fields = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            kinds = [pa.binary() if f == "ids" else pa.int64() for f in fields]
            columns = zip(*found, strict=True) if found else [[]] * len(fields)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=fields)

        def packed(group_of: list[tuple]) -> list[tuple]:
            nonlocal number
            out, filled = [], {}
            window = windows_of([p[2] for p in group_of], capacity)
            named = {w: number + 1 + i for i, w in enumerate(sorted(set(window)))}
            number += len(named)
            for p, w in zip(group_of, window, strict=True):
                out.append((*p, named[w], filled.get(w, 0)))
                filled[w] = filled.get(w, 0) + p[2]
            return out

        for batch in batches:
            for b in slices(batch):
                out = []
                for doc, ids in zip(b.column(0).to_pylist(), encoder.encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start, length in cut(n, capacity, piece):
                        row = (doc, start, length, ids[4 * start : 4 * (start + length)], n)
                        if length == capacity:
                            number += 1
                            out.append((*row, number, 0))
                        else:
                            waiting.append(row)
                while len(waiting) >= group:
                    out += packed(waiting[:group])
                    waiting = waiting[group:]
                yield rows(out)
        if waiting:
            yield rows(packed(waiting))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)
