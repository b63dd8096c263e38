"""Operator 1: BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never be merged, neither directly nor as part of
a longer token, so every such pair marks a place where two tokens certainly meet. Words are cut there, and also at the
spaces, special tokens and pre-token limits of the tokenizer file; every fragment is encoded on its own and the ids are
concatenated. The result is the same as that of encoding the whole text, and a worker needs to merge each distinct
fragment once only.

Defined results: a null text is an empty one and has no ids; a text of any length is encoded whole; repeated rows each
give their row; an empty table gives an empty result; other columns of the input are not read and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import Kept, slices, worker_state

ENCODED = "doc_id long, ids binary"


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible, else the next free one."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ForcedBoundaryEncoder:
    """Encodes texts as the tokenizer file at ``path`` does, fragment by fragment.

    ``remember`` bounds the bytes of the chunks and fragments whose ids are kept.
    """

    def __init__(self, path: str, remember: int = 192 << 20):
        import json
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        # within a word no symbol carries the suffix, at its end the last one does
        self.last = self.merger(spec["model"], self.suffix)
        self.inner = self.merger(spec["model"], "") if self.suffix else self.last
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre = whole.normalizer, whole.pre_tokenizer
        self.special = {t["content"]: int(t["id"]).to_bytes(4, "little") for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # separators to Python that are visible characters to the tokenizer
        self.odd = re.compile("[\x1c-\x1f]")
        self.space = re.compile("[ \\t\\n\\v\\f\\r]+")
        self.joined = self.pairs_within(spec["model"]["vocab"])
        self.chunks, self.ends = Kept(remember // 2), Kept(remember // 4)
        self.inners = Kept(remember // 4) if self.suffix else self.ends

    def merger(self, model: dict, suffix: str):
        """A tokenizer that merges fragments, given with spaces between them."""
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import WhitespaceSplit

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        out = Tokenizer(BPE(vocab=model["vocab"], merges=merges, **({"end_of_word_suffix": suffix} if suffix else {})))
        out.pre_tokenizer = WhitespaceSplit()
        return out

    def pairs_within(self, vocab: dict[str, int]) -> set[str]:
        """Pairs of neighbouring symbols inside some token; every other pair is a certain cut."""
        pairs = set()
        for token in vocab:
            if token not in self.special:
                token = token.removesuffix(self.suffix) if self.suffix else token
                pairs.update(map("".join, zip(token, token[1:], strict=False)))
        return pairs

    def split(self, word: str) -> list[str]:
        """A word of byte symbols, cut at forced boundaries."""
        from operator import concat

        if self.joined.issuperset(map(concat, word, word[1:])):
            return [word]
        start, out = 0, []
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.joined:
                out.append(word[start:i])
                start = i
        return [*out, word[start:]]

    def words(self, chunks: list[str]) -> list[list[str]]:
        """The pre-tokens of each chunk; all are cut together with spaces between them, if they hold no other space."""
        text = " ".join(chunks)
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        if text.count(" ") != len(chunks) - 1:
            return [self.words([c])[0] for c in chunks] if len(chunks) > 1 else [[w for w, _ in self.pre.pre_tokenize_str(text)]]
        found: list[list[str]] = []
        end = -1
        starts = [len(c) + 1 for c in text.split(" ")]
        for word, (at, _) in self.pre.pre_tokenize_str(text):
            while at > end:
                end += starts[len(found)]
                found.append([])
            found[-1].append(word)
        return found + [[] for _ in range(len(chunks) - len(found))]

    def merge(self, model, known: Kept, wanted: set[str]) -> None:
        fragments = list(known.missing(wanted))
        if not fragments:
            return
        e = model.encode(" ".join(fragments), add_special_tokens=False)
        ids, of = e.ids, e.word_ids
        start, n = 0, len(ids)
        for i, f in enumerate(fragments):
            stop = start
            while stop < n and of[stop] == i:
                stop += 1
            known.add(f, b"".join([x.to_bytes(4, "little") for x in ids[start:stop]]))
            start = stop

    def learn(self, chunks: list[str]) -> None:
        """Encodes chunks that were not met before."""
        cut = [[self.split(w) for w in ws] for ws in self.words(chunks)]
        last = {w[-1] for ws in cut for w in ws}
        inner = {f for ws in cut for w in ws if len(w) > 1 for f in w[:-1]}
        if self.suffix:
            self.merge(self.last, self.ends, last)
            self.merge(self.inner, self.inners, inner)
        else:
            self.merge(self.last, self.ends, last | inner)
        ends, inners = self.ends.new, self.inners.new
        for c, ws in zip(chunks, cut, strict=True):
            self.chunks.add(c, b"".join([x for w in ws for x in (*(inners[f] for f in w[:-1]), ends[w[-1]])]))

    def plain(self, texts: list[str]) -> list[bytes]:
        """Texts without special tokens. Tokens never reach over white space, so the chunks between come first."""
        out = []
        for first in range(0, len(texts), 256):
            parts = [self.space.split(t) if self.odd.search(t) else t.split() for t in texts[first : first + 256]]
            missing = self.chunks.missing(set().union(*parts))
            if "" in missing:
                self.chunks.add("", b"")
                missing.remove("")
            if missing:
                self.learn(list(missing))
            get = self.chunks.new.__getitem__
            out += [b"".join(map(get, p)) for p in parts]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.at_special is None or not any(s in t for s in self.special for t in texts):
            return self.plain(texts)
        out = []
        for t in texts:
            parts = self.at_special.split(t)
            ids = iter(self.plain(parts[::2]))
            out.append(b"".join(self.special[p] if i % 2 else next(ids) for i, p in enumerate(parts)))
        return out


class Decoder:
    """Tokens of ids, joined as the tokenizer file's decoder says."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.tokens = [whole.id_to_token(i) for i in range(max(whole.get_vocab().values()) + 1)]
        self.whole = whole if whole.decoder is not None else None

    def decode(self, ids: bytes) -> str:
        import numpy as np

        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.whole is not None:
            return self.whole.decode(numbers, skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, numbers))


class Coder:
    """The encoder and the decoder of one tokenizer file, each made when it is first asked for."""

    def __init__(self, path: str):
        self.path, self.encoder, self.decoder = path, None, None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        self.encoder = self.encoder or ForcedBoundaryEncoder(self.path)
        return self.encoder.encode([t or "" for t in texts])

    def decode(self, ids: list[bytes]) -> list[str]:
        self.decoder = self.decoder or Decoder(self.path)
        return [self.decoder.decode(x) for x in ids]


def coder(path: str) -> Coder:
    return worker_state(("bpe", path), lambda: Coder(path))


def coded(docs: DataFrame, path: str, back: bool, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = coder(path)
        for whole in batches:
            for b in slices(whole):
                ids = held.encode(b.column(1).to_pylist())
                decoded = [pa.array(held.decode(ids), pa.string())] if back else []
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), *decoded], names=["doc_id", "ids", "decoded"][: 2 + back])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, ENCODED + ", decoded string" * back)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian unsigned 32-bit integers."""
    return coded(docs, path, False, id_col, text_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ``decode`` of ``encode``, in one Python worker a task."""
    return coded(docs, path, True, id_col, text_col)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the text that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = coder(path)
        for whole in batches:
            for b in slices(whole):
                texts = held.decode(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"{ENCODED}, decoded string")
