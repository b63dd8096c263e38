"""BPE coding and packing against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
from llm_cases import copies_and_passages, documents, hard_texts
from tokenizers import Tokenizer

from foliograph.llm import bpe, packing

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "ing", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "é", "e\u0301", "İ", "Σ", "ΑΣ", "ß", "漢字", "😀", "\x1c", "\x85", "'s",
         "'ll", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "12", "½", "...", "\u0308", "\u200b", "Z", "!!", "\0", "\ufeff", "ﬁ", "각",
         "\u1100", "\u1161", "€", "$$$", "_"]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_encoders_on_odd_texts():
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    forced, chunks, decoder = bpe.ForcedBoundaryEncoder(WORD, remember=50), packing.ChunkEncoder(BYTE, remember=50), bpe.Decoder(WORD)
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for at in range(0, 3000, 30):
        part = texts[at : at + 30]
        for t, a, b in zip(part, forced.encode(part), chunks.encode(part), strict=True):
            e = word.encode(t, add_special_tokens=False)
            assert ids(a) == e.ids, repr(t)
            assert decoder.decode(a) == word.decode(e.ids, skip_special_tokens=False)
            assert ids(b) == byte.encode(t, add_special_tokens=False).ids, repr(t)


def test_forced_boundaries_are_token_limits():
    forced = bpe.ForcedBoundaryEncoder(WORD)
    word = "".join(w for c in ("qzx", "Ġ!x") for w in forced.words([c])[0])
    assert "".join(forced.split(word)) == word
    assert any(len(forced.split(a + b)) == 2 for a in "qzxj" for b in "qzxj")


def test_round_trip(spark):
    texts = hard_texts()
    library = Tokenizer.from_file(WORD)
    rows = bpe.decode(bpe.encode(documents(spark, texts), WORD), WORD).collect()
    assert len(rows) == len(texts)
    for r in rows:
        e = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert ids(bytes(r.ids)) == e
        assert r.decoded == library.decode(e, skip_special_tokens=False)
    assert bpe.encode(documents(spark, []), WORD).count() == 0


def test_differencing_beats_nothing_left_over():
    assert sorted(packing.differencing([8, 7, 6, 5, 4], 2)) in ([0, 0, 0, 1, 1], [0, 0, 1, 1, 1])
    rng = random.Random(2)
    sizes = [rng.randint(1, 512) for _ in range(600)]
    window = packing.windows_of(sizes, 2048)
    filled = [sum(s for s, w in zip(sizes, window, strict=True) if w == k) for k in set(window)]
    assert max(filled) <= 2048 and len(filled) <= -(-sum(sizes) // 2048) + 2
    assert packing.windows_of([2048, 2048, 1], 2048).count(0) == 1


def test_pack(spark):
    texts = hard_texts() + copies_and_passages()
    library = Tokenizer.from_file(BYTE)
    rows = packing.pack(documents(spark, texts).repartition(3), BYTE, group=40).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, pieces in by_doc.items():
        e = np.array([*library.encode(texts[i] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        pieces.sort(key=lambda r: r.start)
        assert b"".join(bytes(p.ids) for p in pieces) == e and all(p.doc_tokens == len(e) // 4 for p in pieces)
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert sum(p.length for p in pieces) <= 2048
    assert packing.pack(documents(spark, []), BYTE).count() == 0
