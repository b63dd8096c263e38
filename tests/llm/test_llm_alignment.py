"""Alignment of two tokenizers against a plain walk over the token bytes, and the registered query."""

import hashlib
import os
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import documents, hard_texts, words
from tokenizers import Tokenizer

from foliograph.llm import alignment
from foliograph.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATHS = [public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)]
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(rows):
    """The result for (id, text) rows: ends as sets, links by comparing byte ranges of neighbouring tokens."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in visible}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in visible)}
    bytes_a = lambda i: bytes(letters[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>"
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs = []
    for i, t in rows:
        x, y = ([], []) if not t else (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t))
        ranges = []
        for ids, of in ((x, bytes_a), (y, bytes_b)):
            at, out = 0, []
            for n in ids:
                out.append((at, at + len(of(n)), n))
                at = out[-1][1]
            ranges.append(out)
        if not t or any(b"".join(of(n) for n in ids) != (" " + t).encode() for ids, of in ((x, bytes_a), (y, bytes_b))):
            docs.append((i, [], [], [], ""))
            continue
        links, j = [], 0
        for lo, hi, n in ranges[0]:
            while ranges[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(ranges[1]) and ranges[1][k][0] < hi:
                links.append((n, ranges[1][k][2]))
                k += 1
        ends = sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]})
        groups, i0, i1 = [], 0, 0
        for e in ends:
            g = []
            for r, at in ((ranges[0], i0), (ranges[1], i1)):
                stop = at
                while stop < len(r) and r[stop][1] <= e:
                    stop += 1
                g.append(",".join(str(n) for _, _, n in r[at:stop]))
                i0, i1 = (stop, i1) if r is ranges[0] else (i0, stop)
            groups.append("|".join(g))
        docs.append((i, x, y, links, ";".join(groups)))
    counts = Counter(p for d in docs for p in d[3])
    top: dict = {}
    for (_, n), c in counts.items():
        top[n] = max(c, top.get(n, 0))
    return sorted(
        ((i, len(x), len(y), g.count(";") + 1 if g else 0, len(p), sum(counts[q] == top[q[1]] for q in p), sum(counts[q] for q in p),
          hashlib.sha256(g.encode()).hexdigest() if g else "") for i, x, y, p, g in docs), key=str)


def got(df):
    assert df.columns == list(COLUMNS)
    assert all(t == "bigint" for _, t in df.dtypes[:-1])
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = ["▁ marks", "two  spaces   three\n\n lines \n end ", " lead", "<s> </s> <unk> <0x41> <|endoftext|>", "﻿mark", "é ẛ̣ ﬁ",
       "日本語 テキスト", "a" * 3000, "  wide", "I'll we're 12 345,678"]


@pytest.mark.parametrize("sizes", [{}, {"pairs": 20}, {"pairs": 0}])
def test_plain_walk(spark, sizes):
    texts = [*hard_texts(), *ODD, *(" ".join(words(40, s, 0, 60)) for s in range(30))]
    ids = [None, *range(1, len(texts) - 1), 1]  # a null and a repeated id
    want = plain(list(zip(ids, texts, strict=True)))
    assert got(alignment.align_documents(documents(spark, texts, ids), *PATHS, **sizes)) == want


def test_long_window():
    """A text without spaces is one window."""
    held = alignment.Aligner(*PATHS)
    (n_a, n_b, groups, links), = held.documents(["ab" * 200_000])
    assert len(links) // 8 == n_a + n_b - groups.count(b";") - 1
    assert len(held.kept.new) == 1


def test_forgetting(monkeypatch):
    """Kept alignments are forgotten when they exceed their bound, and made again."""
    texts = [" ".join(words(60, s, 0, 40)) for s in range(6)]
    want = alignment.Aligner(*PATHS).documents(texts)
    monkeypatch.setattr(alignment, "KEPT_BYTES", 5000)
    held = alignment.Aligner(*PATHS)
    for _ in range(2):
        assert [held.documents([t])[0] for t in texts] == want
        assert len(held.kept.new) + len(held.kept.old) < 100


def test_tallies(spark, monkeypatch):
    """Counts that a task passes on in parts add up."""
    monkeypatch.setattr(alignment, "TALLY", 10)
    texts = [" ".join(words(30, s, 0, 50)) for s in range(9)]
    assert got(alignment.align_documents(documents(spark, texts).coalesce(1), *PATHS)) == plain(list(enumerate(texts)))


def test_empty(spark):
    assert got(alignment.align_documents(documents(spark, ["x"]).where("doc_id < 0"), *PATHS)) == []
    assert got(alignment.align_documents(documents(spark, [None, ""]), *PATHS)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(2)]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()]
    assert got(QUERIES["op12_alignment"](spark, DIRECTORY)) == plain(rows)
