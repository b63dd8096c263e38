"""The registered queries without SQL against the libraries, plain versions and what must hold."""

import hashlib
import math
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import UP
from tokenizers import Tokenizer

from foliograph.llm import quality
from foliograph.llm.queries import BYTE_BPE, QUERIES, WORD_BPE

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()}


def test_op1(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    rows = QUERIES["op1_bpe"](spark, DIRECTORY).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_op2(spark, texts):
    """The compiled score is the logistic of the weights of the rules that hold, and rows held out are not learned from."""
    docs, labels = (spark.read.parquet(f"{DIRECTORY}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    assert model.rules
    rows = {r.doc_id: r for r in QUERIES["op2_quality"](spark, DIRECTORY).collect()}
    assert sorted(rows) == sorted(texts)
    for i, t in texts.items():
        s = quality.statistics(t)
        total = model.intercept + sum(w for rule, w in model.rules if all(s[f] > x if above else s[f] <= x for f, above, x in rule))
        assert abs(rows[i].score - 1 / (1 + math.exp(-total))) < 1e-9
        assert rows[i].predicted == (rows[i].score >= 0.5) and rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    unseen = labels.where(~quality.held_out(labels.doc_id))
    assert [r for r, _ in quality.fit(docs, unseen).rules] == [r for r, _ in model.rules]


def test_op3(spark, texts):
    """Pseudonyms keep the format, are the same for equal values, and leave the rest alone."""
    rows = {r.doc_id: r for r in QUERIES["op3_pii"](spark, DIRECTORY).collect()}
    assert sorted(rows) == sorted(texts)
    seen: dict = {}
    for i, t in texts.items():
        out = rows[i].text
        if rows[i].n_replaced == 0:
            assert out == t
        for kind in (r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\d{4}-\d{2}-\d{2}"):
            found, made = re.findall(kind, t), re.findall(kind, out)
            assert len(found) == len(made)
            for a, b in zip(found, made, strict=True):
                assert seen.setdefault((kind, a), b) == b
    for kind in {k for k, _ in seen}:
        made = [b for (k, _), b in seen.items() if k == kind]
        assert len(set(made)) == len(made)


def test_op8(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    rows = QUERIES["op8_packing"](spark, DIRECTORY).collect()
    places, sequences = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        places.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in places.items():
        assert [s for s, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]] and sum(n for _, n in parts) == len(ids[i])
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]] and sum(n for _, n in parts) <= 2048
    assert set(places) == set(ids) and sum(map(len, ids.values())) > 0.9 * 2048 * (len(sequences) - 1)


def test_op10(spark, texts):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    rows = {r.doc_id: r for r in QUERIES["op10_licenses"](spark, DIRECTORY).collect()}
    assert sorted(rows) == sorted(texts)
    for i, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(UP))
        found = [(at, label) for p, label in phrases.items() for at in range(len(w)) if tuple(w[at : at + len(p)]) == p]
        r = rows[i]
        assert (r.n_words, r.n_base) == (len(w), len(found))
        assert (r.first_word, r.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
