"""Exact, near and substring dedup against brute force."""

import hashlib
import random

import pytest
from llm_cases import UP, copies_and_passages, documents, hard_texts, near_components, without_repeats

from foliograph.llm import exact_dedup, near_dedup, substrings


def test_exact(spark):
    texts = hard_texts() + copies_and_passages() + ["Same", "sAME", "ÉTÉ", "été"]
    ids = list(range(len(texts)))
    df = documents(spark, [*texts, "Same", "only null"], [*ids, None, None])
    got = exact_dedup.deduplicate(df, exact_dedup.DigestIndex(spark, buckets=4), batches=3).collect()
    assert len(got) == len(texts) + 2
    groups = {}
    for i, t in zip([*ids, None, None], [*texts, "Same", "only null"], strict=True):
        groups.setdefault((t or "").translate(UP), []).append(i)
    want = {}
    for t, members in groups.items():
        keep = max((i for i in members if i is not None), default=None)
        for i in members:
            want[(i, hashlib.sha256(t.encode()).digest())] = (keep, len(members), i == keep)
    assert {(r.doc_id, bytes(r.digest)): (r.keep_id, r.group_size, r.kept) for r in got} == want
    assert exact_dedup.deduplicate(documents(spark, []), exact_dedup.DigestIndex(spark, buckets=2)).count() == 0


def test_exact_keeps_an_index(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    exact_dedup.deduplicate(documents(spark, ["a", "b", "a"], [10, 11, 12]), index, batches=1)
    later = exact_dedup.DigestIndex(spark, path=index.path, buckets=4).open()
    got = exact_dedup.deduplicate(documents(spark, ["b", "c", "C"], [1, 2, 3]), later, batches=1)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()} == {(1, 11, 2, False), (2, 3, 2, False), (3, 3, 2, True)}
    plan = later.groups()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the buckets are added up where they lie


def test_without_copies(spark):
    df = documents(spark, ["x", "X", "y", "y", None, ""], [1, 2, 3, 3, 4, None])
    out = exact_dedup.without_copies(df, exact_dedup.DigestIndex(spark, buckets=2))
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(2, "X"), (3, "y"), (4, None)]


@pytest.mark.parametrize("tile", [256, 4])
def test_near(spark, tile):
    texts = hard_texts() + copies_and_passages()
    base = copies_and_passages(9)[0].split()
    base = (base * 40)[:90]
    crowd = [" ".join([*base[:k], f"c{k}", *base[k + 1 :], f"t{k % 3}"]) for k in range(12)]
    rows = list(enumerate(texts + crowd))
    got = near_dedup.near_duplicates(documents(spark, [t for _, t in rows]), tile=tile).collect()
    want = near_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (n, c, c == i) for i, (n, c) in want.items()}
    assert len(got) == len(rows)


@pytest.mark.parametrize("cell", [1024, 8])
def test_near_links_inside_a_common_passage(spark, cell):
    """The first and the last document of every key are unlike the others, which are alike in pairs of similar size."""
    rng = random.Random(6)
    own = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passage = [f"p{i}" for i in range(64)]
    texts = [" ".join(passage + own(200))] + [" ".join(passage + own(rng.choice([3, 5, 30]))) for _ in range(40)]
    texts += [" ".join(own(2) + passage + own(3)) for _ in range(10)] + [" ".join(own(150) + passage)]
    got = near_dedup.near_duplicates(documents(spark, texts), cell=cell, tile=16).collect()
    want = near_components(list(enumerate(texts)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_nulls_and_repeats(spark):
    t = "one two three four five six seven"
    got = near_dedup.near_duplicates(documents(spark, [t, t, t, "", None, "zz"], [5, 5, None, 6, 7, 8])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [
        (False, 5, 5, True), (False, 5, 5, True), (False, 6, 6, True), (False, 7, 7, True), (False, 8, 8, True)]
    assert [r.kept for r in got if r.doc_id is None] == [True]
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_registers_estimate():
    import numpy as np

    rng = np.random.default_rng(1)
    all_ = np.unique(rng.integers(0, 1 << 63, 6000, dtype=np.uint64) * np.uint64(2))
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        common = int(len(all_) * share)
        a, b = np.sort(all_[: (len(all_) + common) // 2]), np.sort(all_[(len(all_) - common) // 2 :])
        truth = len(np.intersect1d(a, b)) / len(all_)
        guess, _ = near_dedup.estimates(*(near_dedup.registers_of(x)[None, :] for x in (a, b)), np.array([len(a)]), np.array([len(b)]))
        errors.append(abs(guess[0] - truth))
    assert max(errors) < 0.18
    h = np.array([1, 1 << 56, (1 << 57) - 1, 1 << 60], np.uint64)
    r = near_dedup.registers_of(h)
    assert (r != near_dedup.EMPTY).sum() == 2


def test_bands_miss_no_pair():
    import numpy as np

    rng, banding, missed = np.random.default_rng(4), near_dedup.Banding(), 0
    for n in (165, 220, 400, 1500):
        for _ in range(150):
            change = n // 9  # similarity 0.8
            x = rng.integers(0, 1 << 63, n + change, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            a, b = (near_dedup.registers_of(np.sort(s)) for s in (x[:n], x[change:]))
            missed += not len(np.intersect1d(banding.keys(a), banding.keys(b)))
    assert missed == 0


def test_roots(spark):
    path = [(i, i + 1) for i in range(1, 60)] + [(100 - i, 99 - i) for i in range(20)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r.id: r.root for r in near_dedup.roots(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 80 for i in range(80, 101)} | {i: 500 for i in range(500, 540)}
    assert near_dedup.roots(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("hot", "heavy"), [(200, 20_000), (1, 20_000), (1, 400), (1, 1)])
def test_substrings(spark, hot, heavy):
    texts = hard_texts() + copies_and_passages() + ["z " * 300, "z " * 60, "z " * 49]
    rows = list(enumerate(texts))
    got = substrings.remove_repeats(documents(spark, texts), hot=hot, heavy=heavy).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == without_repeats(rows)
    assert len(got) == len(rows)


def test_substrings_nulls_and_repeats(spark):
    t = " ".join(f"v{i}" for i in range(80))
    got = substrings.remove_repeats(documents(spark, [t, t, t, t], [4, 4, None, 9])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (4, 0), (4, 0), (9, 80)]
    assert substrings.remove_repeats(documents(spark, [])).count() == 0
