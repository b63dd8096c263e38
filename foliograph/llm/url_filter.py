"""Operator 7: URL rules behind a blocked Bloom filter.

The listed canonical entries (host and path) fill a blocked Bloom filter, 512 bits a block, built in parallel and put
together block by block. Each URL offers its host's suffixes at dots with its path's prefixes, at the numbers of labels and
the prefix lengths that the list has; those that the filter lets pass are possible hits, and an exact join with the list
removes the false ones. The longest entry that is left decides.

The filter has at most ``max_bytes``, whatever the list's length: a longer list lets more false hits pass, never other
results. The shapes (labels, prefix length) that go with it are bounded too, as a host has at most 127 labels and a listed
path offers at most its first ``LONGEST_PATH`` characters; the rest of a longer one is compared after the join.

Defined results: a null URL or one without "://" has an empty host and path, fits no rule and gets the default verdict;
of rules of equal length the one with the longer host decides, then blocking; rules listed twice count once, null ones not
at all; URLs of any length are read whole; repeated rows give a row each; an empty table gives no rows and an empty list the
default verdict; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import ascii_lower

WORDS = 8  # 64-bit words a block
LONGEST_PATH = 4096
SALTS = (0x47B6137B44974D91, 0x8824AD5BA2B7289D, 0x705495C72DF1424B, 0x9EFC49475C6BFB31,
         0x5C6BFB3144974D91, 0xA2B7289D705495C7, 0x2DF1424B9EFC4947, 0x44974D9147B6137B)  # any odd numbers


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def places(hashes, blocks: int):
    """Block of each hash, and the eight bits it sets there as eight words."""
    import numpy as np

    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.stack([np.uint64(1) << ((hashes * np.uint64(s)) >> np.uint64(58)) for s in SALTS], axis=1)
    return block.astype(np.int64), bits


def hashed(keys: list[str]):
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)


class BlockedBloom:
    """The filter as one array of words, and the shapes of the entries in it."""

    def __init__(self, words, shapes: list[tuple[int, int]]):
        self.words, self.shapes = words, shapes

    def may_hold(self, keys: list[str]):
        block, bits = places(hashed(keys), len(self.words))
        return ((self.words[block] & bits) == bits).all(axis=1)

    def possible(self, hosts: list[str], paths: list[str]) -> list[list[str]]:
        """The keys of each URL that may be listed."""
        keys, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            labels = host.split(".")
            for n, length in self.shapes:
                if n <= len(labels) and length <= len(path):
                    keys.append(".".join(labels[-n:]) + "\n" + path[:length])
                    owner.append(i)
        out: list[list[str]] = [[] for _ in hosts]
        if keys:
            for j in self.may_hold(keys).nonzero()[0].tolist():
                out[owner[j]].append(keys[j])
        return out


def listed(rules: DataFrame) -> DataFrame:
    """(key, rule, host_length, verdict) of each listed entry, once; longer paths may share a key."""
    host, path = ascii_lower(F.col("host")), F.col("path")
    return (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(F.concat_ws("\n", host, F.left(path, F.lit(LONGEST_PATH))).alias("key"), F.concat(host, path).alias("rule"), "verdict",
                F.length(host).alias("host_length"))
        .groupBy("key", "rule", "host_length").agg(F.max("verdict").alias("verdict"))
    )


def build(rules: DataFrame, bits_per_key: int = 16, max_bytes: int = 8 << 20) -> BlockedBloom:
    """Fills the filter: each task makes the blocks it has keys for, equal blocks are or-ed."""
    import numpy as np

    entries = listed(rules)
    shape = entries.select(
        F.size(F.split(F.substring_index("key", "\n", 1), r"\.")).alias("labels"),
        F.least(F.length("rule") - F.col("host_length"), F.lit(LONGEST_PATH)).alias("length")).distinct()
    shapes = sorted((r[0], r[1]) for r in shape.collect())
    blocks = int(max(1, min(max_bytes // (8 * WORDS), entries.count() * bits_per_key // (64 * WORDS) + 1)))
    names = [f"w{i}" for i in range(WORDS)]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict = {}
        for b in batches:
            block, bits = places(hashed(b.column(0).to_pylist()), blocks)
            for at, x in zip(block.tolist(), bits, strict=True):
                own[at] = own[at] | x if at in own else x
        if own:
            words = np.array(list(own.values()), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), *(pa.array(words[:, i]) for i in range(WORDS))], names=["block", *names])

    made = entries.select("key").mapInArrow(fill, "block long, " + ", ".join(f"{n} long" for n in names))
    words = np.zeros((blocks, WORDS), np.uint64)
    for r in made.groupBy("block").agg(*(F.bit_or(n).alias(n) for n in names)).collect():  # at most max_bytes
        words[r[0]] = np.array(r[1:], np.int64).view(np.uint64)
    return BlockedBloom(words, shapes)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
          **size: int) -> DataFrame:
    """(page_id, host, path, rule, verdict): ``rules`` has host, path and verdict."""
    shared = pages.sparkSession.sparkContext.broadcast(build(rules, **size))
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"),
                        host.alias("host"), path.alias("path"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = shared.value.possible(b.column(2).to_pylist(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hits, pa.list_(pa.string()))], names=[*b.schema.names, "hits"])

    probed = urls.mapInArrow(probe, "row long, page_id long, host string, path string, hits array<string>")
    # only possible hits are joined; the other URLs have no key that could pile up
    possible = probed.where(F.size("hits") > 0).select("row", "page_id", "host", "path", F.explode("hits").alias("key"))
    free = probed.where(F.size("hits") == 0).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    weight = F.struct(F.length("rule").alias("length"), "host_length", "verdict", "rule")
    rest = F.substring("rule", F.col("host_length") + 1, F.length("rule"))
    met = possible.join(listed(rules), "key", "left").withColumn("hit", F.when(F.startswith("path", rest), weight))
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max("hit").alias("hit"))
    hits = best.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
    return hits.unionByName(free)
