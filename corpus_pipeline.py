"""A corpus pipeline of five stages over ``documents``: quality, exact copies, near copies, personal data, packing.

Each stage works on all rows that its predecessor kept. Stages but the last return the columns of ``documents``. Null texts
count as empty and null ids stay with their rows, as the operators say; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import exact_dedup, near_dedup, packing, pii, quality
from foliograph.llm.common import stored
from foliograph.llm.queries import BYTE_BPE, PII_KEY, table

# The near-dedup stage compares shingles of five words; the four words of op6_near_dedup are for that query only.
STAGE_SHINGLE = 5

# The stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones that are not held out."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return exact_dedup.without_copies(docs, exact_dedup.DigestIndex(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.without_near_copies(docs, shingle=STAGE_SHINGLE)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; n_chars follows the text."""
    return pii.pseudonymise(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("near-dedup", drop_near_copies),
    ("personal data", hide_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, f"stage-{n}")
    return docs
