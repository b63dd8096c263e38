"""Operator 5: exact deduplication against a persistent digest index.

The index is a table of (digest, keep_id, copies), bucketed and sorted by digest. New rows are first combined to one row a
digest, then met with the index by a sort-merge anti-join on the bucketed side: digests that it lacks are appended with the
row that stays, known ones are appended as a count only. The index is never rewritten, its buckets are never shuffled, and
what a digest has gathered is the sum over its bucket.

Batches are taken newest first (largest ids first), as the row with the largest id stays. Within a batch the largest id
stays too.

Defined results: a null text counts as empty; texts are equal when they are identical after lower-casing A-Z; a text of any
length is hashed whole; rows with a null id never stay in a group that has an id, and share the null keep_id of a group that
has none; repeated rows count each, and are all kept if their id is the one that stays; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm.common import ascii_lower, stored
from foliograph.plans.session import ensure_checkpoint_dir


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """A digest table in a shared folder, bucketed and sorted by digest; ``buckets`` is fixed when it is made."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or f"{ensure_checkpoint_dir(spark)}/digests-{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digests_{uuid.uuid4().hex}"
        self.made = False

    def open(self) -> DigestIndex:
        """Names an index that an earlier session left at this path."""
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, copies BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        self.made = True
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _append(self, df: DataFrame) -> None:
        writer = df.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append")
        (writer if self.made else writer.option("path", self.path)).saveAsTable(self.table)
        self.made = True

    def add(self, digests: DataFrame) -> None:
        """Deduplicates a batch of (doc_id, digest) against the index and appends it."""
        batch = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("copies"))
        if not self.made:
            self._append(batch)
            return
        batch = batch.repartition(self.buckets, "digest")
        owned = self.rows().where("keep_id IS NOT NULL").select("digest")
        new = batch.join(owned.hint("merge"), "digest", "left_anti")
        known = batch.join(owned.hint("merge"), "digest", "left_semi").withColumn("keep_id", F.lit(None).cast("long"))
        self._append(stored(new.unionByName(known), "digest-batch"))

    def groups(self) -> DataFrame:
        """(digest, keep_id, group_size): one row a digest, added up inside its bucket."""
        return self.rows().groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("copies").alias("group_size"))


def deduplicate(docs: DataFrame, index: DigestIndex, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept) of every row; the rows pass the index in ``batches``, newest first.

    A row meets its group by a join of two shuffled tables, so Spark splits the partition of a hot digest.
    """
    digests = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("digest")), "digested")
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (low or 0, high or 0)
    step = max(1, -(-(high - low + 1) // batches))
    number = F.coalesce(F.floor((F.lit(high) - F.col("doc_id")) / step), F.lit(batches - 1))
    for n in range(batches):
        index.add(digests.where(number == n).select("doc_id", "digest"))
    groups = stored(index.groups(), "digest-groups")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return digests.join(groups, "digest").select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def without_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows that repeat both id and text one stays."""
    found = deduplicate(docs, index, id_col=id_col, text_col=text_col, **settings).where("NOT kept")
    gone = found.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct()
    mine = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), text_digest(F.col(text_col)).alias("digest"))
    left = mine.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")), "left_anti")
    return left.dropDuplicates(["id", "digest"]).select("row.*")
