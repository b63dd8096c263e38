"""VC-1: the hash-keyed vector cache refreshed between loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.plans.shapes import union_priority


def refreshed_cache(texts: DataFrame, cache: DataFrame, imported: DataFrame | None = None, key: str = "hash",
                    ) -> DataFrame:
    """Vectors still in use: one per hash, an imported one replacing the cached one, vanished texts dropped."""
    parts = [cache] if imported is None else [imported, cache]
    merged = union_priority([p.select(key, "vec") for p in parts], [key])
    return merged.join(texts.select(key).distinct(), key, "left_semi")


def missing_texts(texts: DataFrame, cache: DataFrame, limit: int | None = None, key: str = "hash",
                  order: str = "doc_uid") -> DataFrame:
    """Texts without a vector, the first ``limit`` if asked; equal texts are listed once."""
    waiting = texts.join(cache.select(key), key, "left_anti").groupBy(key).agg(F.min(order).alias(order))
    return waiting if limit is None else waiting.orderBy(order).limit(limit)


def cache_report(texts: DataFrame, cache: DataFrame, key: str = "hash") -> DataFrame:
    """Texts, distinct texts, cached vectors and coverage, as one row."""
    known = cache.select(key).distinct().withColumn("_known", F.lit(True))
    return texts.join(known, key, "left").agg(
        F.count("*").alias("n_texts"), F.countDistinct(key).alias("n_hashes"),
        F.count("_known").alias("n_covered"), F.avg(F.coalesce("_known", F.lit(False)).cast("double")).alias("coverage"))


class VectorStore:
    """VC-1 between loads: vectors by the hash of their text, kept in a folder that grows by one generation a load.

    A generation is one partition with the vectors that its load computed or imported, sorted by hash; nothing is rewritten. The
    newest generation of a hash counts. A load that is run again under its name replaces its own generation, so a lost driver
    does no harm. Names of loads sort in their order. :meth:`compact` keeps what is still in use as one generation.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "hash"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _stored(self) -> DataFrame | None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(hadoop) or not len(files.listStatus(hadoop)):
            return None
        return self.spark.read.schema(f"{self.key} string, vec array<double>, load string").parquet(self.path)

    def vectors(self, before: str | None = None) -> DataFrame:
        """(hash, vec): the newest vector of every hash, of the loads before one if asked."""
        held = self._stored()
        if held is None:
            return self.spark.createDataFrame([], f"{self.key} string, vec array<double>")
        held = held if before is None else held.where(F.col("load") < before)
        newest = F.max_by("vec", "load").alias("vec")
        return held.groupBy(self.key).agg(newest)

    def add(self, load: str, vectors: DataFrame) -> None:
        """Stores the generation of a load in the place of an earlier run of it."""
        rows = vectors.select(self.key, F.col("vec").cast("array<double>").alias("vec"), F.lit(load).alias("load")).dropDuplicates([self.key])
        (rows.repartition(self.key).sortWithinPartitions(self.key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(self.path))

    def refresh(self, load: str, texts: DataFrame, embed, imported: DataFrame | None = None) -> DataFrame:
        """(hash, vec) of the distinct texts: known vectors are kept, only new texts go to ``embed``.

        ``texts(hash, ...)``; ``embed`` maps the rows of the texts without a vector, one a hash, to (hash, vec). Imported vectors replace
        stored ones. Null hashes have no vector.
        """
        known = self.vectors(load)
        new = imported.select(self.key, "vec") if imported is not None else None
        have = known.select(self.key) if new is None else known.select(self.key).unionByName(new.select(self.key))
        waiting = texts.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]).join(have, self.key, "left_anti")
        made = embed(waiting).select(self.key, "vec")
        self.add(load, made if new is None else made.unionByName(new))
        return self.vectors().join(texts.select(self.key).distinct(), self.key, "left_semi")

    def compact(self, load: str, texts: DataFrame, path: str) -> VectorStore:
        """A store at ``path`` with one generation: the vectors whose texts still exist."""
        out = VectorStore(self.spark, path, self.key)
        out.add(load, self.vectors().join(texts.select(self.key).distinct(), self.key, "left_semi"))
        return out
