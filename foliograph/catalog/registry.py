"""Query registry and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.plans.session import fit_partitions
from foliograph.sources.io import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one data folder as attributes, read lazily."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory.rstrip("/")
        self.counted: set[str] = set()

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        if name not in self.counted:  # from the footers
            self.counted.add(name)
            fit_partitions(self.spark, df.count())
        return df

    @property
    def texts(self) -> DataFrame:
        """The documents, ready for per-row text work."""
        return spread(self.spark.read.parquet(f"{self.directory}/documents.parquet"), "doc_id")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` and the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def r6(c) -> Column:
    """Six digits for comparison; the shift settles exact halves the same way in both engines."""
    return F.round(c + 1e-9, 6)


def s6(expression: str) -> str:
    """The SQL of :func:`r6`."""
    return f"round({expression} + 1e-9, 6)"
