"""Session building and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are written for. AQE splits skewed join partitions and turns a shuffle join into a
# broadcast join only when the measured side is small, so no operator needs a size guess of its own.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Set before the session starts: checkpoint files go when nothing refers to them any more.
STATIC = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Gives a session of a cluster the runtime settings the operators are written for."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


# What one task of a shuffle takes, whatever the size of the input: rows of a table and bytes after compression. Ids compress to a
# tenth of their size and joins multiply rows, so the 64 MB that AQE puts together by default fill gigabytes of a task.
ROWS_A_PARTITION = 100_000
BYTES_A_PARTITION = 8 << 20


def fit_partitions(spark: SparkSession, rows: int) -> None:
    """Shuffle partitions that grow with the rows of a table, so that the memory of a task does not; numbers set higher stay."""
    parts = -(-rows // ROWS_A_PARTITION)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(BYTES_A_PARTITION))


def local_session(app: str = "foliograph", cpus: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (RUNTIME | STATIC).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the cluster names, or a temporary one in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="foliograph-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that loops keep short plans and survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder.

    For loops of joins: a checkpoint keeps the conditions that are known about its columns, and they multiply from round to round
    until planning takes longer than the work; a table that is read back knows none.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
