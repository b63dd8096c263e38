"""Shuffle partitions follow the rows of the tables, so that the memory of a task does not."""

from foliograph.catalog.registry import Tables
from foliograph.plans import session

PARTS, ADVISED = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_partitions_grow_with_the_rows(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "lineitem.parquet"))
    before, advised = spark.conf.get(PARTS), spark.conf.get(ADVISED)
    try:
        assert Tables(spark, str(tmp_path)).lineitem.count() == 1000 and spark.conf.get(PARTS) == before
        monkeypatch.setattr(session, "ROWS_A_PARTITION", 10)
        assert Tables(spark, str(tmp_path)).lineitem.count() == 1000
        assert spark.conf.get(PARTS) == "100" and spark.conf.get(ADVISED) == str(session.BYTES_A_PARTITION)
        session.fit_partitions(spark, 20)  # a small table takes nothing back
        assert spark.conf.get(PARTS) == "100"
    finally:
        spark.conf.set(PARTS, before)
        spark.conf.set(ADVISED, advised)
