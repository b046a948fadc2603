"""Computing a table once when several jobs need it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(table: DataFrame) -> DataFrame:
    """The table, computed once.

    Where the session names a shared folder in ``spark.checkpoint.dir``, it is read back
    from a checkpoint there, which survives the loss of executors.  Elsewhere it is
    persisted by Spark and keeps its lineage, so what is lost is computed again.
    """
    context = table.sparkSession.sparkContext
    folder = table.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and folder is not None:
        context.setCheckpointDir(folder)
    return table.persist() if context.getCheckpointDir() is None else table.checkpoint()


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is removed as it ends, and not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settle_large(table: DataFrame) -> DataFrame:
    """As `settle`, for a table that grows with the text.

    Where the session names a shared folder, it is Parquet there, a small part of the size of
    a checkpoint, and what was shuffled to make it leaves the disks before the next step.
    """
    spark = table.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        return table.persist()
    path = f"{folder.rstrip('/')}/settled-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        table.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(table.schema).parquet(path)
