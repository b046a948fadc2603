"""A session with the settings the queries are written for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("bandlex")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # the default of 100 drops compiled code between two runs of a larger query
        "spark.sql.codegen.cache.maxEntries": "2000",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A folder for tables that later steps read: the shared one that ``spark.checkpoint.dir``
    names, and on a local session without that setting one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or tempfile.mkdtemp(prefix="bandlex-")).rstrip("/")
