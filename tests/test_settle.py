"""Settling computes a table once, with and without a shared folder."""

from bandlex.plans import settle as module
from bandlex.plans.settle import CLEANUP, settle, settle_large
from pyspark.sql import functions as F


def times_computed(spark, table):
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    settled = settle(table.mapInArrow(count, table.schema))
    assert settled.count() == settled.where("id >= 0").count() == 100
    return counter.value / 100


def test_once_on_any_master(spark, tmp_path):
    source = open(module.__file__).read()
    assert "tempfile" not in source and "master" not in source
    table = spark.range(100, numPartitions=3)
    assert times_computed(spark, table) == 1
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    settled = settle(table)
    assert "ExistingRDD" in settled._jdf.queryExecution().executedPlan().toString()
    assert times_computed(spark, table) == 1


def shuffled(spark):
    """Names of the shuffle files on this machine's disks."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (folders.apply(i).getName() for i in range(folders.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_what_was_shuffled_for_a_large_table_is_removed(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    before, was = shuffled(spark), spark.conf.get(CLEANUP, None)
    table = spark.range(10000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    settled = settle_large(table)
    assert shuffled(spark) <= before and spark.conf.get(CLEANUP, None) == was
    assert settled.count() == 1000 and settled.agg(F.sum("n")).first()[0] == 10000
    assert "FileScan parquet" in settled._jdf.queryExecution().executedPlan().toString()
    settle(table.groupBy("n").count())
    assert shuffled(spark) - before  # these are the names of files that stay otherwise
