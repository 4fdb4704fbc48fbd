"""Steps of a query that write their result leave no shuffle files behind."""

import os

from pyspark.sql import functions as F

from tallyworks.operators.ordering import DROP_SHUFFLES, number_rows
from tallyworks.sources import commit_tables, replace_partition, save_intermediate


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for _, _, files in os.walk(folder.getPath()) for f in files if f.startswith("shuffle_")}


def counted(spark, n=5_000):
    return spark.range(n).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n"))


def test_written_steps_leave_no_shuffle_files(spark, tmp_path):
    setting = spark.conf.get(DROP_SHUFFLES)
    before = shuffle_files(spark)
    saved = save_intermediate(counted(spark), "counted")
    commit_tables(spark, str(tmp_path / "root"), "first", {"counted": counted(spark)})
    replace_partition(counted(spark).withColumn("day", F.lit("a")), str(tmp_path / "days"), "day", "a")
    assert not shuffle_files(spark) - before
    assert saved.agg(F.sum("n")).first()[0] == 5_000 and spark.conf.get(DROP_SHUFFLES) == setting


def test_the_sample_of_a_scan_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    numbered = number_rows(counted(spark).select("k"), ["k"], ranges=3, per_range=4)
    assert not shuffle_files(spark) - before
    assert [tuple(r) for r in numbered.orderBy("k").collect()] == [(k, k + 1) for k in range(97)]
