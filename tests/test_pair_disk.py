"""Paired outputs leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from staylytics.session import scratch_path
from staylytics.sources import io


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle_")}


def test_a_written_pair_leaves_no_shuffle_files(spark):
    before, path = shuffle_files(spark), scratch_path(spark, "pair")
    io.save_both(spark.range(2000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), path)
    end = time.time() + 15
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) - before == set()
    assert spark.read.parquet(f"{path}/parquet").count() == spark.read.option("header", True).csv(f"{path}/csv").count() == 7
