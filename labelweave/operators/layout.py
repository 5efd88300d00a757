"""Input layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def splits(df: DataFrame) -> int:
    """How many splits of ``spark.sql.files.maxPartitionBytes`` hold ``df``, by
    the optimizer's size estimate; nothing is run."""
    spark = df.sparkSession
    split = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")))
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // split + 1


def spread_records(df: DataFrame, key: str) -> DataFrame:
    """Tokenizing is the CPU-heavy step.  When the input is too small to give
    every core a split of its own (by the optimizer's size estimate; nothing
    is run), the records are hash-partitioned by their key first: the window
    and record aggregations that follow are then already clustered on the key
    and plan without further exchanges.  Larger inputs are left as read, so
    their text is never shuffled."""
    spark = df.sparkSession
    if splits(df) > spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
