"""Written intermediate tables and input spreading.

A table that several later steps read (a vocabulary, document frequencies, merge
candidates) is written once to the shared folder and read back: the lineage is cut,
a lost executor costs no recomputation, and its row count is known cheaply.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or one in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staged"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/textlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stacked(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts.

    Parts that share a partitioning would be zipped by partition, which fails when adaptive
    execution reads one of them with another number of partitions; so that is turned off.
    """
    parts[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(DataFrame.unionByName, parts)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread an input that has fewer splits than the cluster has cores.

    A big input already has more splits than cores and passes through unchanged; a
    single small file would otherwise run every expression in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
