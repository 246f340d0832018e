"""Helpers shared by several operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

#: Session option: the shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: what ``spark.checkpoint.dir`` names, else the warehouse folder."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed within leaves no shuffle files behind, which otherwise wait for the driver's garbage collection.

    Frames that are returned are better built outside: each of their executions
    would have to shuffle anew.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    It cuts lineage, lost executors lose nothing of it, later reads take only the
    columns they need, and the planner knows its size. The files stay until the
    folder is emptied.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def top_per_group(
    df: DataFrame, group_cols: list[str], order: list[Column], k: int, spread_cols: list[str]
) -> DataFrame:
    """The first ``k`` rows of every group, with their ``rank``.

    Groups are first cut down in ``spread_cols`` buckets, so that no task gets a
    whole one, whatever ``k`` is.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumn("_bucket", F.pmod(F.hash(*spread_cols), F.lit(buckets)))
    within = Window.partitionBy(*group_cols, "_bucket").orderBy(*order)
    df = df.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") <= k)
    df = df.drop("_bucket", "_rank")
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)
