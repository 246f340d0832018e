"""Results written once to the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from labelgrain.operators.shared import CLEANUP, shared_folder, shuffles_removed

__all__ = ["CLEANUP", "shuffles_removed", "stored"]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    It cuts lineage, and lost executors lose nothing of it. The files stay until
    the folder is emptied.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
