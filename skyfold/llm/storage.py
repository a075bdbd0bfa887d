"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from skyfold.session import shared_path


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read
    back: later branches read the table instead of computing it again, and a
    lost executor costs only the read.  The name is unique per call."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
