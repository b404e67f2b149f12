"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temporary one only for a local master where that is unset."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="fairgrid-")
        sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: later steps know its size and survive lost executors."""
    path = new_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
