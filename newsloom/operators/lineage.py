"""Cutting lineage in the folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to spark.checkpoint.dir; a folder of our own only where none is named and all runs in one process."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="newsloom-checkpoint-"))
    return df.checkpoint()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the folder of spark.checkpoint.dir, or of our own where none is named and all runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="newsloom-scratch-")
    return f"{named.rstrip('/')}/{uuid.uuid4().hex}"
