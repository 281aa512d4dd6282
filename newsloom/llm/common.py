"""Helpers that all corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows in one Arrow batch. Texts can be long, so batches stay small.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, whatever the session's own setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the folder that the cluster names in spark.checkpoint.dir.

    A folder of our own is set only where none is named and all runs in one process, as in tests.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="newsloom-checkpoint-"))
    return df.checkpoint()


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(df: DataFrame, id_col: str, *more: Column) -> DataFrame:
    """row (df's columns in one struct, so that no name clashes) with non-null key columns _k0 (id as text), _k1 (whether it is null), _k2, ...

    Joins and groups on these columns share one shuffle, which a null-safe comparison doesn't.
    """
    own = [F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(id_col).isNull(), *more]
    return df.select(F.struct("*").alias("row"), *[c.alias(k) for c, k in zip(own, keys(len(own)), strict=True)])


def keys(n: int) -> list[str]:
    return [f"_k{i}" for i in range(n)]


def order_key(docs: DataFrame, col: str) -> Column:
    """A whole number that never falls where the column rises: numbers and times as such, texts by their first 7 bytes, nulls largest."""
    kind, c = docs.schema[col].dataType, F.col(col)
    if isinstance(kind, T.IntegralType | T.BooleanType):
        key = c.cast("long")
    elif isinstance(kind, T.FractionalType):
        key = F.floor(c).cast("long")
    elif isinstance(kind, T.DateType):
        key = F.unix_date(c).cast("long")
    elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
        key = F.unix_micros(c.cast("timestamp"))
    else:
        key = F.conv(F.rpad(F.hex(F.substring(F.encode(c.cast("string"), "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return F.coalesce(key, F.lit(2**63 - 1))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where all runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="newsloom-shared-")
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage is cut, and columns are packed and pruned."""
    path = f"{shared_folder(df.sparkSession)}/newsloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
