"""Sinks that upsert a stream's micro-batches into a keyed Parquet store.

The store is hashed into buckets by key. A micro-batch is merged with the buckets that it
touches, written beside the store as a journal, and then put over those buckets alone (dynamic
partition overwrite); files of other buckets stay as they are. Notes of the last batch that was
journaled and done make a batch count once: a batch that is done is skipped, and one that broke
off after its journal is finished from the journal, never from half-written buckets. One stream
at a time writes a store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket_of_key"
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] in _ABSENT:
            return None
        raise


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def _noted(spark: SparkSession, path: str, what: str, name: str) -> int:
    """Last batch of the stream that is noted as `what`; -1 if none."""
    notes = _read(spark, f"{path}/_{what}/{name}")
    return -1 if notes is None else max((r["batch"] for r in notes.collect()), default=-1)  # one row


def _note(spark: SparkSession, path: str, what: str, name: str, batch: int) -> None:
    spark.range(1).select(F.lit(batch).cast("long").alias("batch")).coalesce(1).write.mode("overwrite").parquet(f"{path}/_{what}/{name}")


def newest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of each key the row that is highest in order; rows with a null key are left out. Combined before the shuffle, so a hot key is one row a task."""
    known = rows.dropna(subset=keys)
    kept = known.select(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"), F.struct("*").alias("row"), order.alias("order"))
    return kept.groupBy("key").agg(F.max_by("row", "order").alias("row")).select("row.*")


def upsert_sink(path: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], order: Column, name: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merge(old, new) replaces the touched buckets' rows.

    old and new have a row a key, new the highest by `order` of the batch. merge must give all rows of
    old, changed or not, and the new ones. name: of the stream, one for each of its checkpoints. The
    number of buckets is the store's own; choose it so that a bucket fits in a few files.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias(BUCKET)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.select("*", bucket)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= _noted(spark, path, "done", name):
            return
        if batch_id != _noted(spark, path, "journaled", name):
            new = newest(batch, keys, order).persist()
            touched = [r[0] for r in dealt(new).select(BUCKET).distinct().collect()]  # `buckets` at most
            if touched:
                stored = _read(spark, path)
                old = spark.createDataFrame([], new.schema) if stored is None else stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
                dealt(merge(old, new).select(new.columns)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/_journal")
            new.unpersist()
            if not touched:
                _note(spark, path, "done", name, batch_id)
                return
            _note(spark, path, "journaled", name, batch_id)
        journal = spark.read.parquet(f"{path}/_journal")
        journal.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        _note(spark, path, "done", name, batch_id)

    return apply


def records_sink(path: str, name: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: appends a batch's rows once; a batch that comes again takes the place of itself. Empty batches write nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("*", F.lit(name).alias("stream"), F.lit(batch_id).cast("long").alias("batch"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch").parquet(path)

    return apply
