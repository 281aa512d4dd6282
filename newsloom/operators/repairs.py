"""Rows that repairs take, in order, as a work list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators import ordered as O


def targets(rows: DataFrame, repairs: dict[str, tuple[Column, Column]], key: str) -> DataFrame:
    """repair, key, place (from 0, in the repair's order, then by key) of every row that a repair takes.

    repairs: name to (predicate, order); orders are of one type, and rise. The rows are read once,
    and no repair's rows meet in one task, however many they are.
    """
    entries = [F.when(F.coalesce(where, F.lit(False)), F.struct(F.lit(name).alias("repair"), order.alias("order"))) for name, (where, order) in repairs.items()]
    found = rows.select(F.col(key).alias("key"), F.explode(F.array_compact(F.array(*entries))).alias("r")).select("key", "r.*")
    told = O.numbered(found, "repair", [F.col("order"), F.col("key")])
    return told.select("row.repair", F.col("row.key").alias(key), "place")
