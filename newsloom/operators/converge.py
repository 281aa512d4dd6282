"""Work on rows until all are in order, in a bounded number of passes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.lineage import checkpointed


def converge(rows: DataFrame, is_open: Column, attempt: Callable[[DataFrame, int], DataFrame], passes: int = 3) -> DataFrame:
    """rows with `passes`, how many each one took, and `settled`, whether it is in order in the end.

    attempt(open rows, pass from 0) gives the same columns for the rows that it is given, each once,
    changed or not; those that are still open go to the next pass, the others are not touched again.
    A null predicate is not open. Each pass is a checkpoint of the open rows alone, and passes
    end as soon as there are none.
    """
    columns = rows.columns
    still = F.coalesce(is_open, F.lit(False))
    given = checkpointed(rows.withColumn("is_open", still))
    out = given.where("NOT is_open").select(*columns, F.lit(0).alias("passes"), F.lit(True).alias("settled"))
    left = given.where("is_open").select(*columns)
    for n in range(passes):
        if left.isEmpty():
            return out
        tried = checkpointed(attempt(left, n).select(*columns).withColumn("is_open", still))
        out = out.unionByName(tried.where("NOT is_open").select(*columns, F.lit(n + 1).alias("passes"), F.lit(True).alias("settled")))
        left = tried.where("is_open").select(*columns)
    return out.unionByName(left.select(*columns, F.lit(passes).alias("passes"), F.lit(False).alias("settled")))
