"""What becomes of generated texts: the best of several attempts, and the title that a translation ends with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import news as N


def best_attempts(attempts: DataFrame, key: str, order: str, verdict: str = "verdict") -> DataFrame:
    """Of each key the attempt with fewest violations, then the one that copies least, then the first by order."""
    best = F.struct(N.violations(F.col(verdict)).alias("violations"), F.col(f"{verdict}.retention").alias("retention"), F.col(order).alias("order"))
    kept = attempts.select(F.col(key).alias("key"), best.alias("rank"), F.struct("*").alias("row"))
    won = kept.groupBy("key").agg(F.min_by("row", "rank").alias("row"), F.min("rank").alias("rank"), F.count("*").alias("attempts"))
    return won.select("row.*", F.col("rank.violations").alias("violations"), F.col("attempts").alias("tried"))


def final_title(title: Column, suspects: Column, omissions: Column, clubs: Column, retried: Column) -> Column:
    """(title, flagged) of a translation.

    The first time anything suspect sends it back: no title. After one more try the title stays,
    and what is still suspect about it is flagged.
    """
    none = F.array().cast("array<string>")
    listed = lambda c: F.coalesce(c, none)
    any_ = (F.size(listed(suspects)) > 0) | (F.size(listed(omissions)) > 0) | (F.size(listed(clubs)) > 0)
    again = F.coalesce(retried, F.lit(False))
    return F.struct(F.when(again | ~any_, title).alias("title"), F.when(again, listed(suspects)).otherwise(none).alias("flagged"))


def retranslations(rows: DataFrame, final: str, retried: str) -> DataFrame:
    """One row: queued (new without a title), adopted (tried again and still flagged), resolved (tried again and in order)."""
    again, title, flagged = F.coalesce(F.col(retried), F.lit(False)), F.col(f"{final}.title"), F.size(f"{final}.flagged") > 0
    return rows.agg(F.count_if(title.isNull() & ~again).alias("queued"), F.count_if(again & flagged).alias("adopted"), F.count_if(again & ~flagged & title.isNotNull()).alias("resolved"))
