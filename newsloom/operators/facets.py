"""Reader queries: facets, alias folding, filters and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X


def facet_counts(rows: DataFrame, axes: list[str]) -> DataFrame:
    """axis, value, n of every axis in one pass: each row gives one entry an axis, counted before the shuffle."""
    entries = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes])
    return rows.select(F.explode(entries).alias("f")).where("f.value IS NOT NULL").groupBy("f.axis", "f.value").agg(F.count("*").alias("n"))


def fold_aliases(names: DataFrame, registered: list[str] = ()) -> DataFrame:
    """For each key (case and blanks folded) the spelling that wins: in most articles, then not upper case, then least.

    names: word, a row an article and spelling. Registered names have their own spelling and are left out.
    """
    key = X.norm_alias(F.col("word"))
    spellings = names.where(~key.isin(list(registered))).groupBy(key.alias("key"), "word").agg(F.count("*").alias("n"))
    upper = F.when((F.col("word") == F.upper("word")) & (F.col("word") != F.lower("word")), 1).otherwise(0)
    rank = F.struct((-F.col("n")).alias("n"), upper.alias("u"), F.col("word").alias("word"))
    return spellings.groupBy("key").agg(F.min(rank).alias("best"), F.sum("n").alias("n"), F.count("*").alias("spellings")).select("key", F.col("best.word").alias("spelling"), "n", "spellings")


def reader_predicate(filters: dict[str, list], text: str | None = None, columns: list[str] = ()) -> Column:
    """All axes must match (any value of an axis), and every word of the search text some column."""
    out = F.lit(True)
    for axis, values in filters.items():
        if values:
            out = out & F.col(axis).isin(values)
    hay = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])) if columns else None
    for word in (text or "").lower().split():
        out = out & F.contains(hay, F.lit(word))
    return out


def page(rows: DataFrame, order: list[Column], size: int, number: int) -> DataFrame:
    """One page (from 0) of the sorted rows; only the first (number + 1) * size rows are sorted together."""
    top = rows.orderBy(*order).limit((number + 1) * size)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).where(F.col("place") > number * size)


def reader_order(sort: str, published: str = "published_at", confidence: str = "confidence", views: str = "views") -> list[Column]:
    """Order of the reader's three sorts: latest; confidence, nothing counting as 0; views, then the latest."""
    latest = F.desc_nulls_last(published)
    first = {"latest": [], "confidence": [F.desc(F.coalesce(confidence, F.lit(0.0)))], "views": [F.desc(F.coalesce(views, F.lit(0)))]}
    return [*first[sort], latest]


def tier_members(facets: DataFrame, tiers: list[str]) -> DataFrame:
    """Outlets and journalists that choosing tiers checks along. facets: axis, value, tier."""
    return facets.where(F.col("axis").isin("outlet", "journalist") & F.col("tier").isin(tiers)).select("axis", "value")


def blocks_that_match(rows: DataFrame, block: str, predicate: Column) -> DataFrame:
    """A block stays if any of its members matches; hits counts them."""
    return rows.groupBy(block).agg(F.count_if(predicate).alias("hits"), F.count("*").alias("members")).where("hits > 0")


def source_facets(rows: DataFrame) -> DataFrame:
    """axis, value, n: tiers, outlets, each author of an article, stages of the reader's filter, and the rest.

    rows: tier, outlet, journalists (array), stage, direction. A stage counts if the deal is in or
    out, or collapsed; no stage and `other` count as other.
    """
    shown = (F.col("stage") == "collapsed") | F.col("direction").isin("in", "out")
    is_other = F.col("stage").isNull() | (F.col("stage") == "other")
    entry = lambda axis, value: F.struct(F.lit(axis).alias("axis"), value.cast("string").alias("value"))
    single = F.array(entry("tier", tier_key(F.col("tier"))), entry("outlet", F.col("outlet")), entry("stage", F.when(~is_other & shown, F.col("stage"))), entry("other", F.when(is_other, F.lit("other"))))
    names = F.transform(F.array_distinct("journalists"), lambda j: entry("journalist", j))
    return rows.select(F.explode(F.concat(single, names)).alias("f")).where("f.value <> ''").groupBy("f.axis", "f.value").agg(F.count("*").alias("n"))


def tier_key(tier: Column) -> Column:
    """The short form of a tier: 1, 1.5, or nothing."""
    return F.coalesce(F.regexp_replace(tier.cast("double").cast("string"), r"\.0$", ""), F.lit(""))


def reader_match(outlets: list[str] = (), journalists: list[str] = (), tiers: list[str] = (), stages: list[str] = (), other: bool = False, text: str = "", badge: str | None = None) -> Column:
    """The reader's filter over outlet, journalists, tier, stage, direction and search_text.

    Outlets and journalists are one group: any of either. Without a choice a group lets all pass.
    Other items show if asked for, or if a source is chosen and no stage; a chosen stage shows
    deals in or out, and collapsed ones. badge: a column; items with a player's badge are not other.
    """
    by_source = bool(outlets or journalists)
    out = F.contains(F.col("search_text"), F.lit(text.strip().lower())) if text.strip() else F.lit(True)
    if by_source:
        out = out & (F.col("outlet").isin(list(outlets)) | F.arrays_overlap("journalists", F.array(*[F.lit(j) for j in journalists]).cast("array<string>")))
    if tiers:
        out = out & tier_key(F.col("tier")).isin(list(tiers))
    moved = (F.col("stage") == "collapsed") | F.col("direction").isin("in", "out")
    is_other = F.col("stage").isNull() | (F.col("stage") == "other")
    if badge:
        is_other = is_other & ~F.coalesce(F.col(badge), F.lit(False))
    staged = F.coalesce(F.col("stage").isin(list(stages)) & moved, F.lit(False)) if stages else F.lit(True)
    return out & F.when(is_other, F.lit(bool(other or (by_source and not stages)))).otherwise(staged)


def revealed(rows: DataFrame, day: str, steps: int, days: int = 7) -> DataFrame:
    """Rows that `steps` presses show: each opens the days from the newest hidden one back over `days` days."""
    hidden, shown = rows, None
    for _ in range(steps):
        newest = hidden.agg(F.max(day).alias("newest"))  # one row
        marked = hidden.select(F.struct("*").alias("row")).join(F.broadcast(newest)).select("row", (F.datediff("newest", f"row.{day}") < days).alias("open"))
        part = marked.where("open").select("row.*")
        shown = part if shown is None else shown.unionByName(part)
        hidden = marked.where("NOT open").select("row.*")
    return shown
