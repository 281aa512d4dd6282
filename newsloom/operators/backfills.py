"""Repairs of stored rows from material that is there: authors, journalists, bodies, and whose timelines to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import bylines as B
from newsloom.operators import pages as P


def authors_json(authors: Column) -> Column:
    """A list as it is stored: JSON, nothing for an empty list."""
    return F.when(F.size(authors) > 0, F.to_json(authors))


def due(last: Column, now: Column, hours: float = 3.0) -> Column:
    """Whether the last contact is `hours` or more ago; without one it is."""
    return F.coalesce(F.timestamp_diff("SECOND", last, now) >= hours * 3600, F.lit(True))


def author_backfill(rows: DataFrame, raw: DataFrame, key: str, posts: str) -> DataFrame:
    """key, authors (all names of a row without stored ones) and journalist (the name that the stored one should be, or null).

    rows: key, source_id, journalist, body, authors_json; those with stored authors are left out, and so
    are those that nothing names. raw: key, seq, authors as they were collected; the first that isn't
    empty counts. Rows of the source `posts` are read from their bodies' bylines, with the stored
    journalist before them, unless it is one of them with something stuck to it. A stored
    journalist is only put right if there is one author, whose name it begins with.
    """
    none = F.array().cast("array<string>")
    first = raw.where(F.size("authors") > 0).groupBy(F.col(key).alias("raw_key")).agg(F.min_by("authors", "seq").alias("collected"))
    targets = rows.where("authors_json IS NULL").select(F.col(key).alias("key"), "source_id", F.trim(F.coalesce("journalist", F.lit(""))).alias("journalist"), "body")
    told = targets.join(first, F.col("key") == F.col("raw_key"), "left").withColumn("read", B.body_authors(F.col("body")))
    own = F.when(F.col("journalist") != "", F.array("journalist")).otherwise(none)
    stuck = F.exists("read", lambda a: F.startswith(F.col("journalist"), a))
    read = F.when(stuck, F.col("read")).otherwise(F.concat(own, "read"))
    names = F.when(F.col("collected").isNotNull(), F.col("collected")).when(F.col("source_id") == posts, read).otherwise(none)
    named = told.withColumn("names", F.when(F.size(names) > 0, names).otherwise(own))
    found = named.select("key", "journalist", P.normal_authors(F.col("names")).alias("authors")).where(F.size("authors") > 0)
    one = F.get("authors", F.lit(0))
    wrong = (F.size("authors") == 1) & (F.col("journalist") != one) & F.startswith("journalist", one)
    return found.select(F.col("key").alias(key), "authors", F.when(wrong, one).alias("journalist"))


def longer_bodies(rows: DataFrame, found: DataFrame, key: str, body: str, reset: list[str]) -> DataFrame:
    """rows with the found body where it is longer than the stored one, their `reset` columns then null: a poorer answer changes nothing. found: key, body; a row a key."""
    joined = rows.select(F.struct("*").alias("row")).join(found.select(F.col(key).alias("found_key"), F.col(body).alias("found")), F.col(f"row.{key}") == F.col("found_key"), "left")
    longer = F.coalesce(F.length("found") > F.length(F.coalesce(f"row.{body}", F.lit(""))), F.lit(False))
    value = lambda c: F.when(longer, F.col("found") if c == body else F.lit(None)).otherwise(F.col(f"row.{c}"))
    return joined.select(*[(value(c) if c == body or c in reset else F.col(f"row.{c}")).alias(c) for c in rows.columns])


def timeline_targets(items: DataFrame, skip: list[str], most: int = 15) -> DataFrame:
    """handle (as it stands first) and first (position) of the journalists to read, each once, in order of appearance, `most` at most.

    items: position, journalist. Handles of skip, in any case, are left out.
    """
    handle = F.regexp_replace(F.coalesce("journalist", F.lit("")), "^@+", "")
    named = items.select("position", handle.alias("handle")).where("handle <> ''").where(~F.lower("handle").isin([s.lower() for s in skip]))
    first = named.groupBy(F.lower("handle").alias("low")).agg(F.min_by("handle", "position").alias("handle"), F.min("position").alias("first"))
    return first.orderBy("first").limit(most).select("handle", "first")
