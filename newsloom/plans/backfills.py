"""Backfills over the given tables: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import backfills as BF
from newsloom.plans.bridge import ARTICLES, articles, labelled_articles, registrar, with_

Q, SQL, query = registrar()


@query(
    with_(ARTICLES)
    + """SELECT doc_id, array_to_string(CASE WHEN doc_id % 6 = 0 THEN ['Raw ' || lang, 'Two'] WHEN source = 'src1' AND doc_id % 2 = 0 THEN CASE WHEN doc_id % 3 = 1 THEN ['Ann ' || upper(lang)] ELSE ['말머리', 'Ann ' || upper(lang)] END WHEN doc_id % 3 = 1 THEN ['Ann ' || upper(lang) || ' Aug'] ELSE ['말머리'] END, '|') AS authors,
  CASE WHEN doc_id % 6 <> 0 AND source = 'src1' AND doc_id % 2 = 0 AND doc_id % 3 = 1 THEN 'Ann ' || upper(lang) END AS journalist FROM articles WHERE doc_id % 5 <> 0"""
)
def author_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Authors of rows without stored ones: collected, read from posts' bylines, or the journalist alone."""
    d, lit = F.col("doc_id"), F.lit
    a = articles(spark, sf)
    byline = F.when(d % 2 == 0, F.concat(lit("By Ann "), F.upper("lang"), lit(" June 3, 2026 x"))).otherwise("x")
    journalist = F.when(d % 3 == 1, F.concat(lit("Ann "), F.upper("lang"), lit(" Aug"))).otherwise("말머리")
    rows = a.select("doc_id", F.col("source").alias("source_id"), journalist.alias("journalist"), byline.alias("body"), F.when(d % 5 == 0, '["x"]').alias("authors_json"))
    collected = F.array(F.concat(lit("Raw "), "lang", lit(" and Two")))
    raw = a.where("doc_id % 6 = 0").select("doc_id", F.explode(F.array(F.struct(lit(1).alias("seq"), F.array().cast("array<string>").alias("authors")), F.struct(lit(2).alias("seq"), collected.alias("authors")), F.struct(lit(3).alias("seq"), F.array(lit("late")).alias("authors")))).alias("r")).select("doc_id", "r.*")
    return BF.author_backfill(rows, raw, "doc_id", "src1").select("doc_id", F.array_join("authors", "|").alias("authors"), "journalist")


@query(
    with_(ARTICLES, "s AS (SELECT *, CASE WHEN doc_id % 3 <> 0 THEN left(text, CAST(doc_id % 160 AS INTEGER)) END AS stored FROM articles)", "n AS (SELECT *, doc_id % 4 <> 1 AND length(title) > length(coalesce(stored, '')) AS longer FROM s)")
    + "SELECT doc_id, length(CASE WHEN longer THEN title ELSE stored END)::INTEGER AS chars, CASE WHEN NOT longer THEN title_ko END AS title_ko FROM n"
)
def longer_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Stored bodies, some missing or cut short, against found ones: only longer ones are taken, and their translations go."""
    stored = F.when(F.col("doc_id") % 3 != 0, F.substr("text", F.lit(1), (F.col("doc_id") % 160).cast("int")))
    a = labelled_articles(spark, sf)
    rows = a.select("doc_id", stored.alias("body"), "title_ko")
    found = a.where("doc_id % 4 <> 1").select("doc_id", F.col("title").alias("body"))
    return BF.longer_bodies(rows, found, "doc_id", "body", ["title_ko"]).select("doc_id", F.length("body").alias("chars"), "title_ko")


@query(
    "WITH h AS (SELECT doc_id, regexp_replace(CASE WHEN doc_id % 4 = 0 THEN '@' || upper(source) WHEN doc_id % 4 = 1 THEN source WHEN doc_id % 4 = 2 THEN '@' || lang END, '^@+', '') AS handle FROM documents), f AS (SELECT arg_min(handle, doc_id) AS handle, min(doc_id) AS first FROM h WHERE handle <> '' AND lower(handle) NOT IN ('src1', 'en') GROUP BY lower(handle)) SELECT handle, first FROM f ORDER BY first LIMIT 15"
)
def timeline_targets(spark: SparkSession, sf: str) -> DataFrame:
    """The first fifteen journalists that posts cite, in order of appearance."""
    d = F.col("doc_id")
    said = F.when(d % 4 == 0, F.concat(F.lit("@"), F.upper("source"))).when(d % 4 == 1, F.col("source")).when(d % 4 == 2, F.concat(F.lit("@"), "lang"))
    return BF.timeline_targets(articles(spark, sf).select(d.alias("position"), said.alias("journalist")), ["SRC1", "en"])
