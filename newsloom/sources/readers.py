"""Landed items as DataFrames: RSS, JSON APIs, sitemaps, HTML lists, tables by JDBC, and YAML dimensions.

Fetching is no engine's work: payloads are landed as files, and one reader a kind of source
turns them into raw items (source_id, url, title, summary, published, body).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = ["source_id", "url", "title", "summary", "published", "body"]
_TAGS = r"<[^>]+>"


def _items(df: DataFrame, source_id: str, **cols: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select(F.lit(source_id).alias("source_id"), *[cols.get(c, null).alias(c) for c in ITEM[1:]])


def rss(spark: SparkSession, path: str, source_id: str) -> DataFrame:
    rows = spark.read.option("rowTag", "item").schema("title string, link string, pubDate string, description string").xml(path)
    return _items(rows, source_id, url=F.trim("link"), title=F.trim("title"), summary=F.col("description"), published=F.col("pubDate"))


def json_api(spark: SparkSession, path: str, source_id: str, keywords: list[str] = ()) -> DataFrame:
    """A search API's results; titles must hold any of the keywords."""
    schema = "response struct<results: array<struct<webTitle: string, webUrl: string, webPublicationDate: string, fields: struct<trailText: string, body: string>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("response.results").alias("r")).select("r.*")
    if keywords:
        rows = rows.where(reduce(lambda a, b: a | b, [F.contains(F.lower("webTitle"), F.lit(k.lower())) for k in keywords]))
    return _items(rows, source_id, url=F.col("webUrl"), title=F.col("webTitle"), summary=F.regexp_replace("fields.trailText", _TAGS, ""), published=F.col("webPublicationDate"), body=F.regexp_replace("fields.body", _TAGS, ""))


def sitemap(spark: SparkSession, path: str, source_id: str, now: str, window_hours: int = 24, part: str = "/news/") -> DataFrame:
    """URLs with `part` that changed within the window; unparsable times drop out."""
    rows = spark.read.option("rowTag", "url").schema("loc string, lastmod string").xml(path)
    changed = F.try_to_timestamp("lastmod")
    kept = rows.where(F.contains("loc", F.lit(part)) & (changed >= F.to_timestamp(F.lit(now)) - F.make_dt_interval(hours=F.lit(window_hours))))
    return _items(kept, source_id, url=F.trim("loc"), published=F.col("lastmod"))


def html_list(spark: SparkSession, path: str, source_id: str, base_url: str, href: str = ".+") -> DataFrame:
    """Links of a list page whose address matches; each address once, by its first title."""
    pages = spark.read.text(path, wholetext=True)
    links = pages.select(F.posexplode(F.regexp_extract_all("value", F.lit(r"(?s)(<a\b[^>]*>.*?</a>)"), F.lit(1))).alias("at", "a"))
    links = links.select("at", F.regexp_extract("a", "href=[\"']([^\"']+)", 1).alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a", _TAGS, ""), r"\s+", " ")).alias("text"))
    links = links.where(F.col("href").rlike(href) & (F.col("text") != ""))
    url = F.when(F.col("href").rlike("^https?://"), F.col("href")).otherwise(F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace("href", "^/+", "")))
    first = links.groupBy(url.alias("url")).agg(F.min_by("text", "at").alias("text"))
    return _items(first, source_id, url=F.col("url"), title=F.col("text"))


def timeline(spark: SparkSession, path: str, source_id: str) -> DataFrame:
    """Landed posts of a social timeline, each status as it stands first: by file, then line."""
    rows = spark.read.schema("status_id string, author string, text string, created_at string, card_href string").json(path)
    at = F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))  # ids rise along a file
    rest = [c for c in rows.columns if c != "status_id"]
    first = rows.select("status_id", at.alias("at"), F.struct(*rest).alias("row")).groupBy("status_id").agg(F.min_by("row", "at").alias("row")).select("status_id", "row.*")
    url = F.coalesce("card_href", F.concat(F.lit("https://x.test/status/"), F.col("status_id")))
    return _items(first, source_id, url=url, title=F.col("text"), published=F.col("created_at"), body=F.col("text"))


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int = 64) -> DataFrame:
    """A mart table over JDBC, read in ranges of a numeric key."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts).load()


READERS: dict[str, Callable[..., DataFrame]] = {"rss": rss, "json_api": json_api, "sitemap": sitemap, "html_list": html_list, "timeline": timeline}


def read_sources(spark: SparkSession, config: list[dict]) -> DataFrame:
    """All enabled sources' items. config: source_id, adapter, path, options; an unknown adapter raises."""
    frames = []
    for c in config:
        if c.get("enabled", True) and c.get("collect", True):
            if c["adapter"] not in READERS:
                raise ValueError(f"unknown adapter: {c['adapter']}")
            frames.append(READERS[c["adapter"]](spark, c["path"], c["source_id"], **c.get("options", {})))
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in ITEM))
    return reduce(DataFrame.unionByName, frames, empty)


def yaml_rows(text: str, key: str) -> list[dict]:
    """Enabled entries of a YAML list: a dimension of some hundred rows."""
    import yaml

    return [r for r in yaml.safe_load(text)[key] if r.get("enabled", True)]


def write_raw(items: DataFrame, path: str) -> None:
    """Append to the raw landing zone, a folder a source."""
    items.write.mode("append").partitionBy("source_id").parquet(path)
