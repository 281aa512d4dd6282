"""Sources that fail alone: each lands its own items, with an error table and funnel counts beside them.

A source is a job of its own, several at a time; what breaks, in reading its files or in running
its job, costs only that source's rows of this run. Records that a source's files have but its
format can't read, and items that were turned away, go to tables, too. Funnels are counted by
the job that lands the items.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import adapters as A
from newsloom.functions import html as H
from newsloom.operators import pages as P
from newsloom.sources import readers as R

ITEM = "url string, title string, summary string, published string, body string, precision string, image_url string, authors array<string>, accept_path string"
_BAD = "bad_record"
_SIDE = "record string, read string"


@dataclass
class Source:
    """What a source gives: items, counts on the way, records that can't be read, and items turned away."""

    items: DataFrame
    counts: list[Observation] = field(default_factory=list)
    bad: DataFrame | None = None
    rejects: DataFrame | None = None


def observed(df: DataFrame, counts: list[Observation], **metrics: Column) -> DataFrame:
    """df, counted as it passes."""
    counts.append(Observation())
    return df.observe(counts[-1], *[m.alias(n) for n, m in metrics.items()])


def shaped(rows: DataFrame) -> DataFrame:
    """Items in one shape; what a source doesn't give is null."""
    columns = [c.split(" ", 1) for c in ITEM.split(", ")]
    return rows.select(*[(F.col(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n) for n, kind in columns])


def readable(spark: SparkSession, kind: str, path: str, schema: str, **options) -> tuple[DataFrame, DataFrame]:
    """(rows, records that the format can't read) of JSON or XML files."""
    raw = spark.read.format(kind).schema(f"{schema}, {_BAD} string").options(columnNameOfCorruptRecord=_BAD, mode="PERMISSIVE", **options).load(path)
    read = F.to_json(F.struct(*[c for c in raw.columns if c != _BAD])).alias("read")
    return raw.where(F.col(_BAD).isNull()).drop(_BAD), raw.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("record"), read)


def rss(spark: SparkSession, path: str) -> Source:
    rows, bad = readable(spark, "xml", path, "title string, link string, pubDate string, description string", rowTag="item")
    return Source(rows.select(F.trim("link").alias("url"), F.trim("title").alias("title"), F.col("description").alias("summary"), F.col("pubDate").alias("published")), bad=bad)


def posts(spark: SparkSession, path: str) -> Source:
    """A timeline as JSON lines."""
    rows, bad = readable(spark, "json", path, "status_id string, text string, created_at string, card_href string")
    first = rows.where("status_id IS NOT NULL").groupBy("status_id").agg(F.min_by(F.struct("text", "created_at", "card_href"), F.struct("created_at", "text")).alias("r"))
    url = F.coalesce("r.card_href", F.concat(F.lit("https://x.test/status/"), "status_id"))
    return Source(first.select(url.alias("url"), F.col("r.text").alias("title"), F.col("r.text").alias("body"), F.col("r.created_at").alias("published")), bad=bad)


def official(spark: SparkSession, path: str, lookups: str, now: str, window_hours: int = 24) -> Source:
    """A sitemap's recent pages, each looked up by the id in its address; accepted by tags or by title.

    lookups: landed answers as JSON lines: glide_id, article. Counts: candidates, men_tagged,
    accepted. Rejects: men's news that neither tags nor title accept.
    """
    counts: list[Observation] = []
    recent = R.sitemap(spark, path, "", now, window_hours).select("url", A.page_id(F.col("url")).alias("glide_id"))
    block = "struct<type:string,innerText:string,html:string,image:string,author:string>"
    answers, bad = readable(spark, "json", lookups, f"glide_id string, article struct<title:string,publicationDate:string,taxonomies:array<string>,articleType:string,articleBody:array<{block}>>")
    found = recent.join(answers.where("glide_id IS NOT NULL").dropDuplicates(["glide_id"]), "glide_id", "left").select("url", "article.*")
    men = F.coalesce(F.array_contains("taxonomies", A.REQUIRED_TAG), F.lit(False))
    told = found.withColumns({"accept_path": A.accept_path(F.col("articleType"), F.col("taxonomies"), F.col("title")), "men": men})
    told = observed(told, counts, candidates=F.count(F.lit(1)), men_tagged=F.count_if("men"), accepted=F.count("accept_path"))
    header = F.try_element_at(F.filter("articleBody", lambda b: b["type"] == "HEADER"), F.lit(1))
    author = F.nullif(header["author"], F.lit(""))
    items = told.where("accept_path IS NOT NULL").select("url", "title", F.col("publicationDate").alias("published"), F.lit("time").alias("precision"), "accept_path", A.blocks_body(F.col("articleBody")).alias("body"), header["image"].alias("image_url"), F.array_compact(F.array(author)).alias("authors"))
    rejects = found.where(men & (F.col("articleType") == "News") & A.accept_path(F.col("articleType"), F.col("taxonomies"), F.col("title")).isNull())
    return Source(items, counts, bad, rejects.select(F.col("url").alias("record"), F.to_json(F.struct("title", "publicationDate", "taxonomies")).alias("read")))


def anchors(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, at, tag, href and text of every link of the pages, in order."""
    tags = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*+>.*?</a>"), F.lit(0))).alias("at", "a"))
    href = F.nullif(F.trim(F.regexp_extract("a", r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)", 1)), F.lit(""))
    text = F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]+>", ""), r"\s+", " "))
    return tags.select(key, "at", F.regexp_extract("a", r"(?is)^<a\b[^>]*+>", 0).alias("tag"), href.alias("href"), text.alias("text"))


def listed(links: DataFrame, keep: list[str], base_url: str, keywords: list[str], counts: list[Observation]) -> DataFrame:
    """url and text of a list's links: each address once, by its first link; with a text; with one of the keywords.

    Addresses are told apart within `keep` (columns of links). Counts: selected, deduped, titled, passed.
    """
    selected = observed(links, counts, selected=F.count(F.lit(1)))
    absolute = F.when(F.col("href").rlike("(?i)^https?://"), F.col("href")).otherwise(F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace("href", "^/+", "")))
    once = selected.where("href IS NOT NULL").groupBy(*keep, absolute.alias("url")).agg(F.min_by("text", "at").alias("text"))
    titled = observed(once, counts, deduped=F.count(F.lit(1))).where("text <> ''")
    low = F.lower("text")
    has = F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(low, k)) if keywords else F.lit(True)
    return observed(observed(titled, counts, titled=F.count(F.lit(1))).where(has), counts, passed=F.count(F.lit(1)))


def html_site(spark: SparkSession, path: str, base_url: str, selector: str = "", keywords: list[str] = (), details: str | None = None) -> Source:
    """Links of list pages whose tag matches the selector (a pattern), with what their landed pages say.

    details: JSON lines with url and html. A link without a landed page keeps its title and has an
    empty body, to be tried again.
    """
    counts: list[Observation] = []
    lists = spark.read.text(path, wholetext=True).select(F.lit(0).alias("list"), F.col("value").alias("html"))
    found = listed(anchors(lists, "list").where(F.col("tag").rlike(selector)), [], base_url, list(keywords), counts).select("url", F.col("text").alias("title"))
    if details is None:
        return Source(found, counts)
    landed, bad = readable(spark, "json", details, "url string, html string")
    landed = landed.where("url IS NOT NULL").dropDuplicates(["url"])
    said = P.page_bylines(landed)
    texts = H.extract(landed, "url").select("url", "body", "og_image")
    more = said.join(texts, "url").select("url", "authors", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"), "precision", F.coalesce("body", F.lit("")).alias("body"), F.col("og_image").alias("image_url"))
    items = found.join(more, "url", "left").withColumn("body", F.coalesce("body", F.lit("")))
    return Source(items, counts, bad)


KINDS: dict[str, Callable[..., Source]] = {"rss": rss, "posts": posts, "official": official, "html": html_site}


@dataclass
class Landing:
    """items (source_id and ITEM), errors (source_id, error), funnels (source_id, stage, n), bad and rejects (source_id, record, read)."""

    items: DataFrame
    errors: DataFrame
    funnels: DataFrame
    bad: DataFrame
    rejects: DataFrame


def reason(e: Exception) -> str:
    """The first line of what went wrong, or at least its kind."""
    lines = str(e).strip().splitlines()
    return lines[0][:500] if lines else type(e).__name__


def land(spark: SparkSession, config: list[dict], path: str, concurrency: int = 8) -> Landing:
    """Land all enabled sources under path. config: source_id, kind, options, enabled.

    A source's folder is overwritten by each run. The landing has the rows of this run alone: what
    a source that failed had landed before stays in its folder and is not read. Source ids are unique.
    """

    def one(c: dict) -> tuple[str, str | None, dict[str, int], list[str]]:
        name = c["source_id"]
        try:
            if c["kind"] not in KINDS:
                raise ValueError(f"unknown kind: {c['kind']}")
            source = KINDS[c["kind"]](spark, **c.get("options", {}))
            counts = [*source.counts]
            items = observed(shaped(source.items), counts, landed=F.count(F.lit(1)))
            items.write.mode("overwrite").parquet(f"{path}/items/source_id={name}")
            sides = {k: rows for k, rows in (("bad", source.bad), ("rejects", source.rejects)) if rows is not None}
            for side, rows in sides.items():
                rows.write.mode("overwrite").parquet(f"{path}/{side}/source_id={name}")
            return name, None, {k: v for o in counts for k, v in o.get.items()}, ["items", *sides]
        except Exception as e:  # one source's failure is its own
            return name, reason(e), {}, []

    wanted = [c for c in config if c.get("enabled", True)]
    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        told = list(pool.map(inheritable_thread_target(spark)(one), wanted))

    def landed(side: str, schema: str) -> DataFrame:
        out = spark.createDataFrame([], f"source_id string, {schema}")
        for name in (n for n, _, _, sides in told if side in sides):
            rows = spark.read.schema(schema).parquet(f"{path}/{side}/source_id={name}")
            out = out.unionByName(rows.select(F.lit(name).alias("source_id"), *rows.columns))
        return out

    errors = spark.createDataFrame([(n, e) for n, e, _, _ in told if e is not None], "source_id string, error string")
    funnels = spark.createDataFrame([(n, k, int(v)) for n, _, f, _ in told for k, v in f.items()], "source_id string, stage string, n long")
    return Landing(landed("items", ITEM), errors, funnels, landed("bad", _SIDE), landed("rejects", _SIDE))
