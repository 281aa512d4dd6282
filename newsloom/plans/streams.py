"""Streams over the given tables, drained into tables of the shared folder: queries and their SQL.

The SQL is that of the batch form: a stream must end at the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import promotion as P
from newsloom.operators import state as S
from newsloom.operators.lineage import scratch_folder
from newsloom.operators import pages as G
from newsloom.operators.converge import converge
from newsloom.plans import marts, pages, views
from newsloom.plans.bridge import ARTICLES, articles, articles_of, registrar, table
from newsloom.plans.resolving import DOMAINS
from newsloom.streaming import revisions as V
from newsloom.streaming import stores, worklists
from newsloom.streaming.promotion import promotion_stream as promotions

Q, SQL, query = registrar()

#: Later than all rows: a row of this time brings the watermark past them, and is never final itself.
LAST = "2100-01-01 00:00:00"


def arriving(spark: SparkSession, sf: str, name: str, files: int = 1000) -> DataFrame:
    """A given table as a stream of its files; the pattern lets a table be a single file, too."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{sf}/{name}.parque[t]")


def drained(df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """What the stream has emitted when all that is there has been read. settings: of the session, while it runs."""
    spark = df.sparkSession
    folder, before = scratch_folder(spark), {k: spark.conf.get(k, None) for k in settings or {}}
    for k, v in (settings or {}).items():
        spark.conf.set(k, v)
    try:
        df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def with_last(rows: DataFrame, first: Column, at: str) -> DataFrame:
    """rows, and the one that `first` marks once more at LAST."""
    once = F.struct("*")
    again = F.struct(*[F.to_timestamp(F.lit(LAST)).alias(c) if c == at else F.col(c) for c in rows.columns])
    return rows.select(F.explode(F.when(first, F.array(once, again)).otherwise(F.array(once))).alias("r")).select("r.*")


def _posts(docs: DataFrame) -> DataFrame:
    """Documents as posts of their source, a minute apart."""
    return docs.select(F.col("doc_id").alias("post_id"), F.concat(F.lit("@"), F.upper("source")).alias("handle"), F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("at"), F.substr("text", F.lit(1), F.lit(160)).alias("text"), F.concat(F.lit("https://x.test/"), F.col("doc_id")).alias("url"), F.lit("cited").alias("outlet"))


def _originals(docs: DataFrame) -> DataFrame:
    """The same texts up to 4 hours earlier; every sixth has no card, and cards beyond the pages aren't landed."""
    earlier = (F.col("doc_id") % 9) * 30
    card = F.when(F.col("doc_id") % 6 != 0, F.concat(F.lit("https://t.test/"), F.col("doc_id") % 4000))
    return docs.select(F.col("doc_id").alias("original_id"), F.col("source").alias("handle"), F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") - earlier) * 60).alias("at"), F.substr("text", F.lit(1), F.lit(160)).alias("text"), card.alias("card"))


def _landed(pages: DataFrame) -> DataFrame:
    """Pages by the card that leads to them, an hour after the posts that may cite them."""
    return pages.select(F.concat(F.lit("https://t.test/"), "page_id").alias("card"), F.col("url").alias("final_url"), F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("Page "), "page_id")).alias("title"), F.when(F.col("page_id") % 5 != 0, F.lit("body")).alias("body"), F.timestamp_seconds(F.lit(1704067200) + (F.col("page_id") + 60) * 60).alias("at"))


_WORDS = lambda c: rf"list_distinct(list_filter(list_transform(regexp_extract_all({c}, '[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ''\-]+'), lambda w: lower(w)), lambda w: length(w) > 3 AND w NOT IN ({', '.join(f"'{w}'" for w in P.X.STOP_WORDS)})))"
_CHAIN = rf"""WITH d AS MATERIALIZED (SELECT doc_id, source, substring(text, 1, 160) AS text, {_WORDS("substring(text, 1, 160)")} AS words FROM documents),
m AS (SELECT p.doc_id AS post_id, o.doc_id AS original_id, row_number() OVER (PARTITION BY p.doc_id ORDER BY len(list_intersect(p.words, o.words)) DESC, o.doc_id - 30 * (o.doc_id % 9) DESC, o.doc_id) AS n
  FROM d p JOIN d o ON p.source = o.source AND o.doc_id - 30 * (o.doc_id % 9) BETWEEN p.doc_id - {P.WINDOW_MINUTES} AND p.doc_id WHERE len(list_intersect(p.words, o.words)) >= {P.OVERLAP}),
c AS (SELECT d.doc_id AS post_id, d.text, m.original_id, CASE WHEN m.original_id % 6 <> 0 THEN m.original_id % 4000 END AS card FROM d LEFT JOIN (SELECT * FROM m WHERE n = 1) m ON m.post_id = d.doc_id),
l AS (SELECT c.*, g.page_id, g.url AS final_url, regexp_replace(lower(regexp_extract(g.url, '^[^:]+://([^/?#]*)', 1)), '^www\.', '') AS host FROM c LEFT JOIN pages g ON g.page_id = c.card),
w AS (SELECT *, CASE {" ".join(f"WHEN host = '{d}' OR ends_with(host, '.{d}') THEN '{o}'" for d, o in DOMAINS)} END AS found FROM l),
v AS (SELECT *, CASE WHEN original_id IS NULL THEN 'original' WHEN card IS NULL THEN 'card' WHEN page_id IS NULL OR page_id % 5 = 0 THEN 'page' WHEN found IS NULL THEN 'outlet' END AS missed FROM w)
SELECT post_id, original_id, missed, CASE WHEN missed IS NULL THEN final_url ELSE 'https://x.test/' || post_id END AS url, coalesce(CASE WHEN missed IS NULL THEN found END, 'cited') AS outlet,
  CASE WHEN missed IS NULL THEN CASE WHEN page_id % 4 <> 0 THEN 'Page ' || page_id ELSE text END END AS title FROM v"""


@query(_CHAIN)
def promotion_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Posts promoted to the pages that their originals' cards lead to."""
    docs = table(spark, sf, "documents")
    found = P.promotion_chain(_posts(docs), _originals(docs), _landed(table(spark, sf, "pages")), DOMAINS)
    return found.select("post_id", "original_id", "missed", "url", "outlet", "title")


@query(_CHAIN)
def promotion_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same chain with posts, originals and pages as streams."""
    docs = lambda: arriving(spark, sf, "documents")
    posts = with_last(_posts(docs()), F.col("post_id") == 0, "at")
    originals = with_last(_originals(docs()), F.col("original_id") == 0, "at")
    landed = with_last(_landed(arriving(spark, sf, "pages")), F.col("card") == "https://t.test/0", "at")
    found = promotions(posts, originals, landed, DOMAINS, wait="40 days")
    return drained(found.select("post_id", "original_id", "missed", "url", "outlet", "title"))


@query(views.SQL["dedup_from_state"])
def dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The first article of each url is the stored state at revision 5, the others arrive as a stream, French ones last."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("seq") * 60).alias("fetched_at")
    stored = marts.arrivals(spark, sf).where("seq % 10 = 0").select("*", F.lit(5).alias("revision"), at)
    items = marts.arrivals_of(arriving(spark, sf, "documents", files=1_000_000)).where("seq % 10 <> 0").select("*", at)
    return drained(V.revisions_from(items, stored, idle_days=3650, last_sources=["fr"]), V.ROCKSDB)


def _stored(rows: DataFrame, sink) -> None:
    """The stream through the sink, until all that is there has been read."""
    folder = scratch_folder(rows.sparkSession)
    rows.writeStream.foreachBatch(sink).option("checkpointLocation", folder).trigger(availableNow=True).start().awaitTermination()


def _replaced(keys: list[str]):
    """Merge in which a new row takes the place of the old one with its key."""
    return lambda old, new: old.join(new, keys, "left_anti").select(new.columns).unionByName(new)


@query(marts.SQL["mart_upsert"])
def store_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A store that one stream fills with the first English article of each url and another upserts with the last of the others."""
    path = scratch_folder(spark)
    labels = table(spark, sf, "labels").select("doc_id", "quality")

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return S.upsert(old, new, "url", "title", ["doc_id", "tier"], ["title_ko"], ["stage"])

    def rows(english: bool) -> DataFrame:
        docs = arriving(spark, sf, "documents").where(F.col("lang").eqNullSafe("en") == english)
        a = articles_of(docs).join(labels, "doc_id", "left")
        ko = F.when(F.col("quality").isNotNull(), F.col("title")) if english else F.lit(None).cast("string")
        return a.select("url", "title", "doc_id", "tier", ko.alias("title_ko"), "stage")

    _stored(rows(True), stores.upsert_sink(path, ["url"], _replaced(["url"]), -F.col("doc_id"), "english", 16))
    _stored(rows(False), stores.upsert_sink(path, ["url"], merge, F.col("doc_id"), "others", 16))
    return stores.read_store(spark, path).select("url", "doc_id", "title", "tier", "title_ko", "stage")


@query(views.SQL["link_upsert"])
def link_store(spark: SparkSession, sf: str) -> DataFrame:
    """Links of articles and players: order lines beyond the second upsert those of the first two, the newest of a key in each."""
    path = scratch_folder(spark)
    order, keys = F.struct("at", -F.col("line")), ["article_id", "player_id"]
    lines = lambda: arriving(spark, sf, "lineitem").select(F.col("l_orderkey").alias("article_id"), F.col("l_partkey").alias("player_id"), F.col("l_linestatus").alias("stage"), F.col("l_shipdate").alias("at"), F.col("l_linenumber").alias("line"))
    _stored(lines().where("line <= 2"), stores.upsert_sink(path, keys, _replaced(keys), order, "first", 16))
    _stored(lines().where("line > 2"), stores.upsert_sink(path, keys, _replaced(keys), order, "later", 16))
    return stores.read_store(spark, path).select("article_id", "player_id", "stage")


@query(
    f"""WITH {pages._PLANTED} SELECT page_id, array_to_string(authors, '|') AS authors, CASE WHEN len(authors) > 0 THEN 'found' ELSE 'none' END AS outcome FROM b WHERE page_id % 3 <> 2"""
)
def author_refetch(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose stored authors are missing or in Korean letters alone, worked through as a list, with what their HTML says."""
    folder = scratch_folder(spark)
    stored = F.when(F.col("page_id") % 3 == 1, '["사카"]').when(F.col("page_id") % 3 == 2, '["사카", "Ann"]')
    targets = pages.planted(arriving(spark, sf, "pages")).where(worklists.lacks_latin_authors(stored))

    def work(batch: DataFrame) -> DataFrame:
        found = G.page_bylines(batch)
        return found.select("page_id", F.array_join("authors", "|").alias("authors"), worklists.refetch_outcome(F.col("authors")).alias("outcome"))

    worklists.work_through(targets, "page_id", work, f"{folder}/out", f"{folder}/state", "refetch")
    return spark.read.parquet(f"{folder}/out").select("page_id", "authors", "outcome")


_OPEN = "contains({0}, 'the') OR contains({0}, 'ing') OR contains({0}, 'ion') OR contains({0}, 'entent')"
_RULES = [("the", "THE"), ("ing", "in_"), ("ion", "ió")]


@query(
    "WITH RECURSIVE "
    + ARTICLES
    + f""",
f AS (SELECT doc_id, title AS draft, 0 AS passes FROM articles UNION ALL
SELECT doc_id, CASE passes {" ".join(f"WHEN {n} THEN replace(draft, '{a}', '{b}')" for n, (a, b) in enumerate(_RULES))} END, passes + 1 FROM f WHERE passes < 3 AND ({_OPEN.format("draft")}))
SELECT doc_id, arg_max(draft, passes) AS draft, max(passes)::INTEGER AS passes, NOT arg_max({_OPEN.format("coalesce(draft, '')")}, passes) AS settled FROM f GROUP BY doc_id"""
)
def converged_drafts(spark: SparkSession, sf: str) -> DataFrame:
    """Titles that are corrected pass by pass, each pass another rule, until none is wrong or three passes are over."""
    fix = lambda rows, n: rows.withColumn("draft", F.replace("draft", F.lit(_RULES[n][0]), F.lit(_RULES[n][1])))
    return converge(articles(spark, sf).select("doc_id", F.col("title").alias("draft")), F.expr(_OPEN.format("draft")), fix)
