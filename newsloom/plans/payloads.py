"""Landed payloads to item columns, one query a kind of source, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import adapters as A
from newsloom.functions import items as I
from newsloom.functions import news as N
from newsloom.plans.bridge import ARTICLES, articles, registrar, with_

Q, SQL, query = registrar()


@query(
    with_(ARTICLES, "k AS (SELECT *, 'abcdefghij' || lpad(doc_id::VARCHAR, 6, '0') AS token, split_part(title, ' ', 1) AS w FROM articles)")
    + """SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN token END AS page, CASE WHEN doc_id % 3 = 0 OR doc_id % 7 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'tag' WHEN doc_id % 5 = 0 THEN 'title' END AS accepted,
  CASE WHEN doc_id % 2 = 0 THEN 'Lead ' || source || chr(10) || chr(10) || w ELSE 'Lead ' || source END AS body, CASE WHEN doc_id % 6 = 0 THEN 'b.jpg' WHEN doc_id % 6 < 4 THEN 'big-' || source || '|b.jpg' ELSE '' END AS images FROM k WHERE w <> ''"""
)
def official_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses, tags, blocks and images of an official site's answers."""
    d, lit = F.col("doc_id"), F.lit
    a = articles(spark, sf).withColumn("w", F.split_part("title", F.lit(" "), F.lit(1))).where("w <> ''")
    url = F.concat(lit("https://c.test/news/"), F.col("lang"), F.when(d % 4 == 0, "/").otherwise("-"), lit("abcdefghij"), F.lpad(d.cast("string"), 6, "0"))
    tags = F.when(d % 7 == 0, F.array(lit("Women"), lit("Transfer news"))).when(d % 2 == 0, F.array(lit("Men"), lit("Contract news"))).otherwise(F.array(lit("Men")))
    title = F.when(d % 5 == 0, F.concat(lit("He SIGNS "), F.regexp_replace("w", "(?i)joins|signs|transfer|loan", ""))).otherwise("Match report")
    accepted = A.accept_path(F.when(d % 3 == 0, "Video").otherwise("News"), tags, title)
    none = F.lit(None).cast("string")
    block = lambda kind, inner, html: F.struct(lit(kind).alias("type"), inner.alias("innerText"), html.alias("html"))
    second = F.when(d % 2 == 0, F.concat(lit(" "), "w", lit(" "))).otherwise(" ")
    blocks = F.array(block("TEXT", lit(""), F.concat(lit("<b>Lead</b> "), "source")), block("HEADER", lit("no"), none), block("TEXT", second, none))
    asset = lambda file, width: F.struct(file.alias("file"), lit(width).alias("width"))
    element = lambda kind, *assets: F.struct(kind.alias("type"), F.array(*assets).alias("assets"))
    big = element(F.when(d % 6 == 0, "video").otherwise("image"), asset(F.concat(lit("small-"), "source"), 10), asset(F.concat(lit("big-"), "source"), 90))
    images = F.when(d % 6 < 4, F.array(big, element(lit("image"), asset(lit("b.jpg"), None)), element(lit("image"), asset(lit("b.jpg"), 5), asset(lit(""), 50))))
    return a.select("doc_id", A.page_id(url).alias("page"), accepted.alias("accepted"), A.blocks_body(blocks).alias("body"), F.array_join(F.coalesce(A.element_images(images), F.array().cast("array<string>")), "|").alias("images"))


@query(
    with_(ARTICLES)
    + """SELECT doc_id, doc_id % 4 IN (0, 1, 2) AS post_host, CASE doc_id % 3 WHEN 0 THEN 'https://c.test/' || (1000000 + doc_id) WHEN 1 THEN 'https://c.test/' || doc_id END AS post_url,
  CASE WHEN doc_id % 5 <> 0 THEN strftime(date_trunc('minute', published_at) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') END AS published, doc_id % 2 = 0 AND doc_id % 3 <> 0 AS own_post,
  doc_id % 7 = 0 AND doc_id % 5 <= 3 AS suspect, CASE WHEN doc_id % 9 = 0 THEN 'no_candidates' WHEN doc_id % 9 = 1 THEN 'no_men_tag' END AS breach FROM articles"""
)
def post_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts, addresses and times of posts, whose own they are, and what the official funnel may have missed."""
    d, lit = F.col("doc_id"), F.lit
    host = F.element_at(F.array(*[lit(x) for x in ("https://x.com/", "https://Mobile.Twitter.com/", "https://t.co/", "https://notx.com/")]), (d % 4 + 1).cast("int"))
    href = F.when(d % 3 == 0, F.concat(lit("/"), 1000000 + d, lit("?page=2"))).when(d % 3 == 1, F.concat(lit("/index.php?mid=a&document_srl="), d)).otherwise("/board/12")
    posted = F.when(d % 5 != 0, F.concat(lit("at "), F.date_format("published_at", "yyyy.MM.dd  HH:mm"), lit(" by x"))).otherwise("2024-01-01")
    own = A.is_own_post(F.when(d % 2 == 0, F.when(d % 4 == 0, "").otherwise("ME")).otherwise("them"), "me", F.when(d % 3 == 0, "#AFCB #notafc").otherwise("go #afc!"))
    age = F.element_at(F.array(*[lit(x) for x in ("PT0H", "PT1H", "PT3H", "PT6H", "PT7H")]), (d % 5 + 1).cast("int"))
    now = F.to_timestamp(lit("2024-01-01T12:00:00Z"))
    hours = F.regexp_extract(age, r"\d+", 0).cast("int")
    stamp = F.concat(lit("2024-01-01T"), F.lpad((12 - hours).cast("string"), 2, "0"), lit(":00:00Z"))
    suspect = A.miss_suspect(F.when(d % 7 == 0, "On LOAN again").otherwise("Match day"), stamp, now)
    breach = A.coverage_breach(F.when(d % 9 == 0, 0).otherwise(4), F.when(d % 9 == 1, 0).otherwise(2))
    return articles(spark, sf).select("doc_id", A.is_post_host(F.concat(host, "source")).alias("post_host"), A.post_url(href, "https://c.test/").alias("post_url"), F.date_format(A.post_published(posted), "yyyy-MM-dd HH:mm").alias("published"), own.alias("own_post"), suspect.alias("suspect"), breach.alias("breach"))


@query(
    with_(ARTICLES)
    + """SELECT doc_id, 'https://i.test/' || doc_id || '.jpg' AS image, CASE doc_id % 3 WHEN 0 THEN 'full' ELSE 'excerpt' END AS mode, CASE doc_id % 4 WHEN 0 THEN 'Ann|' || source WHEN 1 THEN source ELSE '' END AS authors,
  CASE doc_id % 4 WHEN 0 THEN '부카요 사카' WHEN 1 THEN '부카요 사카' WHEN 2 THEN NULL ELSE '사카' END AS own_name, doc_id % 5 IN (0, 1, 2) AS womens FROM articles"""
)
def stored_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Image keys, modes, stored authors, full names and marks of the women's team."""
    d, lit, none = F.col("doc_id"), F.lit, F.lit(None).cast("string")
    image = I.image_key(F.concat(lit("https://i.test/"), d, F.when(d % 2 == 0, ".jpg?w=10&h=2").otherwise(".jpg")))
    mode = I.serving_mode(F.when(d % 3 == 0, "full").when(d % 3 == 1, "other"))
    authors = I.stored_authors(F.when(d % 4 == 0, F.concat(lit('[" Ann ", "", "'), "source", lit('"]'))).when(d % 4 == 1, F.concat(lit('["'), "source", lit('", null]'))).when(d % 4 == 2, '{"a": 1}').otherwise("broken"))
    name = I.korean_full_name(F.when(d % 4 == 0, "부카요 사카"), F.when(d % 4 != 3, "사카"), F.when(d % 4 == 2, "사").otherwise(F.when(d % 4 == 3, "사카").otherwise("부카요 사카")))
    title = F.when(d % 5 == 0, "WSL news").when(d % 5 == 1, "여자팀").otherwise("x")
    body = F.when(d % 5 == 2, F.concat(F.repeat(lit("y"), 390), lit(" women"))).when(d % 5 == 3, F.concat(F.repeat(lit("y"), 400), lit("women"))).otherwise(none)
    return articles(spark, sf).select("doc_id", image.alias("image"), mode.alias("mode"), F.array_join(authors, "|").alias("authors"), name.alias("own_name"), N.is_womens(title, body).alias("womens"))
