"""Facet, reader and text-fidelity queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.functions import news as N
from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators import facets as A
from newsloom.plans.bridge import ARTICLES, articles, labelled_articles, registrar, table, with_

Q, SQL, query = registrar()


@query(
    with_(ARTICLES)
    + """SELECT axis, value, count(*) AS n FROM (
  SELECT 'source' AS axis, source AS value FROM articles UNION ALL SELECT 'lang', lang FROM articles UNION ALL SELECT 'stage', stage FROM articles
  UNION ALL SELECT 'direction', direction FROM articles UNION ALL SELECT 'body_level', CAST(body_level AS VARCHAR) FROM articles UNION ALL SELECT 'quality', CAST(quality AS VARCHAR) FROM articles)
WHERE value IS NOT NULL GROUP BY axis, value"""
)
def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.facet_counts(labelled_articles(spark, sf).withColumn("quality", F.col("quality").cast("int")), ["source", "lang", "stage", "direction", "body_level", "quality"])


@query(with_(ARTICLES) + "SELECT author, count(*) AS n, count(DISTINCT source) AS sources, min(tier) AS best_tier FROM (SELECT DISTINCT doc_id, source, tier, unnest([split_part(title, ' ', 1), split_part(title, ' ', 2)]) AS author FROM articles) WHERE author <> '' GROUP BY author")
def facet_multivalue(spark: SparkSession, sf: str) -> DataFrame:
    """The first two words of a title stand for its authors."""
    two = F.array_distinct(F.slice(F.split("title", " "), 1, 2))
    rows = articles(spark, sf).select("source", "tier", F.explode(two).alias("author")).where("author <> ''")
    return rows.groupBy("author").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.min("tier").alias("best_tier"))


REGISTERED = ["the", "of", "and"]


@query(
    f"""WITH w AS (SELECT unnest(list_distinct(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))) AS word FROM documents), s AS (SELECT lower(word) AS key, word, count(*) AS n FROM w WHERE lower(word) NOT IN ({", ".join(f"'{r}'" for r in REGISTERED)}) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, (word = upper(word) AND word <> lower(word))::INTEGER, word) AS i, sum(n) OVER (PARTITION BY key) AS total, count(*) OVER (PARTITION BY key) AS spellings FROM s)
SELECT key, word AS spelling, CAST(total AS BIGINT) AS n, spellings FROM r WHERE i = 1"""
)
def alias_folding(spark: SparkSession, sf: str) -> DataFrame:
    """Each word of a document counts as a name of one of its authors."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1)))
    return A.fold_aliases(table(spark, sf, "documents").select(F.explode(words).alias("word")), REGISTERED)


@query(with_(ARTICLES) + "SELECT doc_id, source, tier FROM articles WHERE lang IN ('en', 'fr') AND direction IN ('in', 'out') AND contains(lower(title || ' ' || source), 'the') AND contains(lower(title || ' ' || source), 'src1')")
def reader_filter(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).where(A.reader_predicate({"lang": ["en", "fr"], "direction": ["in", "out"]}, "The SRC1", ["title", "source"])).select("doc_id", "source", "tier")


@query(with_(ARTICLES) + "SELECT url, count(*) FILTER (stage = 'official') AS hits, count(*) AS members FROM articles GROUP BY url HAVING count(*) FILTER (stage = 'official') > 0")
def reader_block_match(spark: SparkSession, sf: str) -> DataFrame:
    return A.blocks_that_match(articles(spark, sf), "url", F.col("stage") == "official")


@query(with_(ARTICLES) + "SELECT doc_id, row_number() OVER (ORDER BY tier, published_at DESC, doc_id)::INTEGER AS place FROM articles ORDER BY tier, published_at DESC, doc_id LIMIT 20 OFFSET 40")
def reader_sort_page(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("tier").asc(), F.desc("published_at"), F.col("doc_id").asc()]
    return A.page(articles(spark, sf).select("doc_id", "tier", "published_at"), order, 20, 2).select("doc_id", "place")


_SORTED = lambda sort, order: f"SELECT '{sort}' AS sort, doc_id, row_number() OVER (ORDER BY {order})::INTEGER AS place FROM v ORDER BY {order} LIMIT 30"


@query(
    with_(ARTICLES, "v AS (SELECT doc_id, published_at, CASE WHEN doc_id % 4 <> 0 THEN 1.0 / (1 + tier) END AS confidence, CASE WHEN doc_id % 3 = 0 THEN doc_id % 7 END AS views FROM articles)")
    + " UNION ALL ".join(f"({_SORTED(s, o)})" for s, o in (("latest", "published_at DESC, doc_id"), ("confidence", "coalesce(confidence, 0) DESC, published_at DESC, doc_id"), ("views", "coalesce(views, 0) DESC, published_at DESC, doc_id")))
)
def reader_sorts(spark: SparkSession, sf: str) -> DataFrame:
    """The first thirty articles by each of the reader's sorts."""
    d = F.col("doc_id")
    v = articles(spark, sf).select("doc_id", "published_at", F.when(d % 4 != 0, 1.0 / (1 + F.col("tier"))).alias("confidence"), F.when(d % 3 == 0, d % 7).alias("views"))
    parts = [A.page(v, [*A.reader_order(sort), F.col("doc_id").asc()], 30, 0).select(F.lit(sort).alias("sort"), "doc_id", "place") for sort in ("latest", "confidence", "views")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn and the next one of its conversation as source and output."""
    c = table(spark, sf, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    return c.select("conv_id", "turn", F.col("text").alias("source")).join(after, ["conv_id", "turn"])


TURNS = "t AS (SELECT a.conv_id, a.turn, a.text AS source, b.text AS output FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"
_NUMBERS = lambda c: rf"regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, 'https?://\S+', ' ', 'g'), '{X.PUBLISH_TIME}', ' ', 'g'), '(\d),(\d{{3}})\b', '\1\2', 'g'), '(\d),(\d{{3}})\b', '\1\2', 'g'), '\d+')"


@query(
    with_(
        f"t AS (SELECT d.doc_id, d.text AS source, e.text AS output FROM documents d JOIN documents e ON e.doc_id = d.doc_id + 1)",  # noqa: F541
        f"n AS (SELECT doc_id, list_distinct({_NUMBERS('source')}) AS s, list_distinct({_NUMBERS('output')}) AS o FROM t)",
    )
    + """SELECT doc_id, CAST(len(list_filter(s, lambda x: NOT list_has_any([x, CAST(x::HUGEINT * 10 AS VARCHAR), CAST(x::HUGEINT * 100 AS VARCHAR), CAST(x::HUGEINT * 1000 AS VARCHAR), CASE WHEN x::HUGEINT % 100 = 0 THEN CAST(x::HUGEINT // 100 AS VARCHAR) END], o))) AS INTEGER) AS missing,
  CAST(len(list_filter(o, lambda x: NOT list_has_any([x, CAST(x::HUGEINT * 10 AS VARCHAR), CAST(x::HUGEINT * 100 AS VARCHAR), CAST(x::HUGEINT * 1000 AS VARCHAR), CASE WHEN x::HUGEINT % 100 = 0 THEN CAST(x::HUGEINT // 100 AS VARCHAR) END], s))) AS INTEGER) AS extra FROM n"""
)
def number_fidelity(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of each document that the next one lacks, and the reverse."""
    d = table(spark, sf, "documents").select("doc_id", X.number_tokens(F.col("text")).alias("numbers"))
    both = d.alias("a").join(d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("numbers").alias("output")).alias("b"), "doc_id")
    lost = lambda x, y: F.size(F.filter(F.array_distinct(x), lambda t: ~F.arrays_overlap(X.number_variants(t), y)))
    return both.select("doc_id", lost(F.col("numbers"), F.col("output")).alias("missing"), lost(F.col("output"), F.col("numbers")).alias("extra"))


_GRAMS = lambda c: f"list_distinct([substring({c}, i, 8) FOR i IN range(1, greatest(length({c}) - 6, 1))])"


@query(
    with_(TURNS, r"s AS (SELECT conv_id, turn, trim(regexp_replace(source, '\s+', ' ', 'g')) AS a, trim(regexp_replace(output, '\s+', ' ', 'g')) AS b FROM t)", f"g AS (SELECT conv_id, turn, {_GRAMS('a')} AS a, {_GRAMS('b')} AS b FROM s)")
    + "SELECT conv_id, turn, round(CASE WHEN len(b) > 0 THEN len(list_intersect(b, a)) / len(b) ELSE 0.0 END, 9)::DOUBLE AS retention FROM g"
)
def ngram_retention(spark: SparkSession, sf: str) -> DataFrame:
    return turns(spark, sf).select("conv_id", "turn", F.round(X.ngram_retention(F.col("source"), F.col("output")), 9).alias("retention"))


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '["“]([^"“”]{4,}?)["”]', 1)) AS INTEGER) AS quotes, array_to_string(list_transform(regexp_extract_all(text, '["“]([^"“”]{4,}?)["”]', 1), lambda q: trim(regexp_replace(q, '\s+', ' ', 'g'))), '|') AS spans FROM documents""")
def quote_preservation(spark: SparkSession, sf: str) -> DataFrame:
    spans = X.quote_spans(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(spans).alias("quotes"), F.array_join(spans, "|").alias("spans"))


@query(
    """WITH d AS (SELECT doc_id, coalesce(source, '') AS source, lang FROM documents WHERE doc_id % 4 <> 3),
l AS (SELECT doc_id, unnest(CASE doc_id % 4 WHEN 0 THEN [source, source, 'The ' || lang] WHEN 1 THEN ['Post ' || lang] ELSE ['The ' || lang, 'Mail'] END) AS label FROM d)
SELECT label, count(*) AS n, count(DISTINCT doc_id) AS docs FROM l WHERE length(label) >= 2 GROUP BY label"""
)
def attribution_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sources that round-ups name, with what is added to them, in brackets of several forms; other brackets are none."""
    lang, source = F.col("lang"), F.coalesce("source", F.lit(""))
    told = [F.format_string("One (%s) , external. Two ( %s , external ) and (£50m) three (The %s - in Italian), external", source, source, lang), F.format_string("He (30) joins (Post %s, in French) , external", lang), F.format_string("x (The %s via Mail) , external (Mail) , external (no)", lang), F.lit("nothing (at all)")]
    body = F.concat(F.substr(F.regexp_replace(F.coalesce("text", F.lit("")), r"[()]|external", ""), F.lit(1), F.lit(200)), F.lit(" "), F.element_at(F.array(*told), (F.col("doc_id") % 4 + 1).cast("int")))
    found = table(spark, sf, "documents").select("doc_id", F.explode(N.attributions(body)).alias("label"))
    return found.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(r"""SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[.!?]\s+'), lambda s: regexp_matches(s, '(ing|tion|eau)$'))) > 0 AS ends FROM documents""")
def sentence_end_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.exists(F.split("text", r"[.!?]\s+"), lambda s: s.rlike("(ing|tion|eau)$")).alias("ends"))


@query()
def html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return H.extract(table(spark, sf, "pages").select("page_id", "url", "html"), "page_id").select("page_id", "title", "og_image", "n_paragraphs", "n_images", "body_chars")


@query(r"""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS raw_title, len(regexp_extract_all(html, '<a '))::INTEGER AS anchors FROM pages""")
def html_title(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("raw_title"), F.size(F.regexp_extract_all("html", F.lit("(<a )"), F.lit(1))).alias("anchors"))


@query()
def paragraphize(spark: SparkSession, sf: str) -> DataFrame:
    return H.paragraphs(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


