"""Citations and their promotion, repair targets and their patches: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import news as N
from newsloom.functions import vocab as V
from newsloom.operators import resolve as R
from newsloom.operators import state as S
from newsloom.plans.bridge import ARTICLES, LINKS, PLAYERS, RUNS, articles, labelled_articles, players, registrar, runs, table, with_
from newsloom.plans.resolving import DOMAINS, _HOST

Q, SQL, query = registrar()
_in = lambda xs: ", ".join(f"'{x}'" for x in xs)
#: Groups of a player's transfer status.
TRANSFER_GROUP = {"in_link": "진행 중", "out_link": "진행 중", "in_done": "이적 확정", "out_done": "이적 확정", "loan_in": "이적 확정", "loan_out": "이적 확정", "link_dropped": "이적 무산", "other_club": "타 클럽행"}


@query(
    with_(ARTICLES, "p AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '[ @' || source || ' ] and [@' || lang || '] say' WHEN 1 THEN 'as @' || source || ' : ' || title ELSE title END AS text FROM articles)", r"c AS (SELECT doc_id, regexp_extract_all(text, '\[\s*(@[A-Za-z0-9_]{1,15})\s*\]', 1) AS a, regexp_extract_all(text, '(@[A-Za-z0-9_]{1,15})\s*\)?\s*:', 1) AS b FROM p)")
    + "SELECT doc_id, CASE WHEN len(a) > 0 THEN a[-1] ELSE b[-1] END AS journalist, CASE WHEN len(a) > 0 THEN len(a) ELSE len(b) END::INTEGER AS handles FROM c WHERE len(a) > 0 OR len(b) > 0"
)
def cited_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts that cite someone, with the last one cited as their journalist."""
    kind, at = F.col("doc_id") % 3, lambda c: F.concat(F.lit("@"), F.col(c))
    text = F.when(kind == 0, F.concat(F.lit("[ "), at("source"), F.lit(" ] and ["), at("lang"), F.lit("] say"))).when(kind == 1, F.concat(F.lit("as "), at("source"), F.lit(" : "), "title")).otherwise(F.col("title"))
    return R.cited_posts(articles(spark, sf).select("doc_id", text.alias("text"))).select("doc_id", "journalist", F.size("handles").alias("handles"))


_OUTLET = " ".join(f"WHEN host = '{d}' OR ends_with(host, '.{d}') THEN '{o}'" for d, o in DOMAINS)


@query(
    f"""WITH l AS (SELECT page_id, url, html, {_HOST} AS host FROM pages), p AS (SELECT page_id, url, CASE WHEN page_id % 3 <> 0 AND page_id % 5 <> 0 AND NOT (host = 'theathletic.com' OR ends_with(host, '.theathletic.com')) THEN CASE {_OUTLET} END END AS outlet FROM l)
SELECT page_id, CASE WHEN outlet IS NOT NULL THEN url ELSE 'https://x.test/status/' || page_id END AS url, coalesce(outlet, 'cited') AS outlet, outlet IS NOT NULL AS promoted FROM p"""
)
def promoted_citations(spark: SparkSession, sf: str) -> DataFrame:
    """Cited posts with a landed page of a free, registered outlet take its address; all others stay."""
    pages = table(spark, sf, "pages")
    posts = pages.select("page_id", F.concat(F.lit("https://x.test/status/"), F.col("page_id").cast("string")).alias("url"), F.lit("cited").alias("outlet"), F.when(F.expr("page_id % 3 <> 0"), F.col("page_id")).alias("card"))
    landed = pages.select(F.col("page_id").alias("card"), F.col("url").alias("final_url"), F.when(F.expr("page_id % 5 <> 0"), F.lit("body")).alias("body"))
    return R.promote(posts, landed, DOMAINS).select("page_id", "url", "outlet", "promoted")


@query(
    with_(ARTICLES, LINKS)
    + f"SELECT source, count(*) AS n, min(doc_id) AS first_doc FROM articles WHERE stage IN ({_in(V.DISPLAYABLE)}) AND doc_id NOT IN (SELECT article_id FROM links WHERE role <> 'mention') GROUP BY source"
)
def unmatched_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles in a stage that no player is linked to, by source."""
    linked = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("doc_id"))
    shown = articles(spark, sf).where(F.col("stage").isin(V.DISPLAYABLE)).select("doc_id", "source")
    return shown.join(linked, "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query(
    with_(ARTICLES)
    + """SELECT route, level, count(*) AS n FROM (SELECT CASE WHEN trim(coalesce(CASE WHEN doc_id % 4 <> 0 THEN text END, '')) <> '' OR trim(coalesce(CASE WHEN doc_id % 8 = 0 THEN title END, '')) <> '' OR source = 'src1' THEN 'generate' ELSE 'title only' END AS route,
  CASE WHEN coalesce(CASE WHEN doc_id % 4 <> 0 THEN text END, '') = '' THEN 0 WHEN source = 'src0' AND lang IN ('en', 'fr') THEN 1 ELSE 2 END AS level FROM articles) GROUP BY route, level"""
)
def generation_routes(spark: SparkSession, sf: str) -> DataFrame:
    """What can be generated from each row's material, and the level of its body."""
    body, excerpt = F.when(F.expr("doc_id % 4 <> 0"), F.col("text")), F.when(F.expr("doc_id % 8 = 0"), F.col("title"))
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    route = F.when(filled(body) | filled(excerpt) | (F.col("source") == "src1"), "generate").otherwise("title only")
    level = F.when(F.coalesce(body, F.lit("")) == "", 0).when((F.col("source") == "src0") & F.col("lang").isin("en", "fr"), 1).otherwise(2)
    return articles(spark, sf).groupBy(route.alias("route"), level.alias("level")).agg(F.count("*").alias("n"))


@query(
    with_(RUNS, ARTICLES)
    + "SELECT (SELECT CAST(count(*) AS VARCHAR) FROM articles WHERE title_ko IS NULL) AS pending, (SELECT CAST(count(*) AS VARCHAR) FROM (SELECT source FROM articles GROUP BY source HAVING max(fetched_at) < TIMESTAMP '2024-01-01 00:00:00' + to_minutes((SELECT max(doc_id) FROM documents) - 60))) AS stale, strftime(run_day, '%Y-%m-%d') AS day, CAST(new_count AS VARCHAR) AS new_items, CAST(dup_count AS VARCHAR) AS dup, CAST(error_count AS VARCHAR) AS err, CAST(CAST(round(100.0::DOUBLE * (new_count - error_count) / new_count) AS BIGINT) AS VARCHAR) || '%' AS success FROM runs WHERE run_day = (SELECT max(run_day) FROM runs)"
)
def run_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of the latest run as texts, with the sources that are an hour behind the last article, and the rows that wait for a translation."""
    last = runs(spark, sf).orderBy(F.desc("run_day")).limit(1)
    a = labelled_articles(spark, sf)
    newest = a.agg(F.max("fetched_at").alias("newest"))  # one row
    stale = a.groupBy("source").agg(F.max("fetched_at").alias("at")).join(F.broadcast(newest)).where(F.col("at") < F.timestamp_add("MINUTE", F.lit(-60), F.col("newest")))
    waits = a.agg(F.count_if(F.col("title_ko").isNull()).cast("string").alias("pending"))  # one row
    beside = stale.agg(F.count("*").cast("string").alias("stale")).join(F.broadcast(waits))
    text = lambda c: F.col(c).cast("string")
    share = F.round(F.lit(100.0) * (F.col("new_count") - F.col("error_count")) / F.col("new_count")).cast("bigint")
    return last.select(F.date_format("run_day", "yyyy-MM-dd").alias("day"), text("new_count").alias("new_items"), text("dup_count").alias("dup"), text("error_count").alias("err"), F.concat(share.cast("string"), F.lit("%")).alias("success")).join(F.broadcast(beside))


_EXCLUDED = ["0a1b2c3d", "ffffffff", "12345678"]


@query(
    with_(ARTICLES, "t AS (SELECT doc_id, url, title, sha256(title || '|' || doc_id) AS h FROM articles WHERE title IS NOT NULL)", "f AS (SELECT trim(title) AS title, max_by(url, doc_id) AS found FROM t GROUP BY 1)")
    + f"SELECT t.doc_id, f.found FROM t JOIN f ON trim(t.title) = f.title WHERE NOT ({' OR '.join(f"starts_with(h, '{p}')" for p in _EXCLUDED)})"
)
def repair_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to repair and the last address found under exactly their title; some are excluded by prefix."""
    t = articles(spark, sf).where("title IS NOT NULL").select("doc_id", "url", "title", F.sha2(F.concat_ws("|", "title", F.col("doc_id").cast("string")).cast("binary"), 256).alias("h"))
    found = t.select(F.col("title").alias("title"), "url", F.col("doc_id").alias("seq"))
    return S.match_by_title(S.without_prefixes(t, "h", _EXCLUDED), found).select("doc_id", "found")


@query(
    with_(ARTICLES)
    + "SELECT doc_id, CASE WHEN tier >= 3 THEN NULL ELSE title_ko END AS title_ko, CASE WHEN tier >= 3 THEN NULL ELSE stage END AS stage FROM articles"
)
def clear_translation(spark: SparkSession, sf: str) -> DataFrame:
    """Translations of the rows of a key list set back to null."""
    rows = labelled_articles(spark, sf).select("doc_id", "title_ko", "stage", "tier")
    return S.cleared(rows, rows.where("tier >= 3").select("doc_id"), "doc_id", ["title_ko", "stage"]).select("doc_id", "title_ko", "stage")


@query(
    with_(PLAYERS)
    + f"SELECT CASE status {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in TRANSFER_GROUP.items())} END AS grp, count(*) AS n, count(*) FILTER (contains(trim(full_name), ' ')) AS two_words FROM players GROUP BY 1"
)
def transfer_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Players by the group of their status, and how many would be warned of as two-word names."""
    group = F.create_map(*[F.lit(x) for kv in TRANSFER_GROUP.items() for x in kv])[F.col("status")]
    return players(spark, sf).groupBy(group.alias("grp")).agg(F.count("*").alias("n"), F.count_if(F.contains(F.trim("full_name"), F.lit(" "))).alias("two_words"))


@query(
    with_(ARTICLES, "t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN title || ' 합니다.' ELSE title END AS a, CASE WHEN doc_id % 7 = 0 THEN source || '해요' END AS b FROM articles)")
    + r"SELECT doc_id FROM t WHERE len(list_filter(regexp_split_to_array(coalesce(a, ''), '[.!?…\n]+'), lambda s: regexp_matches(trim(s), '((^|[^아])니다|해요)\s*$'))) > 0 OR len(list_filter(regexp_split_to_array(coalesce(b, ''), '[.!?…\n]+'), lambda s: regexp_matches(trim(s), '((^|[^아])니다|해요)\s*$'))) > 0 ORDER BY doc_id LIMIT 50"
)
def tone_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The first fifty rows whose summaries end politely."""
    a, b = F.when(F.expr("doc_id % 3 = 0"), F.concat("title", F.lit(" 합니다."))).otherwise(F.col("title")), F.when(F.expr("doc_id % 7 = 0"), F.concat("source", F.lit("해요")))
    return articles(spark, sf).where(N.has_polite_ending(a) | N.has_polite_ending(b)).select("doc_id").orderBy("doc_id").limit(50)
