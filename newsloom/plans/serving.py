"""Serving, routing and operations queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import news as N
from newsloom.functions import vocab as V
from newsloom.plans.bridge import ARTICLES, LINKS, PLAYERS, RUNS, articles, links, players, registrar, runs, table, with_

Q, SQL, query = registrar()

NAMES = ["the", "ing", "éau", "tion", "ent", "keit"]
TURNS = ["of", "de", "er"]
_pos = lambda w: f"strpos(title, '{w}')"
_list = lambda xs: "[" + ", ".join(xs) + "]"


@query(
    with_(ARTICLES, f"""p AS (SELECT doc_id, list_sort(list_filter({_list([f"{{'at': {_pos(n)}, 'name': '{n}'}}" for n in NAMES])}, lambda x: x.at > 0)) AS found,
  list_min(list_filter({_list([_pos(w) for w in TURNS])}, lambda x: x > 0)) AS turn FROM articles)""")
    + "SELECT doc_id, coalesce(CASE WHEN turn IS NOT NULL THEN list_filter(found, lambda x: x.at > turn)[1].name END, found[1].name) AS protagonist FROM p"
)
def protagonist(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", N.protagonist(F.col("title"), NAMES, TURNS).alias("protagonist"))


@query(with_(ARTICLES) + f"SELECT doc_id, CASE {' '.join(f"WHEN contains(title, '{n}') THEN '{n}'" for n in sorted(NAMES, key=lambda n: (-len(n), n)))} END AS club FROM articles")
def club_in_title(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", N.longest_name(F.col("title"), NAMES).alias("club"))


_SQ = lambda c: rf"lower(regexp_replace(coalesce({c}, ''), '\s+', '', 'g'))"


@query(with_(ARTICLES) + f"SELECT doc_id, source FROM articles WHERE source <> 'src0' OR contains({_SQ('title')}, 'ingthe') OR contains({_SQ('text')}, 'ingthe') OR contains({_SQ('title')}, 'eauaux')")
def serving_relevance(spark: SparkSession, sf: str) -> DataFrame:
    """Only the community source is filtered."""
    keep = (F.col("source") != "src0") | N.is_relevant(F.col("title"), F.col("text"), ["ing the"], ["eau aux"])
    return articles(spark, sf).where(keep).select("doc_id", "source")


@query(with_(ARTICLES) + "SELECT route, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, CASE WHEN body_level = 1 THEN 'rewrite' WHEN lang = 'en' THEN 'translate' ELSE 'summarise' END AS route FROM articles) GROUP BY route")
def queue_routes(spark: SparkSession, sf: str) -> DataFrame:
    route = N.level_route(F.col("body_level"), F.col("lang"))
    return articles(spark, sf).groupBy(route.alias("route")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query(
    with_(ARTICLES)
    + """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'The Athletic' ELSE source END AS outlet, CASE WHEN doc_id % 11 <> 0 AND doc_id % 7 <> 0 AND doc_id % 3 <> 0 THEN lang END AS journalist,
  doc_id % 11 <> 0 AND (doc_id % 7 = 0 OR doc_id % 5 = 0) AS exclusive FROM articles"""
)
def parse_bracket(spark: SparkSession, sf: str) -> DataFrame:
    """Titles with a bracket of outlet and journalist, some with a mark in it, others with the mark elsewhere or no bracket."""
    d, lit = F.col("doc_id"), F.lit
    mark = F.when(d % 5 == 0, " 단독").otherwise("")
    name = F.when(d % 3 == 0, "").otherwise(F.col("lang"))
    inner = F.when(d % 7 == 0, "디 애슬레틱-독점").otherwise(F.concat("source", lit(" - "), name, mark))
    title = F.when(d % 11 == 0, F.concat(lit("단독 "), F.regexp_replace("title", r"[\[\]]", ""))).otherwise(F.concat(lit(" ["), inner, lit("]독점 "), "title"))
    return articles(spark, sf).select("doc_id", N.parse_bracket(title).alias("b")).select("doc_id", "b.*")


@query(r"SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z][A-Za-zÀ-ÿ''.\-]*(?:\s+[A-Z][A-Za-zÀ-ÿ''.\-]*)+'), '|') AS entities FROM documents")
def entity_runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.array_join(N.entities(F.col("text")), "|").alias("entities"))


@query(
    with_(PLAYERS, "s AS (SELECT player_id, regexp_replace(lower(surname), '[^a-z0-9]', '', 'g') AS slug FROM players)", "d AS (SELECT slug, count(*) AS n FROM s GROUP BY slug)")
    + "SELECT player_id, CASE WHEN n > 1 THEN slug || '-' || player_id ELSE slug END AS slug FROM s JOIN d USING (slug)"
)
def player_slugs(spark: SparkSession, sf: str) -> DataFrame:
    s = players(spark, sf).select("player_id", N.slug(F.col("surname")).alias("slug"))
    n = s.groupBy("slug").agg(F.count("*").alias("n"))
    return s.join(n, "slug").select("player_id", F.when(F.col("n") > 1, F.concat_ws("-", "slug", F.col("player_id").cast("string"))).otherwise(F.col("slug")).alias("slug"))


@query(
    with_(LINKS, PLAYERS, "n AS (SELECT article_id, count(*) AS k, min(full_name) AS head FROM (SELECT DISTINCT article_id, full_name FROM links JOIN players USING (player_id) WHERE role <> 'mention') GROUP BY article_id)")
    + "SELECT article_id, CASE WHEN k = 1 THEN head ELSE head || ' and ' || (k - 1) || ' more' END AS label FROM n"
)
def linked_labels(spark: SparkSession, sf: str) -> DataFrame:
    own = links(spark, sf).where("role <> 'mention'").select("article_id", "player_id").join(players(spark, sf).select("player_id", "full_name"), "player_id")
    names = F.array_join(F.array_sort(F.collect_set("full_name")), "|")  # a few names an article
    return own.groupBy("article_id").agg(N.linked_label(names).alias("label"))


@query(
    with_(RUNS, "r AS (SELECT *, row_number() OVER (ORDER BY run_day DESC) AS back FROM runs)")
    + """SELECT strftime(run_day, '%Y-%m-%d') AS day, new_count, round(100.0::DOUBLE * new_count / (SELECT max(new_count) FROM r WHERE back <= 30), 1) AS bar,
  round(100.0::DOUBLE * (new_count - error_count) / new_count, 3) AS success FROM r WHERE back <= 30"""
)
def ops_view(spark: SparkSession, sf: str) -> DataFrame:
    """Bars and success of the last thirty runs."""
    last = runs(spark, sf).orderBy(F.desc("run_day")).limit(30)
    most = last.agg(F.max("new_count").alias("most"))  # one row
    return last.join(F.broadcast(most)).select(F.date_format("run_day", "yyyy-MM-dd").alias("day"), "new_count", F.round(F.lit(100.0) * F.col("new_count") / F.col("most"), 1).alias("bar"), F.round(F.lit(100.0) * (F.col("new_count") - F.col("error_count")) / F.col("new_count"), 3).alias("success"))


@query(
    with_(ARTICLES)
    + "SELECT round(100.0::DOUBLE * (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM articles GROUP BY source, title HAVING count(*) > 1)) / count(*), 4) AS duplicate_pct, round(100.0::DOUBLE * count(*) FILTER (title IS NOT NULL AND url IS NOT NULL AND tier IS NOT NULL) / count(*), 4) AS complete_pct FROM articles"
)
def load_quality(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf)
    full = F.col("title").isNotNull() & F.col("url").isNotNull() & F.col("tier").isNotNull()
    per = a.groupBy("source", "title").agg(F.count("*").alias("n"), F.count_if(full).alias("full"))
    return per.agg(F.round(F.lit(100.0) * F.sum(F.col("n") - 1) / F.sum("n"), 4).alias("duplicate_pct"), F.round(F.lit(100.0) * F.sum("full") / F.sum("n"), 4).alias("complete_pct"))


@query("SELECT c_custkey AS source_key FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2000-01-01')")
def lost_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with history whose recent watermark is missing."""
    late = F.max(F.when(F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("2000-01-01 00:00:00")), F.col("o_orderdate")))
    marks = table(spark, sf, "orders").groupBy("o_custkey").agg(late.alias("mark"))
    return table(spark, sf, "customer").join(marks.where("mark IS NULL"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(F.col("c_custkey").alias("source_key"))


@query("SELECT full_name, (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY full_name) AS player_id FROM (SELECT DISTINCT c_mktsegment AS full_name FROM customer) c WHERE full_name NOT IN (SELECT p_name FROM part)")
def candidate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """New names, a handful of segments, with ids after the largest."""
    names = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("full_name")).distinct()
    fresh = names.join(table(spark, sf, "part").select(F.col("p_name").alias("full_name")), "full_name", "left_anti")
    top = table(spark, sf, "part").agg(F.max("p_partkey").alias("top"))
    return fresh.join(F.broadcast(top)).select("full_name", (F.col("top") + F.row_number().over(Window.orderBy("full_name"))).alias("player_id"))


@query(with_(ARTICLES) + f"SELECT source, count(*) FILTER (stage IN ({', '.join(repr(s) for s in V.DISPLAYABLE)}) AND (stage = 'collapsed' OR direction IN ('in', 'out'))) AS shown, count(*) FILTER (tier < 3) AS summaries, count(*) FILTER (length(trim(text)) >= 200) AS usable FROM articles GROUP BY source")
def serving_predicates(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.col("stage").isin(V.DISPLAYABLE) & ((F.col("stage") == "collapsed") | F.col("direction").isin("in", "out"))
    return articles(spark, sf).groupBy("source").agg(F.count_if(shown).alias("shown"), F.count_if(F.col("tier") < 3).alias("summaries"), F.count_if(F.length(F.trim("text")) >= 200).alias("usable"))
