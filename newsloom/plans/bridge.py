"""The domain's relations as fixed projections of the given tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import vocab as V

#: Clock of all queries, so that reruns agree: after the last event.
NOW = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), ts)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles; texts are read only where a query asks for them."""
    return articles_of(table(spark, sf_dir, "documents"))


def labelled_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with quality, toxic and, where they are labelled, a translated title."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rows = articles_of(table(spark, sf_dir, "documents")).join(labels, "doc_id", "left")
    return rows.withColumn("title_ko", F.when(F.col("quality").isNotNull(), F.col("title")))


def articles_of(docs: DataFrame) -> DataFrame:
    """The same of any rows of documents."""
    number = F.substring("source", 4, 9).cast("int")
    title = F.substring("text", 1, 80)
    fetched = F.timestamp_add("MINUTE", F.col("doc_id"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    return docs.select(
        "doc_id", "source", "lang", "n_chars", "text",
        title.alias("title"),
        number.alias("source_no"),
        pick(V.TIERS, number % 6).alias("tier"),
        pick(V.STAGES, F.col("doc_id") % 10).alias("stage"),
        pick(V.DIRECTIONS, F.col("doc_id") % 3).alias("direction"),
        (F.col("doc_id") % 3).cast("int").alias("body_level"),
        fetched.alias("fetched_at"),
        F.timestamp_add("HOUR", -(F.col("doc_id") % 5), fetched).alias("published_at"),
        F.concat(F.lit("https://docs.test/a/"), F.floor(F.col("doc_id") / 10).cast("string")).alias("url"),
    )


_list = lambda xs: "[" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in xs) + "]"

ARTICLES = f"""articles AS (
SELECT d.doc_id, source, lang, n_chars, text, quality, toxic, substring(text, 1, 80) AS title,
       CASE WHEN quality IS NOT NULL THEN substring(text, 1, 80) END AS title_ko,
       CAST(substring(source, 4, 9) AS INTEGER) AS source_no,
       list_extract({_list(V.TIERS)}, CAST(CAST(substring(source, 4, 9) AS INTEGER) % 6 + 1 AS INTEGER))::DOUBLE AS tier,
       list_extract({_list(V.STAGES)}, CAST(d.doc_id % 10 + 1 AS INTEGER)) AS stage,
       list_extract({_list(V.DIRECTIONS)}, CAST(d.doc_id % 3 + 1 AS INTEGER)) AS direction,
       CAST(d.doc_id % 3 AS INTEGER) AS body_level,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.doc_id) AS fetched_at,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.doc_id) - to_hours(d.doc_id % 5) AS published_at,
       'https://docs.test/a/' || CAST(d.doc_id // 10 AS VARCHAR) AS url
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day of events as a run."""
    e = table(spark, sf_dir, "events")
    n = F.count("*")
    return e.groupBy(F.date_trunc("DAY", "ts").cast("date").alias("run_day")).agg(
        n.alias("new_count"), F.count_if(F.col("event_type") == "error").alias("error_count"), F.sum("value").alias("duration_sec"),
        F.count_if(F.col("event_type") == "click").alias("dup_count"),
    )


RUNS = """runs AS (SELECT CAST(ts AS DATE) AS run_day, count(*) AS new_count, count(*) FILTER (event_type = 'error') AS error_count,
       sum(value) AS duration_sec, count(*) FILTER (event_type = 'click') AS dup_count FROM events GROUP BY 1)"""


def source_days(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Items per source (event type and user bucket) and day."""
    e = table(spark, sf_dir, "events")
    e = e if where is None else e.where(where)
    return e.groupBy(F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("source_id"), F.date_trunc("DAY", "ts").cast("date").alias("run_day")).agg(F.count("*").alias("n"))


SOURCE_DAYS = """source_days AS (SELECT event_type || '-' || CAST(user_id % 5 AS VARCHAR) AS source_id, CAST(ts AS DATE) AS run_day, count(*) AS n FROM events GROUP BY 1, 2)"""


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("player_id"), F.col("p_name").alias("full_name"), F.element_at(F.split("p_name", " "), -1).alias("surname"), pick(V.STATUSES, F.col("p_partkey") % 8).alias("status"), (F.col("p_size") > 10).alias("confirmed"))


PLAYERS = f"""players AS (SELECT p_partkey AS player_id, p_name AS full_name, list_extract(string_split(p_name, ' '), -1) AS surname,
       list_extract({_list(V.STATUSES)}, CAST(p_partkey % 8 + 1 AS INTEGER)) AS status, p_size > 10 AS confirmed FROM part)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article-player links: order lines."""
    x = table(spark, sf_dir, "lineitem")
    return x.select(F.col("l_orderkey").alias("article_id"), F.col("l_partkey").alias("player_id"), F.col("l_linenumber").alias("line"), pick(V.STAGES, F.col("l_linenumber") % 10).alias("stage"), F.when(F.col("l_returnflag") == "R", "mention").otherwise("subject").alias("role"), F.col("l_shipdate").alias("extracted_at"), pick(V.TIERS, F.col("l_suppkey") % 6).alias("tier"))


LINKS = f"""links AS (SELECT l_orderkey AS article_id, l_partkey AS player_id, l_linenumber AS line,
       list_extract({_list(V.STAGES)}, CAST(l_linenumber % 10 + 1 AS INTEGER)) AS stage,
       CASE WHEN l_returnflag = 'R' THEN 'mention' ELSE 'subject' END AS role, l_shipdate AS extracted_at,
       list_extract({_list(V.TIERS)}, CAST(l_suppkey % 6 + 1 AS INTEGER))::DOUBLE AS tier FROM lineitem)"""


def named_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with surname, status and named: an article's title is the name of the player on its first line."""
    found = links(spark, sf_dir).join(players(spark, sf_dir).select("player_id", "full_name", "surname", "status"), "player_id")
    titles = found.where("line = 1").select("article_id", F.col("full_name").alias("title"))
    return found.drop("full_name").join(titles, "article_id", "left").withColumn("named", F.coalesce(F.contains("title", "surname"), F.lit(False)))


NAMED_LINKS = """named_links AS (SELECT l.*, p.surname, p.status, coalesce(contains(t.full_name, p.surname), FALSE) AS named FROM links l JOIN players p USING (player_id)
LEFT JOIN (SELECT article_id, full_name FROM links JOIN players USING (player_id) WHERE line = 1) t ON t.article_id = l.article_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def registrar() -> tuple[dict, dict[str, str], object]:
    """(queries, SQL, decorator that adds a query and its SQL under the function's name)."""
    q: dict = {}
    sqls: dict[str, str] = {}

    def query(sql: str | None = None):
        def add(f):
            q[f.__name__] = f
            if sql:
                sqls[f.__name__] = sql
            return f

        return add

    return q, sqls, query
