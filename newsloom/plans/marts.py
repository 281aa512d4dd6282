"""Quality marts, queues, checks, keys and state: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators import state as S
from newsloom.plans.bridge import ARTICLES, RUNS, articles, articles_of, labelled_articles, registrar, runs, table, with_

Q, SQL, query = registrar()


@query(with_(ARTICLES) + "SELECT source, count(*) AS articles, avg(tier) AS avg_tier, count(*) FILTER (title_ko IS NULL) AS missing_translation, avg(n_chars) AS avg_chars FROM articles GROUP BY source")
def source_quality(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_articles(spark, sf).groupBy("source").agg(F.count("*").alias("articles"), F.avg("tier").alias("avg_tier"), F.count_if(F.col("title_ko").isNull()).alias("missing_translation"), F.avg("n_chars").alias("avg_chars"))


@query(with_(ARTICLES) + "SELECT tier, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM articles GROUP BY tier")
def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    counts = articles(spark, sf).groupBy("tier").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select("tier", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 1).alias("pct"))


@query(
    with_(RUNS, "recent AS (SELECT * FROM runs ORDER BY run_day DESC LIMIT 30)")
    + """SELECT 'dup_rate' AS metric, coalesce(sum(dup_count), 0)::DOUBLE / greatest(sum(new_count), 1) AS value FROM recent
UNION ALL SELECT 'error_total', coalesce(sum(error_count), 0)::DOUBLE FROM recent
UNION ALL SELECT 'avg_new', avg(new_count)::DOUBLE FROM recent
UNION ALL SELECT 'latest_new', new_count::DOUBLE FROM recent WHERE run_day = (SELECT max(run_day) FROM recent)"""
)
def slo_rollup(spark: SparkSession, sf: str) -> DataFrame:
    recent = runs(spark, sf).orderBy(F.desc("run_day")).limit(30)
    one = recent.agg(
        (F.coalesce(F.sum("dup_count"), F.lit(0)) / F.greatest(F.sum("new_count"), F.lit(1))).alias("dup_rate"),
        F.coalesce(F.sum("error_count"), F.lit(0)).cast("double").alias("error_total"),
        F.avg("new_count").alias("avg_new"),
        F.max_by("new_count", "run_day").cast("double").alias("latest_new"),
    )
    return one.unpivot([], ["dup_rate", "error_total", "avg_new", "latest_new"], "metric", "value")


@query(with_(ARTICLES) + "SELECT doc_id, source, title FROM articles WHERE title_ko IS NULL")
def work_queue(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_articles(spark, sf).where("title_ko IS NULL").select("doc_id", "source", "title")


@query(with_(ARTICLES) + "SELECT source, count(*) FILTER (title_ko IS NULL) AS pending_title, count(*) FILTER (stage = 'other') AS pending_stage FROM articles GROUP BY source")
def pending_counts(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_articles(spark, sf).groupBy("source").agg(F.count_if(F.col("title_ko").isNull()).alias("pending_title"), F.count_if(F.col("stage") == "other").alias("pending_stage"))


@query(
    with_(ARTICLES)
    + f"""SELECT 'unique_doc_id' AS check_name, (SELECT count(*) FROM (SELECT doc_id FROM articles GROUP BY doc_id HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'unique_url', (SELECT count(*) FROM (SELECT url FROM articles GROUP BY url HAVING count(*) > 1))
UNION ALL SELECT 'not_null_title_ko', (SELECT count(*) FROM articles WHERE title_ko IS NULL)
UNION ALL SELECT 'accepted_stage', (SELECT count(*) FROM articles WHERE stage NOT IN ({", ".join(f"'{s}'" for s in V.DISPLAYABLE)}))
UNION ALL SELECT 'relationship_labels', (SELECT count(*) FROM labels WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = labels.doc_id))
UNION ALL SELECT 'relationship_orders', (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))"""
)
def dq_checks(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf)
    repeated = lambda c: a.groupBy(c).count().where("count > 1")
    orphans = table(spark, sf, "labels").select("doc_id").join(table(spark, sf, "documents").select("doc_id"), "doc_id", "left_anti")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).join(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "left_anti")
    failing = {"unique_doc_id": repeated("doc_id"), "unique_url": repeated("url"), "not_null_title_ko": labelled_articles(spark, sf).where("title_ko IS NULL"), "accepted_stage": a.where(~F.col("stage").isin(V.DISPLAYABLE)), "relationship_labels": orphans, "relationship_orders": lines}
    parts = [df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures") for name, df in failing.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_CANON = r"""canon AS (SELECT page_id, url, trim(url) AS u FROM pages),
parts AS (SELECT page_id, u, regexp_extract(u, '^([^:/?#]+)://', 1) AS scheme, lower(regexp_extract(u, '^[^:/?#]+://([^/?#]*)', 1)) AS host,
  regexp_replace(regexp_extract(u, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path, regexp_extract(u, '^[^?#]*\?([^#]*)', 1) AS q FROM canon),
pairs AS (SELECT page_id, unnest(list_filter(string_split(q, '&'), lambda p: regexp_matches(p, '^[^=]*=.+'))) AS p FROM parts),
kept AS (SELECT page_id, url_decode(regexp_extract(p, '^([^=]*)=', 1)) AS k, url_decode(regexp_replace(p, '^[^=]*=', '')) AS v FROM pairs),
tail AS (SELECT page_id, string_agg(replace(replace(replace(url_encode(k), '%20', '+'), '~', '~'), '*', '%2A') || '=' || replace(url_encode(v), '%20', '+'), '&' ORDER BY k, v) AS t
  FROM kept WHERE NOT regexp_matches(lower(k), '^(utm_|fbclid|gclid)') GROUP BY page_id),
canonical AS (SELECT page_id, scheme || '://' || host || path || CASE WHEN t IS NULL THEN '' ELSE '?' || t END AS canonical FROM parts LEFT JOIN tail USING (page_id))"""


@query(f"WITH {_CANON} SELECT page_id, canonical FROM canonical")
def canonical_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.canonical_url(F.col("url")).alias("canonical"))


@query(with_(ARTICLES) + r"SELECT doc_id, sha256(trim(regexp_replace(title, '\s+', ' ', 'g')) || '|' || url) AS content_hash FROM articles")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", X.content_hash(F.col("title"), F.col("url")).alias("content_hash"))


@query(with_(ARTICLES) + "SELECT doc_id, tier, round(greatest(0.0, 1 - tier / 4), 3) AS confidence FROM articles")
def confidence_score(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", "tier", X.confidence(F.col("tier")).alias("confidence"))


@query("WITH r AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents WHERE doc_id % 4 <> 0 AND text IS NOT NULL) SELECT doc_id, sha256(text) AS content_hash FROM r WHERE n = 1 AND text NOT IN (SELECT text FROM documents WHERE doc_id % 4 = 0 AND text IS NOT NULL)")
def raw_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth document is the store; the others arrive."""
    rows = table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"))
    return S.insert_ignore(rows.where("doc_id % 4 = 0"), rows.where("doc_id % 4 <> 0"), "content_hash", [F.col("doc_id")]).select("doc_id", "content_hash")


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return arrivals_of(table(spark, sf, "documents"))


def arrivals_of(docs: DataFrame) -> DataFrame:
    """Articles as they arrive; two of three carry their source's one title, so that contents come again."""
    a = articles_of(docs)
    title = F.when(F.col("doc_id") % 3 == 0, F.col("title")).otherwise(F.col("source"))
    return a.select("url", F.col("doc_id").alias("seq"), X.content_hash(title, F.col("url")).alias("content_hash"), F.col("lang").alias("source_id"), "body_level")


_FOLD = (
    "WITH RECURSIVE "
    + ARTICLES
    + """,
a AS (SELECT url, doc_id AS seq, sha256(CASE WHEN doc_id % 3 = 0 THEN trim(regexp_replace(title, '\\s+', ' ', 'g')) ELSE source END || '|' || url) AS h, lang AS s, body_level AS lv, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS n FROM articles),
f AS (SELECT url, seq, n, 'new' AS decision, 1 AS revision, h, s, lv FROM a WHERE n = 1
UNION ALL SELECT a.url, a.seq, a.n,
  CASE WHEN f.s = a.s THEN CASE WHEN f.h = a.h THEN 'duplicate' ELSE 'changed' END WHEN a.lv > f.lv THEN 'upgrade' ELSE 'blocked' END,
  f.revision + CASE WHEN f.s = a.s THEN CASE WHEN f.h = a.h THEN 0 ELSE 1 END WHEN a.lv > f.lv THEN 1 ELSE 0 END,
  CASE WHEN f.s = a.s OR a.lv > f.lv THEN a.h ELSE f.h END, CASE WHEN f.s <> a.s AND a.lv > f.lv THEN a.s ELSE f.s END,
  CASE WHEN (f.s = a.s AND f.h <> a.h) OR (f.s <> a.s AND a.lv > f.lv) THEN a.lv ELSE f.lv END
  FROM f JOIN a ON a.url = f.url AND a.n = f.n + 1)
"""
)


@query(_FOLD + "SELECT url, seq, decision, revision::INTEGER AS revision FROM f")
def dedup_state_machine(spark: SparkSession, sf: str) -> DataFrame:
    return S.revision_fold(arrivals(spark, sf))


@query(_FOLD + "SELECT decision, count(*) AS n, max(revision)::INTEGER AS max_revision FROM f GROUP BY decision")
def dedup_counters(spark: SparkSession, sf: str) -> DataFrame:
    return S.revision_fold(arrivals(spark, sf)).groupBy("decision").agg(F.count("*").alias("n"), F.max("revision").alias("max_revision"))


def _mart(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Old and new rows of the mart: of each url the first English article, and the last one in another language or none."""
    a = labelled_articles(spark, sf).select("url", "doc_id", "title", "tier", "title_ko", "stage", F.col("lang").eqNullSafe("en").alias("english"))
    old = S.first_by(a.where("english").drop("english"), ["url"], [F.col("doc_id")])
    new = S.first_by(a.where("NOT english").drop("english"), ["url"], [F.desc("doc_id")])
    return old, new.withColumn("title_ko", F.lit(None).cast("string"))


@query(
    with_(
        ARTICLES,
        "o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS n FROM articles WHERE lang IS NOT DISTINCT FROM 'en') WHERE n = 1)",
        "w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id DESC) AS n FROM articles WHERE lang IS DISTINCT FROM 'en') WHERE n = 1)",
    )
    + """SELECT coalesce(o.url, w.url) AS url, coalesce(w.doc_id, o.doc_id) AS doc_id, CASE WHEN w.url IS NOT NULL THEN w.title ELSE o.title END AS title,
  CASE WHEN w.url IS NOT NULL THEN w.tier ELSE o.tier END AS tier, CASE WHEN w.url IS NULL OR o.title = w.title THEN o.title_ko END AS title_ko,
  CASE WHEN o.url IS NOT NULL THEN o.stage ELSE w.stage END AS stage FROM o FULL OUTER JOIN w ON o.url = w.url"""
)
def mart_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _mart(spark, sf)
    return S.upsert(old, new, "url", "title", ["doc_id", "tier"], ["title_ko"], ["stage"]).select("url", "doc_id", "title", "tier", "title_ko", "stage")


@query(
    """SELECT c.c_custkey, CASE WHEN p.k IS NOT NULL THEN p.seg ELSE c_mktsegment END AS c_mktsegment, coalesce(p.bal, c_acctbal) AS c_acctbal
FROM customer c LEFT JOIN (SELECT o_custkey AS k, CASE WHEN count(*) > 9 THEN 'BUSY' END AS seg, CASE WHEN max(o_totalprice) > 50000 THEN max(o_totalprice) END AS bal FROM orders GROUP BY 1) p ON p.k = c.c_custkey"""
)
def keyed_patch(spark: SparkSession, sf: str) -> DataFrame:
    most = F.max("o_totalprice")
    change = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.count("*") > 9, "BUSY").alias("c_mktsegment"), F.when(most > 50000, most).alias("c_acctbal"))
    old = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return S.patch(old, change, "c_custkey", overwrite=["c_mktsegment"], coalesce=["c_acctbal"])


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag <> 'R')")
def exists_semi(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").select("p_partkey").join(lines, "p_partkey", "left_semi")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def not_exists_anti(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey", "c_name").join(done, "c_custkey", "left_anti")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def orphan_delete(spark: SparkSession, sf: str) -> DataFrame:
    """What a delete of orders without a large line keeps."""
    lines = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left_semi")


GLOSSARY = [("the", "THE"), ("THE re", "there"), ("ing", "in'"), ("ion", "ión")]


@query(with_(ARTICLES) + "SELECT doc_id, replace(replace(replace(replace(title, 'the', 'THE'), 'THE re', 'there'), 'ing', 'in'''), 'ion', 'ión') AS title FROM articles")
def glossary_replace(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", X.glossary_replace(F.col("title"), GLOSSARY).alias("title"))


@query(
    with_(ARTICLES)
    + f"""SELECT doc_id, CASE WHEN source = 'src0' AND body_level = 2 THEN 'official' WHEN source = 'src1' AND stage = 'done' THEN 'official'
  WHEN stage IN ({", ".join(f"'{s}'" for s in V.DISPLAYABLE)}) THEN stage ELSE 'other' END AS stage,
  CASE stage WHEN 'agreed' THEN 'agreed' WHEN 'medical' THEN 'agreed' WHEN 'negotiating' THEN 'talks' WHEN 'personal_terms' THEN 'talks' ELSE stage END AS stage_group FROM articles"""
)
def stage_normalise(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf)
    fixed = F.when((F.col("source") == "src0") & (F.col("body_level") == 2), "official").when((F.col("source") == "src1") & (F.col("stage") == "done"), "official")
    group = F.coalesce(F.create_map(*[F.lit(x) for kv in V.STAGE_GROUP.items() for x in kv])[F.col("stage")], F.col("stage"))
    return a.select("doc_id", fixed.when(F.col("stage").isin(V.DISPLAYABLE), F.col("stage")).otherwise("other").alias("stage"), group.alias("stage_group"))


@query("SELECT event_type, k, count(*) AS n, sum(v) AS total FROM (SELECT event_type, unnest(json_keys(props)) AS k, props FROM events) e, LATERAL (SELECT CAST(json_extract_string(e.props, '$.' || e.k) AS BIGINT) AS v) GROUP BY event_type, k".replace("sum(v)", "CAST(sum(v) AS BIGINT)"))
def json_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", F.explode(F.from_json("props", "map<string,bigint>")).alias("k", "v"))
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


_BYLINE = "concat(split_part(title, ' ', 1), ' and ', split_part(title, ' ', 2), ', ', split_part(title, ' ', 1), ' & https://x.test/', source)"


@query(with_(ARTICLES) + rf"SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array({_BYLINE}, '\s*(?:,|&|\band\b)\s*'), lambda n: trim(n)), lambda n, i: n <> '' AND NOT regexp_matches(n, '^https?://') AND list_position(list_transform(regexp_split_to_array({_BYLINE}, '\s*(?:,|&|\band\b)\s*'), lambda m: trim(m)), n) = i), '|') AS authors FROM articles")
def author_split(spark: SparkSession, sf: str) -> DataFrame:
    word = lambda i: F.coalesce(F.try_element_at(F.split("title", " "), F.lit(i)), F.lit(""))
    byline = F.concat(word(1), F.lit(" and "), word(2), F.lit(", "), word(1), F.lit(" & https://x.test/"), F.col("source"))
    return articles(spark, sf).select("doc_id", F.array_join(X.split_authors(byline), "|").alias("authors"))


@query(
    """SELECT event_id, CASE WHEN age < 60 THEN '방금 전' WHEN age < 3600 THEN CAST(age // 60 AS VARCHAR) || '분 전' WHEN age < 86400 THEN CAST(age // 3600 AS VARCHAR) || '시간 전'
  WHEN age < 691200 THEN CAST(age // 86400 AS VARCHAR) || '일 전' ELSE strftime(ts, '%Y-%m-%d') END AS age_label
FROM (SELECT event_id, ts, CAST(floor(epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(ts)) AS BIGINT) AS age FROM events)"""
)
def humanize_when(spark: SparkSession, sf: str) -> DataFrame:
    micros = F.timestamp_diff("MICROSECOND", F.col("ts"), F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00")))
    return table(spark, sf, "events").select("event_id", X.humanize_age(F.floor(micros / 1_000_000), F.date_format("ts", "yyyy-MM-dd")).alias("age_label"))


@query(
    """SELECT event_id, CASE ago WHEN 0 THEN '오늘' WHEN 1 THEN '어제' ELSE month(d) || '월 ' || day(d) || '일 (' || substring('월화수목금토일', isodow(d)::INTEGER, 1) || ')' END AS label
FROM (SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS d, date_diff('day', CAST(ts + INTERVAL 9 HOUR AS DATE), DATE '2024-01-31') AS ago FROM events)"""
)
def day_labels(spark: SparkSession, sf: str) -> DataFrame:
    local = F.timestamp_add("HOUR", F.lit(9), F.col("ts")).cast("date")
    return table(spark, sf, "events").select("event_id", X.day_label(local, F.lit("2024-01-31").cast("date")).alias("label"))


@query("SELECT strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS day, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event FROM events WHERE ts IS NOT NULL GROUP BY 1")
def day_groups(spark: SparkSession, sf: str) -> DataFrame:
    local = F.timestamp_add("HOUR", F.lit(9), F.col("ts"))
    return table(spark, sf, "events").where("ts IS NOT NULL").groupBy(F.date_format(local, "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


@query(
    with_(ARTICLES)
    + """SELECT doc_id, strftime(CASE WHEN doc_id % 2 = 0 THEN published_at ELSE least(greatest(fetched_at, date_trunc('day', published_at)), date_trunc('day', published_at) + INTERVAL '23:59:59' HOUR TO SECOND) END, '%Y-%m-%d %H:%M:%S') AS sort_at FROM articles""".replace("INTERVAL '23:59:59' HOUR TO SECOND", "INTERVAL 86399 SECOND")
)
def sort_key_clamp(spark: SparkSession, sf: str) -> DataFrame:
    """Day-precise rows sort by their fetch time within the published day."""
    day = F.date_trunc("DAY", "published_at").cast("timestamp_ntz")
    clamped = F.least(F.greatest(F.col("fetched_at"), day), F.timestamp_add("SECOND", F.lit(86399), day))
    at = F.when(F.col("doc_id") % 2 == 0, F.col("published_at")).otherwise(clamped)
    return articles(spark, sf).select("doc_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("sort_at"))


@query("SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey > 5 DESC, p_partkey)) AS turn FROM part ORDER BY p_partkey > 5 DESC, p_partkey LIMIT 10")
def circular_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The next ten ids after cursor 5, round the end."""
    top = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") <= 5).alias("wrapped")).orderBy("wrapped", "p_partkey").limit(10)
    return top.withColumn("turn", F.row_number().over(Window.orderBy("wrapped", "p_partkey")).cast("long")).drop("wrapped")


