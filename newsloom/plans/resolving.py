"""Resolution and clustering queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators import cluster as C
from newsloom.operators import ordered as O
from newsloom.operators import resolve as R
from newsloom.plans.bridge import ARTICLES, LINKS, NAMED_LINKS, PLAYERS, articles, links, named_links, players, registrar, seconds, table, with_

Q, SQL, query = registrar()

#: Words of titles and texts that stand for registered names, with their tiers.
REGISTRY = [("thering", 1.0), ("oftheand", 2.0), ("eredin", 1.5), ("laion", 3.0), ("derund", 0.0)]
DOMAINS = [("example.org", "Org Post"), ("blog.example.com", "Blog"), ("example.com", "Com Daily"), ("m.example.net", "Mobile"), ("example.net", "Net News")]
_values = lambda rows: "(VALUES " + ", ".join(f"('{a}', {b!r})" for a, b in rows) + ")"


@query(
    with_(ARTICLES, f"reg(alias, tier) AS {_values([('th', 1.0), ('er', 2.0), ('on', 1.5), ('le', 3.0)])}", r"h AS (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(lower(title), ' (th|er|on|le)', ' @\1', 'g'), '@(th|er|on|le)', 1)) AS alias FROM articles)")
    + "SELECT a.doc_id, coalesce(min(reg.tier), a.tier)::DOUBLE AS tier FROM articles a LEFT JOIN h ON h.doc_id = a.doc_id LEFT JOIN reg USING (alias) GROUP BY a.doc_id, a.tier"
)
def tier_resolution_handles(spark: SparkSession, sf: str) -> DataFrame:
    """Some word beginnings of the titles count as handles."""
    registry = spark.createDataFrame([("th", 1.0), ("er", 2.0), ("on", 1.5), ("le", 3.0)], "alias string, tier double")
    marked = F.regexp_replace(F.lower("title"), " (th|er|on|le)", " @$1")
    items = articles(spark, sf).select(F.col("doc_id").alias("id"), F.col("tier").alias("own"), marked.alias("marked"))
    found = R.tier_by_handles(items, F.regexp_extract_all("marked", F.lit("@(th|er|on|le)"), F.lit(1)), registry, F.col("own"))
    return found.select(F.col("id").alias("doc_id"), "tier")


@query(
    with_(ARTICLES, f"reg(name, tier) AS {_values(REGISTRY)}")
    + r"SELECT doc_id, coalesce((SELECT min(tier) FROM reg WHERE contains(lower(regexp_replace(coalesce(text, ''), '\s+', '', 'g')), name)), 4.0)::DOUBLE AS tier FROM articles"
)
def tier_resolution_substring(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", F.coalesce(R.tier_by_substring(F.coalesce("text", F.lit("")), REGISTRY), F.lit(4.0)).alias("tier"))


@query(
    """SELECT s_suppkey, CASE WHEN n_regionkey = s_suppkey % 5 THEN least(CASE n_nationkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 1.5 END, 2.0) ELSE 2.0 END::DOUBLE AS tier
FROM supplier JOIN nation ON n_nationkey = s_nationkey"""
)
def tier_resolution_affiliation(spark: SparkSession, sf: str) -> DataFrame:
    """A supplier's nation is its registered journalist; it counts only if affiliated with the source's region."""
    nation = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"))  # 25 rows
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    own = F.when(F.col("n_nationkey") % 3 == 0, 0.0).when(F.col("n_nationkey") % 3 == 1, 1.5)
    return s.select("s_suppkey", F.when(F.col("n_regionkey") == F.col("s_suppkey") % 5, F.least(own, F.lit(2.0))).otherwise(2.0).alias("tier"))


@query(
    f"""WITH e AS (SELECT event_id, user_id, event_type, epoch(date_trunc('second', ts))::BIGINT AS t_at, list_distinct([CAST(floor(value) AS BIGINT) % 3, event_id % 2 + 10, json_extract_string(props, '$.k')::BIGINT % 4 + 20]) AS words FROM events),
p AS (SELECT a.event_id AS item_id, o.event_id AS original_id, len(list_intersect(a.words, o.words)) AS overlap, o.t_at FROM e a JOIN e o ON a.user_id = o.user_id AND o.t_at <= a.t_at AND a.t_at - o.t_at <= {V.WINDOW_MINUTES * 60}
  WHERE a.event_type = 'click' AND o.event_type = 'view')
SELECT item_id, original_id, overlap::INTEGER AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY overlap DESC, t_at DESC, original_id) AS n FROM p WHERE overlap >= 1) WHERE n = 1"""
)
def interval_best_match(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks and the views of the same user within six hours before, by common marks."""
    marks = F.array_distinct(F.array(F.floor("value").cast("bigint") % 3, F.col("event_id") % 2 + 10, F.get_json_object("props", "$.k").cast("bigint") % 4 + 20))
    at = seconds(F.date_trunc("SECOND", "ts").cast("timestamp_ntz"))
    e = table(spark, sf, "events").select("event_id", "event_type", F.col("user_id").alias("handle"), at.alias("at"), marks.alias("words"))
    items = e.where("event_type = 'click'").select("handle", F.col("event_id").alias("item_id"), "at", "words")
    originals = e.where("event_type = 'view'").select("handle", F.col("event_id").alias("original_id"), "at", "words")
    return R.best_earlier_match(items, originals, V.WINDOW_MINUTES * 60, 1)


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), '^www\.', '')"


@query(
    f"SELECT page_id, CASE {' '.join(f"WHEN host = '{d}' OR ends_with(host, '.{d}') THEN '{o}'" for d, o in DOMAINS)} END AS outlet FROM (SELECT page_id, {_HOST} AS host FROM pages)"
)
def domain_suffix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", R.outlet_by_domain(X.url_host(F.col("url")), DOMAINS).alias("outlet"))


@query(
    """WITH k AS (SELECT full_name, min(id) AS id, list_extract(string_split(lower(full_name), ' '), -1) AS key FROM (SELECT p_partkey AS id, p_name AS full_name FROM part) GROUP BY full_name)
SELECT a.full_name AS name_a, b.full_name AS name_b, a.id AS id_a, b.id AS id_b, levenshtein(lower(a.full_name), lower(b.full_name))::INTEGER AS distance
FROM k a JOIN k b ON a.key = b.key AND a.full_name < b.full_name WHERE levenshtein(lower(a.full_name), lower(b.full_name)) <= 4"""
)
def fuzzy_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return R.fuzzy_duplicates(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("full_name")), 4)


@query(
    """WITH p AS (SELECT c_custkey AS player_id, c_name AS full_name, split_part(c_name, '#', 2) AS surname FROM customer),
m AS (SELECT o_orderkey AS mention_id, CASE o_orderkey % 3 WHEN 0 THEN 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') WHEN 1 THEN lpad(o_custkey::VARCHAR, 9, '0') ELSE 'no ' || o_custkey END AS name FROM orders)
SELECT mention_id, coalesce(f.player_id, s.player_id) AS player_id, CASE WHEN f.player_id IS NOT NULL THEN 'full' WHEN s.player_id IS NOT NULL THEN 'surname' ELSE 'candidate' END AS how
FROM m LEFT JOIN p f ON lower(replace(m.name, ' ', '')) = lower(f.full_name) LEFT JOIN p s ON m.name = s.surname"""
)
def entity_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Orders mention customers by full name, by number alone or not at all."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("full_name"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("surname"))
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Customer#"), number)).when(F.col("o_orderkey") % 3 == 1, number).otherwise(F.concat(F.lit("no "), F.col("o_custkey").cast("string")))
    return R.resolve_names(table(spark, sf, "orders").select(F.col("o_orderkey").alias("mention_id"), name.alias("name")), people)


@query(with_(ARTICLES) + "SELECT doc_id, source, turn FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS turn FROM articles) ORDER BY turn, source LIMIT 50")
def round_robin_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = articles(spark, sf).select("doc_id", "source", "n_chars")
    return R.round_robin(rows, "source", [F.desc("n_chars"), F.col("doc_id")], 50).select("doc_id", "source", F.col("turn").cast("long").alias("turn"))


_RANK = "CASE stage " + " ".join(f"WHEN '{s}' THEN {r}" for s, r in V.LEAD_RANK.items()) + " ELSE 0 END"
_REP = f"(tier = 0)::INTEGER DESC, CASE WHEN low_there AND coalesce(tier, 99) >= 4 THEN 0 ELSE 1 END DESC, subject DESC, published_at DESC, coalesce(tier, 99), {_RANK} DESC, doc_id"
_CLUSTER = "c AS (SELECT *, regexp_extract(title, '^(\\S+)', 1) AS cluster, CASE WHEN starts_with(title, 'The') THEN 3 WHEN contains(title, 'the') THEN 2 ELSE 1 END AS subject FROM articles)"


@query(
    with_(ARTICLES, _CLUSTER, "m AS (SELECT *, max((coalesce(tier, 99) < 4)::INTEGER) OVER (PARTITION BY cluster) = 1 AS low_there, count(*) OVER (PARTITION BY cluster) AS members, min((coalesce(tier, -1) >= 4)::INTEGER) OVER (PARTITION BY cluster) = 1 AS gossip FROM c)")
    + f"SELECT cluster, doc_id, members, gossip FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {_REP}) AS n FROM m) WHERE n = 1"
)
def cluster_representative(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters by the first word of the title."""
    a = articles(spark, sf).withColumn("cluster", F.regexp_extract("title", r"^(\S+)", 1))
    subject = F.when(F.startswith("title", F.lit("The")), 3).when(F.contains("title", F.lit("the")), 2).otherwise(1)
    rows = a.select("cluster", "doc_id", "tier", "stage", "published_at", subject.alias("subject"))
    return C.representatives(rows, "cluster", "doc_id").select("cluster", "doc_id", "members", "gossip")


STORY_CLOCK = "2024-01-12 02:00:00"
_STORY = f"s AS (SELECT *, row_number() OVER (ORDER BY starts_with(ltrim(title), 'The') DESC, tier, {_RANK} DESC, published_at DESC, n_chars > 1000 DESC, doc_id) AS place FROM articles WHERE tier IN (0, 1, 1.5) AND floor(epoch(TIMESTAMP '{STORY_CLOCK}' - published_at) / 86400) <= 10)"


@query(
    with_(ARTICLES, _STORY, "f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY place) AS n FROM s)", "t AS (SELECT *, row_number() OVER (ORDER BY place) AS k FROM f WHERE n = 1)")
    + "SELECT doc_id, CASE WHEN k = 1 THEN 1 ELSE 1 + row_number() OVER (PARTITION BY k > 1 ORDER BY published_at DESC, doc_id) END::INTEGER AS slot FROM t WHERE k <= 5"
)
def top_stories(spark: SparkSession, sf: str) -> DataFrame:
    """One lead and four more of the last ten whole days, one a URL. Long articles have an image, `The` is the subject."""
    subject = F.startswith(F.ltrim("title"), F.lit("The")).alias("subject")
    rows = articles(spark, sf).select("doc_id", "url", "tier", "stage", "published_at", subject, (F.col("n_chars") > 1000).alias("image"))
    return C.top_stories(rows, "url", STORY_CLOCK).select("doc_id", "slot")


_GROUP = "CASE stage WHEN 'agreed' THEN 'agreed' WHEN 'medical' THEN 'agreed' WHEN 'negotiating' THEN 'talks' WHEN 'personal_terms' THEN 'talks' ELSE stage END"


@query(
    with_(LINKS, PLAYERS, NAMED_LINKS)
    + f"SELECT player_id, grp AS stage_group, article_id, line, n FROM (SELECT *, row_number() OVER (PARTITION BY player_id, grp ORDER BY named DESC, coalesce(tier, 99), extracted_at DESC, article_id, line) AS r, count(*) OVER (PARTITION BY player_id, grp) AS n FROM (SELECT *, {_GROUP} AS grp FROM named_links WHERE role <> 'mention' AND stage NOT IN ('collapsed', 'other'))) WHERE r = 1"
)
def stage_ladder(spark: SparkSession, sf: str) -> DataFrame:
    rows = named_links(spark, sf).where("role <> 'mention'").select("player_id", "stage", "article_id", "line", "named", "tier", "extracted_at")
    return C.stage_ladder(rows).select("player_id", "stage_group", "article_id", "line", "n")


@query(
    with_(LINKS, PLAYERS, "l AS (SELECT * FROM links JOIN players USING (player_id))")
    + """SELECT player_id, stage FROM (SELECT player_id, stage, row_number() OVER (PARTITION BY player_id ORDER BY
  CASE WHEN status IN ('in_done', 'out_done', 'loan_in', 'loan_out') AND stage = 'official' THEN 0
       WHEN (status IN ('in_done', 'out_done', 'loan_in', 'loan_out') AND stage IN ('official', 'done')) OR (status IN ('link_dropped', 'other_club') AND stage = 'collapsed') THEN 1 ELSE 2 END, extracted_at DESC, article_id, line) AS n
  FROM l WHERE stage <> 'other' AND NOT (stage IN ('official', 'done') AND status NOT IN ('in_done', 'out_done', 'loan_in', 'loan_out')) AND NOT (stage = 'collapsed' AND status NOT IN ('link_dropped', 'other_club'))) WHERE n = 1"""
)
def current_stage(spark: SparkSession, sf: str) -> DataFrame:
    rows = links(spark, sf).select("player_id", "stage", "article_id", "line", "extracted_at").join(players(spark, sf).select("player_id", "status"), "player_id")
    return C.current_stage(rows).select("player_id", "stage")


@query(
    with_(ARTICLES, "o AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY published_at DESC, doc_id) AS i, count(*) OVER (PARTITION BY source) AS n FROM articles)")
    + "SELECT o.doc_id, o.i - 1 AS idx, greatest(0, least(o.i - 1 - 2, o.n - 5)) AS first_idx, least(o.n, greatest(0, least(o.i - 1 - 2, o.n - 5)) + 5) AS after_idx FROM o"
)
def neighbor_window(spark: SparkSession, sf: str) -> DataFrame:
    """Five rows around each article of its source, held within the ends."""
    a = articles(spark, sf).select("doc_id", "source", (-seconds(F.col("published_at"))).alias("age"))
    first, after = O.window_around(F.col("place"), F.col("size"), 5)
    return O.numbered(a, "source", [F.col("age"), F.col("doc_id")]).select("row.doc_id", F.col("place").alias("idx"), first.alias("first_idx"), after.alias("after_idx"))


