"""Monitoring queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import vocab as V
from newsloom.operators import monitor as M
from newsloom.plans.bridge import LINKS, PLAYERS, SOURCE_DAYS, links, players, registrar, source_days, table, with_

Q, SQL, query = registrar()
CLOCK = "2024-01-30 11:00:00"
CYCLE, RECENT = "2001-01-01 00:00:00", "2000-01-01 00:00:00"

_SOURCE = "event_type || '-' || CAST(user_id % 5 AS VARCHAR)"
_AGE = "(epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(w)) / 3600"


def _watermarks(spark: SparkSession, sf: str, before: str | None = None) -> DataFrame:
    e = table(spark, sf, "events")
    if before:
        e = e.where(F.col("ts") < F.to_timestamp_ntz(F.lit(before)))
    return e.groupBy(F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("source_id")).agg(F.max("ts").alias("w"))


@query(f"SELECT {_SOURCE} AS source_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS watermark FROM events GROUP BY 1")
def source_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    return _watermarks(spark, sf).select("source_id", F.date_format("w", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


def _threshold():
    """Hours by user bucket: 0 leaves the source out."""
    bucket = F.element_at(F.split("source_id", "-"), -1)
    return F.when(bucket == "0", 0.0).when(bucket == "1", 1.0).when(bucket == "2", 4.0).when(bucket == "3", 12.0).otherwise(V.STALE_HOURS)


_THRESHOLD = "CASE string_split(source_id, '-')[-1] WHEN '0' THEN 0.0 WHEN '1' THEN 1.0 WHEN '2' THEN 4.0 WHEN '3' THEN 12.0 ELSE 48.0 END"


def _fresh(name: str, cut: str, now: str) -> str:
    return f"""{name} AS (SELECT source_id, round((epoch(TIMESTAMP '{now}') - epoch(date_trunc('second', w))) / 3600, 6) AS age, ({_THRESHOLD})::DOUBLE AS thr
  FROM (SELECT {_SOURCE} AS source_id, max(ts) AS w FROM events {cut} GROUP BY 1))"""


def _freshness(spark: SparkSession, sf: str, now: str, before: str | None = None) -> DataFrame:
    age = F.round(F.timestamp_diff("SECOND", F.date_trunc("SECOND", "w").cast("timestamp_ntz"), F.to_timestamp_ntz(F.lit(now))) / 3600, 6)
    return M.freshness(_watermarks(spark, sf, before), age, _threshold())


@query("WITH " + _fresh("f", "", "2024-01-31 12:00:00") + " SELECT source_id, age AS age_hours, thr AS threshold_hours, age > thr AS stale FROM f WHERE thr > 0")
def freshness_status(spark: SparkSession, sf: str) -> DataFrame:
    return _freshness(spark, sf, "2024-01-31 12:00:00").select("source_id", "age_hours", "threshold_hours", "stale")


_LEVEL = lambda age: f"CASE WHEN {age} <= thr THEN -1 ELSE CAST(floor(({age} - thr) / 48) AS INTEGER) END"


@query(
    "WITH " + _fresh("c", "", "2024-02-05 00:00:00") + ", " + _fresh("p", "", "2024-02-03 00:00:00")
    + f""", j AS (SELECT c.source_id, c.age, c.thr, {_LEVEL('c.age').replace('thr', 'c.thr')} AS level, coalesce({_LEVEL('p.age').replace('thr', 'c.thr')}, -1) AS level_before FROM c LEFT JOIN p ON p.source_id = c.source_id AND p.thr = c.thr WHERE c.thr > 0 AND c.age > c.thr)
SELECT source_id, level, level_before, level > level_before AS send, CASE WHEN level <= level_before THEN round(thr + (level + 1) * 48 - age, 1) END AS hours_to_next FROM j"""
)
def freshness_realert(spark: SparkSession, sf: str) -> DataFrame:
    return M.realerts(_freshness(spark, sf, "2024-02-05 00:00:00"), _freshness(spark, sf, "2024-02-03 00:00:00"))


@query(
    with_(SOURCE_DAYS.replace("FROM events", f"FROM events WHERE ts < TIMESTAMP '{CLOCK}'"), "d AS (SELECT max(run_day) AS last_day, count(DISTINCT run_day) - 1 AS k FROM source_days)", "u AS (SELECT source_id, k, sum(CASE WHEN run_day = last_day THEN n ELSE 0 END) AS x, sum(CASE WHEN run_day < last_day THEN n ELSE 0 END) AS s, sum(CASE WHEN run_day < last_day THEN n * n ELSE 0 END) AS q FROM source_days, d GROUP BY 1, 2)")
    + """SELECT source_id, CAST(x AS BIGINT) AS today, round(s::DOUBLE / k, 1) AS baseline, CASE WHEN k * x < s THEN 'drop' ELSE 'spike' END AS direction FROM u
WHERE k >= 2 AND s >= 3 * k AND CASE WHEN k * q = s * s THEN k * x <> s ELSE (k * x - s) * (k * x - s) > 4 * (k * q - s * s) END"""
)
def volume_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """As of CLOCK, so the last day is a part of one."""
    counts = source_days(spark, sf, F.col("ts") < F.to_timestamp_ntz(F.lit(CLOCK)))
    return M.volume_anomalies(counts, counts.select("run_day").distinct())


@query(
    "WITH c AS (SELECT user_id, count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-30') AS now, count(*) FILTER (CAST(ts AS DATE) = DATE '2024-01-29') AS before FROM events GROUP BY 1) SELECT CAST(user_id AS VARCHAR) AS source_id, before FROM c WHERE before > 0 AND now = 0"
)
def candidate_cliffs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("source_id"), F.date_trunc("DAY", "ts").cast("date").alias("d")).agg(F.count("*").alias("n"))
    return M.cliffs(e, F.col("d") == F.lit("2024-01-30").cast("date"), F.col("d") == F.lit("2024-01-29").cast("date"))


_NO_COUNTS = "day(run_day) % 5 = 0"  # such runs have no counts


@query(
    f"""WITH c AS (SELECT CAST(user_id AS VARCHAR) AS source_id, CAST(ts AS DATE) AS run_day, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT DISTINCT run_day FROM c ORDER BY run_day DESC LIMIT 5), k AS (SELECT run_day, row_number() OVER (ORDER BY run_day DESC) AS i FROM r WHERE NOT {_NO_COUNTS}),
s AS (SELECT source_id, coalesce(sum(n) FILTER (i = 1), 0) AS now, coalesce(sum(n) FILTER (i = 2), 0) AS before FROM c JOIN k USING (run_day) GROUP BY 1)
SELECT source_id, CAST(before AS BIGINT) AS before FROM s WHERE before > 0 AND now = 0"""
)
def recent_cliffs(spark: SparkSession, sf: str) -> DataFrame:
    """Of the last five runs, those with counts: who was there in the last but one and is gone in the last."""
    day = F.date_trunc("DAY", "ts").cast("date")
    counts = table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("source_id"), day.alias("run_day")).agg(F.count("*").alias("n"))
    return M.recent_cliffs(counts.withColumn("n", F.when(F.expr(f"NOT {_NO_COUNTS}"), F.col("n"))), "run_day")


_LAST = f"(SELECT run_day FROM (SELECT DISTINCT run_day FROM source_days ORDER BY run_day DESC LIMIT 12) WHERE NOT {_NO_COUNTS})"


@query(
    with_(SOURCE_DAYS, f"h AS (SELECT * FROM source_days WHERE run_day IN {_LAST})", "d AS (SELECT max(run_day) AS last_day, count(DISTINCT run_day) - 1 AS k FROM h)", "u AS (SELECT source_id, k, sum(CASE WHEN run_day = last_day THEN n ELSE 0 END) AS x, sum(CASE WHEN run_day < last_day THEN n ELSE 0 END) AS s, sum(CASE WHEN run_day < last_day THEN n * n ELSE 0 END) AS q FROM h, d GROUP BY 1, 2)")
    + """SELECT source_id, CAST(x AS BIGINT) AS today, round(s::DOUBLE / k, 1) AS baseline, CASE WHEN k * x < s THEN 'drop' ELSE 'spike' END AS direction FROM u
WHERE k >= 2 AND s >= 3 * k AND CASE WHEN k * q = s * s THEN k * x <> s ELSE (k * x - s) * (k * x - s) > 4 * (k * q - s * s) END"""
)
def recent_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Volumes against the last twelve runs, of which those without counts are passed over after that."""
    recent = M.latest_rows(source_days(spark, sf), "run_day", 12).where(F.expr(f"NOT {_NO_COUNTS}"))
    return M.volume_anomalies(recent, recent.select("run_day").distinct())


@query(with_(SOURCE_DAYS) + "SELECT source_id, n FROM source_days WHERE run_day = (SELECT max(run_day) FROM source_days)")
def latest_run_rows(spark: SparkSession, sf: str) -> DataFrame:
    return M.latest_rows(source_days(spark, sf), "run_day").select("source_id", "n")


@query(with_(SOURCE_DAYS) + "SELECT source_id, CAST(sum(n) AS BIGINT) AS n, count(*) AS runs FROM source_days WHERE run_day IN (SELECT DISTINCT run_day FROM source_days ORDER BY run_day DESC LIMIT 12) GROUP BY 1")
def last_n_runs_window(spark: SparkSession, sf: str) -> DataFrame:
    return M.latest_rows(source_days(spark, sf), "run_day", 12).groupBy("source_id").agg(F.sum("n").alias("n"), F.count("*").alias("runs"))


_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)


@query(
    with_(
        LINKS,
        PLAYERS,
        f"x AS (SELECT player_id, status, stage, extracted_at FROM links JOIN players USING (player_id) WHERE (status IN ('in_done', 'out_done') AND stage IN ({_IN(V.EARLY)})) OR (status IN ('in_link', 'out_link') AND stage IN ({_IN(V.ADVANCED + V.CLOSING)})))",
        f"h AS (SELECT player_id, status, stage, count(*) AS n FROM x WHERE extracted_at >= TIMESTAMP '{CYCLE}' GROUP BY 1, 2, 3)",
        f"w AS (SELECT player_id, count(*) AS total FROM x WHERE extracted_at >= TIMESTAMP '{RECENT}' GROUP BY 1 HAVING count(*) >= 2)",
    )
    + "SELECT player_id, CASE WHEN status IN ('in_done', 'out_done') THEN 'start' ELSE 'finish' END AS kind, total, string_agg(stage || ':' || n, ',' ORDER BY stage || ':' || n) AS stages FROM h JOIN w USING (player_id) GROUP BY player_id, status, total"
)
def roster_staleness(spark: SparkSession, sf: str) -> DataFrame:
    """The cycle and the recent days begin at CYCLE and RECENT."""
    since = lambda at: links(spark, sf).where(F.col("extracted_at") >= F.to_timestamp_ntz(F.lit(at))).select("player_id", "stage")
    return M.roster_staleness(since(CYCLE), since(RECENT), players(spark, sf).select("player_id", "status"))


@query(with_(LINKS, PLAYERS) + "SELECT player_id, stage, count(*) AS n FROM links JOIN players USING (player_id) WHERE confirmed AND extracted_at >= TIMESTAMP '2001-01-01 00:00:00' GROUP BY 1, 2")
def recent_stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    recent = links(spark, sf).where(F.col("extracted_at") >= F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00"))).select("player_id", "stage")
    return recent.join(players(spark, sf).where("confirmed").select("player_id"), "player_id", "left_semi").groupBy("player_id", "stage").agg(F.count("*").alias("n"))


@query(
    with_(LINKS, PLAYERS)
    + """SELECT o_orderkey AS article_id, (SELECT string_agg(full_name, '|' ORDER BY p.player_id) FROM (SELECT DISTINCT player_id FROM links WHERE article_id = o_orderkey AND role <> 'mention') l JOIN players p USING (player_id) WHERE p.confirmed) AS linked,
  CASE WHEN NOT EXISTS (SELECT 1 FROM links l JOIN players p USING (player_id) WHERE l.article_id = o_orderkey AND p.confirmed) THEN 'unlinked' ELSE 'linked' END AS badge FROM orders"""
)
def linked_badge(spark: SparkSession, sf: str) -> DataFrame:
    """Names of an article's confirmed players in order of id; an article has a few links."""
    own = links(spark, sf).select("article_id", "player_id", "role").join(players(spark, sf).where("confirmed").select("player_id", "full_name"), "player_id")
    named = own.groupBy("article_id", "player_id", "full_name").agg(F.max(F.col("role") != "mention").alias("subject"))
    subjects = F.array_sort(F.collect_list(F.when(F.col("subject"), F.struct("player_id", "full_name"))))
    per = named.groupBy("article_id").agg(F.nullif(F.array_join(F.transform(subjects, lambda s: s["full_name"]), "|"), F.lit("")).alias("linked"), F.lit("linked").alias("badge"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("article_id"))
    return orders.join(per, "article_id", "left").withColumn("badge", F.coalesce("badge", F.lit("unlinked")))
