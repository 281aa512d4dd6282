"""Recording of people: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import people as P
from newsloom.plans.bridge import ARTICLES, articles, registrar, with_

Q, SQL, query = registrar()

#: Names that articles give, by the numbers of their first words: two and one, of which common words are many people's.
_NAMES = [(1, 2), (2,), (3, 4), (4,), (5, 6), (7,)]


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with the pairs of people that the first words of their texts make, a few stages of which are none."""
    a = articles(spark, sf).select("doc_id", "source", "stage", F.regexp_extract_all(F.substr("text", F.lit(1), F.lit(400)), F.lit("[A-Za-z]+"), F.lit(0)).alias("w"))
    word = lambda i: F.coalesce(F.get("w", F.lit(i - 1)), F.lit(""))
    stage = lambda i: F.when((F.col("doc_id") + i) % 5 == 0, "unheard of").otherwise(F.col("stage"))
    raw = F.array(*[F.struct(F.concat_ws(" ", *[word(i) for i in n]).alias("full_name"), F.lit(None).cast("string").alias("ko"), stage(k).alias("stage"), F.lit(" Mention " if k % 2 else "x").alias("role")) for k, n in enumerate(_NAMES)])
    return a.select(F.col("doc_id").alias("article_id"), F.col("doc_id").alias("seq"), P.normal_pairs(raw, F.col("source") == "src0", (F.col("source") == "src1")).alias("pairs"), "w")


def _roster(pairs: DataFrame) -> DataFrame:
    """Players with the two first words of every 25th article; of some the surname is their first word."""
    w = lambda i: F.get("w", F.lit(i))
    rows = pairs.where("article_id % 25 = 0 AND size(w) >= 2")
    return rows.select(F.col("article_id").alias("player_id"), F.concat_ws(" ", w(0), w(1)).alias("full_name"), F.when(F.col("article_id") % 100 == 0, w(0)).otherwise(w(1)).alias("surname"))


_RAW = ", ".join(f"{{'name': trim(concat_ws(' ', {', '.join(f"coalesce(w[{i}], {chr(39) * 2})" for i in n)})), 'stage': CASE WHEN (doc_id + {k}) % 5 = 0 THEN 'other' ELSE stage END, 'role': {"'mention'" if k % 2 else 'NULL'}, 'spot': {k}}}" for k, n in enumerate(_NAMES))
_PEOPLE = with_(
    ARTICLES,
    f"raw AS (SELECT doc_id, source, w, unnest([{_RAW}], recursive := true) FROM (SELECT *, regexp_extract_all(substring(text, 1, 400), '[A-Za-z]+') AS w FROM articles))",
    "kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(name) ORDER BY spot) AS n FROM raw WHERE name <> '' AND length(name) <= 100)",
    """rows AS MATERIALIZED (SELECT doc_id, spot, lower(name) AS name, name AS spelled, NOT contains(name, ' ') AS single, lower(string_split(name, ' ')[-1]) AS last, doc_id * 100 + spot AS place, role,
  CASE WHEN source = 'src0' THEN 'official' WHEN stage = 'official' OR stage = 'done' THEN CASE WHEN source = 'src1' THEN 'official' ELSE 'done' END ELSE stage END AS stage FROM kept WHERE n = 1 AND length(string_split(name, ' ')[-1]) <= 50)""",
    "roster AS MATERIALIZED (SELECT DISTINCT doc_id AS player_id, lower(w[1] || ' ' || w[2]) AS name, lower(CASE WHEN doc_id % 100 = 0 THEN w[1] ELSE w[2] END) AS surname FROM raw WHERE doc_id % 25 = 0 AND len(w) >= 2)",
    "full_ AS (SELECT name, min(player_id) AS by_full FROM roster GROUP BY name)",
    "sur AS (SELECT surname, count(*) AS listed, min(player_id) AS by_surname FROM roster GROUP BY surname)",
    "fresh AS (SELECT name, last, min(place) AS first FROM rows WHERE NOT single AND name NOT IN (SELECT name FROM full_) GROUP BY name, last)",
    "nth AS (SELECT *, row_number() OVER (PARTITION BY last ORDER BY first) AS n FROM fresh)",
    "state AS MATERIALIZED (SELECT r.*, f.by_full, s.listed, s.by_surname, a.name AS one, coalesce(s.listed, 0) + coalesce((a.first // 100 < r.doc_id)::INTEGER, 0) + coalesce((b.first // 100 < r.doc_id)::INTEGER, 0) AS holders FROM rows r LEFT JOIN full_ f ON f.name = r.name LEFT JOIN sur s ON r.single AND s.surname = r.name LEFT JOIN nth a ON r.single AND a.last = r.name AND a.n = 1 LEFT JOIN nth b ON r.single AND b.last = r.name AND b.n = 2)",
    "made AS (SELECT name, first AS made FROM fresh UNION ALL SELECT name, min(place) FROM state WHERE single AND by_full IS NULL AND holders <> 1 GROUP BY name)",
    "told AS (SELECT s.*, made, CASE WHEN by_full IS NOT NULL THEN 'full' WHEN made = place THEN 'candidate' WHEN made < place THEN 'known' ELSE 'surname' END AS how FROM state s LEFT JOIN made USING (name))",
    "links AS (SELECT *, CASE WHEN how = 'full' THEN by_full WHEN how = 'surname' AND listed = 1 THEN by_surname END AS player_id, CASE WHEN how IN ('candidate', 'known') THEN name WHEN how = 'surname' AND by_surname IS NULL THEN one END AS candidate FROM told)",
)


@query(_PEOPLE + "SELECT doc_id AS article_id, name, player_id, candidate, how FROM links")
def recorded_people(spark: SparkSession, sf: str) -> DataFrame:
    """Who each pair of each article is: a player, or a candidate that it or an earlier row made."""
    pairs = _pairs(spark, sf)
    links, _ = P.record_people(pairs, _roster(pairs))
    return links.select("article_id", F.lower("pair.full_name").alias("name"), "player_id", "candidate", "how")


@query(_PEOPLE + "SELECT doc_id AS article_id, player_id, candidate, arg_max(stage, spot) AS stage, max_by(ROW(role), spot)[1] AS role FROM links GROUP BY ALL")
def article_people(spark: SparkSession, sf: str) -> DataFrame:
    """Links as an upsert of the pairs leaves them."""
    pairs = _pairs(spark, sf)
    return P.article_links(P.record_people(pairs, _roster(pairs))[0])


@query(_PEOPLE + "SELECT candidate, spelled AS full_name, nullif(array_to_string(string_split(spelled, ' ')[:-2], ' '), '') AS first_name, string_split(spelled, ' ')[-1] AS surname, doc_id AS first_seen FROM links WHERE how = 'candidate'")
def new_candidates(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf)
    return P.record_people(pairs, _roster(pairs))[1].select("candidate", "full_name", "first_name", "surname", "first_seen")
