"""Dictionaries of any size: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import names as N
from newsloom.plans.bridge import registrar, table

Q, SQL, query = registrar()


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.substr("text", F.lit(1), F.lit(300)).alias("head"))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    """As many names as documents have different second and third words: the dictionary grows with the table."""
    return table(spark, sf, "documents").select(F.regexp_extract("text", r"^\S+ (\S+ \S+)", 1).alias("name")).where("name <> ''").distinct()


_TABLES = r"""WITH t AS (SELECT doc_id, substring(text, 1, 300) AS head FROM documents),
n AS MATERIALIZED (SELECT DISTINCT regexp_extract(text, '^\S+ (\S+ \S+)', 1) AS name FROM documents WHERE regexp_extract(text, '^\S+ (\S+ \S+)', 1) <> ''),
h AS MATERIALIZED (SELECT doc_id, head, name, strpos(head, name) AS place FROM t, n WHERE contains(head, name))"""


@query(_TABLES + "\nSELECT doc_id, first(name ORDER BY length(name) DESC, name) AS longest, count(*) AS names FROM h GROUP BY doc_id")
def dictionary_names(spark: SparkSession, sf: str) -> DataFrame:
    """The longest name of a dictionary in each text's head, and how many names there are."""
    places = N.name_places(_texts(spark, sf), _names(spark, sf), "doc_id", "head")
    best = F.min(F.struct((-F.length("name")).alias("n"), "name"))
    return places.groupBy("doc_id").agg(best.alias("b"), F.count_distinct("name").alias("names")).select("doc_id", F.col("b.name").alias("longest"), "names")


TURNS = ["ing ", "ion ", ". "]
_TURN = "list_min(list_filter([" + ", ".join(f"strpos(head, '{w}')" for w in TURNS) + "], lambda x: x > 0))"


@query(
    _TABLES
    + f""",
w AS (SELECT doc_id, {_TURN} AS turn FROM t),
p AS (SELECT h.doc_id, name, place, coalesce(place > turn, FALSE) AS behind FROM h JOIN w USING (doc_id))
SELECT doc_id, first(name ORDER BY behind DESC, place, name) AS name FROM p GROUP BY doc_id"""
)
def dictionary_protagonists(spark: SparkSession, sf: str) -> DataFrame:
    """Whom each text's head is about: the first name behind its first turn, else its first name."""
    turns = spark.createDataFrame([(w,) for w in TURNS], "name string")
    return N.protagonists(_texts(spark, sf), _names(spark, sf), turns, "doc_id", "head")
