"""Exact dedup by content sort, with DataFrame functions only.

Every row's normalised bytes (text without ASCII white space) are range-partitioned at
splitters that Spark samples, each partition is sorted externally, and the window
compares neighbouring keys byte by byte; the best row of a run of equals stays. The
splitters are the first HEAD characters and a hash of the rest, so that the sample which
the driver holds has short keys and texts with one common beginning still spread.

A text that more than max(100, rows / HOT_SHARE) rows share is hot. At most HOT_SHARE
texts can be hot at any size of input past 100 * HOT_SHARE rows (fewer below), so their
digests are a bounded broadcast. Hot rows get a salt in the range key, so that a text
that a third of all rows share is sorted in SALTS places; their sub-groups meet in an
aggregation on the full text, which combines before its shuffle.

Defined cases: null text is empty; all empty texts are one group. Ties in length go to
the smallest id, null ids last; of identical rows one is kept. An empty table gives no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import documents, partitions, text_or_empty

HOT_SHARE, SALTS, HEAD = 2000, 32, 32
WHITE = r"[\x20\x09-\x0D]"


def normal_digest(text_col: str) -> Column:
    """text_sha256 of a text."""
    return F.sha2(F.regexp_replace(text_or_empty(text_col), WHITE, "").cast("binary"), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select(
        "id", F.length("text").alias("chars"), F.regexp_replace("text", WHITE, "").alias("norm")
    )
    rows = rows.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    most = max(100, docs.count() // HOT_SHARE)
    hot = F.broadcast(rows.groupBy("sha").count().where(F.col("count") > most).select("sha", F.lit(True).alias("hot")))
    rows = rows.join(hot, "sha", "left").withColumn("hot", F.col("hot").isNotNull())
    salted = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(-1))

    best = F.struct((-F.col("chars")).alias("neg"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    salted = salted.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("rest", F.xxhash64("norm"))
    run = Window.partitionBy("head", "rest", "salt", "norm")
    ranked = (
        salted.repartitionByRange(partitions(spark), "head", "rest", "salt")
        .withColumn("best", best)
        .withColumn("rank", F.row_number().over(run.orderBy(F.desc("chars"), F.col("id").asc_nulls_last())))
        .withColumn("first", F.first("best").over(run.orderBy(F.desc("chars"), F.col("id").asc_nulls_last())))
        .withColumn("n", F.count("*").over(run))
        .select("id", "sha", "salt", "rank", "best", "first", "n")
    )
    whole = salted.where("hot").groupBy("norm", "sha").agg(F.min(best).alias("whole"), F.count("*").alias("whole_n")).select("sha", "whole", "whole_n")
    out = ranked.join(F.broadcast(whole), "sha", "left")
    keep = F.coalesce("whole", "first")
    return out.select(
        F.col("id").alias(id_col),
        keep["id"].alias("keep_id"),
        F.coalesce("whole_n", "n").cast("long").alias("group_size"),
        ((F.col("rank") == 1) & F.col("best").eqNullSafe(keep)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP5_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm,
             row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id,
             count(*) OVER (PARTITION BY norm) AS n
      FROM t WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""
