"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns
the columns of documents; the last returns the packed pieces. Between stages the driver
writes Parquet; run() writes nothing but checkpoints.

Defined cases: null texts count as empty ones, and null ids are ids of their own. Empty
tables give empty ones. A column's name may be any but those of documents twice. The stages
- quality: scores every row by its text alone, so repeated rows stay or go together;
- exact_dedup: of equal texts the longest, then least id stays; of rows with one id and one
  text but for blanks, the longest; rows with one id and other texts all stay;
- near_duplicates: of a class the least id stays, null ids last; of equal rows one;
- mix: rows with equal id and text are one document, taken as often as drawn, an epoch a row;
- pack: every row gives its pieces, an empty text one with the end token alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import checkpointed, keyed, keys
from newsloom.llm.exact_dedup import exact_dedup, normal_digest
from newsloom.llm.jaccard import one_of_each_class
from newsloom.llm.mixing import mix_documents
from newsloom.llm.packing import pack_documents
from newsloom.llm.quality import THRESHOLD, fit_quality, score_quality


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones of docs, accepts."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs.select(F.struct("*").alias("row"), "text"), model, keep=("row",))
    return scored.where(F.col("score") >= THRESHOLD).select("row.*")


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the row that exact dedup keeps."""
    kept = exact_dedup(docs).where("kept")
    kept = keyed(kept, "doc_id", F.col("text_sha256")).select(keys(3)).distinct()
    rows = keyed(docs, "doc_id", normal_digest("text")).join(kept, keys(3), "left_semi")
    same = Window.partitionBy(keys(3)).orderBy(F.length("row.text").desc_nulls_last())  # rows with one id and one text
    return rows.withColumn("rank", F.row_number().over(same)).where("rank = 1").select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five words, 0.8)."""
    return one_of_each_class(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document's words as often as they are drawn."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return pack_documents(docs, lean=True)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", keep_first_copies),
    ("near_duplicates", keep_one_of_near_copies),
    ("mix", mix),
    ("pack", pack),
]
#: A trained network, MinHash, seeded draws and tokens: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
