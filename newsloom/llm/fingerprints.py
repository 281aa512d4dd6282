"""Canonical exact digests of documents.

The canonical form is NFKC, case folded, NFKC again, with runs of white space as one blank
and none at the ends. The fingerprint is the 128-bit xxhash of its UTF-8 bytes. Classes
group the digest together with the (compressed) canonical bytes, so two texts share a class
only if their bytes are equal, whatever the hash does; bytes move only for texts whose digest
stands more than once, and copies combine before the shuffle. Such rows and their classes are
broadcast while they are at most SMALL, and joined by a shuffle beyond.
The likeness of two fingerprints is exact: 1.0 for equal canonical bytes, else 0.0.

Each text meets the one that follows in descending id order without one global sort: quantile
splitters deal ids to buckets by binary search, the first row of each bucket (one row a
bucket) is also lent to the bucket before, and a pass over the sorted buckets, in which each
text is made canonical once, edits every text with the next one.

Defined cases: null text is empty and has a fingerprint like any other. Equal ids follow
in the order of their text's hash; null ids come last. A table of one row is its own
neighbour. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import checkpointed, documents, order_key, partitions, small_batches, text_or_empty


#: Rows of some 100 bytes that may be broadcast.
SMALL = 100_000


def canonical(text: str) -> str:
    if text.isascii():
        return " ".join(text.lower().split())
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(form: str) -> str:
    return raw_digest(form).hex()


def raw_digest(form: str) -> bytes:
    return xxhash.xxh3_128_digest(form.encode("utf-8", "surrogatepass"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), order_key(docs, id_col).alias("key"), F.xxhash64(text).alias("hash"), text.alias("text"))


def _dealt(rows: DataFrame, cuts: np.ndarray) -> DataFrame:
    """rows with bucket: how many of the cuts lie below the key; -1 for null ids."""
    schema = T.StructType([*rows.schema, T.StructField("bucket", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket = np.searchsorted(cuts, b.column("key").to_numpy().astype(float))
            bucket[b.column("id").is_null().to_numpy(zero_copy_only=False)] = -1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket)], names=schema.names)

    return rows.mapInArrow(run, schema)


def in_order(rows: DataFrame) -> DataFrame:
    """rows (id, key, hash, text) with bucket and lent, sorted in each partition: a bucket's rows by descending id, then the row that follows them."""
    spark = rows.sparkSession
    n = 4 * partitions(spark)
    cuts = rows.where("id IS NOT NULL").select(F.col("key").cast("double").alias("key")).approxQuantile("key", [i / n for i in range(1, n)], 0.2 / n)
    cuts = np.unique(np.array(cuts, float))  # some for each partition
    light = _dealt(rows.select("id", "key", "hash"), cuts)
    head = F.max(F.struct(F.col("id").isNotNull().alias("has"), "id", F.bitwise_not("hash").alias("back")))
    heads = sorted(light.groupBy("bucket").agg(head.alias("m")).collect(), key=lambda r: -r["bucket"])  # a row a bucket
    lent = [(r["m"]["id"], ~r["m"]["back"], heads[k - 1]["bucket"]) for k, r in enumerate(heads)]  # the first goes to the last
    schema = T.StructType([T.StructField("lent_id", rows.schema["id"].dataType), T.StructField("lent_hash", T.LongType()), T.StructField("lent_to", T.LongType())])
    marked = _dealt(rows, cuts).join(F.broadcast(spark.createDataFrame(lent, schema)), F.col("id").eqNullSafe(F.col("lent_id")) & (F.col("hash") == F.col("lent_hash")), "left")
    own = F.struct(F.lit(False).alias("lent"), F.col("bucket").alias("to"))
    also = F.struct(F.lit(True).alias("lent"), F.col("lent_to").alias("to"))
    places = F.explode(F.when(F.col("lent_to").isNull(), F.array(own)).otherwise(F.array(own, also)))
    dealt = marked.select("id", "hash", "text", places.alias("at")).select("id", "hash", "text", F.col("at.to").alias("bucket"), "at.lent")
    return dealt.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "lent", F.desc_nulls_last("id"), "hash")


def form_sha(form: str) -> bytes:
    return hashlib.sha256(form.encode()).digest()


def with_edits(ordered: DataFrame) -> DataFrame:
    """id, hash, n_chars, edited_sha256, fingerprint, form_sha, edited_fingerprint, near_edited, near_next of each row of in_order()."""
    s, d = T.BinaryType(), T.DoubleType()
    names = ["n_chars", "edited_sha256", "fingerprint", "form_sha", "edited_fingerprint", "near_edited", "near_next"]
    schema = T.StructType([ordered.schema["id"], ordered.schema["hash"], *[T.StructField(n, t) for n, t in zip(names, (T.LongType(), s, s, s, s, d, d), strict=True)]])
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def edited(text: str, form: str, after: str, next_form: str) -> tuple:
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        edit = canonical(new)
        return len(text), hashlib.sha256(new.encode()).digest(), raw_digest(form), form_sha(form), raw_digest(edit), float(form == edit), float(form == next_form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # bucket, text, form, id and hash of the row before
        for b in batches:
            out, places, early = [], [], None
            last, keep = waiting, None
            for i, (text, bucket, lent) in enumerate(zip(b.column("text").to_pylist(), b.column("bucket").to_pylist(), b.column("lent").to_pylist(), strict=True)):
                if lent and last is None:
                    continue  # a repeated row that was lent again
                form = canonical(text)
                if last is not None and last[0] == bucket:
                    out.append(edited(last[1], last[2], text, form))
                    if keep is None:
                        early = last[3]
                    else:
                        places.append(keep)
                last, keep = (None, None) if lent else ((bucket, text, form, None), i)
            waiting = last if keep is None or last is None else (*last[:3], pa.RecordBatch.from_arrays([b.column("id").slice(keep, 1), b.column("hash").slice(keep, 1)], names=["id", "hash"]))
            if out:
                at = pa.array(places, pa.int32())
                own = [b.column("id").take(at), b.column("hash").take(at)]
                if early is not None:
                    own = [pa.concat_arrays([early.column(k), own[k]]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))], names=schema.names)

    return ordered.mapInArrow(run, schema)


def fingerprint_classes(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, bool]:
    """(fingerprint, form_sha, class_id (smallest id), class_size: a row a class of two or more; whether they are few)."""
    many = checkpointed(found.groupBy("fingerprint").count().where("count > 1").select("fingerprint"))  # written, so that AQE can split the join at a frequent text
    repeated = checkpointed(found.select("id", "hash", "fingerprint").join(many, "fingerprint", "left_semi").select(F.col("id").alias("own"), F.col("hash").alias("own_hash")))
    few = repeated.count() <= SMALL
    texts = rows.join(F.broadcast(repeated) if few else repeated, F.col("id").eqNullSafe(F.col("own")) & (F.col("hash") == F.col("own_hash")), "left_semi").select("id", "text")
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, T.BinaryType()) for n in ("fingerprint", "form_sha", "packed")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            forms = [canonical(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([raw_digest(f) for f in forms], pa.binary()), pa.array([form_sha(f) for f in forms], pa.binary()), pa.array([pack(f.encode()) for f in forms], pa.binary())], names=schema.names)

    grouped = texts.mapInArrow(run, schema).groupBy("fingerprint", "packed").agg(F.first("form_sha").alias("form_sha"), F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return grouped.select("fingerprint", "form_sha", "class_id", "class_size"), few


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, their likeness, and its class."""
    small_batches(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    found = checkpointed(with_edits(in_order(rows)))
    classes, few = fingerprint_classes(rows, found)
    out = found.join(F.broadcast(classes) if few else classes, ["fingerprint", "form_sha"], "left")
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return out.select(F.col("id").alias(id_col), "n_chars", text("edited_sha256"), text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))
