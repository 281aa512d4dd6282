"""Mixing sources to target weights with fixed-length blocks of words.

Each source's words, in the order of their documents, are cut into blocks of BLOCK words
(the last may be shorter). Output shards of SLOTS slots each draw multinomial source counts
from what is left of every source's quota, so shards are random and totals are exact: all
shards are halved down to single ones, and each task draws the halvings that it needs. The
k-th slot of a source takes the block that a keyed Feistel permutation of the source's
block indices gives for k; after all blocks, the next epoch has another permutation. Blocks
and slots are joined by (source, index).

Sizes on the driver follow sources, never shards or documents. Word offsets come from two
levels of sums (BUCKETS hash buckets in each source), so a source with a third of all rows
is summed in BUCKETS places. All draws are seeded: reruns agree.

Defined cases: null text has size 0 and is never taken; a source without words has target
0. The null source is a source of its own, last in order. Repeated rows are rows of their
own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import checkpointed, documents, keyed, keys, small_batches, text_or_empty

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
BLOCK, SLOTS, BUCKETS, SEED = 64, 1 << 18, 1024, 20
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source: by weight, at most `most` times its size."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    left, out = share * sum(sizes), [0.0] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        total = sum(w[i] for i in free)
        full = [i for i in free if w[i] * left / total > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = w[i] * left / total
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in full]
    return out


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..n-1, elementwise: Feistel rounds, walked back into range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2)
    mask = (np.int64(1) << half) - 1
    out, todo = index.astype(np.int64).copy(), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in range(4):
            x = (right.astype(np.uint64) + key[todo].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x >> np.uint64(32)).astype(np.int64) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= n[todo]]
    return out


def split(quota: np.ndarray, slots: int, rng: np.random.Generator) -> np.ndarray:
    """Slots of each source in a part of `slots` slots: multinomial draws from what the quotas have left."""
    take = np.minimum(rng.multinomial(slots, quota / quota.sum()), quota) if slots else np.zeros_like(quota)
    while short := slots - int(take.sum()):
        rest = quota - take
        take += np.minimum(rng.multinomial(short, rest / rest.sum()), rest)
    return take


class Shards:
    """The draws of all shards, each worked out where it is needed.

    All shards are halved again and again; a half's counts are drawn from the whole's with a seed
    of its own, so any task finds a shard's counts, and those of the shards before it, in as many
    draws as there are halvings, and totals are exact.
    """

    def __init__(self, quota: np.ndarray, slots: int, seed: int) -> None:
        self.quota, self.slots, self.seed = quota.astype(np.int64), slots, seed
        self.n = max(1, -(-int(quota.sum()) // slots))
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """(slots of each source in the shard, and in the shards before it)."""
        if shard not in self.known:
            low, high, here, before = 0, self.n, self.quota, np.zeros_like(self.quota)
            while high - low > 1:
                middle = (low + high) // 2
                first = split(here, (middle - low) * self.slots, np.random.default_rng((self.seed, low, high)))
                if shard < middle:
                    high, here = middle, first
                else:
                    low, here, before = middle, here - first, before + first
            if len(self.known) >= 64:
                self.known.clear()
            self.known[shard] = here, before
        return self.known[shard]


def word_offsets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, source, size, start (words before it in its source), and the carried columns."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text_or_empty(text_col)).alias("hash"), *carry)
    rows = checkpointed(rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")).select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("source", "bucket").orderBy("id", "hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ordered.alias("o").join(sums.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source")) & (F.col("o.bucket") == F.col("s.bucket")))
    return joined.select("id", "o.source", "size", "hash", *carry, (F.col("inside") + F.col("bucket_start")).alias("start"))


def source_numbers(spark: SparkSession, sources: Sequence[str | None]) -> DataFrame:
    """numbered, source_no: a row a source. Given as Arrow, as rows of tuples go through Python workers of another kind, which stay on every executor."""
    return spark.createDataFrame(pa.table({"numbered": pa.array(sources, pa.string()), "source_no": pa.array(range(len(sources)), pa.int32())}))


def mix_spans(offsets: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED) -> tuple[DataFrame, list[tuple]]:
    """The mix as spans of documents, and (source, source_size, target) of each source.

    Columns: shard, position (of the slot in it), epoch, source_no, block, id, hash, start,
    first_word (in the document), n_words.
    """
    spark = offsets.sparkSession
    small_batches(spark)
    found = offsets.groupBy("source").agg(F.sum("size").alias("n")).collect()  # a row a source
    found = sorted(((r["source"], int(r["n"] or 0)) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in found]
    targets = source_targets(sizes, weights, share, most)
    blocks = np.array([-(-n // block) for n in sizes], np.int64)
    quota = np.array([min(round(t / n * b), int(most * b)) if n else 0 for t, n, b in zip(targets, sizes, blocks, strict=True)], np.int64)
    info = [(s, n, float(t), i) for i, ((s, n), t) in enumerate(zip(found, targets, strict=True))]
    schema = "source_no int, block long, shard long, position long, epoch int"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(quota, slots, seed)
        for b in batches:
            slot = b.column(0).to_numpy(zero_copy_only=False)
            shard = slot // slots
            used, own = np.unique(shard, return_inverse=True)
            drawn, starts = (np.array(x).reshape(len(used), len(quota)) for x in zip(*[shards.of(int(i)) for i in used], strict=True)) if len(used) else (np.zeros((0, len(quota)), np.int64),) * 2
            bounds = np.cumsum(drawn, axis=1)
            mixed = permute(slot % slots, bounds[own, -1], shard + seed)
            source = (mixed[:, None] >= bounds[own]).sum(1)
            k = starts[own, source] + mixed - (bounds[own, source] - drawn[own, source])
            n = blocks[source]
            epoch = k // n
            index = permute(k % n, n, source * 1000 + epoch + seed)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((source, pa.int32()), (index, pa.int64()), (shard, pa.int64()), (slot % slots, pa.int64()), (epoch, pa.int32()))], names=["source_no", "block", "shard", "position", "epoch"])

    drawn = spark.range(int(quota.sum())).mapInArrow(fill, schema)
    numbers = F.broadcast(source_numbers(spark, [s for s, _ in found]))
    own = offsets.where("size > 0").join(numbers, F.col("source").eqNullSafe(F.col("numbered")))
    end = F.col("start") + F.col("size")
    pieces = own.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    first = F.greatest(F.col("block") * block, F.col("start"))
    pieces = pieces.select("source_no", "block", "id", "hash", "start", (first - F.col("start")).alias("first_word"), (F.least((F.col("block") + 1) * block, end) - first).alias("n_words"))
    return drawn.join(pieces, ["source_no", "block"]), info


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as rows of docs: a row for each document and epoch, with the words taken.

    Words of neighbouring blocks stand as in the text; where blocks in between were not
    taken, a line break stands. n_chars, if docs has it, counts the new text.
    """
    offsets = checkpointed(word_offsets(docs, id_col, text_col, source_col))
    spans, _ = mix_spans(offsets)
    taken = spans.groupBy("id", "hash", "source_no", "start", "epoch").agg(F.array_sort(F.collect_list(F.struct("first_word", "n_words"))).alias("spans"))  # at most a document's own blocks
    asked = keyed(taken, "id", F.col("hash")).select(*keys(3), F.col("row.spans").alias("spans"))
    texts = keyed(docs, id_col, F.xxhash64(text_or_empty(text_col))).dropDuplicates(keys(3))
    joined = texts.join(asked, keys(3))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        pattern = re.compile(WORD)
        for b in batches:
            out = []
            for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                places = [m.span() for m in pattern.finditer(text)]
                runs: list[list[int]] = []
                for s in spans:
                    if runs and runs[-1][1] == s["first_word"]:
                        runs[-1][1] += s["n_words"]
                    else:
                        runs.append([s["first_word"], s["first_word"] + s["n_words"]])
                out.append(text if runs == [[0, len(places)]] else "\n".join(text[places[a][0] : places[z - 1][1]] for a, z in runs))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.string())], names=["row", "mixed"])

    rest = T.StructType([f for f in docs.schema if f.name != text_col])
    small_batches(docs.sparkSession)
    asked_rows = joined.select(F.struct(*[F.col("row")[f.name].alias(f.name) for f in rest]).alias("row"), F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")).alias("text"), "spans")
    mixed = asked_rows.mapInArrow(cut, T.StructType([T.StructField("row", rest), T.StructField("mixed", T.StringType())]))
    own = {text_col: F.col("mixed"), "n_chars": F.length("mixed")}
    return mixed.select(*[own.get(f.name, F.col("row")[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema])


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row a document: id, size, source_size, target (of its source), taken."""
    offsets = checkpointed(word_offsets(docs, id_col, text_col, source_col))
    spans, info = mix_spans(offsets)
    taken = spans.groupBy(F.col("source_no").alias("n"), F.col("start").alias("at")).agg(F.sum("n_words").alias("taken"))
    sources = F.broadcast(docs.sparkSession.createDataFrame(info, "numbered string, source_size long, target double, source_no int"))  # a row a source
    rows = offsets.join(sources, F.col("source").eqNullSafe(F.col("numbered")))
    out = rows.join(taken, (F.col("source_no") == F.col("n")) & (F.col("start") == F.col("at")) & (F.col("size") > 0), "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(documents(spark, sf_dir))
