"""Ranked lexical search: the k highest-scoring documents of each item, by a threshold-seeded join.

Terms are runs of characters other than ASCII's controls, blanks and punctuation, A-Z in lower
case. For a block of items, documents become a table of postings: a row a document, with the
numbers and counts of those of its terms that some item of the block has. From it

1. each term's frequency, its largest and its k-th largest impact and the documents of its k
   largest are stored (k rows a term and task, then k a term);
2. an item's k-th score is at least every k-th impact of its terms. Those stored documents are
   scored exactly, and their k-th score is a lower bound, too: the larger is the threshold;
3. an item's terms in order of falling bounds are cut where the bounds of all that follow
   together stay under the threshold: a document with none of the terms before can't be among the k;
4. the postings of the terms before the cut give the candidates, each once an item and
   document; they are scored exactly, those under the threshold are dropped, and k a task and
   item go to the final ranking.

Impacts and thresholds are whole numbers; a document of exactly the threshold is kept, since it
may win by its id. Blocks bound what the driver holds and broadcasts: terms of about BLOCK bytes
of items, k documents for each. One item of any length is one block's work.

Defined cases: null texts have no terms. Documents without terms count nowhere; items without
terms, or whose terms no document has, have no rows. Equal scores rank by ascending id, null ids
last. Each row is a document and each row of the items an item, also where ids repeat. Empty
tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import documents, small_batches, written

K = 20
#: Bytes of items whose terms are searched together.
BLOCK = 1 << 20
#: Pairs of a document and an item whose terms are looked up at once.
PAIRS = 1 << 14
_PLAIN = bytes(c if chr(c).isdigit() or chr(c).islower() or c >= 128 else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8; all bytes that part them are ASCII."""
    return text.translate(_PLAIN).split()


def _utf8(col: str) -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start .. start + size - 1 of each one after another, and which it belongs to."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) + np.repeat(start - (np.cumsum(size) - size), size), owner


@dataclass
class Items:
    """Items of a block: ids, and of each its terms (numbers, ascending) and how often it has them."""

    ids: list
    names: list[bytes]  # of terms
    begin: np.ndarray
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        counts = [Counter(terms(t)) for _, t in rows]
        names = sorted({t for c in counts for t in c})
        number = {t: i for i, t in enumerate(names)}
        flat = [sorted((number[t], n) for t, n in c.items()) for c in counts]
        pairs = np.array([p for f in flat for p in f], np.int64).reshape(-1, 2)
        return cls([i for i, _ in rows], names, np.concatenate([[0], np.cumsum([len(f) for f in flat])]).astype(np.int64), pairs[:, 0], pairs[:, 1])

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.begin))


def postings(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """row (its own number), id, n (terms in all), and term and tf of the items' terms that it has, by number; written."""
    small_batches(docs.sparkSession)
    names = docs.sparkSession.sparkContext.broadcast(items.names)  # of one block
    lists = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("term", lists), T.StructField("tf", lists)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(names.value)}
        for b in batches:
            n, size, term, tf = [], [], [], []
            for text in b.column(1).to_pylist():
                found = terms(text)
                counts = Counter(found)
                own = sorted((number[t], c) for t, c in counts.items() if t in number)
                n.append(len(found))
                size.append(len(own))
                term += [t for t, _ in own]
                tf += [c for _, c in own]
            ends = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))], names=schema.names)

    found = docs.select(F.col(id_col).alias("id"), _utf8(text_col)).mapInArrow(run, schema)
    return written(found.where("n > 0").withColumn("row", F.monotonically_increasing_id()))


@dataclass
class Batch:
    """Postings of some documents, flat: of each posting its document (place), term, and impact without the term's weight."""

    doc: np.ndarray
    term: np.ndarray
    q: np.ndarray

    @classmethod
    def of(cls, b: pa.RecordBatch, total: int, words: int) -> Batch:
        n, listed = b.column("n").to_numpy(), b.column("term")
        doc = np.repeat(np.arange(b.num_rows), listed.value_lengths().to_numpy())
        tf = b.column("tf").flatten().to_numpy().astype(np.int64)
        m = 100 - 25 + 25 * n * total // words
        return cls(doc, listed.flatten().to_numpy().astype(np.int64), 1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))


def best(score: np.ndarray, tie: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of each group, ties by the smaller tie."""
    order = np.lexsort((tie, -score, group))
    g = group[order]
    start = np.flatnonzero(np.diff(g, prepend=-1))
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[rank < k]


@dataclass
class Stored:
    """What is stored of each term: document frequency, its largest impacts without the weight, falling, and their documents' rows."""

    df: np.ndarray
    top: list[np.ndarray]
    rows: list[np.ndarray]


def stored_impacts(index: DataFrame, n_terms: int, total: int, words: int, k: int) -> Stored:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        held, most = [np.empty(0, np.int64)] * 3, 1 << 20
        for b in batches:
            own = Batch.of(b, total, words)
            df += np.bincount(own.term, minlength=n_terms)
            held = [np.concatenate(x) for x in zip(held, (own.term, own.q, b.column("row").to_numpy()[own.doc]), strict=True)]
            if len(held[0]) > most:
                keep = best(held[1], held[2], held[0], k)
                held = [x[keep] for x in held]
                most = max(most, 2 * len(keep))
        keep = best(held[1], held[2], held[0], k)
        term, q, row = (x[keep] for x in held)
        start = np.flatnonzero(np.diff(term, prepend=-1))
        ends = pa.array(np.append(start, len(term)), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(term[start]), pa.array(df[term[start]]), pa.ListArray.from_arrays(ends, pa.array(q)), pa.ListArray.from_arrays(ends, pa.array(row))], names=["term", "df", "q", "row"])

    per_task = written(index.select("row", "n", "term", "tf").mapInArrow(run, "term long, df long, q array<long>, row array<long>"))
    each = per_task.select("term", F.explode(F.arrays_zip("q", "row")).alias("at")).select("term", "at.q", "at.row")
    order = Window.partitionBy("term").orderBy(F.desc("q"), "row")
    tops = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("term", "rank", "q", "row").toArrow()  # k rows a term of the block
    counts = per_task.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    term, rank, q, row = (tops.column(c).to_numpy() for c in ("term", "rank", "q", "row"))
    by = np.lexsort((rank, term))
    cuts = np.searchsorted(term[by], np.arange(1, n_terms))
    return Stored(df, np.split(q[by], cuts), np.split(row[by], cuts))


@dataclass
class Plan:
    """What a task needs to score: weights, items, thresholds, and which items a term or a row makes a candidate of."""

    items: Items
    weight: np.ndarray
    total: int
    words: int
    floor: np.ndarray  # of each item, the lowest score that counts
    by_row: bool  # candidates by the documents' rows, or else by their terms
    key: np.ndarray  # rows or terms, ascending
    item: np.ndarray  # the item beside each

    def candidates(self, b: pa.RecordBatch, own: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Document (place) and item of each candidate, once each."""
        asked, doc = (b.column("row").to_numpy(), np.arange(b.num_rows)) if self.by_row else (own.term, own.doc)
        first = np.searchsorted(self.key, asked)
        at, owner = spread(first, np.searchsorted(self.key, asked, "right") - first)
        found = np.unique(doc[owner] * len(self.items.ids) + self.item[at])
        return found // len(self.items.ids), found % len(self.items.ids)

    def scores(self, own: Batch, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Exact scores of the pairs."""
        n_terms, begin = len(self.weight), self.items.begin
        places = own.doc * n_terms + own.term  # ascending
        impact = self.weight[own.term] * own.q
        out = np.zeros(len(doc), np.int64)
        for a in range(0, len(doc), PAIRS):
            d, i = doc[a : a + PAIRS], item[a : a + PAIRS]
            at, pair = spread(begin[i], begin[i + 1] - begin[i])
            wanted = d[pair] * n_terms + self.items.term[at]
            place = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
            hit = places[place] == wanted
            np.add.at(out, a + pair[hit], self.items.times[at[hit]] * impact[place[hit]])
        return out


def ranked(index: DataFrame, plan: Plan, k: int) -> DataFrame:
    """item, score, id, row: of each item the k best candidates of each task that reach its floor."""
    given = index.sparkSession.sparkContext.broadcast(plan)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), index.schema["id"], T.StructField("row", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, held, rows = given.value, None, 0
        for b in batches:
            own = Batch.of(b, p.total, p.words)
            doc, item = p.candidates(b, own)
            if not len(doc):
                continue
            score = p.scores(own, doc, item)
            good = np.flatnonzero((score > 0) & (score >= p.floor[item]))
            at = pa.array(doc[good])
            new = pa.table([pa.array(item[good]), pa.array(score[good]), b.column("id").take(at), b.column("row").take(at)], names=schema.names)
            held = new if held is None else pa.concat_tables([held, new])
            rows += len(good)
            if rows > 4 * k * len(p.items.ids):
                held = kept(held)
                rows = held.num_rows
        if held is not None:
            yield from kept(held).combine_chunks().to_batches()

    def kept(held: pa.Table) -> pa.Table:
        tie = np.empty(held.num_rows, np.int64)
        tie[pc.sort_indices(held, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_end").to_numpy()] = np.arange(held.num_rows)
        return held.take(pa.array(best(held.column("score").to_numpy(), tie, held.column("item").to_numpy(), k)))

    return index.select("row", "id", "n", "term", "tf").mapInArrow(run, schema)


def kth_scores(rows: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Of each item, the k-th highest score; 0 where there are fewer."""
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    last = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("item", "score")
    out = np.zeros(n_items, np.int64)
    for r in last.collect():  # a row an item of the block
        out[r["item"]] = r["score"]
    return out


def essential(items: Items, bound: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Of each posting of an item, whether it makes candidates: the bounds of it and all smaller ones reach the floor."""
    owner = items.owner()
    order = np.lexsort((bound, owner))
    sums = np.cumsum(bound[order])
    sums -= (sums - bound[order])[items.begin[:-1][owner[order]]]
    out = np.zeros(len(owner), bool)
    out[order] = sums >= np.maximum(floor, 1)[owner[order]]
    return out


def search_block(docs: DataFrame, rows: list[tuple], k: int, id_col: str, text_col: str) -> tuple[Items, DataFrame]:
    """The items of a block, and item, score, id, row of the best candidates."""
    items = Items.of(rows)
    index = postings(docs, items, id_col, text_col)
    total, words = (int(x or 0) for x in index.agg(F.count("*"), F.sum("n")).first())
    n_terms = len(items.names)
    if not total or not n_terms:
        none = index.select(F.lit(0).cast("long").alias("item"), F.lit(0).cast("long").alias("score"), "id", "row").where("false")
        return items, none
    stored = stored_impacts(index, n_terms, total, words, k)
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in stored.df.tolist()], np.int64)
    each = items.times * weight[items.term]
    owner = items.owner()
    largest = np.array([q[0] if len(q) else 0 for q in stored.top], np.int64)
    kth = np.array([q[k - 1] if len(q) == k else 0 for q in stored.top], np.int64)
    floor = np.zeros(len(items.ids), np.int64)
    np.maximum.at(floor, owner, each * kth[items.term])
    seeds = [(r, i) for i, t, e in zip(owner.tolist(), items.term.tolist(), each.tolist(), strict=True) if e for r in stored.rows[t].tolist()]
    pairs = np.unique(np.array(seeds, np.int64).reshape(-1, 2), axis=0)
    seeded = ranked(index, Plan(items, weight, total, words, floor, True, pairs[:, 0], pairs[:, 1]), k)
    floor = np.maximum(floor, kth_scores(seeded, len(items.ids), k))
    first = np.flatnonzero(essential(items, each * largest[items.term], floor))
    by_term = first[np.argsort(items.term[first], kind="stable")]
    return items, ranked(index, Plan(items, weight, total, words, floor, False, items.term[by_term], owner[by_term]), k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score of the k highest-scoring documents of each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("id"), _utf8(item_text_col).alias("text"))
    blocks = max(1, -(-int(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    out = []
    for n in range(blocks):
        rows = [(r["id"], bytes(r["text"])) for r in dealt.where(F.col("block") == n).orderBy("id", "text").collect()]  # about `block` bytes
        own, found = search_block(docs, rows, k, id_col, text_col)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame(list(enumerate(own.ids)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", items.schema[item_col].dataType)]))
        out.append(top.join(F.broadcast(named), "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    return reduce(DataFrame.unionByName, out)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT row_number() OVER () AS row_no, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
whole AS MATERIALIZED (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_words FROM d WHERE len(t) > 0),
asked AS MATERIALIZED (SELECT row_no, item_id, term, count(*) AS times FROM (SELECT row_no, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
tf AS MATERIALIZED (SELECT row_id, doc_id, n, term, count(*) AS tf FROM (SELECT row_id, doc_id, len(t) AS n, unnest(t) AS term FROM d) SEMI JOIN (SELECT DISTINCT term FROM asked) USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, n_docs),
impact AS (SELECT row_id, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_words))) AS impact FROM tf JOIN w USING (term), whole),
scored AS (SELECT row_no, item_id, row_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM asked JOIN impact USING (term) GROUP BY ALL HAVING sum(times * impact) > 0),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score DESC, doc_id NULLS LAST, row_id) AS INTEGER) AS rank FROM scored)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""
