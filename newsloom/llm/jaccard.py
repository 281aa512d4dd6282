"""N-gram Jaccard join with Bayesian candidate pruning (word shingles of WORDS words).

1. Each text becomes its set of hashed shingles; HASHES 8-bit MinHash values and a digest of
   the set are kept. Copies (equal sets) meet first, so a text that a third of all rows
   share counts once from here on.
2. Sets are candidates if one of BANDS bands of ROWS values agrees. At similarity 0.8 all
   bands miss with a chance of 5e-8.
3. The members of a band meet in units of about BLOCK, or in pairs of such blocks. Pairs are
   compared inside the task, MinHash values STEP at a time: with m of n equal, the posterior
   under a uniform prior is Beta(m + 1, n - m + 1), and a pair is dropped as soon as its
   chance of reaching the threshold falls below TOLERANCE. A pair belongs to the unit of the
   first band in which it agrees, so it is taken up once. A unit emits the members that have
   a pair left, never the pairs.
4. These members' shingles meet in the same units, and just the pairs that stayed are verified
   exactly: one by one, or by a matrix product of common shingles where a unit has many. Out
   come each set's number of links, and paths over what the links join.
5. The paths give the classes: connected components by least neighbours and pointer jumping,
   cut by checkpoint() each turn; only linked sets take part.

There is no cap on partners, and rows grow with members, not with pairs: a set goes to a unit
with each block of a band's members, and its shingles only to those in which it has a pair.

Words are lower-case runs of non-white-space. A text of one to four words is one shingle
of its own. Defined cases: null and empty texts have no shingle; they are copies of each
other, without links to other texts. Repeated rows are copies. Null ids are never a
class's id unless all of its ids are null. Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import checkpointed, documents, keyed, keys, partitions, small_batches, text_or_empty

WORDS, THRESHOLD = 5, 0.8
ROWS, BANDS, STEP, TOLERANCE, BLOCK = 4, 32, 16, 1e-5, 512
HASHES = ROWS * BANDS

_rng = np.random.default_rng(11)
_MULTIPLY = _rng.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_PLACE = (_rng.integers(1, 2**63, WORDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = [xxhash.xxh3_64_intdigest(w) for w in text.lower().encode().split()]
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(words, np.uint64)
    size = min(WORDS, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out += (h[k : len(h) - size + 1 + k] ^ np.uint64(k)) * _PLACE[k]
        out ^= out >> np.uint64(31)
    return np.unique(out * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size))


def signature(grams: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of 16 bits."""
    low = (grams >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for k in range(0, len(low), 1024):
        best = np.minimum(best, (low[k : k + 1024, None] * _MULTIPLY + _ADD).min(0))
    best = (best ^ (best >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (best >> np.uint32(16)).astype(np.uint16)


def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values of n with P(similarity >= threshold) >= tolerance.

    Values that agree by chance, one in 65536, only add to the matches.
    """
    below = 0.0  # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
    for m in range(n + 1):
        below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, hash (of the text), digest (of the shingle set), n (its size), signature, bands."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest, size, marks, bands = [], [], [], []
            for text in b.column(1).to_pylist():
                grams = shingles(text)
                raw = grams.tobytes()
                digest.append(xxhash.xxh3_128_digest(raw) + xxhash.xxh64_digest(raw, seed=9))
                size.append(len(grams))
                mark = signature(grams)
                marks.append(mark.tobytes())
                keys = mark.reshape(BANDS, ROWS).view(np.int64)[:, 0] if len(grams) else []
                bands.append([(int(v) * 1_000_003 + k) % 2**63 for k, v in enumerate(keys)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "hash", "digest", "n", "signature", "bands"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.xxhash64(text_or_empty(text_col)).alias("hash")).mapInArrow(run, f"id {kind}, hash long, digest binary, n long, signature binary, bands array<bigint>")


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of 0..n-1 that each of them reaches by the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        step = root.copy()
        np.minimum.at(step, root[a], low)
        np.minimum.at(step, root[b], low)
        while (step[step] != step).any():
            step = step[step]
        root = step
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def path(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that join what (a, b) joins: each component's rows in a line, so that no row gets more than two links."""
    rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = joined(len(rows), at[: len(a)], at[len(a) :])
    order = np.argsort(root, kind="stable")
    same = root[order[1:]] == root[order[:-1]]
    return rows[order[:-1][same]], rows[order[1:][same]]


def in_units(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 4096) -> Iterator[pa.Table]:
    """Rows of whole units (sorted by keys), some thousand at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        last = [table.column(k)[rows - 1].as_py() for k in keys]
        same = np.ones(rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= table.column(k).to_numpy() == v
        cut = int(np.argmax(same))
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut).combine_chunks().to_batches()
            held, rows = rest, rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def unit_pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b): row numbers of the pairs to compare, a unit's or many small units' at a time.

    A unit (band, p, p) has the pairs of block p, a unit (band, p, q) those between p and q.
    """
    p, q, own = (table.column(c).to_numpy() for c in ("p", "q", "own"))
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for c in (table.column(k).to_numpy() for k in UNIT):
        new[1:] |= c[1:] != c[:-1]
    starts = np.append(np.flatnonzero(new), table.num_rows)
    sizes = np.diff(starts)
    two = starts[:-1][sizes == 2]
    two = two[(p[two] == q[two]) | (own[two] != own[two + 1])]
    if len(two):
        yield two, two + 1
    for s, n in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        a, b = np.triu_indices(n, 1)
        a, b = a + s, b + s
        across = (p[s] == q[s]) | (own[a] != own[b])
        for k in range(0, len(a), 1 << 15):
            part = slice(k, k + (1 << 15))
            yield a[part][across[part]] if p[s] != q[s] else a[part], b[part][across[part]] if p[s] != q[s] else b[part]


def staying_pairs(table: pa.Table, threshold: float, tolerance: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of the table's units that are the unit's own and that the incremental comparison keeps."""
    need = [(n, least_matches(n, threshold, tolerance)) for n in range(STEP, HASHES + 1, STEP)]
    marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
    bands = marks.view(np.int64)  # ROWS values of 16 bits each
    n, turn = table.column("n").to_numpy(), table.column("turn").to_numpy()
    for a, b in unit_pairs(table):
        sized = (n[a] >= threshold * n[b]) & (n[b] >= threshold * n[a])
        a, b = a[sized], b[sized]
        first = (bands[a] == bands[b]).argmax(1) == turn[a]
        a, b = a[first], b[first]
        equal = np.zeros(len(a), np.int64)
        for k, least in need:
            equal += (marks[a, k - STEP : k] == marks[b, k - STEP : k]).sum(1)
            live = equal >= least
            a, b, equal = a[live], b[live], equal[live]
        yield a, b


#: What names a unit.
UNIT = ["band", "p", "q"]


def in_blocks(rows: DataFrame) -> DataFrame:
    """rows with p, q and own: each row goes to the units of its block with every block of its band."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("digest"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))


def together(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), *UNIT).sortWithinPartitions(*UNIT, "digest")


def candidate_members(sets: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """band, turn (its number), p, q, own, digest: the members of each unit that have a pair left."""
    banded = sets.where("n > 0").select("digest", F.posexplode("bands").alias("turn", "band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    shared = banded.join(sizes, "band").join(sets.select("digest", "n", "signature"), "digest")
    names = ["band", "turn", "p", "q", "own", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_units(batches, UNIT):
            has = np.zeros(table.num_rows, bool)
            for a, b in staying_pairs(table, threshold, tolerance):
                has[a] = has[b] = True
            yield from table.select(names).filter(pa.array(has)).to_batches()

    units = together(in_blocks(shared).select(*names, "n", "signature"))
    return checkpointed(units.mapInArrow(run, units.select(*names).schema))


def common_counts(grams: list[np.ndarray]) -> np.ndarray:
    """How many shingles each pair of sets has in common, by a matrix product over shared shingles."""
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, column, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    owner, column = owner[keep], np.unique(column[keep], return_inverse=True)[1]
    out = np.zeros((len(grams), len(grams)), np.float32)
    for first in range(0, int(column.max(initial=-1)) + 1, 4096):
        inside = (column >= first) & (column < first + 4096)
        grid = np.zeros((len(grams), 4096), np.float32)
        grid[owner[inside], column[inside] - first] = 1
        out += grid @ grid.T
    return out


def exact_common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair have in common."""
    rows = np.unique(np.concatenate([a, b]))
    if len(a) <= 4 * len(rows):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
    return common_counts([sets[x] for x in rows])[np.searchsorted(rows, a), np.searchsorted(rows, b)]


def similar_sets(sets: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(degrees, paths) of the exact links between distinct sets.

    degrees: a (digest), far (documents linked, copies included), n_text_links. paths: a, b,
    with the components of the links.
    sets: digest, rep (none, id, hash of one document that has it), copies, n, signature, bands.
    texts: id, hash, text.
    """
    members = candidate_members(sets, threshold, tolerance)
    reps = members.select("digest").distinct().join(sets.select("digest", "rep"), "digest").select("digest", "rep.id", "rep.hash").alias("r")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([shingles(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("digest"), found], names=["digest", "grams"])

    held = texts.alias("t").join(reps, F.col("t.id").eqNullSafe(F.col("r.id")) & (F.col("t.hash") == F.col("r.hash"))).dropDuplicates(["digest"]).select("digest", "text")
    full = held.mapInArrow(grams, "digest binary, grams binary")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_units(batches, UNIT, 512):
            sets_ = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
            copies = table.column("copies").to_numpy()
            size = np.array([len(g) for g in sets_])
            far, texts_ = np.zeros(len(sets_), np.int64), np.zeros(len(sets_), np.int64)
            links: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in staying_pairs(table, threshold, tolerance):
                if not len(a):
                    continue
                common = exact_common(sets_, a, b)
                live = common >= threshold * (size[a] + size[b] - common) - 1e-9
                a, b = a[live], b[live]
                links.append(path(a, b))
                np.add.at(far, a, copies[b])
                np.add.at(far, b, copies[a])
                np.add.at(texts_, a, 1)
                np.add.at(texts_, b, 1)
            digest = table.column("digest").combine_chunks()
            linked = pa.array(np.flatnonzero(texts_), pa.int64())
            left, right = (pa.array(np.concatenate([e[i] for e in links] or [np.empty(0, np.int64)]), pa.int64()) for i in (0, 1))
            one, none = len(linked), len(left)
            a = pa.concat_arrays([digest.take(linked).cast(pa.binary()), digest.take(left).cast(pa.binary())])
            b = pa.concat_arrays([pa.nulls(one, pa.binary()), digest.take(right).cast(pa.binary())])
            pad = np.zeros(none, np.int64)
            yield pa.RecordBatch.from_arrays([a, b, pa.array(np.append(far[texts_ > 0], pad)), pa.array(np.append(texts_[texts_ > 0], pad))], names=["a", "b", "far", "n"])

    own = members.join(sets.select("digest", "copies", "n", "signature"), "digest").join(full, "digest")
    found = checkpointed(together(own).mapInArrow(verify, "a binary, b binary, far long, n long"))
    degrees = found.where("b IS NULL").groupBy("a").agg(F.sum("far").alias("far"), F.sum("n").alias("n_text_links"))
    return degrees, found.where("b IS NOT NULL").select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """digest, root: the least digest that each linked digest reaches."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(both.repartition("a"))
    roots = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("digest"), F.least("a", "m").alias("root")))
    while True:
        reached = both.join(roots.toDF("b", "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        lower = roots.join(reached.withColumnRenamed("a", "digest"), "digest").select("digest", "root", F.least("root", "m").alias("next"))
        hop = lower.select(F.col("digest").alias("via"), F.col("next").alias("far"))
        stepped = checkpointed(lower.join(hop, lower["next"] == hop["via"]).select("digest", "root", F.least("next", "far").alias("next")))
        if stepped.where("next != root").isEmpty():
            return roots
        roots = stepped.select("digest", F.col("next").alias("root"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: id, copy_id, copies, n_links, n_text_links, class_id, class_size, stays, text_hash.

    copy_id: least id of the documents with the same shingle set; copies: how many.
    n_links: other documents at or above the threshold, copies included; n_text_links:
    different sets among them. class_id: least id of the connected class.
    stays: the row is the one of its class with the least id (and hash of its text, text_hash).
    """
    found = checkpointed(sketches(docs, id_col, text_col))
    sets = checkpointed(found.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("bands").alias("bands")))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("hash"), text_or_empty(text_col).alias("text"))
    degree, paths = similar_sets(sets, texts, threshold, tolerance)
    roots = components(paths)
    small = sets.select("digest", "rep", "copies").join(degree.withColumnRenamed("a", "digest"), "digest", "left").join(roots, "digest", "left")
    small = small.withColumn("root", F.coalesce("root", "digest"))
    classes = small.groupBy("root").agg(F.min("rep").alias("first"), F.sum("copies").alias("class_size"))
    info = small.join(classes, "root").select("digest", F.col("rep.id").alias("copy_id"), "copies", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"), "first", "class_size")
    out = found.select("id", "hash", "digest").join(info, "digest")
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    return out.select(F.col("id").alias(id_col), "copy_id", "copies", "n_links", "n_text_links", F.col("first.id").alias("class_id"), "class_size", stays.alias("stays"), F.col("hash").alias("text_hash"))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each class: the one that stays, and of equal rows one."""
    kept = near_duplicates(docs, id_col=id_col, text_col=text_col).where("stays")
    kept = keyed(kept, id_col, F.col("text_hash")).select(keys(3)).distinct()
    rows = keyed(docs, id_col, F.xxhash64(text_or_empty(text_col))).dropDuplicates(keys(3))
    return rows.join(kept, keys(3), "left_semi").select("row.*")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
