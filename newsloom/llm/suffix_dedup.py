"""Suffix-array dedup: removes every byte that a repeated string of WINDOW bytes covers.

1. Every window of WINDOW bytes has a key, the least hash of its GRAM-byte strings, so
   equal windows have equal keys wherever they stand. Consecutive windows with one key are
   one segment (some 550 bytes). Segments are counted by key and content, equal ones meet
   before the shuffle, and a key seen once is done: its windows stand nowhere else.
2. A key with one segment content, seen more than once, repeats as a whole.
3. The distinct segments of any other key form shards by key. A shard's suffixes are put
   in order by induced sorting (newsloom.llm.induced), whose queues of (position, common
   prefix) are disk-backed; two neighbours with a common prefix of WINDOW bytes are a
   repeated string, and both are marked. All else of a shard is in memory, so a shard must
   fit in a task's. A key with more than SHARD / WINDOW distinct segments is not sorted
   as one: its segments go through these steps again as texts, with another hash, so that
   equal windows still meet but in smaller groups. Only after ORDERS hashes is what is left
   of a key sorted whole, which windows of a few different strings alone can reach.
4. Marked ranges return to every place of their segment, and each text drops their union.

Strings are judged on the input: windows are compared before anything is removed, and a
text's own repeats (overlapping ones too) count. Segments are told apart by 128 bits of
hash next to the key and length.

Defined cases: null text is empty: 0 bytes, nothing removed. Texts under WINDOW bytes keep
everything. Repeated rows repeat each other, so they lose all they have from WINDOW bytes
on. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import checkpointed, documents, partitions, small_batches, text_or_empty
from newsloom.llm.induced import suffix_buckets

WINDOW, GRAM = 400, 32
#: Bytes of segments that are sorted together.
SHARD = 4 << 20
#: Hashes by which the segments of a crowded key are cut in turn.
ORDERS = 3


def gram_hashes(data: np.ndarray, size: int, order: int = 0) -> np.ndarray:
    """A 64-bit hash of each string of `size` bytes (a power of two); each order ranks them otherwise."""
    h = data.astype(np.uint64) + np.uint64(1)
    factor, width = 0x9E3779B97F4A7C15, 1
    while width < size:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % 2**64, width * 2
    h ^= np.uint64(order * 0xD1B54A32D192ED03 % 2**64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(raws: list[bytes], window: int, gram: int, order: int = 0) -> tuple[np.ndarray, ...]:
    """(text, key, first window, windows, whether a window may come again) of each run of windows with one key.

    A window may come again in its segment only if the string with the least hash does.
    """
    data = np.frombuffer(b"".join(raws), np.uint8)
    size = np.array([len(r) for r in raws], np.int64)
    starts = np.cumsum(size) - size
    held = np.flatnonzero(size >= window)
    if not len(held):
        return (np.empty(0, np.int64),) * 5
    h, width = gram_hashes(data, gram, order), window - gram + 1
    key = sliding_min(h, width)
    counts = size[held] - window + 1
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = inner + np.repeat(starts[held], counts)  # windows that lie in one text
    owner = np.repeat(held, counts)
    keys = key[at]
    run = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]))
    n = np.diff(np.append(run, len(keys)))
    first, own_key = at[run], keys[run]
    table = np.zeros(1 << 16, bool)
    table[(own_key & np.uint64(0xFFFF)).astype(np.int64)] = True
    least = np.flatnonzero(table[(h & np.uint64(0xFFFF)).astype(np.int64)])  # strings that may have the hash of a key
    place, last = np.searchsorted(least, first), np.searchsorted(least, first + n + width - 1)
    times, live = np.zeros(len(first), np.int64), np.flatnonzero((n > 1) & (place < last))
    while len(live):
        times[live] += h[least[place[live]]] == own_key[live]
        place[live] += 1
        live = live[(times[live] < 2) & (place[live] < last[live])]
    return owner[run], own_key.view(np.int64), first - starts[owner[run]], n, (times > 1).astype(np.int64)


def utf8(text: str | bytes) -> bytes:
    return text if isinstance(text, bytes) else text.encode()


#: Bytes of texts that are hashed together.
STRETCH = 256 << 10


def find_segments(rows: DataFrame, window: int, gram: int, order: int = 0) -> DataFrame:
    """id, hash, key, start, n, own, h1, h2: a row a segment of each text. own: it may repeat itself."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = [utf8(t) for t in b.column("text").to_pylist()]
            first = 0
            while first < len(raws):
                after, size = first, 0
                while after < len(raws) and size < STRETCH:
                    size += len(raws[after])
                    after += 1
                part = raws[first:after]
                owner, *cols = segments(part, window, gram, order)
                if len(owner):
                    views = [memoryview(r) for r in part]
                    wide = [xxhash.xxh3_128_digest(views[o][a : a + m + window - 1]) for o, a, m in zip(owner.tolist(), cols[1].tolist(), cols[2].tolist(), strict=True)]
                    two = np.frombuffer(b"".join(wide), np.int64).reshape(-1, 2)
                    at = pa.array(owner + first)
                    yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("hash").take(at), *(pa.array(c, pa.int64()) for c in cols), pa.array(two[:, 0]), pa.array(two[:, 1])], names=["id", "hash", "key", "start", "n", "own", "h1", "h2"])
                first = after

    return rows.mapInArrow(run, f"id {kind}, hash long, key long, start long, n long, own long, h1 long, h2 long")


def sort_shards(held: DataFrame, window: int, shard: int) -> DataFrame:
    """From (key, h1, h2, n, many, bytes), sorted by key, the marked ranges of each segment."""

    def ranges(group: list[tuple]) -> Iterator[tuple]:
        """group: (key, h1, h2, many, bytes) of whole keys."""
        starts = np.cumsum([0, *(len(g[4]) + 1 for g in group)])
        text = np.zeros(starts[-1], np.uint16)  # 0 parts the segments
        for s, g in zip(starts[:-1], group, strict=True):
            text[s : s + len(g[4])] = np.frombuffer(g[4], np.uint8)
            text[s : s + len(g[4])] += 1
        marked = np.zeros(len(text) + 1, bool)
        for at, lcp in suffix_buckets(text, window):
            k = np.flatnonzero(lcp >= window)
            marked[at[k]] = True
            marked[at[k - 1]] = True
        for s, g in zip(starts[:-1], group, strict=True):
            windows = len(g[4]) - window + 1
            own = marked[s : s + windows] if not g[3] else np.ones(windows, bool)
            edge = np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))
            first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            for a, z in zip(first.tolist(), after.tolist(), strict=True):
                yield g[0], g[1], g[2], a, z + window - 1

    names = ["key", "h1", "h2", "first", "after"]

    def emit(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = list(ranges(group))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("key", "h1", "h2", "many", "bytes")), strict=True):
                if size >= shard and row[0] != group[-1][0]:
                    yield from emit(group)
                    group, size = [], 0
                group.append(row)
                size += len(row[4])
        if group:
            yield from emit(group)

    return held.mapInArrow(run, "key long, h1 long, h2 long, first long, after long")


def repeated_ranges(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, order: int = 0) -> DataFrame:
    """id, hash, ranges (array of first, after): the bytes of each text to remove.

    rows: id, hash (of the text), text (or its bytes).
    """
    n_parts = partitions(rows.sparkSession)
    found = find_segments(rows, window, gram, order)
    kinds = found.groupBy("key", "h1", "h2", "n").agg(F.count("*").alias("seen"), F.max("own").alias("own"), F.min(F.struct("id", "hash", "start")).alias("rep"))
    of_key = Window.partitionBy("key")
    kinds = kinds.withColumns({"total": F.sum("seen").over(of_key), "variety": F.count("*").over(of_key), "any_own": F.max("own").over(of_key)})
    shared = checkpointed(kinds.where("total > 1 OR any_own = 1").select("key", "h1", "h2", "n", (F.col("seen") > 1).alias("many"), "rep", "variety"))
    whole = shared.where("variety = 1 AND many").select("key", "h1", "h2", F.lit(0).cast("long").alias("first"), (F.col("n") + window - 1).alias("after"))
    crowded = F.col("variety") * window > shard
    split = order + 1 < ORDERS and not shared.where(crowded).isEmpty()

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for text, parts in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist(), strict=True):
                raw = utf8(text)
                out += [(p["key"], p["h1"], p["h2"], p["many"], raw[p["start"] : p["start"] + p["n"] + window - 1]) for p in parts]
            if out:
                key, h1, h2, many, data = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(many, pa.bool_()), pa.array(data, pa.binary())], names=["key", "h1", "h2", "many", "bytes"])

    def contents(chosen: DataFrame) -> DataFrame:
        """key, h1, h2, many, bytes of segments, each cut from one text that has it."""
        wanted = chosen.groupBy("rep.id", "rep.hash").agg(F.collect_list(F.struct("key", "h1", "h2", "many", F.col("rep.start").alias("start"), "n")).alias("wanted"))  # at most a text's own segments
        texts = rows.alias("t").join(wanted.alias("w"), F.col("t.id").eqNullSafe(F.col("w.id")) & (F.col("t.hash") == F.col("w.hash"))).select("text", "wanted")
        return texts.mapInArrow(slices, "key long, h1 long, h2 long, many boolean, bytes binary").dropDuplicates(["key", "h1", "h2"])

    mixed = shared.where("variety > 1 OR NOT many")
    held = contents(mixed.where(~crowded) if split else mixed)
    sorted_ = sort_shards(held.repartition(n_parts, "key").sortWithinPartitions("key"), window, shard)
    marks = whole.union(sorted_)
    if split:
        again = checkpointed(contents(mixed.where(crowded)).select(F.struct("key", "h1", "h2").alias("id"), F.xxhash64("key", "h1", "h2").alias("hash"), F.col("bytes").alias("text"), "many"))
        cuts = repeated_ranges(again.drop("many"), window, gram, shard, order + 1).select("id.*", F.inline("ranges"))
        marks = marks.union(cuts).union(again.where("many").select("id.*", F.lit(0).cast("long"), F.octet_length("text").cast("long")))
    marks = checkpointed(marks)
    places = found.join(marks, ["key", "h1", "h2"]).select("id", "hash", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("after")).alias("after"))
    return places.groupBy("id", "hash").agg(F.array_sort(F.collect_set(F.struct("first", "after"))).alias("ranges"))  # at most a text's own


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: id, n_bytes, removed (array of first, after), kept (the bytes left)."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("hash"), text_or_empty(text_col).alias("text"))
    cuts = repeated_ranges(rows, window, gram, shard)
    joined = rows.alias("t").join(cuts.alias("c"), F.col("t.id").eqNullSafe(F.col("c.id")) & (F.col("t.hash") == F.col("c.hash")), "left").select("t.id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, removed, kept = [], [], []
            for text, ranges in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist(), strict=True):
                raw = text.encode()
                runs: list[list[int]] = []
                for r in ranges or ():
                    if runs and r["first"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], r["after"])
                    else:
                        runs.append([r["first"], r["after"]])
                edges = [0, *(x for run in runs for x in run), len(raw)]
                size.append(len(raw))
                removed.append([{"first": a, "after": z} for a, z in runs])
                kept.append(b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
            spans = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(size, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.binary())], names=["id", "n_bytes", "removed", "kept"])

    out = joined.mapInArrow(cut, f"id {kind}, n_bytes long, removed array<struct<first: long, after: long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["after"] - r["first"])
    return found.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
