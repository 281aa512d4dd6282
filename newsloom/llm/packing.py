"""Best-fit packing into fixed-size token sequences by best-two-fit.

Documents become token pieces in Arrow tasks. The plan needs only the histogram of piece
lengths, at most `capacity` numbers however large the corpus: a bin is filled greedily
from the longest length left, then its smallest piece gives way to two unpacked lengths
that fill the widened gap more tightly, and the same bin is repeated while the histogram
lasts. Each repeat uses up a length, so the plan stays a few thousand bins. A piece finds
its slot by its length and its rank among pieces of that length; pieces are numbered where
they lie and counts by partition are added, so a length that a third of the rows share has
no task of its own, and nothing is sorted.

Defined cases: null text is empty and gives one piece with the end token alone. Repeated
rows and equal ids are pieces of their own. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import codecs
import ctypes
import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import checkpointed, documents, small_batches, text_or_empty

CAPACITY, END_ID = 1024, 2
#: Entries of a worker's cache from chunks and tokens to ids; a batch's own may be more.
CACHED = 800_000


#: The caches of this worker's tokenizers.
_caches: list[dict[str, bytes]] = []


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path), {}
    _caches.append(made[1])
    return made


def _free() -> None:
    """Give back what this worker's caches and allocators hold: it stays alive for the passes of other stages."""
    for cache in _caches:
        cache.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def _ids(tok, chunks: list[str]) -> list[bytes]:
    return [array("I", e.ids).tobytes() for e in tok.encode_batch_fast(chunks, add_special_tokens=False)]


def _word_ids(tok, words: list[str]) -> list[bytes]:
    """The same of many short strings without white space but a first blank: encoded as the lines of longer texts, whose ids are cut at the line breaks."""
    (mark,) = tok.encode("\n", add_special_tokens=False).ids
    lines = [words[i : i + 256] for i in range(0, len(words), 256)]
    out: list[bytes] = []
    for own, e in zip(lines, tok.encode_batch_fast(["\n".join(x) for x in lines], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, "<u4")
        ends = 4 * np.append(np.flatnonzero(ids == mark), len(ids))
        raw, starts = ids.tobytes(), np.append(0, ends[:-1] + 4)
        out += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)] if len(ends) == len(own) else _ids(tok, own)
    return out


#: The byte-level pattern starts a token at a blank after a non-blank character and looks
#: behind nowhere, so a text can be cut there. Texts with other runs of blanks, or with a
#: special token's string, are encoded whole.
_UNSAFE = re.compile(r"\s ")
_PAIRS = tuple(f"{c} " for c in map(chr, range(128)) if c.isspace())


def _unsafe(text: str) -> bool:
    if not text or text[0] == " " or "<|" in text:
        return True
    return any(p in text for p in _PAIRS) if text.isascii() else _UNSAFE.search(text) is not None


#: The byte-level pattern's tokens in text of ASCII and Latin letters. Other text is left to the tokenizer.
_LATIN = r"\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(rf"[\x00-\x7f{_LATIN}]*")
_TOKENS = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^\sA-Za-z0-9{_LATIN}]+|\s+(?!\S)|\s+", re.ASCII)

#: One such token.
_ONE = re.compile(rf" ?[A-Za-z{_LATIN}]+")

#: What may stand in a line among others.
_WORD = re.compile(r" ?\S+")


def _alphabet() -> str:
    """The byte-level pattern's letter of each byte; the line break stays, as it parts tokens here."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
    return "".join("\n" if b == 0x0A else letters.get(b, chr(b)) for b in range(256))


_LETTERS = _alphabet()


def _token_ids(tok, tokens: list[str]) -> list[bytes]:
    """The same of single tokens of the byte-level pattern without line breaks: nothing is left to cut, so the tokenizer's model takes them at once."""
    if not tokens:
        return []
    tokenize = tok.model.tokenize
    coded = codecs.charmap_decode("\n".join(tokens).encode(), "strict", _LETTERS)[0].split("\n")
    return [array("I", [t.id for t in tokenize(c)]).tobytes() for c in coded]


def _chunk_ids(tok, known: dict[str, bytes], chunks: list[str]) -> list[bytes]:
    """The ids of each chunk, which known keeps; a token is encoded when it is first met."""
    out = list(map(known.get, chunks))
    new = [k for k, ids in enumerate(out) if ids is None]
    missing = [chunks[k] for k in new]
    if len(known) + 2 * len(missing) > CACHED:
        known.clear()
        known.update((c, ids) for c, ids in zip(chunks, out, strict=True) if ids is not None)
    cut = {c: _TOKENS.findall(c) if _PLAIN.fullmatch(c) else [] for c in missing if not _ONE.fullmatch(c)}
    fresh = {t for ts in cut.values() for t in ts if t not in known}
    fresh.update(c for c in missing if c not in cut)
    whole = [c for c, ts in cut.items() if not ts]
    tokens = [t for t in fresh if "\n" not in t]
    words = [c for c in whole if _WORD.fullmatch(c)]
    rest = [t for t in fresh if "\n" in t] + [c for c in whole if not _WORD.fullmatch(c)]
    for strings, ids in ((tokens, _token_ids), (words, _word_ids), (rest, _ids)):
        known.update(zip(strings, ids(tok, strings), strict=True))
    for k, c in zip(new, missing, strict=True):
        if ts := cut.get(c):
            known[c] = b"".join([known[t] for t in ts])
        out[k] = known[c]
    return out


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Little-endian 32-bit ids of each text, equal to the tokenizer's for the whole text.

    A batch is split at blanks and dictionary-encoded in Arrow; each distinct chunk is looked
    up once, and the ids of all chunks are gathered in one go.
    """
    tok, known = _tokenizer(path)
    whole = [_unsafe(t) for t in texts]
    out: list[bytes | None] = [None] * len(texts)
    for i, raw in zip(np.flatnonzero(whole).tolist(), _ids(tok, [t for t, w in zip(texts, whole, strict=True) if w]), strict=True):
        out[i] = raw
    cut = [t for t, w in zip(texts, whole, strict=True) if not w]
    if cut:
        parts = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.asarray(parts.offsets)
        none, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        chunks = pc.binary_join_element_wise(none, coded.dictionary, blank).to_numpy(zero_copy_only=False).tolist()
        codes[starts[:-1]] = len(chunks) + np.arange(len(cut))  # no blank before a text's first chunk
        chunks += [t.split(" ", 1)[0] for t in cut]
        pool = _chunk_ids(tok, known, chunks)
        length = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        first = np.cumsum(length) - length
        times = length[codes]
        ends = np.cumsum(times)
        at = np.arange(ends[-1]) + np.repeat(first[codes] - ends + times, times)
        ids = np.frombuffer(b"".join(pool), "<u4")[at]
        edges = np.append(0, ends)[starts]
        for i, low, high in zip(np.flatnonzero(~np.array(whole)).tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out[i] = ids[low:high].tobytes()
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, free: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, if asked for, the ids of each piece. free: a task leaves no caches."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    end = np.asarray([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, raw in enumerate(encode_texts(batch.column(1).to_pylist(), tokenizer_path)):
                raw += end
                n = len(raw) // 4
                at, k = 0, 0
                while at < n:
                    size = (n % capacity or capacity) if k == 0 else capacity
                    part = raw[4 * at : 4 * (at + size)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("int64"))
                    at, k = at + size, k + 1
            columns = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        if free:
            _free()

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(pieces, schema)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, repeats) that use each length as often as the histogram has it."""
    left = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        left[size] = n
    bins = []
    while left.any():
        lengths: list[int] = []
        gap, free = capacity, left.copy()
        while gap and len(fit := np.flatnonzero(free[: gap + 1])):
            size = int(fit[-1])
            n = min(int(free[size]), gap // size)
            lengths += [size] * n
            free[size] -= n
            gap -= n * size
        if gap and len(lengths) > 1:
            small = lengths[-1]
            room = gap + small
            sizes = np.flatnonzero(free[:room])
            if len(sizes):
                mate = np.searchsorted(sizes, room - sizes, "right") - 1
                ok = mate >= 0
                pair = np.where(ok, sizes + sizes[mate], 0)
                pair[ok & (sizes == sizes[mate]) & (free[sizes] < 2)] = 0
                a = int(pair.argmax())
                if pair[a] > small:
                    lengths = [*lengths[:-1], int(sizes[a]), int(sizes[mate[a]])]
        used = Counter(lengths)
        repeats = min(int(left[size]) // n for size, n in used.items())
        for size, n in used.items():
            left[size] -= n * repeats
        bins.append((lengths, repeats))
    return bins


#: Counts by input partition and length that may be broadcast.
SMALL = 1_000_000


def best_two_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (with a column length) plus sequence_id and offset.

    Pieces of one length are ranked by input partition and, inside it, as they come: rows are
    numbered where they are, and only counts by partition and length are summed up.
    """
    spark = pieces.sparkSession
    row = pieces.select(F.struct("*").alias("row"), F.col("length").cast("long").alias("length"), F.spark_partition_id().alias("part"))
    schema = T.StructType([*row.schema, T.StructField("rank", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            size = b.column("length").to_numpy()
            order = np.argsort(size, kind="stable")
            times = np.bincount(size, minlength=capacity + 1)
            rank = np.empty(len(size), np.int64)
            rank[order] = np.arange(len(size)) + np.repeat(seen - np.cumsum(times) + times, times)
            seen += times
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank)], names=schema.names)

    numbered = checkpointed(row.mapInArrow(number, schema))
    counts = numbered.groupBy("length", "part").count()
    up_to = F.sum("count").over(Window.partitionBy("length").orderBy("part"))  # a row a partition
    before = checkpointed(counts.select("length", "part", (up_to - F.col("count")).alias("before")))
    few = before.count() <= SMALL
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # capacity rows at most
    slots, used, base = [], Counter(), 0
    for lengths, repeats in plan_bins(histogram, capacity):
        at = 0
        for size in lengths:
            slots.append((size, used[size], base, at))
            used[size] += repeats
            at += size
        base += repeats
    of, since, seq, offset = (np.array(c, np.int64) for c in zip(*sorted(slots), strict=True)) if slots else (np.empty(0, np.int64),) * 4
    group = np.searchsorted(of, np.arange(capacity + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            slot = np.empty(len(size), np.int64)
            for n in np.unique(size).tolist():
                own = size == n
                slot[own] = group[n] + np.searchsorted(since[group[n] : group[n + 1]], rank[own], "right") - 1
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(seq[slot] + rank - since[slot]), pa.array(offset[slot])], names=["row", "sequence_id", "offset"])

    ranked = numbered.join(F.broadcast(before) if few else before, ["length", "part"]).select("row", "length", (F.col("rank") + F.col("before")).alias("rank"))
    placed = ranked.mapInArrow(place, T.StructType([schema["row"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    return placed.select("row.*", "sequence_id", "offset")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def pack_documents(docs: DataFrame, lean: bool = False) -> DataFrame:
    """lean: no other Python pass runs beside the tokenizer's, which leaves no caches in its workers."""
    import public_tokenizers

    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), free=lean)
    return best_two_fit(checkpointed(pieces) if lean else pieces)
