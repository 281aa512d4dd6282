"""Language identification: script ranges, scores of words, and a Viterbi path over each text.

A text's words are maximal runs of letters of one script (marks belong to the letter before).
The script of a word narrows its candidates to the languages that write in it; each candidate
scores the word by hashed character n-grams with word borders, in a mixture with a uniform
share, so that unseen n-grams cost every language the same. The Viterbi path over the words
with a penalty for each switch labels spans, so a mixed text has spans of several languages.
The language with most letters is the text's (ties: the smaller name); its score is the mean,
over letters, of its probability in their span.

Learning counts n-grams in Spark over a bounded sample: about `per_lang` rows a language (those
whose hash of id and text is low), each of at most `longest` bytes. The model is
languages x len(ORDERS) x 2^BITS numbers, which is broadcast. Prediction is one narrow Arrow
pass over whole texts.

Defined cases: null texts and texts without a letter are `und` with score 0 and no span; so is
every text if nothing can be learnt. Rows with a null text or null language teach nothing. Null
ids are not held out. A word in a script that no language was learnt in has all languages as
candidates. Equal texts have equal results. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import documents, small_batches, text_or_empty
from newsloom.llm.quality import held_out

ORDERS, BITS = (2, 3, 4), 16
BUCKETS = 1 << BITS
SWITCH, UNIFORM = 12.0, 0.02
#: A language writes in a script that holds this share of its letters.
LEAST_SHARE = 0.005
PER_LANG, LONGEST = 3000, 65_536
#: Letters that are scored at once, and what a language outside a word's candidates gets.
SLICE, OUTSIDE = 1 << 19, -1e6
UNKNOWN = "und"

#: Unicode's ranges of scripts. Letters elsewhere share one more script.
SCRIPTS = {
    "latin": [(0x41, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPTS) + 1
_MARK = 255


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: its script (0: no letter), and its lower case where that is one code point."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            script[c] = N_SCRIPTS
            if len(low := ch.lower()) == 1:
                lower[c] = ord(low)
        elif unicodedata.category(ch)[0] == "M":
            script[c] = _MARK
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            part = script[first : last + 1]
            part[part == N_SCRIPTS] = k
    return script, lower


@dataclass
class Words:
    """Words of some texts: code points, and of each word its start, end, script and text."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    owner: np.ndarray
    text_start: np.ndarray


def words(texts: list[str]) -> Words:
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    text_start = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
    script = _characters()[0][codes]
    at = np.arange(len(codes))
    script = script[np.maximum.accumulate(np.where(script == _MARK, 0, at))] if len(codes) else script
    script[script == _MARK] = 0  # marks before any letter
    edge = np.flatnonzero(np.diff(script, prepend=0, append=0))
    begin = edge[:-1] if len(edge) else edge
    letter = script[begin] > 0
    start, end = begin[letter], edge[1:][letter]
    return Words(codes, start, end, script[start], np.searchsorted(text_start, start, "right") - 1, text_start)


def runs(size: np.ndarray) -> Iterator[slice]:
    """Runs of words of about SLICE letters together, or one longer word."""
    part = np.cumsum(size + 1) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return (slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def letters_of(w: Words, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the given words one after another, and where each word begins."""
    before = np.cumsum(size) - size
    return _characters()[1][w.codes[np.arange(size.sum()) + np.repeat(start - before, size)]], before


def distinct(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """One word of each spelling, by 64-bit hashes of its letters, and of each word which one is its own."""
    key = np.empty(len(w.start), np.uint64)
    size = w.end - w.start
    for which in runs(size):
        z, before = letters_of(w, w.start[which], size[which])
        place = np.arange(len(z)) - np.repeat(before, size[which])
        mixed = (z.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        key[which] = np.add.reduceat(mixed ^ mixed >> np.uint64(32), before)
    return np.unique(key, return_index=True, return_inverse=True)[1:]


def grams(w: Words, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each given word begins, and of each order the bucket of the n-gram at each place (BUCKETS: none)."""
    letters, before = letters_of(w, start, size)
    n, places = len(size), len(letters) + len(size)
    z = np.zeros(places + 1 + max(ORDERS), np.uint32)  # words with a 0 before, between and after
    z[np.arange(len(letters)) + np.repeat(np.arange(1, n + 1), size)] = letters
    first = before + np.arange(n)
    left = np.repeat(first + size + 1, size + 1) - np.arange(places)  # to the border behind the word
    out, h = [], z[:places].copy()
    for order in range(2, max(ORDERS) + 1):
        h = h * np.uint32(0x01000193) ^ z[order - 1 : order - 1 + places]
        if order in ORDERS:
            bucket = ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)
            bucket[left < order - 1] = BUCKETS
            out.append(bucket)
    return first, out


@dataclass
class LanguageModel:
    langs: list[str]
    tables: list[np.ndarray]  # of each order: BUCKETS + 1 rows, the last 0, a column a language
    writes: np.ndarray  # scripts x languages
    prior: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """Of each word and language, the log likelihood; OUTSIDE beyond the word's candidates."""
        one, own = distinct(w)
        start, size = w.start[one], (w.end - w.start)[one]
        out = np.empty((len(one), len(self.langs)), np.float32)
        for which in runs(size):
            first, buckets = grams(w, start[which], size[which])
            each = sum(np.take(table, b, axis=0) for table, b in zip(self.tables, buckets, strict=True))
            out[which] = np.add.reduceat(each, first, axis=0) / len(ORDERS)
        allowed = self.writes[w.script[one]]
        allowed |= ~allowed.any(1)[:, None]
        out[~allowed] = OUTSIDE
        return out[own]

    def path(self, score: np.ndarray, owner: np.ndarray, switch: float = SWITCH) -> np.ndarray:
        """The best language of each word. Texts in which no stretch of words gains enough to pay its switches have one; the others' paths are walked."""
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        size = np.diff(np.append(first, len(owner)))
        text = np.repeat(np.arange(len(size)), size)
        score = score.copy()
        score[first] += self.prior
        main = np.add.reduceat(score, first, axis=0, dtype=float).argmax(1).astype(np.int16)
        label = main[text]
        if len(self.langs) > 1:
            at = np.arange(len(text))
            own, others = score[at, label], score.copy()
            others[at, label] = -np.inf
            gain = np.maximum(others.max(1) - own, -100).astype(float)  # at most what any other language gains by a word
            after = np.cumsum(gain)
            after -= (after - gain)[first][text]
            before = after - gain
            apart = text * (np.ptp(after) + np.ptp(before) + 1000)  # so that a running minimum starts anew with each text
            inner = np.maximum.reduceat(after - apart - np.minimum.accumulate(before - apart), first)
            head, tail = np.maximum.reduceat(after, first), after[first + size - 1] - np.minimum.reduceat(before, first)
            walk = ((inner > 2 * switch - 0.01) | (np.maximum(head, tail) > switch - 0.01))[text]
            if walk.any():
                label[walk] = self.walked(score[walk], owner[walk], switch)
        return label

    def walked(self, score: np.ndarray, owner: np.ndarray, switch: float) -> np.ndarray:
        """The Viterbi paths of all texts a word at a time side by side, the longest first; the first word's score has the prior."""
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        size = np.diff(np.append(first, len(owner)))
        rank = np.empty(len(size), np.int64)
        rank[np.argsort(-size, kind="stable")] = np.arange(len(size))
        size_down = -np.sort(-size)
        active = np.searchsorted(-size_down, -np.arange(size.max(initial=0) + 1), "left")  # texts with more words than so many
        begin = np.cumsum(active) - active
        text = np.repeat(np.arange(len(size)), size)
        place = begin[np.arange(len(owner)) - first[text]] + rank[text]  # step after step, and in a step by rank
        by_step = np.empty((score.shape[1], len(owner)), np.float32)
        by_step[:, place] = score.T
        came, stays = np.empty(len(owner), np.int16), np.empty(by_step.shape, bool)  # the best language before; whether staying beats it
        now = np.empty(len(size), np.int16)
        at = by_step[:, : len(size)]
        for step in range(1, len(active)):
            a, n = begin[step], active[step]
            if n < at.shape[1]:
                now[n : at.shape[1]] = at[:, n:].argmax(0)
                at = at[:, :n]
            if n:
                at = at - at.max(0)
                came[a : a + n], stays[:, a : a + n] = at.argmax(0), at >= -switch
                at = np.maximum(at, -switch) + by_step[:, a : a + n]
        label = np.empty(len(owner), np.int16)
        for step in range(len(active) - 2, -1, -1):
            a, n = begin[step], active[step]
            state = now[:n]
            label[a : a + n] = state
            if step:
                now[:n] = np.where(stays[state, np.arange(a, a + n)], state, came[a : a + n])
        return label[place]

    def spans(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Of each span: text, start and end (code points), language; of each text: language (-1: none) and score."""
        w = words(texts)
        pred, sure = np.full(len(texts), -1), np.zeros(len(texts))
        if not len(w.start) or not self.langs:
            none = np.empty(0, np.int64)
            return none, none, none, none, pred, sure
        score = self.scores(w)
        label = self.path(score, w.owner)
        begin = np.flatnonzero((np.diff(w.owner, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
        end = np.append(begin[1:], len(label)) - 1
        text, lang = w.owner[begin], label[begin].astype(np.int64)
        letters = np.add.reduceat(w.end - w.start, begin)
        total = np.add.reduceat(score, begin, axis=0, dtype=float)
        chance = np.exp(total - total.max(1)[:, None])
        chance /= chance.sum(1)[:, None]
        share = np.zeros((len(texts), len(self.langs)))
        np.add.at(share, (text, lang), letters)
        seen = share.sum(1) > 0
        pred[seen] = share[seen].argmax(1)
        held = np.bincount(text, letters * chance[np.arange(len(text)), pred[text]], len(texts))
        sure[seen] = np.minimum(held[seen] / share[seen].sum(1), 1)
        return text, w.start[begin] - w.text_start[text], w.end[end] - w.text_start[text], lang, pred, sure


def fit_languages(docs: DataFrame, per_lang: int = PER_LANG, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn every language of the rows that are not held out."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    rows = sorted(known.groupBy("lang").agg(F.count("*").alias("n"), F.sum((F.octet_length("text") <= longest).cast("long")).alias("short")).collect())  # a row a language
    parts = 1 << 20
    share = spark.createDataFrame([(r["lang"], -(-parts * per_lang // max(r["short"], 1))) for r in rows], "lang string, part long")
    low = F.pmod(F.xxhash64("id", "text"), F.lit(parts)) < F.col("part")
    sample = known.where(F.octet_length("text") <= longest).join(F.broadcast(share), "lang").where(low).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                counts, scripts = held.setdefault(lang, (np.zeros((len(ORDERS), BUCKETS + 1), np.int64), np.zeros(N_SCRIPTS + 1, np.int64)))
                w = words(texts)
                scripts += np.bincount(w.script, w.end - w.start, N_SCRIPTS + 1).astype(np.int64)
                for which in runs(w.end - w.start):
                    for k, bucket in enumerate(grams(w, w.start[which], (w.end - w.start)[which])[1]):
                        counts[k] += np.bincount(bucket, minlength=BUCKETS + 1)
        for lang, (counts, scripts) in held.items():
            for kind, found in [*enumerate(counts[:, :BUCKETS]), (-1, scripts)]:
                slot = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(np.full(len(slot), kind)), pa.array(slot), pa.array(found[slot])], names=["lang", "kind", "slot", "n"])

    counted = sample.mapInArrow(count, "lang string, kind long, slot long, n long").groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # languages x (len(ORDERS) x 2^BITS + scripts) rows at most
    langs = [r["lang"] for r in rows]
    index = {lang: k for k, lang in enumerate(langs)}
    lang, kind, slot, n = np.array([index[x] for x in found.column("lang").to_pylist()], np.int64), *(found.column(c).to_numpy() for c in ("kind", "slot", "n"))
    tables = []
    for k in range(len(ORDERS)):
        c = np.zeros((BUCKETS, len(langs)))
        own = kind == k
        c[slot[own], lang[own]] = n[own]
        p = np.log((1 - UNIFORM) * c / np.maximum(c.sum(0), 1) + UNIFORM / BUCKETS)
        tables.append(np.vstack([p, np.zeros((1, len(langs)))]).astype(np.float32))
    letters = np.zeros((N_SCRIPTS + 1, len(langs)))
    letters[slot[kind == -1], lang[kind == -1]] = n[kind == -1]
    prior = np.log(np.array([r["n"] for r in rows], float) / max(sum(r["n"] for r in rows), 1))
    return LanguageModel(langs, tables, letters > LEAST_SHARE * letters.sum(0), prior.astype(np.float32))


def label_languages(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The kept columns, lang_pred, score, and spans (start, end in code points, lang) of each whole text."""
    small_batches(docs.sparkSession)
    given = docs.sparkSession.sparkContext.broadcast(model)  # bounded by its number of languages
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*given.value.langs, UNKNOWN], pa.string())
        for b in batches:
            text, start, end, lang, pred, sure = given.value.spans(b.column(len(keep)).to_pylist())
            parts = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64()), names.take(pa.array(lang))], ["start", "end", "lang"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(b.num_rows + 1)), pa.int32()), parts)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], names.take(pa.array(pred % len(names))), pa.array(sure), spans], names=schema.names)

    return docs.select(*[F.col(c) for c in keep], text_or_empty(text_col).alias("_whole_text")).mapInArrow(run, schema)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return label_languages(docs, fit_languages(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
