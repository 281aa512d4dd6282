"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of CHUNK bytes that overlap by STRIDE, so every
filter window of the whole text lies in some chunk. Bytes are embedded, FILTERS filters of
WIDTH bytes slide in steps of STRIDE, each filter is max-pooled over its chunk, and the
largest and the mean pool over all chunks of the document give one probability.

Training runs on the driver over a bounded sample: at most `per_class` labelled rows of
each class (in the order of a hash of their id) with at most `longest` bytes each. The
class balance of all learnable labels sets the bias afterwards. Scoring is one narrow
Arrow pass over whole texts.

Defined cases: null text is empty; it is scored as one chunk of padding. Without labels of
both classes every score is the share of label 1 (0.5 without any label). Null ids are not
held out. Equal texts have equal scores. Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import documents, small_batches, text_or_empty

CHUNK, WIDTH, STRIDE, EMBED, FILTERS = 512, 8, 4, 8, 32
STEP = CHUNK - STRIDE
PAD = 256
THRESHOLD, FOLDS = 0.3, 5
PER_CLASS, LONGEST, EPOCHS = 1200, 16_384, 10


@dataclass
class QualityModel:
    embed: np.ndarray  # 257 x EMBED, the last for padding
    near: np.ndarray  # filters' first STRIDE bytes
    far: np.ndarray  # and the rest
    bias: np.ndarray
    out: np.ndarray  # 2 * FILTERS
    shift: float

    def pools(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest value in each chunk, and the window that has it."""
        groups = self.embed[chunks].reshape(len(chunks), CHUNK // STRIDE, STRIDE * EMBED)
        z = groups[:, :-1] @ self.near
        z += groups[:, 1:] @ self.far
        at = z.argmax(1)
        return np.take_along_axis(z, at[:, None], 1)[:, 0] + self.bias, at

    def scores(self, texts: list[bytes]) -> np.ndarray:
        logits = np.empty(len(texts))
        for first in range(0, len(texts), 64):
            part = texts[first : first + 64]
            chunks, owner = chunked(part)
            pool = np.concatenate([np.maximum(self.pools(chunks[k : k + 128])[0], 0) for k in range(0, len(chunks), 128)])
            logits[first : first + 64] = features(pool, owner) @ self.out + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of all texts, and where each text's begin."""
    counts = [max(1, math.ceil((len(t) - STRIDE) / STEP)) for t in texts]
    out = np.full((sum(counts), CHUNK), PAD, np.int16)
    starts, row = [], 0
    for text, n in zip(texts, counts, strict=True):
        padded = np.full(STEP * n + STRIDE, PAD, np.int16)
        padded[: len(text)] = np.frombuffer(text, np.uint8)
        out[row : row + n] = np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (STEP * 2, 2))
        starts.append(row)
        row += n
    return out, np.array(starts)


def features(pool: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = np.diff(np.append(starts, len(pool)))[:, None]
    return np.hstack([np.maximum.reduceat(pool, starts), np.add.reduceat(pool, starts) / n])


def train(texts: list[bytes], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 7) -> QualityModel:
    """Fit by Adam on the logistic loss; share: of label 1 among all learnable labels."""
    rng = np.random.default_rng(seed)
    f32 = np.float32
    m = QualityModel(rng.normal(0, 0.5, (257, EMBED)).astype(f32), rng.normal(0, 0.18, (STRIDE * EMBED, FILTERS)).astype(f32), rng.normal(0, 0.18, (STRIDE * EMBED, FILTERS)).astype(f32), np.zeros(FILTERS, f32), rng.normal(0, 0.1, 2 * FILTERS).astype(f32), 0.0)
    m.embed[PAD] = 0
    share = min(max(share, 1e-6), 1 - 1e-6)
    if len(set(labels.tolist())) < 2:
        m.out[:], m.shift = 0, math.log(share / (1 - share))
        return m
    names = ("embed", "near", "far", "bias", "out")
    mean = {n: np.zeros_like(getattr(m, n)) for n in (*names,)} | {"shift": 0.0}
    square = {n: np.zeros_like(getattr(m, n)) for n in (*names,)} | {"shift": 0.0}
    step = 0
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(texts))
        for first in range(0, len(order), 32):
            rows = order[first : first + 32]
            chunks, starts = chunked([texts[i] for i in rows])
            raw, at = m.pools(chunks)
            pool = np.maximum(raw, 0)
            x = features(pool, starts)
            p = 1 / (1 + np.exp(-np.clip(x @ m.out + m.shift, -30, 30)))
            d = ((p - labels[rows]) * weight[rows] / len(rows)).astype(f32)
            n = np.diff(np.append(starts, len(pool)))
            owner = np.repeat(np.arange(len(rows)), n)
            dx = d[:, None] * m.out
            is_max = pool == x[owner, :FILTERS]
            ties = np.add.reduceat(is_max.astype(f32), starts)
            dpool = (is_max * (dx[:, :FILTERS] / ties)[owner] + (dx[:, FILTERS:] / n[:, None])[owner]) * (raw > 0)
            window = chunks[np.arange(len(chunks))[:, None, None], at[:, :, None] * STRIDE + np.arange(WIDTH)]
            seen = m.embed[window]  # chunks x filters x WIDTH x EMBED
            dfilter = np.einsum("cf,cfwe->wef", dpool, seen, optimize=True).reshape(2, STRIDE * EMBED, FILTERS)
            both = np.stack([m.near, m.far]).reshape(WIDTH, EMBED, FILTERS)
            dembed = np.zeros_like(m.embed)
            np.add.at(dembed, window, dpool[:, :, None, None] * both.transpose(2, 0, 1)[None])
            dembed[PAD] = 0
            step += 1
            grads = {"embed": dembed, "near": dfilter[0], "far": dfilter[1], "bias": dpool.sum(0), "out": x.T @ d + 1e-4 * m.out, "shift": float(d.sum())}
            for name, g in grads.items():
                mean[name] = 0.9 * mean[name] + 0.1 * g
                square[name] = 0.999 * square[name] + 0.001 * g * g
                move = rate * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                setattr(m, name, getattr(m, name) - (move if name == "shift" else move.astype(f32)))
    m.shift += math.log(share / (1 - share))  # trained at even weights
    return m


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, longest: int = LONGEST, epochs: int = EPOCHS) -> QualityModel:
    """Learn labels.quality from a bounded sample of the rows that are not held out."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").where(~held_out("id"))
    total, ones = known.agg(F.count("*"), F.sum("y")).first()
    key = F.xxhash64("id")
    picked = [known.where(F.col("y") == y).orderBy(key, "id").limit(per_class) for y in (0, 1)]
    sample = F.broadcast(picked[0].union(picked[1]).groupBy("id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col("doc_id").alias("id"), text_or_empty("text").alias("text")).where(F.octet_length("text") <= longest)
    rows = texts.join(sample, "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y")).orderBy(key, "id").collect()  # 2 * per_class rows of at most `longest` bytes
    return train([r["text"].encode() for r in rows], np.array([r["y"] for r in rows], np.float32), ones / total if total else 0.5, epochs)


def score_quality(docs: DataFrame, model: QualityModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The kept columns and a score from 0 to 1 of each whole text."""
    small_batches(docs.sparkSession)
    kept = [F.col(c) for c in keep]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.encode() for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(model.scores(texts), pa.float64())], names=schema.names)

    return docs.select(*kept, text_or_empty(text_col).alias("_whole_text")).mapInArrow(run, schema)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
