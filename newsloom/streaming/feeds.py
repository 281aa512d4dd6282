"""Structured Streaming: landed items, the revision state machine, and volume windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsloom.operators.state import classify

ARRIVAL = "url string, seq long, content_hash string, source_id string, body_level int, fetched_at timestamp"


def landed(spark: SparkSession, path: str, schema: str = ARRIVAL, files: int = 100) -> DataFrame:
    """A stream of landed JSON items."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def first_landings(items: DataFrame, late: str = "2 days") -> DataFrame:
    """Insert-ignore over a stream: each content hash once within the watermark."""
    return items.where("content_hash IS NOT NULL").withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["content_hash"])


def revisions(items: DataFrame) -> DataFrame:
    """url, seq, decision, revision of each arrival; state is one small row a url.

    Arrivals of a micro-batch are taken in order of seq, as in the batch fold.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = pd.concat(list(frames)).sort_values("seq")  # one url's arrivals of one micro-batch
        out = []
        for r in rows.itertuples():
            decision, last = classify(tuple(last) if last else None, r.content_hash, r.source_id, int(r.body_level))
            out.append((key[0], int(r.seq), decision, int(last[1])))
        state.update(last)
        yield pd.DataFrame(out, columns=["url", "seq", "decision", "revision"])

    return items.groupBy("url").applyInPandasWithState(step, "url string, seq long, decision string, revision int", "hash string, revision int, source string, level int", "append", GroupStateTimeout.NoTimeout)


def volumes(items: DataFrame, width: str = "1 day", late: str = "6 hours") -> DataFrame:
    """Items of each source and window, final once the watermark has passed."""
    per = items.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", width), "source_id").agg(F.count("*").alias("n"))
    return per.select(F.col("window.start").alias("start"), "source_id", "n")
