"""The promotion chain over streams: posts, originals and pages land at different times.

Two stream-stream left outer joins with an aggregation between them. A post waits until the
watermark has passed what could still match: then its best original is known, and its card waits
for the page up to `wait`; whatever hasn't come by then leaves the post as it is. State holds the
posts and originals of the window and the delays, not of the whole past; of pages it holds all, or
those of `kept` where it is given. Posts and originals meet by handle and window, so that a row is
compared with those of two windows, not with all of its handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import promotion as P


def promotion_stream(posts: DataFrame, originals: DataFrame, landed: DataFrame, domains: list[tuple[str, str]], window_minutes: int = P.WINDOW_MINUTES, overlap: int = P.OVERLAP, wait: str = "6 hours", late: str = "1 hour", kept: str | None = None) -> DataFrame:
    """As operators.promotion.promotion_chain, in append mode.

    All three have a time (at, timestamp); rows that come more than `late` after newer ones may
    be left out. landed counts up to `wait` after the post, however long before it, unless `kept`
    says how long.
    """
    window = lambda at: F.floor(F.unix_micros(at) / (60_000_000 * window_minutes))
    p = posts.withWatermark("at", late).select(F.struct("*").alias("post"), F.col("at").alias("post_at"), P.handle_key(F.col("handle")).alias("post_handle"), X.significant_words(F.col("text")).alias("post_words"))
    p = p.select("*", F.explode(F.array(window(F.col("post_at")), window(F.col("post_at")) - 1)).alias("post_window"))  # its own and the one before
    o = originals.withWatermark("at", late).select("original_id", "card", F.col("at").alias("original_at"), P.handle_key(F.col("handle")).alias("original_handle"), X.significant_words(F.col("text")).alias("words"), window(F.col("at")).alias("original_window"))
    within = (F.col("original_at") <= F.col("post_at")) & (F.col("original_at") >= F.col("post_at") - F.make_dt_interval(mins=F.lit(window_minutes)))
    pairs = p.join(o, (F.col("post_handle") == F.col("original_handle")) & (F.col("post_window") == F.col("original_window")) & within, "left_outer")
    shared = F.size(F.array_intersect("post_words", "words"))
    match = F.when(shared >= overlap, F.struct((-shared).alias("shared"), (-F.unix_micros("original_at")).alias("time"), "original_id", "card"))
    best = pairs.groupBy("post", "post_at").agg(F.min(match).alias("match"))  # most words, latest, smallest id
    chosen = best.select("post", "post_at", F.col("match.original_id").alias("original_id"), F.col("match.card").alias("card"))
    page = landed.where("card <> ''").withWatermark("at", late).select(F.col("card").alias("page_card"), F.col("at").alias("page_at"), F.struct("final_url", "title", "body").alias("page"))
    come = F.col("page_at") <= F.col("post_at") + F.expr(f"INTERVAL {wait}")
    come = come if kept is None else come & (F.col("page_at") >= F.col("post_at") - F.expr(f"INTERVAL {kept}"))
    return P.promoted(chosen.join(page, (F.col("card") == F.col("page_card")) & come, "left_outer"), domains)
