"""From a post that cites someone to the article behind it: original post, its card, the landed page.

Each step is a left join, so whatever is missing on the way leaves the post as it is, with the
step that it failed at. streaming/promotion.py is the same chain over streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.items import is_paywalled
from newsloom.operators import resolve as R

#: Minutes that an original may be older, and words that it must share.
WINDOW_MINUTES, OVERLAP = 180, 4


def handle_key(handle: Column) -> Column:
    return F.lower(F.regexp_replace(handle, "^@+", ""))


def outcome(original: Column, card: Column, final_url: Column, body: Column, domains: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(outlet of the page that the post is promoted to, else null; the step that failed, else null)."""
    outlet = R.outlet_by_domain(X.url_host(final_url), domains)
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    missed = F.when(original.isNull(), "original").when(empty(card), "card").when(empty(final_url) | empty(body), "page").when(is_paywalled(final_url), "paywall").when(outlet.isNull(), "outlet")
    return F.when(missed.isNull(), outlet), missed


def promoted(joined: DataFrame, domains: list[tuple[str, str]]) -> DataFrame:
    """post's columns with url, outlet, title and body of the page where there is one, and missed. joined: post, original_id, page (struct)."""
    outlet, missed = outcome(F.col("original_id"), F.col("card"), F.col("page.final_url"), F.col("page.body"), domains)
    rows = joined.select("post", "original_id", "page", outlet.alias("found"), missed.alias("missed"))
    taken = lambda page, own: F.when(F.col("missed").isNull(), page).otherwise(own)
    kept = [f"post.{c}" for c in joined.schema["post"].dataType.names if c not in ("url", "outlet", "text")]
    title = F.coalesce(F.nullif("page.title", F.lit("")), "post.text")
    return rows.select(*kept, "post.text", taken(F.col("page.final_url"), F.col("post.url")).alias("url"), taken(F.col("found"), F.col("post.outlet")).alias("outlet"), taken(title, F.lit(None)).alias("title"), taken(F.col("page.body"), F.lit(None)).alias("body"), "original_id", "missed")


def promotion_chain(posts: DataFrame, originals: DataFrame, landed: DataFrame, domains: list[tuple[str, str]], window_minutes: int = WINDOW_MINUTES, overlap: int = OVERLAP) -> DataFrame:
    """Posts with their original's page, or as they were.

    posts: post_id (unique), handle, at (timestamp), text, url, outlet and others. originals:
    original_id, handle, at, text, card. landed: card, final_url, title, body; a row a card.
    The original is that of the post's handle within the window before it that shares most
    significant words, `overlap` at least; of equals the latest, then the smallest id. Only its
    card counts, even if another original has a better one.
    """
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    words = X.significant_words(F.col("text")).alias("words")
    own = posts.where("handle IS NOT NULL AND at IS NOT NULL").select(handle_key(F.col("handle")).alias("handle"), F.col("post_id").alias("item_id"), seconds("at").alias("at"), words)
    other = originals.where("handle IS NOT NULL AND at IS NOT NULL").select(handle_key(F.col("handle")).alias("handle"), "original_id", seconds("at").alias("at"), words)
    best = R.best_earlier_match(own, other, 60 * window_minutes, overlap).select("item_id", "original_id")
    cards = best.join(originals.select("original_id", "card"), "original_id", "left")
    page = landed.where("card <> ''").select("card", F.struct("final_url", "title", "body").alias("page"))
    joined = posts.select(F.struct("*").alias("post")).join(cards, F.col("post.post_id") == F.col("item_id"), "left")
    return promoted(joined.join(page, "card", "left"), domains)
