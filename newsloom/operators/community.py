"""Community posts that carry articles over: which posts to take, and what item each becomes.

The chain is columns and left joins: the post's bracket says the outlet, its text the address of
the original; a paid outlet's item has the post's own text, a free one that of the landed
original, if it is one. Nothing falls out unnamed: each post ends with an outcome.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import adapters as A
from newsloom.functions import bylines as B
from newsloom.functions import html as H
from newsloom.functions import news as N
from newsloom.functions import text as X
from newsloom.operators import pages as P
from newsloom.operators import resolve as R

#: Outlets that cost, a mark of official posts, one of posts that must not be carried on, and limits of bodies.
PAID, OFFICIAL, NO_REPOST = ["The Athletic"], "공홈", "퍼가기가 금지된"
POST_CHARS, ORIGINAL_CHARS = 2000, 200
_ADDRESS = r"https?://[^\s\"'<>)]+"
_VOID = {"br", "img", "meta", "link", "input", "hr", "source", "wbr", "area", "base", "col", "embed", "param", "track"}


class _Post(HTMLParser):
    """Text, links and images of the element of a class, the date in the head, and strong texts of the frame beside it."""

    def __init__(self, content: str) -> None:
        super().__init__(convert_charrefs=True)
        self.content = content
        self.open: list[tuple[str, set[str]]] = []
        self.text: list[str] = []
        self.strong: list[str] = []
        self.date: list[str] = []
        self.links: list[str] = []
        self.images: list[str] = []
        self.done = False

    def _in(self, name: str) -> bool:
        return any(name in classes for _, classes in self.open)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        inside = self._in(self.content) and not self.done
        if tag == "a" and inside and a.get("href"):
            self.links.append(a["href"])
        if tag == "img" and inside and (src := a.get("src") or a.get("data-src")) and src not in self.images:
            self.images.append(src)
        if tag not in _VOID:
            self.open.append((tag, set(a.get("class", "").split())))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                was = self._in(self.content)
                del self.open[i:]
                self.done = self.done or (was and not self._in(self.content))  # the first such element only
                return

    def handle_data(self, data: str) -> None:
        if not (text := data.strip()) or any(tag in ("script", "style") for tag, _ in self.open):
            return
        if self._in(self.content):
            if not self.done:
                self.text.append(text)
        elif any(tag == "strong" for tag, _ in self.open) and self._in("rd_body"):
            self.strong.append(text)
        elif self._in("date") and self._in("rd_hd") and not self.date:
            self.date.append(text)


def read_posts(posts: DataFrame, content: str = "xe_content") -> DataFrame:
    """post (all columns but html, in a struct), text, links, images, strong, date of each post."""
    rest = F.struct(*[c for c in posts.columns if c != "html"])
    given = posts.select(rest.alias("post"), F.col("html").cast("string").alias("html"))
    text, many = T.StringType(), T.ArrayType(T.StringType())
    schema = T.StructType([given.schema["post"], *[T.StructField(n, k) for n, k in (("text", text), ("strong", text), ("date", text), ("links", many), ("images", many))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for html in b.column(1).to_pylist():
                p = _Post(content)
                p.feed(html or "")
                p.close()
                found.append(p)
            texts = [pa.array([" ".join(getattr(p, n)) for p in found], pa.string()) for n in ("text", "strong", "date")]
            lists = [pa.array([getattr(p, n) for p in found], pa.list_(pa.string())) for n in ("links", "images")]
            yield pa.RecordBatch.from_arrays([b.column(0), *texts, *lists], names=schema.names)

    return given.mapInArrow(run, schema)


def original_address(text: Column, links: Column, own_host: str) -> Column:
    """The last address written in a post that isn't its own site's, else the first such link."""
    foreign = lambda u: ~F.contains(u, F.lit(own_host))
    written = F.filter(F.regexp_extract_all(text, F.lit(_ADDRESS), F.lit(0)), foreign)
    linked = F.filter(links, lambda u: F.startswith(u, F.lit("http")) & foreign(u))
    return F.coalesce(F.try_element_at(written, F.lit(-1)), F.try_element_at(linked, F.lit(1)))


def discovered(results: DataFrame, known: DataFrame, base_url: str, limit: int) -> DataFrame:
    """keyword, title, url of the posts to take: each keyword gives one in turn, `limit` together.

    results: keyword (its number), page, at, title, href, must (words that the title has to hold, or
    null), failed. A failed page ends its keyword's pages. A post counts where it is found first;
    titles of `known` (title) are left out.
    """
    ends = results.where(F.coalesce("failed", F.lit(False))).groupBy("keyword").agg(F.min("page").alias("end"))
    read = results.join(ends, "keyword", "left").where(F.col("end").isNull() | (F.col("page") < F.col("end")))
    posts = read.withColumn("url", A.post_url(F.coalesce("href", F.lit("")), base_url)).where("url IS NOT NULL AND title <> ''")
    first = posts.groupBy("url").agg(F.min_by(F.struct("keyword", "page", "at", "title", "must"), F.struct("keyword", "page", "at")).alias("r")).select("url", "r.*")
    holds = F.col("must").isNull() | (F.col("must") == "") | F.contains(X.squashed(F.col("title")), X.squashed(F.col("must")))
    fresh = first.where(holds).join(known.select("title").distinct(), "title", "left_anti")
    return R.round_robin(fresh, "keyword", [F.col("page"), F.col("at")], limit).select("keyword", "title", "url")


def community_items(posts: DataFrame, originals: DataFrame, terms: list[str], names: list[str], own_host: str) -> DataFrame:
    """A row a post with its outcome: item, official, unresolved (no outlet or original) or irrelevant.

    posts: url, title, html. originals: url, html of landed originals, null where the site refused;
    a row an address. Columns: post_url, title, url (the original's), outlet, exclusive, journalist,
    authors, body, body_level (0 no body, 1 the post's, 2 the original's), lang, image_url, images
    (none of a paid outlet's post that must not be carried on), published_at, precision, outcome.
    """
    told = read_posts(posts).select("post", F.substr("text", F.lit(1), F.lit(POST_CHARS)).alias("post_body"), F.contains("strong", F.lit(NO_REPOST)).alias("blocked"), "date", "images", original_address(F.col("text"), F.col("links"), own_host).alias("original"), N.parse_bracket(F.coalesce("post.title", F.lit(""))).alias("bracket"))
    landed = originals.where("url IS NOT NULL AND html IS NOT NULL").dropDuplicates(["url"])
    said = P.page_bylines(landed).select("url", "authors", "published_at", "precision")
    read = H.extract(landed, "url").select("url", F.col("body").alias("text"), "og_image").join(said, "url")
    read = read.select(F.col("url").alias("original"), F.struct("text", "og_image", "authors", "published_at", "precision").alias("page"))
    rows = told.join(read, "original", "left")

    none = F.array().cast("array<string>")
    paid = F.coalesce(F.col("bracket.outlet").isin(PAID), F.lit(False))
    usable = ~paid & (F.length(F.trim(F.coalesce("page.text", F.lit("")))) >= ORIGINAL_CHARS)
    rows = rows.withColumns({"paid": paid, "usable": usable}).withColumn("body", B.without_publish_time(F.when(F.col("usable"), F.col("page.text")).otherwise(F.col("post_body"))))
    found = F.when(~F.col("paid"), F.col("page.authors"))
    authors = F.coalesce(*[F.nullif(F.coalesce(c, none), none) for c in (B.body_authors(F.col("body")), found, B.body_authors(F.col("post_body")))], none)
    head = F.col("bracket.journalist")
    authors = F.when(head.isNotNull(), F.concat(F.array(head), F.filter(authors, lambda a: a != head))).otherwise(authors)
    resolved = F.col("bracket.outlet").isNotNull() & F.col("original").isNotNull()
    relevant = N.is_relevant(F.col("post.title"), F.col("body"), terms, names)
    outcome = F.when(F.coalesce(F.contains("bracket.outlet", F.lit(OFFICIAL)), F.lit(False)), "official").when(~resolved, "unresolved").when(~relevant, "irrelevant").otherwise("item")
    posted = A.post_published(F.coalesce("date", F.lit("")))
    has_time = F.col("usable") & F.col("page.published_at").isNotNull()
    at = F.when(has_time, F.col("page.published_at")).otherwise(posted)
    precision = F.when(has_time, F.col("page.precision")).when(posted.isNotNull(), "time")
    images = F.when(F.col("paid") & ~F.col("blocked"), F.col("images")).otherwise(none)
    out = rows.withColumn("authors", authors)
    return out.select(
        F.col("post.url").alias("post_url"), "post.title", F.col("original").alias("url"), "bracket.outlet", "bracket.exclusive",
        F.coalesce(head, F.try_element_at("authors", F.lit(1))).alias("journalist"), "authors", "body",
        F.when(F.col("body") == "", 0).when(F.col("usable"), 2).otherwise(1).alias("body_level"), F.when(F.col("usable"), "en").otherwise("ko").alias("lang"),
        F.when(F.col("usable") | F.col("paid"), F.col("page.og_image")).alias("image_url"), images.alias("images"), at.alias("published_at"), precision.alias("precision"), outcome.alias("outcome"),
    )
