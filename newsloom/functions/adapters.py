"""Column functions that turn landed payloads of single sources into item columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import text as X

#: Words of a transfer title, and the tags of an official item.
TRANSFER_TITLE = r"(?i)\b(joins|signs|transfer|loan)\b"
REQUIRED_TAG, ANY_TAGS = "Men", ["Transfer news", "Contract news"]


def element_images(elements: Column, limit: int = 10) -> Column:
    """Widest asset of each image element, each file once.

    elements: array of struct(type, assets: array of struct(file, width)).
    """
    images = F.filter(elements, lambda e: e["type"] == "image")
    ranked = F.transform(images, lambda e: F.array_sort(F.transform(F.filter(e["assets"], lambda a: a["file"] != ""), lambda a: F.struct((-F.coalesce(a["width"], F.lit(0))).alias("w"), a["file"].alias("file")))))
    files = F.transform(F.filter(ranked, lambda r: F.size(r) > 0), lambda r: r[0]["file"])
    return F.slice(F.array_distinct(files), 1, limit)


def page_id(url: Column) -> Column:
    """Trailing token of ten or more letters and digits."""
    return F.nullif(F.regexp_extract(url, "-([A-Za-z0-9]{10,})$", 1), F.lit(""))


def accept_path(kind: Column, tags: Column, title: Column) -> Column:
    """How an official item is accepted: by its tags, by its title, or not at all."""
    tags = F.coalesce(tags, F.array().cast("array<string>"))
    open_ = (kind == "News") & F.array_contains(tags, REQUIRED_TAG)
    return F.when(open_ & F.arrays_overlap(tags, F.array(*[F.lit(t) for t in ANY_TAGS])), "tag").when(open_ & F.coalesce(title, F.lit("")).rlike(TRANSFER_TITLE), "title")


def block_text(block: Column) -> Column:
    inner = F.trim(F.coalesce(block["innerText"], F.lit("")))
    return F.when(inner != "", inner).otherwise(F.trim(F.regexp_replace(F.coalesce(block["html"], F.lit("")), "<[^>]+>", "")))


def blocks_body(blocks: Column) -> Column:
    """Texts of TEXT blocks, a blank line between."""
    texts = F.transform(F.filter(blocks, lambda b: b["type"] == "TEXT"), block_text)
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n\n")


def is_post_host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[^:]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return host.isin("x.com", "twitter.com", "t.co") | host.rlike(r"\.(x|twitter)\.com$")


def post_url(href: Column, base_url: str) -> Column:
    """Canonical address of a community post from a search result's link."""
    number = F.coalesce(F.nullif(F.regexp_extract(href, r"document_srl=(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(href, r"^/(\d{6,})", 1), F.lit("")))
    return F.when(number.isNotNull(), F.concat(F.lit(base_url.rstrip("/") + "/"), number))


def post_published(text: Column) -> Column:
    """`yyyy.MM.dd HH:mm` of UTC+9 as a UTC time without zone."""
    at = F.try_to_timestamp(F.nullif(F.regexp_replace(F.regexp_extract(text, r"(\d{4}\.\d{2}\.\d{2}\s+\d{2}:\d{2})", 1), r"\s+", " "), F.lit("")), F.lit("yyyy.MM.dd HH:mm"))
    return F.timestamp_add("HOUR", F.lit(-9), at.cast("timestamp_ntz"))


def is_own_post(author: Column, handle: str, text: Column, tag: str = "AFC") -> Column:
    """A post of the account itself (reposts have another author) with the tag as a word."""
    own = (F.coalesce(author, F.lit("")) == "") | (F.lower(author) == handle.lower())
    return own & F.coalesce(text, F.lit("")).rlike(rf"(?i)#{tag}\b")


def miss_suspect(title: Column, published: Column, now: Column, hours: float = 6.0) -> Column:
    """A rejected item with a transfer title, published within the last hours; times without a zone don't count."""
    zoned = published.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    at = F.when(zoned, F.try_to_timestamp(published))
    return F.coalesce((F.timestamp_diff("SECOND", at, now) <= hours * 3600) & title.rlike(TRANSFER_TITLE), F.lit(False))


def coverage_breach(candidates: Column, tagged: Column) -> Column:
    """First broken invariant of the official source's funnel."""
    return F.when(candidates == 0, "no_candidates").when(tagged == 0, "no_men_tag")


def _sections(body: Column) -> Column:
    """(heading, text) of each part that a line with ### opens."""
    parts = F.split(F.concat(F.lit("\n"), F.coalesce(body, F.lit(""))), r"\n\s*(?=###)")
    opened = F.filter(parts, lambda p: p.startswith("###"))
    return F.transform(opened, lambda p: F.struct(F.split_part(p, F.lit("\n"), F.lit(1)).alias("heading"), F.regexp_replace(p, r"^[^\n]*\n?", "").alias("text")))


def role(title: Column, title_original: Column, body: Column, own_keys: Column, latin_keys: Column, said: Column, mark: str = "대체자", gap: int = 6) -> Column:
    """subject or mention: whether the article treats the person as its news.

    own_keys: names in the translation, blanks out; latin_keys: folded Latin names. said: what
    the model called it; it can only turn a subject by title into a mention. A name that
    stands up to `gap` characters before `mark` is one that was replaced.
    """
    squashed = lambda t: F.regexp_replace(F.coalesce(t, F.lit("")), r"\s+", "")
    short, long = F.filter(own_keys, lambda k: F.length(k) >= 2), F.filter(latin_keys, lambda k: F.length(k) >= 4)

    def hit(t: Column) -> Column:
        return F.exists(short, lambda k: F.contains(squashed(t), k)) | F.exists(long, lambda k: F.contains(X.fold_latin(F.coalesce(t, F.lit(""))), k))

    def replaced(t: Column) -> Column:
        return F.exists(short, lambda k: F.regexp_like(squashed(t), F.concat(F.lit(r"\Q"), k, F.lit(rf"\E.{{0,{gap}}}{mark}"))))

    in_title = ~replaced(title) & (hit(title) | hit(title_original))
    in_head = F.exists(_sections(body), lambda s: hit(s["heading"]) & ~replaced(s["heading"]) & hit(s["text"]))
    mention = ~(in_title | in_head) | (in_title & ~in_head & F.coalesce(said == "mention", F.lit(False)))
    return F.when(mention, "mention").otherwise("subject")
