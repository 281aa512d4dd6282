"""Column functions on items: payload fallbacks, authors, dates of the reader, search words and page layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import text as X


def body_level(declared: Column, body: Column) -> Column:
    """The declared level, else 2 with a body and 0 without."""
    return F.coalesce(declared.cast("int"), F.when(F.coalesce(body, F.lit("")) != "", 2).otherwise(0))


def published_or_fetched(published: Column, fetched: Column) -> Column:
    """The published time, unless it lies an hour or more past the fetch or is missing."""
    return F.when(published.isNull() | (published > F.timestamp_add("HOUR", F.lit(1), fetched)), fetched).otherwise(published)


def primary_author(authors: Column, registered: list[str]) -> Column:
    """The first registered author, else the first one."""
    known = F.filter(authors, lambda a: X.norm_alias(a).isin(registered)) if registered else F.array().cast("array<string>")
    return F.coalesce(F.try_element_at(known, F.lit(1)), F.try_element_at(authors, F.lit(1)))


def select_journalist(given: Column, label: Column, authors: Column, registered: list[str]) -> Column:
    """One name for an item: its own, its source's label, or its primary author."""
    filled = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(filled(given), filled(label), primary_author(authors, registered))


def select_authors(authors: Column, journalist: Column) -> Column:
    """All authors in order, each once; joined names are split. Without authors the journalist's names."""
    names = F.when(F.size(authors) > 0, authors).otherwise(F.array_compact(F.array(journalist)))
    return F.array_distinct(F.flatten(F.transform(names, X.split_authors)))


def stored_authors(json: Column) -> Column:
    """Names of a stored JSON list, trimmed; anything else gives none."""
    names = F.coalesce(F.from_json(json, "array<string>"), F.array().cast("array<string>"))
    return F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != "")


def image_key(url: Column) -> Column:
    """An image's address without its query, which only resizes it."""
    return F.split_part(url, F.lit("?"), F.lit(1))


def serving_mode(mode: Column) -> Column:
    return F.when(mode.isin("full", "excerpt"), mode).otherwise("excerpt")


def in_kst(ts: Column) -> Column:
    return F.timestamp_add("HOUR", F.lit(9), ts)


def time_in_group(published: Column, fetched: Column, precision: Column) -> Column:
    """Hour and minute in Korea; nothing where only the day is known."""
    at = F.date_format(in_kst(F.coalesce(published, fetched)), "HH:mm")
    return F.when(precision.eqNullSafe("day"), "").otherwise(F.coalesce(at, F.lit("")))


def published_label(published: Column, precision: Column) -> Column:
    local = in_kst(published)
    return F.coalesce(F.when(precision.eqNullSafe("time"), F.date_format(local, "yyyy-MM-dd HH:mm")).otherwise(F.date_format(local, "yyyy-MM-dd")), F.lit(""))


def day_only(day: Column, today: Column) -> Column:
    """Month and day, with the year if it is another one."""
    month_day = F.concat(F.month(day).cast("string"), F.lit("월 "), F.day(day).cast("string"), F.lit("일"))
    return F.when(F.year(day) == F.year(today), month_day).otherwise(F.concat(F.year(day).cast("string"), F.lit("년 "), month_day))


#: Shapes of landed date texts; those of the second list have no time.
_TIMED = ["yyyy-MM-dd['T'][ ]HH:mm[:ss][.SSSSSSSSS][XXX][XX][X]", "yyyyMMdd'T'HHmm[ss][XXX][XX][X]", "d MMM yyyy HH:mm[:ss][ Z]", "MMM d, yyyy HH:mm[:ss]"]
_DAYS = ["yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "d MMM yyyy", "MMM d, yyyy", "d MMMM yyyy", "MMMM d, yyyy"]


def parsed_date(raw: Column) -> Column:
    """struct(at, precision) of a date text; without a zone it is UTC, without a time its precision is day. None if no shape fits."""
    raw = F.trim(F.regexp_replace(raw, r"^\s*[A-Za-z]{3},\s*", ""))  # without the day of the week
    local = F.coalesce(*[F.try_to_timestamp(raw, F.lit(f)) for f in _TIMED + _DAYS]).cast("timestamp_ntz")
    at = F.when(raw.rlike(r"(Z|[+-]\d{2}:?\d{2}|\d[+-]\d{2})$") & raw.rlike(r"[T ]\d{1,2}:|T\d{4}"), F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)).otherwise(local)
    precision = F.when(raw.rlike(r"[T ]\d{1,2}:|T\d{4}"), "time").otherwise("day")
    return F.when(at.isNotNull(), F.struct(at.alias("at"), precision.alias("precision")))


#: Particles that follow a word, and what parts a title's words.
_PARTING = r"[\s,./·'\"()\[\]]+"
_PARTICLE = "(을|를|이|가|은|는|와|과|의|에서|에|으로|로|도|만)$"


def search_candidates(title: Column) -> Column:
    """(target, keyword) pairs to look a lost item up by, in order of trial, each once.

    The title without its bracket, then the outlet with the first word, the first word alone,
    and the same with the longest word; words have two letters at least, particles are cut off.
    """
    body = F.trim(F.regexp_replace(title, r"^\s*\[[^\]]*\]", ""))
    outlet = F.trim(F.split(F.regexp_extract(title, r"^\s*\[([^\]]*)\]", 1), r"\s*-\s*")[0])
    words = F.filter(F.split(body, _PARTING), lambda w: F.length(w) >= 2)
    most = F.array_max(F.transform(words, F.length))
    bare = lambda w: F.regexp_replace(F.coalesce(w, F.lit("")), _PARTICLE, "")
    first = bare(F.try_element_at(words, F.lit(1)))
    longest = bare(F.try_element_at(F.filter(words, lambda w: F.length(w) == most), F.lit(1)))
    pair = lambda target, keyword: F.struct(F.lit(target).alias("target"), F.trim(keyword).alias("keyword"))
    with_outlet = lambda w: F.when((outlet != "") & (w != ""), F.concat(outlet, F.lit(" "), w)).otherwise("")
    tried = F.array(pair("title", body), pair("title_content", with_outlet(first)), pair("title", first), pair("title_content", with_outlet(longest)), pair("title", longest))
    return F.array_distinct(F.filter(tried, lambda c: c["keyword"] != ""))


def excerpt(paragraphs: Column, limit: int = 300, most: int = 2) -> Column:
    """The first paragraphs, `most` at most, until they have `limit` characters together."""
    heads = F.slice(paragraphs, 1, most)
    before = lambda i: F.aggregate(F.slice(heads, 1, i), F.lit(0), lambda n, p: n + F.length(p))
    return F.filter(heads, lambda p, i: before(i) < limit)


def laid_out(paragraphs: Column, images: Column, every: int = 2) -> Column:
    """Blocks (type, text): headings, quotes and paragraphs, an image after every `every` of them while there are any."""
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    kind = lambda p: F.when(F.startswith(p, F.lit("### ")), block("h3", F.trim(F.substring(p, 5, 2**30)))).when(F.startswith(p, F.lit("> ")), block("quote", F.trim(F.substring(p, 3, 2**30)))).otherwise(block("p", p))

    def with_image(p: Column, i: Column) -> Column:
        turn = ((i + 1) / every).cast("int")
        due = ((i + 1) % every == 0) & (turn <= F.size(images))
        return F.when(due, F.array(kind(p), block("img", F.get(images, turn - 1)))).otherwise(F.array(kind(p)))

    return F.flatten(F.transform(paragraphs, with_image))


def itemized(blocks: Column, sources: Column) -> Column:
    """Paragraphs that end with a named source in brackets as items (type, text, source)."""
    name = lambda b: F.trim(F.regexp_extract(b["text"], r"\(([^()]{2,60})\)\s*$", 1))
    core = lambda b: F.trim(F.split(name(b), r"\s+-\s+|,\s+|\s+via\s+")[0])
    item = lambda b: F.struct(F.lit("item").alias("type"), F.trim(F.regexp_replace(b["text"], r"\s*\([^()]{2,60}\)\s*$", "")).alias("text"), name(b).alias("source"))
    plain = lambda b: F.struct(b["type"].alias("type"), b["text"].alias("text"), F.lit(None).cast("string").alias("source"))
    return F.transform(blocks, lambda b: F.when((b["type"] == "p") & F.array_contains(sources, core(b)), item(b)).otherwise(plain(b)))


def korean_full_name(approved: Column, name: Column, candidate: Column) -> Column:
    """The approved spelling, else a candidate longer than the name."""
    longer = F.when(name.isNull() | (F.length(candidate) > F.length(name)), F.nullif(candidate, F.lit("")))
    return F.coalesce(approved, longer)


def is_paywalled(url: Column) -> Column:
    """The paid outlet's own host, or its folder at its owner's."""
    host = F.lower(F.regexp_extract(url, r"^[^:]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1))
    own = (host == "theathletic.com") | F.endswith(host, F.lit(".theathletic.com"))
    return own | (F.endswith(host, F.lit("nytimes.com")) & path.rlike("^/athletic(/|$)"))
