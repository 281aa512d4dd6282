"""Column functions on text, keys, numbers and times. All are built from Spark functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import vocab as V


#: Months, and how publish dates and clock times stand in a text.
MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
PUBLISH_TIME = rf"(?i)(?:{MONTHS})\.?\s+\d{{1,2}}\s*,?\s*\d{{4}}|(?:Updated\s+)?\d{{1,2}}:\d{{2}}\s*[ap]m"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.transform(F.array(value), use)[0]


def squeezed(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def squashed(c: Column) -> Column:
    """Lower case without white space."""
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def norm_alias(c: Column) -> Column:
    return squashed(c)


def url_host(url: Column) -> Column:
    """Lower-case host without `www.`."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[^:]+://([^/?#]*)", 1)), r"^www\.", "")


def _coded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def canonical_url(url: Column) -> Column:
    """Lower-case host; no fragment, trailing slash, tracking or blank parameters; parameters sorted."""
    u = F.trim(url)
    scheme = F.regexp_extract(u, r"^([^:/?#]+)://", 1)
    host = F.lower(F.regexp_extract(u, r"^[^:/?#]+://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(u, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.+"))
    pairs = F.transform(parts, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.regexp_replace(p, "^[^=]*=", "")).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).rlike("^(" + "|".join(V.TRACKING) + ")")))
    tail = F.array_join(F.transform(kept, lambda p: F.concat(_coded(p["k"]), F.lit("="), _coded(p["v"]))), "&")
    return F.concat(scheme, F.lit("://"), host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))


def content_hash(title: Column, url: Column) -> Column:
    return F.sha2(F.concat(squeezed(title), F.lit("|"), canonical_url(url)).cast("binary"), 256)


def confidence(tier: Column) -> Column:
    return F.coalesce(F.round(F.greatest(F.lit(0.0), 1 - tier / 4), 3), F.lit(0.0))


def domain_suffix(host: Column, domain: Column) -> Column:
    return (host == domain) | F.endswith(host, F.concat(F.lit("."), domain))


#: A comma between thousands, and a quoted span.
THOUSANDS, QUOTED = r"(?<=\d),(?=\d{3}(?!\d))", '["“]([^"“”]{4,}?)["”]'


def number_tokens(text: Column) -> Column:
    """Digit runs outside URLs, publish dates and clock times, thousands commas dropped."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"https?://\S+", " ")
    timed = bare.rlike(r"[A-Za-z]\.?\s+\d{1,2}\s*,?\s*\d{4}|\d:\d{2}")  # what every such date or time holds, found faster
    quiet = F.when(timed, F.regexp_replace(bare, PUBLISH_TIME, " ")).otherwise(bare)
    plain = F.regexp_replace(quiet, THOUSANDS, "")
    return F.regexp_extract_all(plain, F.lit(r"(\d+)"), F.lit(1))


def number_variants(token: Column) -> Column:
    """A number with its unit conversions: times 10, 100, 1000, and a hundredth; one of more than 34 digits has none."""
    n = token.try_cast("decimal(34,0)")
    whole = [n * f for f in (10, 100, 1000)]
    text = [x.cast("decimal(38,0)").cast("string") for x in whole]
    less = F.when(n % 100 == 0, (n / 100).cast("decimal(34,0)").cast("string"))
    return F.filter(F.array(token, *text, less), lambda x: x.isNotNull())


def missing_numbers(source: Column, output: Column) -> Column:
    """Numbers of source, each once, that output has in no unit."""
    found = number_tokens(output)
    return F.filter(F.array_distinct(number_tokens(source)), lambda t: ~F.arrays_overlap(number_variants(t), found))


def char_ngrams(text: Column, n: int = V.NGRAM) -> Column:
    """Distinct runs of n characters. Text becomes an array of characters first, as a place in
    UTF-8 is only found by counting from the start.
    """

    def grams(chars: Column) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(chars, i, n), "")))

    return let(F.split(squeezed(text), ""), grams)


def ngram_retention(source: Column, output: Column, n: int = V.NGRAM) -> Column:
    """Share of output's character n-grams that source has; 0 for a short output."""
    share = lambda out: F.when(F.size(out) > 0, F.size(F.array_intersect(out, char_ngrams(source, n))) / F.size(out)).otherwise(0.0)
    return let(char_ngrams(output, n), share)


def quote_spans(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(QUOTED), F.lit(1)), squeezed)


def missing_quotes(source: Column, output: Column) -> Column:
    out = F.regexp_replace(F.coalesce(output, F.lit("")), r"\s+", " ")
    return F.filter(quote_spans(source), lambda q: ~F.contains(out, q))


def cited_handles(text: Column) -> Column:
    """Handles in brackets, else handles before a colon, with their @."""
    first = F.regexp_extract_all(text, F.lit(r"\[\s*(@[A-Za-z0-9_]{1,15})\s*\]"), F.lit(1))
    second = F.regexp_extract_all(text, F.lit(r"(@[A-Za-z0-9_]{1,15})\s*\)?\s*:"), F.lit(1))
    return F.when(F.size(first) > 0, first).otherwise(second)


#: Words of a post, and those that say nothing of what it is about.
_WORD = r"[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'\-]+"
STOP_WORDS = "the a an and or to of in on for with set are is has have been will would from that this over amid could into out at as by".split()


def significant_words(text: Column, stop: list[str] = STOP_WORDS) -> Column:
    """Distinct words of four letters or more, in lower case, without stop words."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0)), F.lower)
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(stop)))


def split_authors(value: Column) -> Column:
    """Names of a byline in order, each once; URLs dropped."""
    names = F.transform(F.split(F.coalesce(value, F.lit("")), r"\s*(?:,|&|\band\b)\s*"), lambda n: F.trim(n))
    return F.array_distinct(F.filter(names, lambda n: (n != "") & ~n.rlike("^https?://")))


def humanize_age(seconds: Column, day: Column) -> Column:
    """Age in the reader's words up to seven days, then the day (yyyy-MM-dd)."""
    ago = lambda unit, label: F.concat(F.floor(seconds / unit).cast("string"), F.lit(label))
    return F.when(seconds < 60, "방금 전").when(seconds < 3600, ago(60, "분 전")).when(seconds < 86400, ago(3600, "시간 전")).when(seconds < 8 * 86400, ago(86400, "일 전")).otherwise(day)


def day_label(day: Column, today: Column) -> Column:
    """Today, yesterday, or month, day and weekday."""
    ago = F.datediff(today, day)
    weekday = F.element_at(F.array(*[F.lit(c) for c in "월화수목금토일"]), F.weekday(day) + 1)
    long = F.concat(F.month(day).cast("string"), F.lit("월 "), F.day(day).cast("string"), F.lit("일 ("), weekday, F.lit(")"))
    return F.when(ago == 0, "오늘").when(ago == 1, "어제").otherwise(long)


def glossary_replace(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements in the glossary's order."""
    for wrong, right in pairs:
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c


def _marked_letters() -> tuple[str, str]:
    """Latin letters with marks and the letters without."""
    marked, plain = [], []
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base.isascii():
            marked.append(c)
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _UNMARKED = _marked_letters()


def strip_marks(c: Column) -> Column:
    """Latin letters without their marks, in their case; ae, ss and o for letters that have no mark."""
    out = F.translate(F.regexp_replace(c, r"\p{Mn}", ""), _MARKED + "øØ", _UNMARKED + "oO")
    for letter, plain in (("æ", "ae"), ("Æ", "AE"), ("ß", "ss")):
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def fold_latin(c: Column) -> Column:
    """Lower case without marks of Latin letters."""
    return F.lower(strip_marks(F.lower(c)))
