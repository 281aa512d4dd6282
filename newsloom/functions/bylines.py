"""Authors that stand at the head of a body, in the forms that bylines have there.

A marked byline is read by a small automaton, a fold over the head's tokens: names of capitalised
words with particles between them, joined by commas and `and`, until something is neither. Korean
letters have no case, so there a name ends where a bracket, colon or hyphen says so, or else
where the words stop looking like one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import text as X

#: Characters of a body that count as its head.
HEAD = 200
#: Months as they stand before a day, particles of names, words of jobs, and shapes of Korean bylines.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept|Sep|Oct|Nov|Dec"
PARTICLES = "de|van|von|der|del|di|da|le|la"
JOBS = "REPORTER|CORRESPONDENT|WRITER|EDITOR"
KOREAN_BYLINE = r"(?U)(?:\bBy\s+|글\s*[:：]\s*)([가-힣].{0,120})"
KOREAN_BOUNDED = {"bracket": r"(?U)^\s*[\(（]([^)）]{2,80})[\)）]", "colon": r"(?U)^\s*([가-힣][가-힣 ·]{1,30})\s*[:：]\s", "hyphen": r"(?U)^\s*[A-Za-z][A-Za-z .'’]{2,25}\s*[-–—]\s*([가-힣][가-힣 ·]{1,40})"}
KOREAN_LONGEST, KOREAN_SENTENCE_END = 14, "(다|요|죠)$"

_NOT_A_NAME = rf"(?:{MONTHS})\.?\s+\d|Updated\b"
_NAME = r"[A-Z][\w'’\-]*"
_START = rf"(?Us)\bBy +(?!{_NOT_A_NAME})(?=[A-Z])(.*)$"
_TOKENS = rf"(?Us){_NOT_A_NAME}|{_NAME}|(?:{PARTICLES}|and)(?= )|,| +|."
_LEAD = rf"(?U)^\s*((?!{_NOT_A_NAME}){_NAME}(?: +(?!{_NOT_A_NAME}){_NAME})?) +(?:[\w'’\-]+ +){{0,2}}(?i:{JOBS})\b"

#: Where the automaton is: before a name's first word, behind a word, behind blanks, behind a particle and its blanks, behind a separator and its blanks, at the end.
_FIRST, _WORD, _BLANK, _PARTICLE, _PARTICLE_BLANK, _SEPARATOR, _NEXT, _END = range(8)



def without_publish_time(body: Column) -> Column:
    """The body without dates and times in its head, blanks there joined; as it is if there are none."""
    head, rest = F.substr(body, F.lit(1), F.lit(HEAD)), F.substr(body, F.lit(HEAD + 1))
    cut = F.trim(F.concat(F.regexp_replace(F.regexp_replace(head, X.PUBLISH_TIME, ""), "[ \t]{2,}", " "), rest))
    return F.when(head.rlike(X.PUBLISH_TIME), F.coalesce(F.nullif(F.regexp_replace(cut, r"(?U)^\s+|\s+$", ""), F.lit("")), body)).otherwise(body)


def _step(s: Column, t: Column) -> Column:
    """The automaton's next state. s: mode, names, name, gap (what may yet belong to the name)."""
    is_date = t.rlike(rf"(?U)^(?:{_NOT_A_NAME})$")
    name, blank, comma = ~is_date & t.rlike("^[A-Z]"), t.rlike("^ "), t == ","
    joiner, particle, at = t == "and", t.rlike(f"^(?:{PARTICLES})$"), s["mode"]

    def to(mode: int, names: Column | None = None, word: Column | None = None, gap: Column | None = None) -> Column:
        return F.struct(F.lit(mode).alias("mode"), (s["names"] if names is None else names).alias("names"), (s["name"] if word is None else word).alias("name"), (F.lit("") if gap is None else gap).alias("gap"))

    more = F.concat(s["name"], s["gap"], t)
    return (
        F.when(at == _END, s)
        .when((at == _FIRST) & name, to(_WORD, word=t))
        .when((at == _WORD) & blank, to(_BLANK, gap=t))
        .when(at.isin(_WORD, _BLANK) & comma, to(_SEPARATOR))
        .when((at == _BLANK) & joiner, to(_SEPARATOR))
        .when(at.isin(_BLANK, _PARTICLE_BLANK) & name, to(_WORD, word=more))
        .when((at == _BLANK) & particle, to(_PARTICLE, gap=F.concat(s["gap"], t)))
        .when((at == _PARTICLE) & blank, to(_PARTICLE_BLANK, gap=F.concat(s["gap"], t)))
        .when((at == _SEPARATOR) & blank, to(_NEXT))
        .when((at == _NEXT) & name, to(_WORD, names=F.array_append(s["names"], s["name"]), word=t))
        .otherwise(to(_END))
    )


def marked_authors(head: Column) -> Column:
    """Names after `By`; without job titles, each once. Null without such a byline."""
    rest = F.nullif(F.regexp_extract(head, _START, 1), F.lit(""))
    begin = F.struct(F.lit(_FIRST).alias("mode"), F.array().cast("array<string>").alias("names"), F.lit("").alias("name"), F.lit("").alias("gap"))
    names = F.aggregate(F.regexp_extract_all(rest, F.lit(_TOKENS), F.lit(0)), begin, _step, lambda s: F.array_append(s["names"], s["name"]))
    return F.when(rest.isNotNull(), F.array_distinct(F.filter(names, lambda n: (n != "") & ~n.rlike(f"(?i){JOBS}"))))


def looks_like_a_name(part: Column) -> Column:
    """One or two short words without a digit that end no sentence."""
    words = F.size(F.filter(F.split(part, r"(?U)\s+"), lambda w: w != ""))
    return words.between(1, 2) & (F.length(part) <= KOREAN_LONGEST) & ~part.rlike(r"(?U)\d") & ~part.rlike(KOREAN_SENTENCE_END)


def _parts(names: Column) -> Column:
    return F.transform(F.split(names, r"(?U)\s*[,·]\s*"), lambda p: F.trim(p))


def _first_two(part: Column) -> Column:
    return F.array_join(F.slice(F.filter(F.split(part, r"(?U)\s+"), lambda w: w != ""), 1, 2), " ")


def bounded_authors(head: Column) -> Column:
    """Names that a bracket, a colon or a hyphen bounds, if all of them look like names; null else."""

    def read(form: str) -> Column:
        parts = F.filter(_parts(F.regexp_extract(head, KOREAN_BOUNDED[form], 1)), lambda p: p != "")
        if form == "hyphen":
            parts = F.transform(F.slice(parts, 1, 1), _first_two)
        return F.when((F.size(parts) > 0) & F.forall(parts, looks_like_a_name), F.array_distinct(parts))

    return F.coalesce(*[read(form) for form in KOREAN_BOUNDED])


def running_authors(head: Column) -> Column:
    """Names after a mark, from the left: the first part that isn't just a name gives its first two words and ends them."""

    def step(s: Column, part: Column) -> Column:
        ended = ~looks_like_a_name(part)
        new = F.when(ended, _first_two(part)).otherwise(part)
        return F.when(s["end"], s).otherwise(F.struct(F.array_append(s["names"], new).alias("names"), ended.alias("end")))

    found = F.regexp_extract(head, KOREAN_BYLINE, 1)
    begin = F.struct(F.array().cast("array<string>").alias("names"), F.lit(False).alias("end"))
    names = F.aggregate(_parts(found), begin, step, lambda s: s["names"])
    return F.when(found != "", F.array_distinct(F.filter(names, lambda n: n != "")))


def body_authors(body: Column) -> Column:
    """All authors of the byline at a body's head, in order, each once. A mark that is only followed by itself marks nobody."""
    none = F.array().cast("array<string>")
    given = F.coalesce(body, F.lit(""))
    flat = F.substr(F.regexp_replace(given, r"(?U)\s+", " "), F.lit(1), F.lit(HEAD))
    lead = F.nullif(F.regexp_extract(given, _LEAD, 1), F.lit(""))
    own = F.coalesce(F.nullif(F.coalesce(bounded_authors(flat), running_authors(flat), none), none), F.when(lead.isNotNull(), F.array(lead)), none)
    marked = marked_authors(F.substr(given, F.lit(1), F.lit(HEAD)))
    people = lambda names: F.filter(names, lambda n: ~n.rlike("^By( +By)*$"))
    return F.coalesce(X.let(marked, lambda names: F.when((F.size(names) == 0) | (F.size(people(names)) > 0), people(names))), own)
