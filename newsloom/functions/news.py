"""Column functions on titles, names, routes and verdicts of news items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import vocab as V


def longest_name(text: Column, names: list[str]) -> Column:
    """The longest listed name that the text contains; of equal lengths the least."""
    ordered = sorted(names, key=lambda n: (-len(n), n))
    return F.coalesce(*[F.when(F.contains(text, F.lit(n)), F.lit(n)) for n in ordered])


def first_clause(title: Column) -> Column:
    return F.split_part(F.replace(title, F.lit("…"), F.lit("...")), F.lit("..."), F.lit(1))


def protagonist(title: Column, names: list[str], turns: list[str]) -> Column:
    """The name found first; if a transition word stands in the title, the first name after the earliest one."""
    at = lambda w: F.locate(w, title)
    places = F.array_sort(F.array(*[F.struct(at(n).alias("at"), F.lit(n).alias("name")) for n in names]))
    found = F.filter(places, lambda p: p["at"] > 0)
    turn = F.array_min(F.filter(F.array(*[at(w) for w in turns]), lambda p: p > 0))
    after = F.filter(found, lambda p: p["at"] > turn)
    return F.coalesce(F.when(turn.isNotNull(), F.try_element_at(after, F.lit(1))["name"]), F.try_element_at(found, F.lit(1))["name"])


def is_relevant(title: Column, body: Column, terms: list[str], names: list[str]) -> Column:
    """A term in title or body, or a name in the title, blanks aside. Without terms and names all are."""
    if not terms and not names:
        return F.lit(True)
    t, b = X.squashed(F.coalesce(title, F.lit(""))), X.squashed(F.coalesce(body, F.lit("")))
    hits = [F.contains(c, F.lit(w.lower().replace(" ", ""))) for w in terms for c in (t, b)] + [F.contains(t, F.lit(n.lower().replace(" ", ""))) for n in names]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def is_womens(title: Column, body: Column) -> Column:
    """A mark of the women's team in the title or the first 400 characters of the body."""
    pattern = "(?i)women|wsl|여자"
    return F.coalesce(title, F.lit("")).rlike(pattern) | F.substring(F.coalesce(body, F.lit("")), 1, 400).rlike(pattern)


#: Marks of an exclusive report, and outlets as a bracket spells them.
EXCLUSIVE = ["독점", "단독"]
OUTLET_SPELLINGS = {
    "디 애슬레틱": "The Athletic", "디애슬레틱": "The Athletic", "디 애슬래틱": "The Athletic", "디애슬래틱": "The Athletic", "The Athletic": "The Athletic",
    "골닷컴": "Goal.com", "르퀴프": "L'Équipe", "레퀴프": "L'Équipe", "인디펜던트": "The Independent", "디 인디펜던트": "The Independent",
    "텔레그래프": "The Telegraph", "DM": "Daily Mail", "비사커": "BeSoccer", "타임스": "The Times", "타임즈": "The Times",
}


def parse_bracket(title: Column) -> Column:
    """outlet, journalist and exclusive of a title's leading bracket: `[Outlet]`, `[Outlet - Name]`, either with a mark."""
    inner = F.trim(F.regexp_extract(title, r"^\s*\[([^\]]+)\]", 1))
    exclusive, bare = F.lit(False), inner
    for mark in EXCLUSIVE:
        exclusive, bare = exclusive | F.contains(inner, F.lit(mark)), F.replace(bare, F.lit(mark), F.lit(""))
    parts = F.split(bare, r"\s*-\s*", 2)
    stripped = lambda i: F.nullif(F.btrim(F.try_element_at(parts, F.lit(i)), F.lit(" -")), F.lit(""))
    spelt = F.create_map(*[F.lit(x) for kv in OUTLET_SPELLINGS.items() for x in kv])
    return F.struct(F.coalesce(spelt[stripped(1)], stripped(1)).alias("outlet"), stripped(2).alias("journalist"), F.coalesce(exclusive, F.lit(False)).alias("exclusive"))


#: A run of capitalised words, with marked letters, apostrophes, dots and hyphens.
_ENTITY = r"[A-Z][A-Za-zÀ-ÿ'.\-]*(?:\s+[A-Z][A-Za-zÀ-ÿ'.\-]*)+"


def entities(text: Column) -> Column:
    """Runs of two or more capitalised words in order, repeats included."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_ENTITY), F.lit(0))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def linked_label(names: Column) -> Column:
    """`A` or `A and n more` of names joined by |."""
    parts = F.split(names, r"\|")
    n = F.size(parts)
    return F.when(F.coalesce(names, F.lit("")) != "", F.when(n == 1, parts[0]).otherwise(F.concat(parts[0], F.lit(" and "), (n - 1).cast("string"), F.lit(" more"))))


def gate_verdict(source: Column, output: Column, grounding: Column | None = None, names: Column | None = None, clubs: Column | None = None) -> Column:
    """missing, extra, quotes, retention, names, clubs and ok of a rewrite.

    grounding: all that figures may come from, the title included; the source alone without it.
    names, clubs: those that the output has from nowhere (see injected). Copying too much is no
    count of its own here, but not ok.
    """
    none = F.array().cast("array<string>")
    missing, extra = X.missing_numbers(source, output), X.missing_numbers(output, source if grounding is None else grounding)
    quotes, kept = X.missing_quotes(source, output), X.ngram_retention(source, output)
    names, clubs = (none if c is None else F.coalesce(c, none) for c in (names, clubs))
    verdict = F.struct(missing.alias("missing"), extra.alias("extra"), quotes.alias("quotes"), names.alias("names"), clubs.alias("clubs"), kept.alias("retention"))
    return X.let(verdict, lambda v: v.withField("ok", violations(v) == 0))


def violations(verdict: Column) -> Column:
    """How many things are wrong with a rewrite; a copy counts as one."""
    lists = [F.coalesce(F.size(verdict[c]), F.lit(0)) for c in ("missing", "extra", "quotes", "names", "clubs")]
    return sum(lists[1:], lists[0]) + F.coalesce((verdict["retention"] > V.RETENTION).cast("int"), F.lit(0))


def level_route(level: Column, source_lang: Column) -> Column:
    """Which queue a row goes to."""
    return F.when(level == 1, "rewrite").when(F.coalesce(source_lang, F.lit("en")) == "en", "translate").otherwise("summarise")


#: Fixed value: a round-up's mark of where an item comes from.
_ATTRIBUTION = r"\(\s*([^()]{2,60}?)\s*(?:,\s*external\s*\)|\)\s*,\s*external)"


def attributions(text: Column) -> Column:
    """Sources that a round-up names, in order and as often as it does, without additions."""
    labels = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_ATTRIBUTION), F.lit(1))
    return F.filter(F.transform(labels, lambda x: F.trim(F.split(x, r"\s+-\s+|,\s+|\s+via\s+")[0])), lambda x: x != "")


def omitted_sources(source: Column, output: Column) -> Column:
    """Sources that the output names less often than the round-up."""
    named, out = attributions(source), F.coalesce(output, F.lit(""))
    times = lambda x: (F.length(out) - F.length(F.replace(out, x, F.lit("")))) / F.length(x)
    return F.filter(F.array_distinct(named), lambda x: times(x) < F.size(F.filter(named, lambda y: y == x)))


#: Words before a surname that make no name.
NAME_STOP = ["a", "after", "an", "and", "as", "at", "before", "breaking", "but", "by", "can", "could", "deal", "exclusive", "for", "from", "had", "has", "have", "he", "her", "his", "how", "if", "in", "is", "it", "its", "latest", "new", "news", "not", "now", "of", "official", "on", "over", "report", "she", "that", "the", "their", "they", "this", "to", "under", "was", "we", "were", "what", "when", "where", "who", "why", "will", "with", "would", "you"]


def has_name(text: Column, surname: str) -> Column:
    """A capitalised word that is no stop word stands before the surname."""
    before = F.regexp_extract_all(X.strip_marks(F.coalesce(text, F.lit(""))), F.lit(rf"\b([A-Z][a-z]+)[\s-]+\Q{surname}\E\b"), F.lit(1))
    return F.exists(before, lambda w: ~F.lower(w).isin(NAME_STOP))


def title_mistranslation(title: Column, original: Column, names: dict[str, str], source: Column, loan: str = "임대") -> Column:
    """Why a translated title doesn't fit: names (translated to original) all gone, or a loan from nowhere."""
    folded, context = X.fold_latin(F.coalesce(original, F.lit(""))), F.concat_ws(" ", original, source)
    lost, held = [], F.lit(False)
    for surname in dict.fromkeys(names.values()):
        own = [k for k, v in names.items() if v == surname]
        named = folded.rlike(rf"\b\Q{surname.lower()}\E\b") & has_name(context, surname)
        kept = F.exists(F.array(*[F.lit(k) for k in own]), lambda k: F.contains(title, k))
        held = held | (named & kept)
        lost.append(F.when(named & ~kept, F.lit(f"name:{surname}")))
    gone = F.filter(F.array(*lost), lambda r: r.isNotNull()) if lost else F.array().cast("array<string>")
    borrowed = F.contains(title, F.lit(loan)) & ~F.contains(original, F.lit(loan)) & ~original.rlike(r"(?i)\bloan")
    reasons = F.concat(F.when(held, F.array().cast("array<string>")).otherwise(gone), F.when(borrowed, F.array(F.lit("loan"))).otherwise(F.array().cast("array<string>")))
    return F.when(F.coalesce(title, F.lit("")).eqNullSafe("") | F.coalesce(original, F.lit("")).eqNullSafe(""), F.array().cast("array<string>")).otherwise(reasons)


def unfounded_names(title: Column, source: Column, names: dict[str, str]) -> Column:
    """Names of a translated title that the source has in neither form."""
    folded = X.fold_latin(F.coalesce(source, F.lit("")))
    parts = [F.when(F.contains(title, F.lit(own)) & ~F.contains(folded, F.lit(latin.lower())) & ~F.contains(F.coalesce(source, F.lit("")), F.lit(own)), F.lit(own)) for own, latin in names.items()]
    return F.filter(F.array(*parts), lambda r: r.isNotNull())


def ko_present(text: Column, name: Column | str) -> Column:
    """The name stands in the text without a Hangul syllable right before it."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.regexp_like(text, F.concat(F.lit(r"(?:^|[^가-힣])\Q"), name, F.lit(r"\E")))


def injected(output: Column, source: Column, names: dict[str, list[str]], synonyms: bool = True) -> Column:
    """Names of the output for which the source has neither the name nor an alias as a word.

    synonyms: another name with the same aliases will do, as of a club; people's don't.
    """
    source = F.coalesce(source, F.lit(""))
    folded = X.fold_latin(source)
    found = []
    for name, aliases in names.items():
        same = [k for k, v in names.items() if set(v) == set(aliases)] if synonyms else [name]
        grounded = F.lit(False)
        for k in same:
            grounded = grounded | ko_present(source, k)
        for alias in aliases:
            grounded = grounded | F.regexp_like(folded, F.concat(F.lit(r"\b\Q"), X.fold_latin(F.lit(alias)), F.lit(r"\E\b")))
        found.append(F.when(ko_present(output, name) & ~grounded, F.lit(name)))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


#: Polite sentence endings, and quotes, in which they are right.
_POLITE = r"((?<!아)니다|해요|예요|에요|세요|네요|군요|는데요|어요|아요|지요|죠)\s*$"
_QUOTED = r"""\"[^\"]*\"|“[^”]*”|「[^」]*」|『[^』]*』|'[^']*'"""


def has_polite_ending(text: Column) -> Column:
    """A sentence outside quotes ends politely."""
    return F.exists(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), _QUOTED, ""), r"[.!?…\n]+"), lambda s: F.trim(s).rlike(_POLITE))


def roster_surnames(names: list[str], least: int = 3) -> list[str]:
    """Last words, of `least` letters at least, of names of two words or more."""
    last = [n.split()[-1] for n in names if n and len(n.split()) > 1]
    return sorted({n for n in last if len(n) >= least})


def serving_kept(title: Column, title_ko: Column, body: Column, linked: Column, terms: list[str], names: list[str]) -> Column:
    """A community item stays if either title, its body, a surname or a link to a player speaks for it."""
    both = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(title_ko, F.lit("")))
    surnames = roster_surnames(names)
    kept = is_relevant(title, body, terms, names) | is_relevant(title_ko, F.lit(""), terms, names) | F.coalesce(linked, F.lit(False))
    return kept | is_relevant(both, F.lit(""), [], surnames) if surnames else kept


#: What an incoming move says in a title's first clause.
INBOUND = ["아스날 이적", "아스날 합류", "아스날행", "아스날로"]


def other_club(title: Column, key: Column, subject: str, clubs: list[str], inbound: list[str] = INBOUND) -> Column:
    """The club from whose side a title speaks; null if it is the subject's own or names none."""
    title = F.coalesce(title, F.lit(""))
    clause = first_clause(title)
    ours = F.startswith(F.ltrim(title), F.lit(subject))
    for sign in inbound:
        ours = ours | F.contains(clause, F.lit(sign))
    return F.when(~ours & (key.isNull() | F.contains(clause, key)), longest_name(clause, clubs))
