"""People that a model finds in articles: checked pairs, and their players or new candidates.

Articles are taken in order. A name is a player by full name, else, if it is one word, by a
surname that exactly one player has by then; else it becomes a candidate, which the rows after
it find. No row is visited in turn: all that a row needs to know of those before it is where
each new full name stands first, and when a surname's first two new names have come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators.lineage import checkpointed

#: Limits of pairs, names and keys.
MOST_PAIRS, LONGEST_NAME, LONGEST_OWN, LONGEST_SURNAME = 30, 100, 50, 50
LEAST_OWN_KEY, LEAST_LATIN_KEY = 2, 4
ROLES = ["subject", "mention"]


def normal_stage(stage: Column) -> Column:
    return F.when(stage.isin(V.STAGES), stage).otherwise("other")


def normal_role(role: Column) -> Column:
    said = F.lower(F.trim(role))
    return F.when(said.isin(ROLES), said)


def normal_pairs(raw: Column, official: Column, by_title: Column, glossary: list[tuple[str, str]] = ()) -> Column:
    """Checked pairs (full_name, ko, stage, role) of an article's raw ones.

    The first MOST_PAIRS are looked at; names that are empty, too long or in the article's own
    script go, of names that fold alike the first stays. official: every stage is official; from
    other sources an official stage counts as done, unless by_title says that the club's own
    page was taken in by its title, where done is official.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))

    def checked(p: Column) -> Column:
        said = normal_stage(p["stage"])
        stage = F.when(official, "official").otherwise(F.when(said == "official", "done").otherwise(said))
        ko = X.glossary_replace(blank(p["ko"]), list(glossary))
        return F.struct(F.trim(p["full_name"]).alias("full_name"), F.when(F.length(ko) <= LONGEST_OWN, ko).alias("ko"), F.when(by_title & (stage == "done"), "official").otherwise(stage).alias("stage"), normal_role(p["role"]).alias("role"))

    named = F.filter(F.slice(raw, 1, MOST_PAIRS), lambda p: p.isNotNull() & blank(p["full_name"]).isNotNull() & (F.length(F.trim(p["full_name"])) <= LONGEST_NAME) & ~p["full_name"].rlike("[가-힣]"))
    found = F.transform(named, checked)
    first = lambda names: F.filter(found, lambda p, i: F.array_position(names, X.fold_latin(p["full_name"])) == i + 1)
    once = X.let(F.transform(found, lambda p: X.fold_latin(p["full_name"])), first)
    return F.coalesce(once, F.array().cast("array<struct<full_name:string,ko:string,stage:string,role:string>>"))


def name_keys(ko: Column, full_name: Column, forms: Column) -> tuple[Column, Column]:
    """(own, latin) keys that an article's texts are searched for: whole names and last words.

    forms: struct(full_name, surname, ko_name, ko_full_name) of the player, or null.
    """
    last = lambda c: F.element_at(F.split(F.trim(c), r"\s+"), -1)
    more = lambda c: F.when(F.trim(c).rlike(r"\s"), last(c))
    own = [ko, more(ko)]
    for form in ("ko_name", "ko_full_name"):
        own += [forms[form], more(forms[form])]
    latin = [full_name, more(full_name), forms["full_name"], forms["surname"]]
    kept = lambda keys, least: F.array_distinct(F.filter(F.array(*keys), lambda k: F.coalesce(F.length(k), F.lit(0)) >= least))
    return kept([F.regexp_replace(k, r"\s+", "") for k in own], LEAST_OWN_KEY), kept([X.fold_latin(F.trim(k)) for k in latin], LEAST_LATIN_KEY)


def record_people(articles: DataFrame, roster: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, candidates) of articles in order of seq.

    articles: article_id, seq (unique, not null), pairs (full_name and others; names that fold
    alike once an article). roster: player_id, full_name, surname. links: article_id, seq, at
    (place of the pair), the pair's columns, player_id or candidate (a folded name), how: full,
    surname, candidate (new with this row), known (a candidate of an earlier row), or long (its
    surname is too long to be listed, so it links nobody). candidates: candidate, full_name,
    first_name, surname, first_seen (article_id), and the pair that it came from.

    Two sums by folded name are joined to the pairs; a name that a third of all pairs hold is one
    row of either, and the join splits its pairs. The pairs are read and folded once, into a checkpoint.
    """
    given = articles.select("article_id", "seq", F.posexplode("pairs").alias("at", "pair"))
    words = F.split(F.trim("pair.full_name"), r"\s+")
    rows = given.select("article_id", "seq", "at", "pair", F.struct("seq", "at").alias("place"), X.fold_latin(F.trim("pair.full_name")).alias("name"), (F.size(words) == 1).alias("single"), F.element_at(words, -1).alias("last"))
    rows = checkpointed(rows.withColumn("short", F.length("last") <= LONGEST_SURNAME))

    full = roster.groupBy(X.fold_latin(F.col("full_name")).alias("name")).agg(F.min("player_id").alias("by_full"))
    surnames = roster.groupBy(X.fold_latin(F.col("surname")).alias("surname")).agg(F.count("*").alias("listed"), F.min("player_id").alias("by_surname"))

    # where each name that no player has stands first
    new = rows.where("short").groupBy("name", "single").agg(F.min("place").alias("first"), F.min_by(X.fold_latin(F.col("last")), "place").alias("surname")).join(full, "name", "left_anti")
    turn = F.row_number().over(Window.partitionBy("surname").orderBy("first.seq", "first.at"))
    two = new.where("NOT single").withColumn("turn", turn).where("turn <= 2")  # the first two of a surname
    came = two.groupBy("surname").agg(F.min(F.when(F.col("turn") == 1, F.col("first.seq"))).alias("one_seq"), F.min(F.when(F.col("turn") == 1, F.col("name"))).alias("one"), F.min(F.when(F.col("turn") == 2, F.col("first.seq"))).alias("two_seq"))
    known = surnames.join(came, "surname", "full_outer")

    # one-word names: what the surname stood for when the article came
    before = lambda c: F.coalesce((F.col(c) < F.col("seq")).cast("int"), F.lit(0))
    holders = F.coalesce("listed", F.lit(0)) + before("one_seq") + before("two_seq")
    joined = rows.join(full, "name", "left").join(known.withColumnRenamed("surname", "key"), F.col("single") & (F.col("name") == F.col("key")), "left").withColumn("holders", holders)
    misses = joined.where("single AND by_full IS NULL AND holders <> 1 AND short").groupBy("name").agg(F.min("place").alias("made"))
    made = new.where("NOT single").select("name", F.col("first").alias("made")).unionByName(misses)

    there = F.coalesce(F.col("made") <= F.col("place"), F.lit(False))
    by_surname = F.col("single") & (F.col("holders") == 1)
    how = F.when(F.col("by_full").isNotNull(), "full").when(there & (F.col("made") == F.col("place")), "candidate").when(there, "known").when(by_surname, "surname").otherwise("long")
    out = joined.join(made, "name", "left").withColumn("how", how)
    listed = F.when(F.col("how") == "full", F.col("by_full")).when((F.col("how") == "surname") & (F.col("listed") == 1), F.col("by_surname"))
    candidate = F.when(F.col("how").isin("candidate", "known"), F.col("name")).when((F.col("how") == "surname") & F.col("by_surname").isNull(), F.col("one"))
    links = out.select("article_id", "seq", "at", "pair", listed.alias("player_id"), candidate.alias("candidate"), "how")
    split = F.split(F.trim("pair.full_name"), r"\s+")
    first_name = F.nullif(F.array_join(F.slice(split, 1, F.size(split) - 1), " "), F.lit(""))
    candidates = links.where("how = 'candidate'").select("candidate", "pair.full_name", F.when(F.length(first_name) <= LONGEST_SURNAME, first_name).alias("first_name"), F.element_at(split, -1).alias("surname"), F.col("article_id").alias("first_seen"), "pair")
    return links, candidates


def article_links(links: DataFrame) -> DataFrame:
    """A row an article and person, as an upsert of the pairs in order leaves it: the last pair's stage and role."""
    who = links.where("player_id IS NOT NULL OR candidate IS NOT NULL")
    last = who.groupBy("article_id", "player_id", "candidate").agg(F.max_by("pair", "at").alias("pair"))
    return last.select("article_id", "player_id", "candidate", "pair.stage", "pair.role")
