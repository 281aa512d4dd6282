"""What the reader's sidebar lists: outlets and authors of articles under one name each, and their facets.

Dimensions are tables that are joined, never literals:
sources: source_id, outlet, display_name, label (of all its articles, in place of a name), is_x, tier;
directory: key, name, outlet, place (registered people, by folded name or alias);
outlets: key, name (of outlets, by folded spelling); journalist_tiers, outlet_tiers: key, tier.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators.facets import tier_key

#: The last tier of the first screen, articles that a name needs for it, and outlets whose people are not listed.
FIRST_SCREEN_TIER, FIRST_SCREEN_COUNT = 1.5, 2
NOT_LISTED = ["Goal.com"]
#: Stages that the reader's filter shows as one.
SHOWN_GROUPS = [["official"], ["done"], ["agreed", "medical"], ["negotiating", "personal_terms"], ["interest"], ["rumour"], ["collapsed"]]

_filled = lambda c: F.nullif(c, F.lit(""))


@dataclass
class Dimensions:
    sources: DataFrame
    directory: DataFrame
    outlets: DataFrame
    journalist_tiers: DataFrame
    outlet_tiers: DataFrame


def _names(articles: DataFrame) -> DataFrame:
    """article_id, place, name: the stored journalist (place -1) and the authors of each article."""
    journalist = F.array(F.struct(F.lit(-1).alias("place"), F.trim("journalist").alias("name")))
    authors = F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a, i: F.struct(i.alias("place"), F.trim(a).alias("name")))
    return articles.select("article_id", F.explode(F.concat(journalist, authors)).alias("n")).where("n.name <> ''").select("article_id", "n.place", "n.name")


def spellings(articles: DataFrame, directory: DataFrame) -> DataFrame:
    """key, name: of names that no one in the directory has and that are spelt in several ways, the spelling of most articles, then not in capitals, then least."""
    keyed = _names(articles).select("article_id", "name", X.norm_alias(F.col("name")).alias("key")).join(directory.select("key"), "key", "left_anti")
    counts = keyed.groupBy("key", "name").agg(F.count_distinct("article_id").alias("n"))
    capitals = (F.col("name") == F.upper("name")) & (F.col("name") != F.lower("name"))
    best = F.min(F.struct((-F.col("n")).alias("n"), capitals.alias("capitals"), "name"))
    return counts.groupBy("key").agg(best.alias("best"), F.count("*").alias("spelt")).where("spelt > 1").select("key", F.col("best.name").alias("name"))


def entries(articles: DataFrame, directory: DataFrame) -> DataFrame:
    """name, entry (name, outlet, registered), direct: whom each name of the articles stands for.

    By its key; else, for a byline of several people, the registered one who stands first in it
    as whole words. Candidates have their name's rarest word among the byline's.
    """
    names = _names(articles).select("name").distinct().withColumn("key", X.norm_alias(F.col("name")))
    people = directory.select("key", F.struct("name", "outlet", F.lit(True).alias("registered")).alias("entry"))
    spelt = spellings(articles, directory).select("key", F.struct("name", F.lit(None).cast("string").alias("outlet"), F.lit(False).alias("registered")).alias("entry"))
    direct = names.join(people.unionByName(spelt), "key").select("name", "entry", F.lit(True).alias("direct"))
    word = r"(?U)\w+"
    canonical = directory.groupBy("name").agg(F.min("place").alias("place"), F.min_by("outlet", "place").alias("outlet"))
    canonical = canonical.select(F.lower("name").alias("low"), F.struct("name", "outlet", F.lit(True).alias("registered")).alias("entry"), "place")
    parts = canonical.select("low", F.explode(F.array_distinct(F.regexp_extract_all("low", F.lit(word), F.lit(0)))).alias("word"))
    rare = parts.join(parts.groupBy("word").agg(F.count("*").alias("n")), "word").groupBy("low").agg(F.min_by("word", F.struct("n", "word")).alias("word"))
    canonical = canonical.join(rare, "low")
    rest = names.join(direct, "name", "left_anti").select("name", F.lower("name").alias("byline"))
    words = rest.select("name", "byline", F.explode(F.array_distinct(F.regexp_extract_all("byline", F.lit(word), F.lit(0)))).alias("word"))
    at = F.regexp_instr("byline", F.concat(F.lit(r"(?U)(?<!\w)\Q"), "low", F.lit(r"\E(?!\w)")))
    within = words.join(canonical, "word").withColumn("at", at).where("at > 0").groupBy("name").agg(F.min_by("entry", F.struct("at", "place")).alias("entry"))
    return direct.unionByName(within.select("name", "entry", F.lit(False).alias("direct")))


def shown_outlets(articles: DataFrame, dims: Dimensions) -> DataFrame:
    """articles with `source` (struct of the source's row) and `shown`, the outlet's name for the reader.

    The stored outlet under its name in the outlets; for posts the outlet of the journalist, or
    the outlet that the handle is; else the source's outlet, its name, its id.
    """
    source = dims.sources.select("source_id", F.struct(*[c for c in dims.sources.columns if c != "source_id"]).alias("source"))
    fold = dims.outlets.select("key", F.col("name").alias("folded"))
    handle = F.trim(F.coalesce("journalist", F.lit("")))
    rows = articles.join(source, "source_id", "left").withColumns({"k_outlet": X.norm_alias(F.col("outlet")), "k_person": X.norm_alias(handle), "k_handle": X.norm_alias(F.regexp_replace(handle, "^@+", ""))})
    rows = rows.join(fold.withColumnsRenamed({"key": "k_outlet", "folded": "f_outlet"}), "k_outlet", "left")
    rows = rows.join(dims.directory.select(F.col("key").alias("k_person"), F.col("outlet").alias("f_person")), "k_person", "left")
    rows = rows.join(fold.withColumnsRenamed({"key": "k_handle", "folded": "f_handle"}), "k_handle", "left")
    own = F.when(_filled(F.col("outlet")).isNotNull(), F.coalesce("f_outlet", "outlet"))
    post = F.when(F.coalesce("source.is_x", F.lit(False)), F.coalesce(_filled(F.col("f_person")), "f_handle"))
    shown = F.coalesce(own, post, _filled(F.col("source.outlet")), _filled(F.col("source.display_name")), "source_id", F.lit(""))
    return rows.withColumns({"shown": shown, "own_outlet": own}).select(*articles.columns, "source", "shown", "own_outlet")


def author_views(articles: DataFrame, dims: Dimensions) -> DataFrame:
    """shown_outlets' rows with `views`: of each author once, the first being the article's own, name, label, registered, outlet.

    articles: article_id (unique), source_id, outlet, journalist, authors (array) and others.
    The first is the stored journalist; without one, or if it only joins the authors' names, the
    first author that is known, else the first. A source's label stands alone. An author's outlet is
    that of the directory, then the article's, for others the article's, then the source's.
    """
    found = entries(articles, dims.directory)
    outlet = dims.outlets.select("key", F.col("name").alias("folded"))
    found = found.join(outlet, X.norm_alias(F.col("entry.outlet")) == F.col("key"), "left").select("name", F.when(F.col("entry").isNotNull(), F.struct("entry.name", F.coalesce("folded", "entry.outlet").alias("outlet"), "entry.registered")).alias("entry"), "direct")
    said = _names(articles).join(found, "name", "left")
    lists = said.groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct("place", "name", "entry", "direct"))).alias("said"))
    rows = shown_outlets(articles, dims).join(lists, "article_id", "left")

    authors = F.filter("said", lambda s: s["place"] >= 0)
    journalist = F.try_element_at(F.filter("said", lambda s: s["place"] < 0), F.lit(1))
    known = F.filter(authors, lambda s: F.coalesce(s["direct"], F.lit(False)))
    primary = F.coalesce(F.try_element_at(known, F.lit(1)), F.try_element_at(authors, F.lit(1)))
    label = F.col("source.label")
    is_label = lambda s: F.coalesce(s["name"] == label, F.lit(False))
    joined = ~is_label(journalist) & (F.size(authors) > 0) & ~F.exists(authors, lambda s: s["name"] == journalist["name"])
    first = F.when(journalist.isNull() | joined, primary).otherwise(journalist)

    def view(s: Column) -> Column:
        registered = F.coalesce(s["entry"]["registered"], F.lit(False))
        at = F.when(registered, F.coalesce(_filled(s["entry"]["outlet"]), "own_outlet")).otherwise(F.coalesce(_filled(F.col("own_outlet")), "source.outlet"))
        own = F.coalesce(s["entry"]["name"], s["name"])
        branch = ~registered & F.coalesce(F.startswith(F.lower(own), F.concat(F.lower(_filled(at)), F.lit("."))), F.lit(False))
        name = F.when(branch, at).otherwise(own)
        bare = is_label(s) | F.endswith(name, F.lit(")")) | F.coalesce(name == at, F.lit(False)) | F.coalesce(F.lower(name) == F.lower("source.display_name"), F.lit(False))
        outlet = F.when(~bare, _filled(at))
        return F.struct(name.alias("name"), F.coalesce(F.concat(name, F.lit(" ("), outlet, F.lit(")")), name).alias("label"), registered.alias("registered"), outlet.alias("outlet"))

    listed = F.when(F.col("first").isNull(), F.array()).when(is_label(F.col("first")), F.array("first")).otherwise(F.concat(F.array("first"), F.col("authors_said")))
    rows = rows.withColumns({"first": first, "authors_said": authors})
    views = F.transform(listed, view)
    once = X.let(views, lambda vs: X.let(F.transform(vs, lambda v: v["name"]), lambda names: F.filter(vs, lambda v, i: F.array_position(names, v["name"]) == i + 1)))
    return rows.withColumn("views", F.coalesce(once, F.array())).drop("said", "first", "authors_said")


def placed(counted: DataFrame) -> DataFrame:
    """Facets of outlets and journalists (axis, value, n, tier, solo) with the place on the sidebar, one ordered rule.

    first: the first screen, by tier; joint: only in articles of several; single: one article;
    tier: folded away by tier; unlisted: no tier of the list.
    """
    person = F.col("axis") == "journalist"
    listed = F.col("tier").isin(V.TIERS)
    enough = F.col("n") >= F.when(person, FIRST_SCREEN_COUNT).otherwise(1)
    place = F.when(listed & (F.col("tier") <= FIRST_SCREEN_TIER) & enough, "first").when(person & ~F.col("solo"), "joint").when(person & (F.col("n") == 1), "single").when(listed & (F.col("tier") > FIRST_SCREEN_TIER), "tier").when(F.coalesce(~listed, F.lit(True)), "unlisted")
    return counted.withColumn("place", place)


def sidebar(articles: DataFrame, dims: Dimensions) -> DataFrame:
    """axis, value, label, n, tier, place: every facet of the sidebar.

    articles as for author_views, with position (unique, the order of the articles), team, tier,
    stage, direction, badge (whether a badge of a player stands on it). Axes: total, team, tier,
    outlet, journalist, stage, stage_group, other. Tiers, stages and groups without an article
    count 0. A facet's tier is that which the last article gives it, an author's only where the
    article is theirs. An author's label has the outlet of most articles, then the least.
    """
    rows = author_views(articles, dims)
    tiers = lambda t, key, name: t.select(F.col("key").alias(key), F.col("tier").alias(name))
    head = F.try_element_at("views", F.lit(1))
    rows = rows.withColumns({"k_shown": X.norm_alias(F.col("shown")), "k_said": X.norm_alias(F.coalesce("journalist", F.lit(""))), "k_head": X.norm_alias(head["name"])})
    rows = rows.join(tiers(dims.outlet_tiers, "k_shown", "t_shown"), "k_shown", "left").join(tiers(dims.journalist_tiers, "k_said", "t_said"), "k_said", "left").join(tiers(dims.journalist_tiers, "k_head", "t_head"), "k_head", "left")
    own_tier = F.coalesce(F.when(head["registered"], F.coalesce("t_said", "t_head")), "tier").cast("double")
    outlet_tier = F.coalesce("t_shown", "source.tier").cast("double")
    staged = F.coalesce(F.col("stage").isin(V.DISPLAYABLE), F.lit(False))
    shown = staged & ((F.col("stage") == "collapsed") | F.coalesce(F.col("direction").isin("in", "out"), F.lit(False)))
    none = F.lit(None).cast("string")

    def facet(axis: str, value: Column, given: Column | None = None, outlet: Column = none, solo: Column | None = None, gives: Column | None = None) -> Column:
        at = F.struct("position", (F.lit(None).cast("double") if given is None else given).alias("tier"))
        return F.struct(F.lit(axis).alias("axis"), value.cast("string").alias("value"), (at if gives is None else F.when(gives, at)).alias("at"), outlet.alias("outlet"), (F.lit(False) if solo is None else solo).alias("solo"))

    single = F.array(facet("total", F.lit("")), facet("team", F.coalesce(_filled(F.col("team")), F.lit("arsenal"))), facet("tier", F.when(F.col("tier").isNotNull(), tier_key(F.col("tier")))), facet("outlet", F.col("shown"), outlet_tier), facet("stage", F.when(shown, F.col("stage"))), facet("other", F.when(~staged & ~F.coalesce("badge", F.lit(False)), F.lit("other"))))
    people = F.transform("views", lambda v, i: facet("journalist", v["name"], own_tier, v["outlet"], F.size("views") == 1, i == 0))
    each = rows.select(F.explode(F.concat(single, people)).alias("f")).select("f.*").where("value IS NOT NULL")
    by_outlet = each.groupBy("axis", "value", "outlet").agg(F.count("*").alias("n"), F.max("at").alias("at"), F.bool_or("solo").alias("solo"))
    most = F.min(F.when(F.col("outlet").isNotNull(), F.struct((-F.col("n")).alias("n"), "outlet")))
    whole = by_outlet.groupBy("axis", "value").agg(F.sum("n").alias("n"), F.max("at").alias("at"), F.bool_or("solo").alias("solo"), most.alias("most"))
    whole = whole.select("axis", "value", "n", F.col("at.tier").alias("tier"), "solo", F.col("most.outlet").alias("outlet")).where(~F.coalesce(F.col("outlet").isin(NOT_LISTED), F.lit(False)))
    label = F.coalesce(F.concat("value", F.lit(" ("), "outlet", F.lit(")")), "value")
    lists = placed(whole.where("axis IN ('outlet', 'journalist')")).select("axis", "value", label.alias("label"), "n", tier_key(F.col("tier")).alias("tier"), "place")

    spark = articles.sparkSession
    groups = {s: ",".join(g) for g in SHOWN_GROUPS for s in g}
    fixed = [("tier", tier_key_text(t), "") for t in V.TIERS] + [("stage", s, groups[s]) for s in V.DISPLAYABLE] + [("other", "other", ""), ("total", "", "")]
    shape = spark.createDataFrame(fixed, "axis string, value string, grp string")  # some twenty rows
    plain = whole.where("axis NOT IN ('outlet', 'journalist')").select("axis", "value", "n")
    counted = shape.join(plain, ["axis", "value"], "full_outer").withColumn("n", F.coalesce("n", F.lit(0)))
    grouped = counted.where("grp <> ''").groupBy(F.col("grp").alias("value")).agg(F.sum("n").alias("n")).select(F.lit("stage_group").alias("axis"), "value", "n")
    rest = counted.where("axis <> 'tier' OR grp IS NOT NULL").select("axis", "value", "n").unionByName(grouped)
    return lists.unionByName(rest.select("axis", "value", F.col("value").alias("label"), "n", F.lit("").alias("tier"), F.lit(None).cast("string").alias("place")))


def tier_key_text(tier: float) -> str:
    return f"{tier:g}"
