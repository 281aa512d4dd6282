"""Credibility tiers, best matches in time, domains and fuzzy names."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.items import is_paywalled


def tier_by_handles(items: DataFrame, handles: Column, registry: DataFrame, fallback: Column) -> DataFrame:
    """Least tier of the registered handles that each item cites, else the fallback.

    items has id. registry: alias, tier; a dimension of some hundred rows.
    """
    cited = items.select("id", F.explode(handles).alias("alias"))
    best = cited.join(F.broadcast(registry), "alias").groupBy("id").agg(F.min("tier").alias("found"))
    return items.join(best, "id", "left").withColumn("tier", F.coalesce("found", fallback)).drop("found")


def tier_by_substring(text: Column, registry: list[tuple[str, float]]) -> Column:
    """Least tier of the names that the squashed text contains. The registry is a short list of literals."""
    return least_tier(X.squashed(text), registry)


def least_tier(squashed: Column, registry: list[tuple[str, float]]) -> Column:
    if not registry:
        return F.lit(None).cast("double")
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("tier")) for n, t in registry])
    return F.array_min(F.transform(F.filter(names, lambda r: F.contains(squashed, r["name"])), lambda r: r["tier"]))


def best_earlier_match(items: DataFrame, originals: DataFrame, window_seconds: int, least: int) -> DataFrame:
    """For each item the original of the same handle, at most a window earlier, with most words in common.

    items: handle, item_id, at (seconds), words. originals: handle, original_id, at, words.
    The window is cut into buckets of its own length, so the join is an equi join on (handle,
    bucket) with each original in two buckets, and a handle's history spreads by time.
    Ties go to the later original, then the smaller id.
    """
    bucket = lambda at: F.floor(at / window_seconds)
    o = originals.withColumnsRenamed({"at": "o_at", "words": "o_words"}).withColumn("bucket", F.explode(F.array(bucket(F.col("o_at")), bucket(F.col("o_at")) + 1)))
    pairs = items.withColumn("bucket", bucket(F.col("at"))).join(o, ["handle", "bucket"]).where("o_at <= at").where(F.col("at") - F.col("o_at") <= window_seconds)
    scored = pairs.withColumn("overlap", F.size(F.array_intersect("words", "o_words"))).where(F.col("overlap") >= least)
    best = Window.partitionBy("item_id").orderBy(F.desc("overlap"), F.desc("o_at"), "original_id")
    return scored.withColumn("n", F.row_number().over(best)).where("n = 1").select("item_id", "original_id", "overlap")


def outlet_by_domain(host: Column, domains: list[tuple[str, str]]) -> Column:
    """First outlet, in the list's order, whose domain is the host or a suffix of it."""
    out = F.lit(None).cast("string")
    for domain, outlet in reversed(domains):
        out = F.when(X.domain_suffix(host, F.lit(domain)), outlet).otherwise(out)
    return out


def _piece_steps(most: int) -> list[tuple[int, int, int]]:
    """(difference of length, piece, shift): where a piece of the shorter name can stand in the longer one.

    Of `most` + 1 pieces one survives any `most` edits, and the edits left and right of it bound its shift.
    """
    steps = []
    for longer in range(most + 1):
        for i in range(most + 1):
            after = most - i
            steps += [(longer, i, shift) for shift in range(max(-i, longer - after), min(i, longer + after) + 1)]
    return steps


def fuzzy_duplicates(names: DataFrame, most: int = 2) -> DataFrame:
    """Pairs of different names with one folded surname and an edit distance of at most `most`.

    names: id, full_name. Equal names meet first; the pairs are between different names. Candidates
    share the surname, which changes no distance, and one of `most` + 1 pieces of what stands before
    it, about where it stood: each name goes to `most` + 1 keys as the shorter and to some
    (`most` + 1)^3 / 2 as the longer, and every candidate is verified. Null names are in no pair.
    """
    kinds = names.where("full_name IS NOT NULL").groupBy("full_name").agg(F.min("id").alias("id"))
    kinds = kinds.withColumn("folded", X.fold_latin(F.col("full_name"))).withColumn("surname", F.element_at(F.split("folded", " "), -1))
    kinds = kinds.withColumn("given", F.substr("folded", F.lit(1), F.length("folded") - F.length("surname"))).withColumn("size", F.length("given"))

    def key(size: Column, piece: Column, shift: Column) -> Column:
        start = F.floor(piece * size / (most + 1)).cast("int")
        end = F.floor((piece + 1) * size / (most + 1)).cast("int")
        at = start + shift
        inside = (size >= 0) & (at >= 0) & (at + end - start <= F.col("size"))
        return F.when(inside, F.xxhash64("surname", size, piece, F.substr("given", at + 1, end - start)))

    steps = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, ("longer", "piece", "shift"), strict=True)]) for s in _piece_steps(most)])
    short = kinds.withColumn("key", F.explode(F.transform(F.sequence(F.lit(0), F.lit(most)), lambda i: key(F.col("size"), i, F.lit(0)))))
    long = kinds.withColumn("key", F.explode(F.array_compact(F.transform(steps, lambda s: key(F.col("size") - s["longer"], s["piece"], s["shift"])))))
    a, b = short.alias("a"), long.alias("b")
    pairs = a.join(b, "key").where((F.col("a.surname") == F.col("b.surname")) & (F.col("a.full_name") != F.col("b.full_name")))
    near = pairs.withColumn("distance", F.levenshtein("a.given", "b.given", most)).where("distance >= 0")
    first = F.col("a.full_name") < F.col("b.full_name")
    side = lambda c, one, other: F.when(first, F.col(f"{one}.{c}")).otherwise(F.col(f"{other}.{c}"))
    found = near.select(side("full_name", "a", "b").alias("name_a"), side("full_name", "b", "a").alias("name_b"), side("id", "a", "b").alias("id_a"), side("id", "b", "a").alias("id_b"), "distance")
    return found.dropDuplicates(["name_a", "name_b"])


def resolve_names(mentions: DataFrame, players: DataFrame) -> DataFrame:
    """Player of each mention: by full name, else by a surname that only one player has, else none.

    mentions: mention_id, name. players: player_id, full_name, surname.
    """
    full = players.groupBy(X.squashed(F.col("full_name")).alias("key")).agg(F.min("player_id").alias("by_full"))
    sur = players.groupBy(X.squashed(F.col("surname")).alias("key")).agg(F.min("player_id").alias("by_surname"), F.count("*").alias("n")).where("n = 1").drop("n")
    keyed = mentions.withColumn("key", X.squashed(F.col("name")))
    single = ~F.contains(F.trim(F.col("name")), F.lit(" "))
    found = keyed.join(full, "key", "left").join(sur, "key", "left")
    player = F.coalesce("by_full", F.when(single, F.col("by_surname")))
    how = F.when(F.col("by_full").isNotNull(), "full").when(single & F.col("by_surname").isNotNull(), "surname").otherwise("candidate")
    return found.select("mention_id", player.alias("player_id"), how.alias("how"))


def round_robin(rows: DataFrame, key: str, order: list[Column], limit: int) -> DataFrame:
    """The first `limit` rows when each key gives one row in turn."""
    turn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    top = rows.withColumn("turn", turn).where(F.col("turn") <= limit)
    return top.orderBy("turn", key).limit(limit)


@dataclass(frozen=True)
class Registry:
    """Tiers by folded name, and the outlets of journalists who have one."""

    journalists: dict[str, float]
    outlets: dict[str, float]
    affiliations: dict[str, str]


def folded_key(name: str) -> str:
    return "".join(name.split()).lower()


def registry(journalists: list[dict], outlets: list[dict]) -> Registry:
    """The lookup of a credibility dimension of some hundred entries: name, aliases, tier, outlet.

    An entry without a tier has no rank. An alias that two ranked entries of a kind share is an
    error; spellings that fold to one key keep the first. Journalists count by name as well.
    """
    tiers: list[dict[str, float]] = []
    for entries in (journalists, outlets):
        ranked = [(alias, e["tier"]) for e in entries if e.get("tier") is not None for alias in e["aliases"]]
        twice = [a for a, n in Counter(a.lower() for a, _ in ranked).items() if n > 1]
        if twice:
            raise ValueError(f"duplicate alias: {twice[0]}")
        found: dict[str, float] = {}
        for alias, tier in ranked:
            found.setdefault(folded_key(alias), float(tier))
        tiers.append(found)
    for e in journalists:
        if e.get("tier") is not None:
            tiers[0].setdefault(folded_key(e["name"]), float(e["tier"]))
    own = {}
    for e in journalists:
        for name in (e["name"], *e["aliases"]) if e.get("outlet") else ():
            own.setdefault(folded_key(name), e["outlet"])
    return Registry(*tiers, own)


def directory(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """key, name, outlet: every name and alias of a dimension, folded; the first entry wins."""
    rows: dict[str, tuple] = {}
    for e in entries:
        for name in (e["name"], *e["aliases"]):
            rows.setdefault(folded_key(name), (e["name"], e.get("outlet")))
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "key string, name string, outlet string")


def _lookup(entries: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in entries.items() for x in kv])[key] if entries else F.lit(None).cast("double")


def resolve_tier(mode: Column, text: Column, title: Column, body: Column, outlet: Column, fallback: Column, tier: Column, source_outlet: Column, journalist: Column, known: Registry) -> Column:
    """Tier of an item by its source's mode; null items are dropped by the caller.

    x_mentions: the least tier of registered handles, else the outlet's, else the fallback.
    fmkorea: the least tier of journalists in title or body, else of outlets in the title, else 4.
    Any other: the source's own, or a registered journalist's if lower and affiliated with the
    source; none for a source without a tier.
    The registry is a dimension of literals, so nothing is joined.
    """
    handles = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(@\w+)"), F.lit(1)), X.squashed)
    cited = F.array_min(F.array_compact(F.transform(handles, lambda h: _lookup(known.journalists, h))))
    mentioned = F.coalesce(cited, _lookup(known.outlets, X.norm_alias(F.coalesce(outlet, F.lit("")))), fallback)
    filled = lambda c: F.coalesce(c, F.lit(""))
    head = X.squashed(filled(title))
    both = F.concat(head, F.lit(" "), X.squashed(filled(body)))  # no name reaches over from the title to the body
    found = F.coalesce(least_tier(both, list(known.journalists.items())), least_tier(head, list(known.outlets.items())), F.lit(4.0))
    key = X.norm_alias(journalist)
    affiliated = _lookup(known.affiliations, key).cast("string") == source_outlet
    fixed = F.when(tier.isNotNull() & affiliated & _lookup(known.journalists, key).isNotNull(), F.least(tier, _lookup(known.journalists, key))).otherwise(tier)
    return F.when(mode == "x_mentions", mentioned).when(mode == "fmkorea", found).otherwise(fixed)


def cited_posts(posts: DataFrame) -> DataFrame:
    """Posts (text) that cite a handle, with handles and the last of them as journalist."""
    found = posts.withColumn("handles", X.cited_handles(F.coalesce("text", F.lit("")))).where(F.size("handles") > 0)
    return found.withColumn("journalist", F.element_at("handles", -1))


def promote(posts: DataFrame, landed: DataFrame, domains: list[tuple[str, str]]) -> DataFrame:
    """Posts whose card leads to a landed page with a body, of a free and registered outlet, as that outlet's articles.

    posts: url, outlet, card, and others. landed: card, final_url, body; a row a card. Whatever is
    missing on the way leaves a post as it is.
    """
    outlet = outlet_by_domain(X.url_host(F.col("final_url")), domains)
    page = landed.where("card IS NOT NULL AND final_url IS NOT NULL AND body <> ''").select("card", F.struct("final_url", "body", outlet.alias("outlet")).alias("page"))
    page = page.where(F.col("page.outlet").isNotNull() & ~is_paywalled(F.col("page.final_url")))
    joined = posts.select(F.struct("*").alias("post")).join(page, F.col("post.card") == page["card"], "left")
    kept = [f"post.{c}" for c in posts.columns if c not in ("url", "outlet")]
    return joined.select(*kept, F.coalesce("page.final_url", "post.url").alias("url"), F.coalesce("page.outlet", "post.outlet").alias("outlet"), F.col("page.body").alias("promoted_body"), F.col("page").isNotNull().alias("promoted"))
