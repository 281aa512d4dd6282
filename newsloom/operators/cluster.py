"""Representatives, top stories, ladders and current stages: first rows by total orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import news as N
from newsloom.functions import vocab as V

#: The steps of a ladder as the reader sees them, the last one first.
SHOWN = ["official", "done", "agreed", "talks", "interest", "rumour"]


def lead_rank(stage: str = "stage") -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in V.LEAD_RANK.items() for x in kv])
    return F.coalesce(ranks[F.col(stage)], F.lit(0))


def representatives(rows: DataFrame, cluster: str, row_id: str) -> DataFrame:
    """The best row of each cluster, its size, and whether every member is gossip.

    Order: official first, then not of the lowest tier if any is higher, the subject's rank,
    latest, tier, stage. Rows of one cluster meet sorted; nothing is collected.
    """
    tier = F.coalesce(F.col("tier"), F.lit(99.0))
    per = rows.groupBy(cluster).agg(F.count("*").alias("members"), F.max(tier < 4).alias("low_there"), F.min(F.coalesce(F.col("tier") >= 4, F.lit(False))).alias("gossip"))
    joined = rows.join(per, cluster)
    lowest = F.when(F.col("low_there") & (tier >= 4), 0).otherwise(1)
    key = F.struct(F.when(F.col("tier") == 0, 0).otherwise(1).alias("a"), (-lowest).alias("b"), (-F.col("subject")).alias("c"), (-_micros("published_at")).alias("d"), tier.alias("e"), (-lead_rank()).alias("f"), F.col(row_id).alias("g"))
    best = joined.groupBy(cluster).agg(F.min(key).alias("best"), F.first("members").alias("members"), F.first("gossip").alias("gossip"))
    return best.select(cluster, F.col("best.g").alias(row_id), "members", "gossip")


def _micros(c: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col(c))


def top_stories(rows: DataFrame, event: str, now: str, mains: int = 4) -> DataFrame:
    """Slots 1 (lead) and 2 to mains + 1 (latest first) among recent rows of the top tiers, one an event.

    Recent: TOP_HORIZON_DAYS whole days before now at most. Order: the subject opens the title,
    tier, stage, latest, has an image. rows: doc_id, tier, stage, published_at, subject, image, and the event.
    """
    clock = F.to_timestamp_ntz(F.lit(now))
    days = F.floor(F.timestamp_diff("MICROSECOND", F.col("published_at"), clock) / 86_400_000_000)
    recent = rows.where(F.col("tier").isin(V.TOP_TIERS) & (days <= V.TOP_HORIZON_DAYS))
    first = lambda c: F.when(F.col(c), 0).otherwise(1)
    key = F.struct(first("subject").alias("s"), F.col("tier").alias("t"), (-lead_rank()).alias("r"), (-_micros("published_at")).alias("p"), first("image").alias("i"), F.col("doc_id").alias("doc_id"))
    firsts = recent.groupBy(event).agg(F.min(key).alias("k"))
    few = firsts.orderBy("k").limit(mains + 1)  # a handful of rows from here on
    placed = few.withColumn("place", F.row_number().over(Window.orderBy("k")))
    later = F.row_number().over(Window.partitionBy(F.col("place") > 1).orderBy("k.p", "k.doc_id"))
    return placed.select(F.col("k.doc_id").alias("doc_id"), F.when(F.col("place") == 1, 1).otherwise(1 + later).alias("slot"))


def ladder_key() -> Column:
    """Named in the title first, then the best tier, then the latest."""
    unnamed = (~F.coalesce("named", F.lit(False))).cast("int")
    return F.struct(unnamed.alias("u"), F.coalesce("tier", F.lit(99.0)).alias("t"), (-_micros("extracted_at")).alias("x"), F.col("article_id").alias("article_id"), F.col("line").alias("line"))


def stage_ladder(rows: DataFrame) -> DataFrame:
    """Best link of each player and display group, and the group's size.

    rows: player_id, stage, article_id, line, named (the player's name is in the title), tier,
    extracted_at; without mentions. An article of the player goes before one that only holds them.
    """
    group = F.coalesce(F.create_map(*[F.lit(x) for kv in V.STAGE_GROUP.items() for x in kv])[F.col("stage")], F.col("stage"))
    shown = rows.where(~F.col("stage").isin("collapsed", "other")).withColumn("stage_group", group)
    best = shown.groupBy("player_id", "stage_group").agg(F.min(ladder_key()).alias("k"), F.count("*").alias("n"))
    return best.select("player_id", "stage_group", "k.article_id", "k.line", "n")


def current_stage(rows: DataFrame) -> DataFrame:
    """Official if completed, else the latest terminal stage that the roster backs, else the latest not denied."""
    done, over = F.col("status").isin(V.COMPLETED), F.col("status").isin("link_dropped", "other_club")
    stage = F.col("stage")
    denied = (stage.isin("official", "done") & ~done) | ((stage == "collapsed") & ~over)
    backed = (done & stage.isin("official", "done")) | (over & (stage == "collapsed"))
    turn = F.when(done & (stage == "official"), 0).when(backed, 1).otherwise(2)
    key = F.struct(turn.alias("turn"), (-_micros("extracted_at")).alias("x"), F.col("article_id").alias("a"), F.col("line").alias("l"), stage.alias("stage"))
    return rows.where((stage != "other") & ~denied).groupBy("player_id").agg(F.min(key).alias("k")).select("player_id", "k.stage")


def event_cards(rows: DataFrame, cluster: str, row_id: str) -> DataFrame:
    """A row a cluster: members, representative, ending card and how many other reports each side has.

    rows: cluster, id, tier, stage, published_at, subject and club, the other club from whose
    side a report speaks. The ending is the latest such report in a named stage.
    """
    late = lambda c: F.struct((-_micros("published_at")).alias("p"), F.col(row_id).alias("id"), F.col(c).alias("club"))
    ends = F.col("club").isNotNull() & (lead_rank() >= 1)
    per = rows.groupBy(cluster).agg(F.min(F.when(ends, late("club"))).alias("ending"), F.count_if(F.col("club").isNull()).alias("own"), F.count_if(F.col("club").isNotNull()).alias("other"))
    best = representatives(rows, cluster, row_id)
    clubs = rows.select(F.col(row_id).alias("_id"), F.col("club").isNotNull().alias("_other"))
    joined = best.join(per, cluster).join(clubs, F.col(row_id) == F.col("_id"))
    same = F.col("ending.id").eqNullSafe(F.col(row_id))
    other_gone = F.col("_other").cast("int") + (F.col("ending").isNotNull() & ~same).cast("int")
    return joined.select(cluster, "members", row_id, F.col("ending.id").alias("ending_id"), F.col("ending.club").alias("ending_club"), (F.col("own") - (~F.col("_other")).cast("int")).alias("own_side"), (F.col("other") - other_gone).alias("other_side"))


def player_entries(rows: DataFrame) -> DataFrame:
    """A row a player with links beyond mentions: n, last_day, stages, and the collapsed report that the roster backs.

    rows: player_id, status, article_id, line, stage, role, named, tier, extracted_at.
    """
    own = rows.where("role <> 'mention'")
    backed = (F.col("stage") == "collapsed") & F.col("status").isin("link_dropped", "other_club")
    stages = F.array_join(F.array_sort(F.collect_set("stage")), ",")  # ten at most
    per = own.groupBy("player_id").agg(F.count("*").alias("n"), F.date_format(F.max("extracted_at"), "yyyy-MM-dd").alias("last_day"), stages.alias("stages"), F.min(F.when(backed, ladder_key())).alias("ended"), F.count_if(backed).alias("ended_n"))
    return per.select("player_id", "n", "last_day", "stages", F.col("ended.article_id").alias("ended_article"), F.when(F.col("ended_n") > 0, F.col("ended_n")).alias("ended_n"))


def day_blocks(rows: DataFrame, block: str, row_id: str) -> DataFrame:
    """Blocks by the day of their latest report: blocks and that day's reports without those marked dup, and whether all are.

    rows: block, id, published_at, day, dup (of the latest report counts).
    """
    latest = F.struct((-_micros("published_at")).alias("p"), F.col(row_id).alias("id"), F.col("day").alias("day"), F.col("dup").alias("dup"))
    days = rows.groupBy(block, "day").agg(F.count("*").alias("n"), F.min(latest).alias("first"))  # combined before blocks meet
    per = days.groupBy(block).agg(F.min("first").alias("rep"), F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("by_day"))
    own = per.select(F.col("rep.day").alias("day"), F.col("rep.dup").alias("dup"), F.element_at("by_day", F.col("rep.day")).alias("n"))
    reports = F.sum(F.when(F.col("dup"), 0).otherwise(F.col("n"))).alias("reports")
    return own.groupBy("day").agg(F.count_if(~F.col("dup")).alias("blocks"), reports, F.bool_and("dup").alias("all_dup")).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def player_views(players: DataFrame, links: DataFrame) -> DataFrame:
    """A row a player for the players' pages, those without articles of their own included.

    players: player_id, full_name, surname, status. links: player_id, status, article_id, line,
    stage, role, named, tier, extracted_at. Columns: name, slug (the surname's letters, with the
    id if others share them), n, last_day, stage (the current one), ladder (stage_group,
    article_id, n; in the reader's order), ended_article, ended_n.
    """
    own = links.where("role <> 'mention'")
    slugs = players.select("player_id", "full_name", F.coalesce(F.nullif(N.slug(F.coalesce("surname", F.lit(""))), F.lit("")), F.lit("player")).alias("bare"))
    shared = slugs.groupBy("bare").agg((F.count("*") > 1).alias("shared"))
    base = slugs.join(shared, "bare").select("player_id", F.col("full_name").alias("name"), F.when(F.col("shared"), F.concat_ws("-", "bare", F.col("player_id").cast("string"))).otherwise(F.col("bare")).alias("slug"))
    entries = player_entries(links).drop("stages")
    order = F.create_map(*[F.lit(x) for i, g in enumerate(SHOWN) for x in (g, i)])
    step = F.struct(order[F.col("stage_group")].alias("at"), "stage_group", "article_id", "n")
    ladder = stage_ladder(own).groupBy("player_id").agg(F.array_sort(F.collect_list(step)).alias("steps"))  # six at most
    steps = F.transform("steps", lambda s: F.struct(s["stage_group"], s["article_id"], s["n"]))
    out = base.join(entries, "player_id", "left").join(current_stage(own), "player_id", "left").join(ladder.select("player_id", steps.alias("ladder")), "player_id", "left")
    return out.withColumns({"n": F.coalesce("n", F.lit(0)), "ladder": F.coalesce("ladder", F.array())})
