"""Items, tiers, events, players, reader rules, gates and repair targets: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import items as I
from newsloom.functions import news as N
from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators import cluster as C
from newsloom.operators import facets as A
from newsloom.operators import gates as G
from newsloom.operators import ordered as O
from newsloom.operators import repairs as RP
from newsloom.operators import resolve as R
from newsloom.operators import state as S
from newsloom.plans.bridge import ARTICLES, LINKS, NAMED_LINKS, NOW, PLAYERS, articles, labelled_articles, links, named_links, players, registrar, seconds, table, with_
from newsloom.plans.marts import arrivals
from newsloom.plans.reading import _GRAMS, _NUMBERS, TURNS, turns
from newsloom.plans.resolving import _GROUP, _RANK
from newsloom.plans.serving import NAMES, _pos
from newsloom.plans.serving import TURNS as TURN_WORDS

Q, SQL, query = registrar()
_in = lambda xs: ", ".join(f"'{x}'" for x in xs)
_word = lambda i: F.coalesce(F.try_element_at(F.split("title", " "), F.lit(i)), F.lit(""))
_when = lambda condition, value: F.when(F.expr(condition), value)

_SPLIT = r"'\s*(?:,|&|\band\b)\s*'"
_PARTS = rf"list_filter(list_transform(regexp_split_to_array(w1 || ',' || w2 || ' and ' || w3, {_SPLIT}), lambda n: trim(n)), lambda n: n <> '' AND NOT regexp_matches(n, '^https?://'))"


@query(
    with_(ARTICLES, f"w AS (SELECT *, split_part(title, ' ', 1) AS w1, split_part(title, ' ', 2) AS w2, split_part(title, ' ', 3) AS w3 FROM articles)", f"p AS (SELECT *, {_PARTS} AS parts FROM w)")  # noqa: F541
    + f"""SELECT doc_id, coalesce(CASE WHEN doc_id % 4 = 0 THEN body_level END, CASE WHEN coalesce(text, '') <> '' THEN 2 ELSE 0 END)::INTEGER AS level,
  strftime(CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN fetched_at ELSE published_at END, '%Y-%m-%d %H:%M') AS published,
  coalesce(CASE WHEN doc_id % 5 = 0 THEN source END, CASE WHEN source_no = 3 THEN 'Desk' END, CASE WHEN lower(regexp_replace(w1, '\\s+', '', 'g')) IN ({_in(NAMES)}) THEN w1 WHEN lower(regexp_replace(w2 || ' and ' || w3, '\\s+', '', 'g')) IN ({_in(NAMES)}) THEN w2 || ' and ' || w3 ELSE w1 END) AS journalist,
  array_to_string(list_filter(parts, lambda n, i: list_position(parts, n) = i), '|') AS authors FROM p"""
)
def item_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Level, publish time, journalist and authors of items whose authors are the title's first words."""
    authors = F.array(_word(1), F.concat(_word(2), F.lit(" and "), _word(3)))
    said = F.when(F.expr("doc_id % 7 = 0"), F.timestamp_add("HOUR", F.lit(2), F.col("fetched_at"))).when(F.expr("doc_id % 11 <> 0"), F.col("published_at"))
    journalist = I.select_journalist(_when("doc_id % 5 = 0", F.col("source")), _when("source_no = 3", "Desk"), authors, NAMES)
    return articles(spark, sf).select("doc_id", I.body_level(_when("doc_id % 4 = 0", F.col("body_level")), F.col("text")).alias("level"), F.date_format(I.published_or_fetched(said, F.col("fetched_at")), "yyyy-MM-dd HH:mm").alias("published"), journalist.alias("journalist"), F.array_join(I.select_authors(authors, journalist), "|").alias("authors"))


@query(
    with_(ARTICLES, "k AS (SELECT doc_id, tier, title, title_ko, CASE WHEN doc_id % 9 <> 0 THEN published_at END AS p, fetched_at AS f, CASE doc_id % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'time' END AS pr FROM articles)", "d AS (SELECT *, p + INTERVAL 9 HOUR AS kp, coalesce(p, f) + INTERVAL 9 HOUR AS kt FROM k)")
    + f"""SELECT doc_id, regexp_replace(CAST(tier AS VARCHAR), '\\.0$', '') AS tier_key, CASE WHEN pr = 'day' THEN '' ELSE strftime(kt, '%H:%M') END AS time_label,
  coalesce(CASE WHEN pr = 'time' THEN strftime(kp, '%Y-%m-%d %H:%M') ELSE strftime(kp, '%Y-%m-%d') END, '') AS published_label,
  CASE WHEN year(kt) = 2024 THEN '' ELSE year(kt) || '년 ' END || month(kt) || '월 ' || day(kt) || '일' AS day_only,
  CASE date_diff('day', CAST(kt AS DATE), CAST(TIMESTAMP '{NOW}' + INTERVAL 9 HOUR AS DATE)) WHEN 0 THEN '오늘' WHEN 1 THEN '어제' ELSE month(kt) || '월 ' || day(kt) || '일 (' || substring('월화수목금토일', isodow(kt)::INTEGER, 1) || ')' END AS gossip_when,
  coalesce(title_ko, '') = '' AND coalesce(title, '') <> '' AS pending FROM d"""
)
def date_columns(spark: SparkSession, sf: str) -> DataFrame:
    a = labelled_articles(spark, sf)
    published, precision = _when("doc_id % 9 <> 0", F.col("published_at")), F.when(F.expr("doc_id % 4 = 0"), "day").when(F.expr("doc_id % 4 = 1"), "time")
    day = I.in_kst(F.coalesce(published, F.col("fetched_at"))).cast("date")
    today = I.in_kst(F.to_timestamp_ntz(F.lit(NOW))).cast("date")
    pending = (F.coalesce("title_ko", F.lit("")) == "") & (F.coalesce("title", F.lit("")) != "")
    return a.select("doc_id", A.tier_key(F.col("tier")).alias("tier_key"), I.time_in_group(published, F.col("fetched_at"), precision).alias("time_label"), I.published_label(published, precision).alias("published_label"), I.day_only(day, today).alias("day_only"), X.day_label(day, today).alias("gossip_when"), pending.alias("pending"))


@query(
    """WITH t AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN strftime(d, '%Y-%m-%dT%H:%M:%S') || '+09:00' WHEN 1 THEN strftime(d, '%Y-%m-%d') WHEN 2 THEN strftime(d, '%-d %b %Y') WHEN 3 THEN strftime(d, '%Y-%m-%d %H:%M:%S') ELSE 'soon' END AS raw, d FROM (SELECT doc_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id * 37) AS d FROM documents))
SELECT doc_id, CASE WHEN doc_id % 5 <> 4 THEN strftime(CASE doc_id % 5 WHEN 0 THEN d - INTERVAL 9 HOUR WHEN 3 THEN d ELSE date_trunc('day', d) END, '%Y-%m-%d %H:%M:%S') END AS at, CASE doc_id % 5 WHEN 0 THEN 'time' WHEN 3 THEN 'time' WHEN 4 THEN NULL ELSE 'day' END AS precision FROM t"""
)
def parsed_dates(spark: SparkSession, sf: str) -> DataFrame:
    d = F.timestamp_add("MINUTE", F.col("doc_id") * 37, F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    shape = lambda f: F.date_format(d, f)
    kind = F.col("doc_id") % 5
    raw = F.when(kind == 0, F.concat(shape("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))).when(kind == 1, shape("yyyy-MM-dd")).when(kind == 2, shape("d MMM yyyy")).when(kind == 3, shape("yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    return table(spark, sf, "documents").select("doc_id", I.parsed_date(raw).alias("p")).select("doc_id", F.date_format("p.at", "yyyy-MM-dd HH:mm:ss").alias("at"), "p.precision")


JOURNALISTS = [{"name": "Src One", "aliases": ["@src1", "ther ing"], "tier": 1.0, "outlet": "north"}, {"name": "src2", "aliases": ["@src2"], "tier": 0.5, "outlet": "south"}, {"name": "No Rank", "aliases": ["@src3"], "tier": None, "outlet": "north"}, {"name": "fr", "aliases": ["@FR"], "tier": 2.0, "outlet": None}]
OUTLETS = [{"name": "Source Four", "aliases": ["src 4", "eredin"], "tier": 1.5}, {"name": "Source Five", "aliases": ["src5", "oftheand"], "tier": 3.0}]
_SQUASHED = lambda c: rf"lower(regexp_replace(coalesce({c}, ''), '\s+', '', 'g'))"


@query(
    with_(ARTICLES, f"s AS (SELECT *, {_SQUASHED('title')} AS t, {_SQUASHED('text')} AS b FROM articles)")
    + """SELECT doc_id, (CASE doc_id % 3
  WHEN 0 THEN coalesce(least(CASE source WHEN 'src1' THEN 1.0 WHEN 'src2' THEN 0.5 END, CASE lang WHEN 'fr' THEN 2.0 END), CASE source WHEN 'src4' THEN 1.5 WHEN 'src5' THEN 3.0 END, CASE WHEN doc_id % 2 = 0 THEN 3.5 END)
  WHEN 1 THEN coalesce(least(CASE WHEN contains(t || ' ' || b, 'thering') OR contains(t, 'srcone') OR contains(b, 'srcone') THEN 1.0 END, CASE WHEN contains(t, 'src2') OR contains(b, 'src2') THEN 0.5 END, CASE WHEN contains(t || ' ' || b, '@src1') THEN 1.0 END, CASE WHEN contains(t || ' ' || b, '@fr') OR contains(t || ' ' || b, 'fr') THEN 2.0 END), least(CASE WHEN contains(t, 'eredin') OR contains(t, 'src4') THEN 1.5 END, CASE WHEN contains(t, 'oftheand') OR contains(t, 'src5') THEN 3.0 END), 4.0)
  ELSE CASE WHEN doc_id % 7 = 0 THEN NULL WHEN source = 'src2' AND doc_id % 2 = 0 THEN least(0.5, tier) ELSE tier END END)::DOUBLE AS tier FROM s"""
)
def tier_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """All three modes over one table; a source's journalist is the source itself, of the south in every second item. Some sources have no tier."""
    known = R.registry(JOURNALISTS, OUTLETS)
    c = F.col
    mode = F.when(c("doc_id") % 3 == 0, "x_mentions").when(c("doc_id") % 3 == 1, "fmkorea").otherwise("fixed")
    text = F.concat(F.lit("@"), c("source"), F.lit(" and @"), c("lang"))
    place = F.when(c("doc_id") % 2 == 0, "south").otherwise("north")
    tier = R.resolve_tier(mode, text, c("title"), c("text"), c("source"), F.when(c("doc_id") % 2 == 0, 3.5), F.when(c("doc_id") % 7 != 0, c("tier")), place, c("source"), known)
    return articles(spark, sf).select("doc_id", tier.alias("tier"))


@query(
    with_("d AS (SELECT * FROM (VALUES ('srcone', 'Src One', 'north'), ('@src1', 'Src One', 'north'), ('thering', 'Src One', 'north'), ('src2', 'src2', 'south'), ('@src2', 'src2', 'south'), ('norank', 'No Rank', 'north'), ('@src3', 'No Rank', 'north'), ('fr', 'fr', NULL), ('@fr', 'fr', NULL)) v(key, name, outlet))", ARTICLES)
    + "SELECT doc_id, coalesce(d.name, '@' || source) AS name, outlet, d.key IS NOT NULL AS registered FROM articles LEFT JOIN d ON d.key = '@' || source"
)
def journalist_views(spark: SparkSession, sf: str) -> DataFrame:
    """Names as the directory has them."""
    a = articles(spark, sf).select("doc_id", F.concat(F.lit("@"), F.col("source")).alias("said"))
    known = R.directory(spark, JOURNALISTS)
    return a.join(F.broadcast(known), X.norm_alias(F.col("said")) == F.col("key"), "left").select("doc_id", F.coalesce("name", "said").alias("name"), "outlet", F.col("key").isNotNull().alias("registered"))


_STATE = """WITH RECURSIVE {articles},
a AS (SELECT url, doc_id AS seq, sha256(CASE WHEN doc_id % 3 = 0 THEN trim(regexp_replace(title, '\\s+', ' ', 'g')) ELSE source END || '|' || url) AS h, lang AS s, body_level AS lv, row_number() OVER (PARTITION BY url ORDER BY (doc_id % 10 = 0)::INTEGER DESC, (lang = 'fr')::INTEGER, doc_id) AS n FROM articles),
f AS (SELECT url, seq, n, 'seen' AS decision, 5 AS revision, h, s, lv FROM a WHERE n = 1
UNION ALL SELECT a.url, a.seq, a.n,
  CASE WHEN f.s = a.s THEN CASE WHEN f.h = a.h THEN 'duplicate' ELSE 'changed' END WHEN a.lv > f.lv THEN 'upgrade' ELSE 'blocked' END,
  f.revision + CASE WHEN f.s = a.s THEN CASE WHEN f.h = a.h THEN 0 ELSE 1 END WHEN a.lv > f.lv THEN 1 ELSE 0 END,
  CASE WHEN f.s = a.s OR a.lv > f.lv THEN a.h ELSE f.h END, CASE WHEN f.s <> a.s AND a.lv > f.lv THEN a.s ELSE f.s END,
  CASE WHEN (f.s = a.s AND f.h <> a.h) OR (f.s <> a.s AND a.lv > f.lv) THEN a.lv ELSE f.lv END
  FROM f JOIN a ON a.url = f.url AND a.n = f.n + 1)
SELECT url, seq, decision, revision::INTEGER AS revision FROM f WHERE n > 1""".replace("{articles}", ARTICLES)


@query(_STATE)
def dedup_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """The first article of each url is stored at revision 5, the others arrive, French ones last."""
    a = arrivals(spark, sf)
    stored = a.where("seq % 10 = 0").withColumn("revision", F.lit(5))
    return S.revision_fold(a.where("seq % 10 <> 0"), seen=stored, last_sources=["fr"])


@query(with_(ARTICLES) + "SELECT url, CAST(max(coalesce(CASE WHEN doc_id % 4 = 0 THEN body_level END, CASE WHEN coalesce(text, '') <> '' THEN 2 ELSE 0 END)) AS INTEGER) AS level, count(*) AS rows_seen FROM articles GROUP BY url")
def seen_map(spark: SparkSession, sf: str) -> DataFrame:
    """The stored state by url; rows without a level have that of their body."""
    level = I.body_level(_when("doc_id % 4 = 0", F.col("body_level")), F.col("text"))
    return articles(spark, sf).groupBy("url").agg(F.max(level).alias("level"), F.count("*").alias("rows_seen"))


CLUBS = ["ing", "tion", "der", "eau"]
_PROTAGONIST = f"coalesce(CASE WHEN list_min(list_filter([{', '.join(_pos(w) for w in TURN_WORDS)}], lambda x: x > 0)) IS NOT NULL THEN list_filter(list_sort(list_filter([{', '.join(f"{{'at': {_pos(n)}, 'name': '{n}'}}" for n in NAMES)}], lambda x: x.at > 0)), lambda x: x.at > list_min(list_filter([{', '.join(_pos(w) for w in TURN_WORDS)}], lambda y: y > 0)))[1].name END, list_sort(list_filter([{', '.join(f"{{'at': {_pos(n)}, 'name': '{n}'}}" for n in NAMES)}], lambda x: x.at > 0))[1].name)"
_CLUB = "CASE WHEN NOT starts_with(ltrim(title), 'The') AND NOT contains(clause, 'the') AND (key IS NULL OR contains(clause, key)) THEN CASE " + " ".join(f"WHEN contains(clause, '{c}') THEN '{c}'" for c in sorted(CLUBS, key=lambda n: (-len(n), n))) + " END END"
_REP = f"(tier = 0)::INTEGER DESC, CASE WHEN low_there AND coalesce(tier, 99) >= 4 THEN 0 ELSE 1 END DESC, subject DESC, published_at DESC, coalesce(tier, 99), {_RANK} DESC, doc_id"


@query(
    with_(
        ARTICLES,
        f"k AS (SELECT *, {_PROTAGONIST} AS key, split_part(replace(title, '…', '...'), '...', 1) AS clause FROM articles)",
        f"c AS (SELECT *, coalesce(key, 'doc ' || doc_id) AS cluster, {_CLUB} AS club, CASE WHEN starts_with(ltrim(title), 'The') THEN 3 WHEN contains(text, 'The') THEN 2 ELSE 1 END AS subject FROM k)",
        "m AS (SELECT *, max((coalesce(tier, 99) < 4)::INTEGER) OVER (PARTITION BY cluster) = 1 AS low_there FROM c)",
        f"r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY {_REP}) AS place, CASE WHEN club IS NOT NULL AND {_RANK} >= 1 THEN row_number() OVER (PARTITION BY cluster, club IS NOT NULL AND {_RANK} >= 1 ORDER BY published_at DESC, doc_id) END AS ending FROM m)",
    )
    + """SELECT cluster, count(*) AS members, min(doc_id) FILTER (place = 1) AS doc_id, min(doc_id) FILTER (ending = 1) AS ending_id, min(club) FILTER (ending = 1) AS ending_club,
  count(*) FILTER (place > 1 AND coalesce(ending, 0) <> 1 AND club IS NULL) AS own_side, count(*) FILTER (place > 1 AND coalesce(ending, 0) <> 1 AND club IS NOT NULL) AS other_side FROM r GROUP BY cluster"""
)
def event_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Events by protagonist, unknown ones alone: representative, ending card, and the two sides of related reports."""
    title = F.col("title")
    key = N.protagonist(title, NAMES, TURN_WORDS)
    subject = F.when(F.startswith(F.ltrim("title"), F.lit("The")), 3).when(F.contains("text", F.lit("The")), 2).otherwise(1)
    a = articles(spark, sf).select("doc_id", "tier", "stage", "published_at", subject.alias("subject"), F.coalesce(key, F.concat(F.lit("doc "), F.col("doc_id").cast("string"))).alias("cluster"), N.other_club(title, key, "The", CLUBS, ["the"]).alias("club"))
    return C.event_cards(a, "cluster", "doc_id")


@query(
    with_(LINKS, PLAYERS, NAMED_LINKS, "l AS (SELECT * FROM named_links WHERE role <> 'mention')", "e AS (SELECT player_id, article_id, line, row_number() OVER (PARTITION BY player_id ORDER BY named DESC, coalesce(tier, 99), extracted_at DESC, article_id, line) AS r, count(*) OVER (PARTITION BY player_id) AS k FROM l WHERE stage = 'collapsed' AND status IN ('link_dropped', 'other_club'))")
    + """SELECT player_id, count(*) AS n, strftime(max(extracted_at), '%Y-%m-%d') AS last_day, array_to_string(list_sort(list_distinct(list(stage))), ',') AS stages, any_value(e.article_id) AS ended_article, any_value(e.k) AS ended_n
FROM l LEFT JOIN (SELECT player_id, article_id, k FROM e WHERE r = 1) e USING (player_id) GROUP BY player_id"""
)
def player_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Players with links beyond mentions: how many, the last day, stages, and the collapsed report that the roster backs."""
    return C.player_entries(named_links(spark, sf))


@query(
    with_(
        LINKS, PLAYERS, NAMED_LINKS,
        "own AS (SELECT * FROM named_links WHERE role <> 'mention')",
        f"lad AS (SELECT player_id, grp, article_id, n, row_number() OVER (PARTITION BY player_id ORDER BY list_position(['official', 'done', 'agreed', 'talks', 'interest', 'rumour'], grp)) AS k FROM (SELECT *, row_number() OVER (PARTITION BY player_id, grp ORDER BY named DESC, coalesce(tier, 99), extracted_at DESC, article_id, line) AS r, count(*) OVER (PARTITION BY player_id, grp) AS n FROM (SELECT *, {_GROUP} AS grp FROM own WHERE stage NOT IN ('collapsed', 'other'))) WHERE r = 1)",
        "steps AS (SELECT player_id, string_agg(grp || ':' || article_id || ':' || n, ' ' ORDER BY k) AS ladder FROM lad GROUP BY player_id)",
        "e AS (SELECT player_id, article_id, row_number() OVER (PARTITION BY player_id ORDER BY named DESC, coalesce(tier, 99), extracted_at DESC, article_id, line) AS r, count(*) OVER (PARTITION BY player_id) AS k FROM own WHERE stage = 'collapsed' AND status IN ('link_dropped', 'other_club'))",
        "cur AS (SELECT player_id, stage, row_number() OVER (PARTITION BY player_id ORDER BY CASE WHEN status IN ('in_done', 'out_done', 'loan_in', 'loan_out') AND stage = 'official' THEN 0 WHEN (status IN ('in_done', 'out_done', 'loan_in', 'loan_out') AND stage IN ('official', 'done')) OR (status IN ('link_dropped', 'other_club') AND stage = 'collapsed') THEN 1 ELSE 2 END, extracted_at DESC, article_id, line) AS n FROM own WHERE stage <> 'other' AND NOT (stage IN ('official', 'done') AND status NOT IN ('in_done', 'out_done', 'loan_in', 'loan_out')) AND NOT (stage = 'collapsed' AND status NOT IN ('link_dropped', 'other_club')))",
        "k AS (SELECT player_id, count(*) AS n, strftime(max(extracted_at), '%Y-%m-%d') AS last_day FROM own GROUP BY player_id)",
        "s AS (SELECT player_id, full_name, regexp_replace(lower(surname), '[^a-z0-9]', '', 'g') AS bare, count(*) OVER (PARTITION BY regexp_replace(lower(surname), '[^a-z0-9]', '', 'g')) AS sharing FROM players)",
    )
    + """SELECT s.player_id, full_name AS name, CASE WHEN sharing > 1 THEN bare || '-' || s.player_id ELSE bare END AS slug, coalesce(k.n, 0) AS n, last_day, cur.stage, coalesce(ladder, '') AS ladder, e.article_id AS ended_article, e.k AS ended_n
FROM s LEFT JOIN k USING (player_id) LEFT JOIN steps USING (player_id) LEFT JOIN (SELECT * FROM e WHERE r = 1) e USING (player_id) LEFT JOIN (SELECT * FROM cur WHERE n = 1) cur USING (player_id)"""
)
def player_views(spark: SparkSession, sf: str) -> DataFrame:
    """All players with slug, current stage and ladder, also those that no article is about."""
    v = C.player_views(players(spark, sf), named_links(spark, sf))
    ladder = F.array_join(F.transform("ladder", lambda x: F.concat_ws(":", x["stage_group"], x["article_id"], x["n"])), " ")
    return v.withColumn("ladder", ladder)

@query(
    with_(LINKS, PLAYERS)
    + "SELECT article_id, string_agg(full_name, '|' ORDER BY player_id) AS chips, count(*) AS n FROM (SELECT DISTINCT article_id, player_id, full_name FROM links JOIN players USING (player_id) WHERE role <> 'mention' AND confirmed) GROUP BY article_id"
)
def player_chips(spark: SparkSession, sf: str) -> DataFrame:
    """The players of each article; an article has a few."""
    own = links(spark, sf).where("role <> 'mention'").select("article_id", "player_id").join(players(spark, sf).where("confirmed").select("player_id", "full_name"), "player_id")
    names = F.array_sort(F.collect_set(F.struct("player_id", "full_name")))
    return own.groupBy("article_id").agg(names.alias("p")).select("article_id", F.array_join("p.full_name", "|").alias("chips"), F.size("p").cast("long").alias("n"))


@query(
    with_(PLAYERS, "k AS (SELECT * FROM players WHERE status IN ('in_link', 'in_done', 'out_done') AND surname <> '')")
    + "SELECT surname, max(player_id) AS last_id, min(player_id) AS first_id, count(*) = 1 AS exactly_one, count(*) FILTER (confirmed AND status = 'in_link') AS open_links FROM k GROUP BY surname"
)
def player_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Names of known players: the last holder (name map), the first one (holder), and whether it is the only one."""
    known = players(spark, sf).where("status IN ('in_link', 'in_done', 'out_done') AND surname <> ''")
    return known.groupBy("surname").agg(F.max("player_id").alias("last_id"), F.min("player_id").alias("first_id"), (F.count("*") == 1).alias("exactly_one"), F.count_if(F.expr("confirmed AND status = 'in_link'")).alias("open_links"))


@query(
    with_(ARTICLES)
    + """SELECT doc_id, stage, tier FROM articles WHERE contains(lower(title || ' ' || source), 'e') AND (source IN ('src1', 'src2') OR list_has_any([lang, split_part(title, ' ', 1)], ['de', 'The'])) AND tier IN (1.0, 1.5, 2.0)
  AND CASE WHEN stage = 'other' THEN FALSE ELSE stage IN ('official', 'agreed', 'collapsed', 'rumour') AND (stage = 'collapsed' OR direction IN ('in', 'out')) END
UNION ALL SELECT doc_id, stage, tier FROM articles WHERE source IN ('src3') AND tier IN (0.0, 3.0, 4.0) AND (stage = 'other' OR TRUE)"""
)
def reader_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A search with stages, and one by outlet alone, which opens other items too."""
    a = articles(spark, sf).select("doc_id", "stage", "tier", "direction", F.col("source").alias("outlet"), F.array("lang", _word(1)).alias("journalists"), F.lower(F.concat_ws(" ", "title", "source")).alias("search_text"))
    one = A.reader_match(["src1", "src2"], ["de", "The"], ["1", "1.5", "2"], ["official", "agreed", "collapsed", "rumour"], text=" E ")
    two = A.reader_match(["src3"], tiers=["0", "3", "4"])
    return a.where(one).unionByName(a.where(two)).select("doc_id", "stage", "tier")


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 14")
def reader_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Two presses of seven days each; every day has events."""
    return A.revealed(table(spark, sf, "events").select("event_id", F.col("ts").cast("date").alias("day")), "day", 2).select("event_id")


@query(
    with_(ARTICLES, "e AS (SELECT *, stage IS NULL OR stage = 'other' AS o, stage = 'collapsed' OR direction IN ('in', 'out') AS shown FROM articles)")
    + """SELECT axis, value, count(*) AS n FROM (
  SELECT 'tier' AS axis, regexp_replace(CAST(tier AS VARCHAR), '\\.0$', '') AS value FROM e UNION ALL SELECT 'outlet', source FROM e UNION ALL SELECT 'stage', stage FROM e WHERE NOT o AND shown UNION ALL SELECT 'other', 'other' FROM e WHERE o
  UNION ALL SELECT 'journalist', unnest(list_distinct([lang, split_part(title, ' ', 1)])) FROM e) WHERE value <> '' GROUP BY axis, value"""
)
def source_facets(spark: SparkSession, sf: str) -> DataFrame:
    return A.source_facets(articles(spark, sf).select("tier", F.col("source").alias("outlet"), F.array("lang", _word(1)).alias("journalists"), "stage", "direction"))


ALIASES = {"ing": ["tion", "ent"], "éau": ["tion", "ent"], "the": ["of"], "der": ["Köln"]}
_ground = lambda name: " OR ".join([f"contains(source, '{k}')" for k, v in ALIASES.items() if set(v) == set(ALIASES[name])] + [f"regexp_matches(folded, '(^|[^a-z0-9_]){a}([^a-z0-9_]|$)')" for a in (["koln"] if name == "der" else ALIASES[name])])


@query(
    "WITH t AS (SELECT doc_id, coalesce(substring(text, 1, 60), '') AS output, coalesce(substring(text, 200, 40), '') AS source, strip_accents(lower(coalesce(substring(text, 200, 40), ''))) AS folded FROM documents) SELECT doc_id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN contains(output, '{n}') AND NOT ({_ground(n)}) THEN '{n}' END" for n in ALIASES)
    + "], lambda x: x IS NOT NULL), '|') AS injected FROM t"
)
def injection_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Names of a text's beginning that a later part does not ground."""
    part = lambda a, n: F.coalesce(F.substring("text", a, n), F.lit(""))
    return table(spark, sf, "documents").select("doc_id", F.array_join(N.injected(part(1, 60), part(200, 40), ALIASES), "|").alias("injected"))


@query(
    with_(ARTICLES, """t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN title || '. 합류합니다. 끝' WHEN 1 THEN '"합류합니다." ' || source WHEN 2 THEN source || ' 아니다.' ELSE source || ' 좋네요' END AS said FROM articles)""")
    + r"""SELECT doc_id, len(list_filter(regexp_split_to_array(regexp_replace(said, '"[^"]*"|“[^”]*”|「[^」]*」|『[^』]*』|''[^'']*''', '', 'g'), '[.!?…\n]+'), lambda s: regexp_matches(trim(s), '((^|[^아])니다|해요|예요|에요|세요|네요|군요|는데요|어요|아요|지요|죠)\s*$'))) > 0 AS polite FROM t"""
)
def tone_gate(spark: SparkSession, sf: str) -> DataFrame:
    kind, source = F.col("doc_id") % 4, F.col("source")
    said = F.when(kind == 0, F.concat("title", F.lit(". 합류합니다. 끝"))).when(kind == 1, F.concat(F.lit('"합류합니다." '), source)).when(kind == 2, F.concat(source, F.lit(" 아니다."))).otherwise(F.concat(source, F.lit(" 좋네요")))
    return articles(spark, sf).select("doc_id", N.has_polite_ending(said).alias("polite"))


_VARIANTS = "[x, CAST(x::HUGEINT * 10 AS VARCHAR), CAST(x::HUGEINT * 100 AS VARCHAR), CAST(x::HUGEINT * 1000 AS VARCHAR), CASE WHEN x::HUGEINT % 100 = 0 THEN CAST(x::HUGEINT // 100 AS VARCHAR) END]"
_QUOTES = r"""list_transform(regexp_extract_all(source, '["“]([^"“”]{4,}?)["”]', 1), lambda q: trim(regexp_replace(q, '\s+', ' ', 'g')))"""


@query(
    with_(
        TURNS,
        rf"n AS (SELECT conv_id, turn, list_distinct({_NUMBERS('source')}) AS s, list_distinct({_NUMBERS('output')}) AS o, {_QUOTES} AS quotes, regexp_replace(output, '\s+', ' ', 'g') AS flat, trim(regexp_replace(source, '\s+', ' ', 'g')) AS a, trim(regexp_replace(output, '\s+', ' ', 'g')) AS b FROM t)",
        f"g AS (SELECT *, {_GRAMS('a')} AS ga, {_GRAMS('b')} AS gb FROM n)",
        f"v AS (SELECT conv_id, turn, len(list_filter(s, lambda x: NOT list_has_any({_VARIANTS}, o))) AS missing, len(list_filter(o, lambda x: NOT list_has_any({_VARIANTS}, s))) AS extra, len(list_filter(quotes, lambda q: NOT contains(flat, q))) AS lost, CASE WHEN len(gb) > 0 THEN len(list_intersect(gb, ga)) / len(gb) ELSE 0.0 END AS kept FROM g)",
    )
    + "SELECT conv_id, turn, missing::INTEGER AS missing, extra::INTEGER AS extra, lost::INTEGER AS lost_quotes, missing = 0 AND extra = 0 AND lost = 0 AND kept <= 0.75 AS ok FROM v"
)
def rewrite_gates(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict on each turn as a rewrite of the one before."""
    v = turns(spark, sf).select("conv_id", "turn", N.gate_verdict(F.col("source"), F.col("output")).alias("v"))
    return v.select("conv_id", "turn", F.size("v.missing").alias("missing"), F.size("v.extra").alias("extra"), F.size("v.quotes").alias("lost_quotes"), "v.ok")


@query(
    with_(ARTICLES)
    + r"""SELECT source, count(*) FILTER (title IS NULL OR (regexp_matches(title, '[éàäöüß]') AND NOT regexp_matches(title, '[A-Z]'))) AS author_refetch,
  count(*) FILTER (abs(epoch(fetched_at - published_at)) < 300 AND lang IN ('en', 'de')) AS published_at, count(*) FILTER (coalesce(text, '') = '') AS empty_body,
  count(*) FILTER (title_ko IS NULL) AS body_level, count(*) FILTER (n_chars > 0.75 * 2000) AS retention, count(*) FILTER (body_level = 1 AND title_ko IS NOT NULL) AS rewritten FROM articles GROUP BY source"""
)
def repair_targets(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows each repair would take, by source."""
    gap = F.abs(F.timestamp_diff("SECOND", "published_at", "fetched_at"))
    title = F.col("title")
    flags = {
        "author_refetch": title.isNull() | (title.rlike("[éàäöüß]") & ~title.rlike("[A-Z]")),
        "published_at": (gap < 300) & F.col("lang").isin("en", "de"),
        "empty_body": F.coalesce("text", F.lit("")) == "",
        "body_level": F.col("title_ko").isNull(),
        "retention": F.col("n_chars") > V.RETENTION * 2000,
        "rewritten": (F.col("body_level") == 1) & F.col("title_ko").isNotNull(),
    }
    return labelled_articles(spark, sf).groupBy("source").agg(*[F.count_if(c).alias(name) for name, c in flags.items()])


@query(
    with_(
        TURNS,
        rf"n AS (SELECT conv_id, turn, list_distinct({_NUMBERS('source')}) AS s, list_distinct({_NUMBERS('output')}) AS o, list_distinct({_NUMBERS("source || ' ' || conv_id")}) AS grounds, {_QUOTES} AS quotes, regexp_replace(output, '\s+', ' ', 'g') AS flat, trim(regexp_replace(source, '\s+', ' ', 'g')) AS a, trim(regexp_replace(output, '\s+', ' ', 'g')) AS b FROM t)",
        f"g AS (SELECT *, {_GRAMS('a')} AS ga, {_GRAMS('b')} AS gb FROM n)",
        f"v AS (SELECT conv_id, turn, len(list_filter(s, lambda x: NOT list_has_any({_VARIANTS}, o))) AS missing, len(list_filter(o, lambda x: NOT list_has_any({_VARIANTS}, grounds))) AS extra, len(list_filter(quotes, lambda q: NOT contains(flat, q))) AS lost, CASE WHEN len(gb) > 0 THEN len(list_intersect(gb, ga)) / len(gb) ELSE 0.0 END AS kept FROM g)",
    )
    + "SELECT conv_id, turn, violations::INTEGER AS violations, tried FROM (SELECT *, missing + extra + lost + (kept > 0.75)::INTEGER AS violations, count(*) OVER (PARTITION BY conv_id) AS tried, row_number() OVER (PARTITION BY conv_id ORDER BY missing + extra + lost + (kept > 0.75)::INTEGER, kept, turn) AS n FROM v) WHERE n = 1"
)
def rewrite_best_attempt(spark: SparkSession, sf: str) -> DataFrame:
    """Of a conversation's turns, as rewrites of the ones before, the one with fewest violations; figures may come from the conversation's number, too."""
    told = turns(spark, sf).select("conv_id", "turn", N.gate_verdict(F.col("source"), F.col("output"), F.concat_ws(" ", "source", "conv_id")).alias("verdict"))
    return G.best_attempts(told, "conv_id", "turn").select("conv_id", "turn", "violations", "tried")


@query(
    """WITH r AS (SELECT doc_id % 5 = 0 AS suspect, doc_id % 7 = 0 AS omitted, doc_id % 11 = 0 AS club, doc_id % 2 = 0 AS again FROM documents)
SELECT count(*) FILTER (NOT again AND (suspect OR omitted OR club)) AS queued, count(*) FILTER (again AND suspect) AS adopted, count(*) FILTER (again AND NOT suspect) AS resolved FROM r"""
)
def retranslation_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of translations, some of which are suspect, some tried again."""
    listed = lambda n: F.when(F.col("doc_id") % n == 0, F.array(F.lit("x")))
    again = F.col("doc_id") % 2 == 0
    title = G.final_title(F.lit("title"), listed(5), listed(7), listed(11), again)
    return G.retranslations(table(spark, sf, "documents").select(title.alias("final"), again.alias("again")), "final", "again")


_REPAIRS = "SELECT 'author' AS repair, doc_id, epoch(published_at) * -1 AS age FROM articles WHERE title IS NULL OR (regexp_matches(title, '[éàäöüß]') AND NOT regexp_matches(title, '[A-Z]')) UNION ALL SELECT 'published', doc_id, epoch(published_at) FROM articles WHERE abs(epoch(fetched_at - published_at)) < 300 AND lang IN ('en', 'de') UNION ALL SELECT 'body', doc_id, epoch(published_at) * -1 FROM articles WHERE coalesce(text, '') = '' UNION ALL SELECT 'translation', doc_id, epoch(fetched_at) FROM articles WHERE title_ko IS NULL UNION ALL SELECT 'rewrite', doc_id, epoch(published_at) * -1 FROM articles WHERE body_level = 1 AND n_chars % 100 > 75"


@query(with_(ARTICLES, f"t AS ({_REPAIRS})") + "SELECT repair, doc_id, row_number() OVER (PARTITION BY repair ORDER BY age, doc_id) - 1 AS place FROM t")
def repair_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that each repair takes, in its order."""
    gap = F.abs(F.timestamp_diff("SECOND", "published_at", "fetched_at"))
    title, at, kept = F.col("title"), lambda c: seconds(F.col(c)), F.col("n_chars") % 100 / 100
    repairs = {
        "author": (title.isNull() | (title.rlike("[éàäöüß]") & ~title.rlike("[A-Z]")), -at("published_at")),
        "published": ((gap < 300) & F.col("lang").isin("en", "de"), at("published_at")),
        "body": (F.coalesce("text", F.lit("")) == "", -at("published_at")),
        "translation": (F.col("title_ko").isNull(), at("fetched_at")),
        "rewrite": ((F.col("body_level") == 1) & (kept > V.RETENTION), -at("published_at")),
    }
    return RP.targets(labelled_articles(spark, sf), repairs, "doc_id").select("repair", "doc_id", "place")


_TITLE = "'[' || source || ' - ' || lang || '] ' || title"
_SOUGHT = r"""WITH {articles}, t AS (SELECT doc_id, source AS outlet, trim(regexp_replace({title}, '^\s*\[[^\]]*\]', '')) AS body FROM articles),
w AS (SELECT *, list_filter(regexp_split_to_array(body, '[\s,./·''"()\[\]]+'), lambda x: length(x) >= 2) AS words FROM t),
k AS (SELECT *, coalesce(words[1], '') AS f, coalesce(list_filter(words, lambda x: length(x) = list_max(list_transform(words, lambda y: length(y))))[1], '') AS l FROM w),
c AS (SELECT doc_id, list_filter(['title:' || body, CASE WHEN f <> '' THEN 'title_content:' || outlet || ' ' || f ELSE 'title_content:' END, 'title:' || f, CASE WHEN l <> '' THEN 'title_content:' || outlet || ' ' || l ELSE 'title_content:' END, 'title:' || l], lambda x: NOT ends_with(x, ':') OR length(x) > 14) AS found FROM k)
SELECT doc_id, array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), '|') AS candidates FROM c"""


@query(_SOUGHT.replace("{articles}", ARTICLES).replace("{title}", _TITLE))
def search_candidates(spark: SparkSession, sf: str) -> DataFrame:
    found = I.search_candidates(F.concat(F.lit("["), F.col("source"), F.lit(" - "), F.col("lang"), F.lit("] "), F.col("title")))
    return articles(spark, sf).select("doc_id", F.array_join(F.transform(found, lambda c: F.concat(c["target"], F.lit(":"), c["keyword"])), "|").alias("candidates"))


@query(
    """WITH p AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS paras FROM documents)
SELECT doc_id, array_to_string(CASE WHEN len(paras) = 0 THEN [] WHEN length(paras[1]) >= 300 THEN paras[1:1] ELSE paras[1:2] END, '|') AS excerpt,
  array_to_string(flatten(list_transform(paras, lambda x, i: CASE WHEN i % 2 = 0 AND i // 2 <= 3 THEN [CASE WHEN starts_with(x, '### ') THEN 'h3' WHEN starts_with(x, '> ') THEN 'quote' ELSE 'p' END, 'i' || (i // 2 - 1)] ELSE [CASE WHEN starts_with(x, '### ') THEN 'h3' WHEN starts_with(x, '> ') THEN 'quote' ELSE 'p' END] END)), ',') AS layout FROM p"""
)
def page_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Excerpt and block order of each text's lines, with three images to place."""
    paras = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda p: p != "")
    blocks = I.laid_out(paras, F.array(*[F.lit(f"i{k}") for k in range(3)]))
    names = F.transform(blocks, lambda b: F.when(b["type"] == "img", b["text"]).otherwise(b["type"]))
    return table(spark, sf, "documents").select("doc_id", F.array_join(I.excerpt(paras), "|").alias("excerpt"), F.array_join(names, ",").alias("layout"))


@query(
    with_(ARTICLES, "k AS (SELECT *, CAST(published_at + INTERVAL 9 HOUR AS DATE) AS day FROM articles)", "b AS (SELECT url, max_by(day, {'p': published_at, 'd': -doc_id}) AS day, max_by(doc_id, {'p': published_at, 'd': -doc_id}) % 7 = 0 AS dup FROM k GROUP BY url)")
    + "SELECT strftime(b.day, '%Y-%m-%d') AS day, count(DISTINCT url) FILTER (NOT dup) AS blocks, count(*) FILTER (NOT dup AND k.day = b.day) AS reports, bool_and(dup) AS all_dup FROM b JOIN k USING (url) GROUP BY b.day"
)
def day_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks by the day of their latest report; every seventh stands in the band above and isn't counted."""
    day = I.in_kst(F.col("published_at")).cast("date")
    return C.day_blocks(articles(spark, sf).select("url", "doc_id", "published_at", day.alias("day"), (F.col("doc_id") % 7 == 0).alias("dup")), "url", "doc_id")


@query(
    with_(ARTICLES, "s AS (SELECT doc_id, source, title, coalesce(title_ko, '') AS k, text FROM articles)")
    + f"SELECT doc_id, source FROM s WHERE source <> 'src0' OR contains({_SQUASHED('title')}, 'ingthe') OR contains({_SQUASHED('text')}, 'ingthe') OR contains({_SQUASHED('title')}, 'eauaux') OR contains({_SQUASHED('k')}, 'ingthe') OR contains({_SQUASHED('k')}, 'eauaux') OR contains(lower(regexp_replace(title || ' ' || k, '\\s+', '', 'g')), 'aux') OR doc_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')"
)
def serving_signals(spark: SparkSession, sf: str) -> DataFrame:
    """The community source's items with any of four signals; order lines stand for links to players."""
    linked = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("doc_id")).distinct().withColumn("linked", F.lit(True))
    keep = (F.col("source") != "src0") | N.serving_kept(F.col("title"), F.col("title_ko"), F.col("text"), F.col("linked"), ["ing the"], ["eau aux"])
    return labelled_articles(spark, sf).join(linked, "doc_id", "left").where(keep).select("doc_id", "source")


@query(
    "SELECT article_id, player_id, stage FROM (SELECT l_orderkey AS article_id, l_partkey AS player_id, l_linestatus AS stage, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY (l_linenumber > 2) DESC, l_shipdate DESC, l_linenumber) AS n FROM lineitem) WHERE n = 1"
)
def link_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines beyond the second arrive over the first two."""
    x = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("article_id"), F.col("l_partkey").alias("player_id"), F.col("l_linestatus").alias("stage"), F.struct("l_shipdate", -F.col("l_linenumber")).alias("at"), "l_linenumber")
    return S.newest_links(x.where("l_linenumber <= 2"), x.where("l_linenumber > 2"), ["article_id", "player_id"], "at").select("article_id", "player_id", "stage")


@query(with_(PLAYERS) + "SELECT status, string_agg(surname || '(' || full_name || ')', ', ' ORDER BY player_id) AS roster FROM players WHERE confirmed GROUP BY status")
def confirmed_roster(spark: SparkSession, sf: str) -> DataFrame:
    """One line of names a status, for a prompt; a roster is some hundred players."""
    said = F.array_sort(F.collect_list(F.struct("player_id", F.concat("surname", F.lit("("), "full_name", F.lit(")")).alias("said"))))
    return players(spark, sf).where("confirmed").groupBy("status").agg(said.alias("s")).select("status", F.array_join("s.said", ", ").alias("roster"))


@query(
    with_(ARTICLES, "o AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY published_at DESC, doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM articles)", "b AS (SELECT *, greatest(0, least(i - 2, n - 5)) AS low FROM o)")
    + "SELECT b.doc_id, b.source, o.doc_id AS neighbor_id FROM b JOIN o ON o.source = b.source AND o.i >= b.low AND o.i < b.low + 5 AND o.doc_id <> b.doc_id"
)
def neighbors(spark: SparkSession, sf: str) -> DataFrame:
    """The other articles of the window of five around each one of its source."""
    a = articles(spark, sf).select("doc_id", "source", (-seconds(F.col("published_at"))).alias("age"))
    near = O.neighbours(a, "source", [F.col("age"), F.col("doc_id")])
    return near.select("row.doc_id", "row.source", F.explode("others.doc_id").alias("neighbor_id"))
