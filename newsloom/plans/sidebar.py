"""The sidebar's facets over the given tables: query and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions import vocab as V
from newsloom.operators import reader as R
from newsloom.plans.bridge import ARTICLES, articles, pick, registrar, table, with_

Q, SQL, query = registrar()


def dimensions(spark: SparkSession, sf: str) -> R.Dimensions:
    """Nations as sources and outlets, every third supplier as a registered person under two names."""
    nations, suppliers = table(spark, sf, "nation"), table(spark, sf, "supplier")
    n, k = F.col("n_nationkey"), F.col("s_suppkey")
    sources = nations.select(F.concat(F.lit("src"), n).alias("source_id"), F.when(n % 3 != 0, F.col("n_name")).alias("outlet"), F.concat("n_name", F.lit(" Desk")).alias("display_name"), F.when(n % 7 == 0, "Staff").alias("label"), (n % 5 == 0).alias("is_x"), pick(V.TIERS, n % 6).alias("tier"))
    named = suppliers.join(F.broadcast(nations), n == F.col("s_nationkey")).where(k % 3 == 0)  # 25 nations
    person = F.concat(F.lit("Person "), k)
    directory = named.select(F.explode(F.array(F.lower("s_name"), X.norm_alias(person))).alias("key"), person.alias("name"), F.when(k % 2 == 0, F.initcap("n_name")).alias("outlet"), k.cast("int").alias("place"))
    outlets = nations.select(X.norm_alias(F.col("n_name")).alias("key"), F.col("n_name").alias("name"))
    people_tiers = suppliers.where(k % 6 == 0).select(F.lower("s_name").alias("key"), pick(V.TIERS, k % 5).alias("tier"))
    outlet_tiers = nations.where(n % 2 == 0).select(X.norm_alias(F.col("n_name")).alias("key"), pick(V.TIERS, n % 4).alias("tier"))
    return R.Dimensions(sources, directory, outlets, people_tiers, outlet_tiers)


def bylined(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with journalists and authors: people by number, guests spelt in two ways, joined bylines, labels."""
    d = F.col("doc_id")
    supplier = F.format_string("Supplier#%09d", d % 100)
    guest = F.when(d % 8 == 1, F.concat(F.lit("GUEST G"), d % 30)).otherwise(F.concat(F.lit("Guest G"), d % 30))
    journalist = F.element_at(F.array(F.lit(""), F.lit("Staff"), F.concat(F.lit("Person "), d % 100, F.lit(" and Guest G"), d % 30), F.upper(supplier), supplier, F.lit(None).cast("string")), (d % 6 + 1).cast("int"))
    authors = F.when(d % 4 == 1, F.array(guest)).when(d % 4 == 2, F.array(supplier, guest)).when(d % 4 == 3, F.array(guest, supplier, F.lit("Only Guest")))
    outlet = F.when(d % 5 == 0, F.lower(F.element_at(F.array(*[F.lit(x) for x in ("FRANCE", "SAUDI ARABIA", "PERU")]), (d % 3 + 1).cast("int")))).when(d % 5 == 1, F.concat(F.lit("Indie "), d % 3))
    a = articles(spark, sf)
    return a.select(d.alias("article_id"), d.alias("position"), F.col("source").alias("source_id"), outlet.alias("outlet"), journalist.alias("journalist"), authors.alias("authors"), F.when(d % 9 == 0, "city").alias("team"), "tier", F.when(d % 13 != 0, F.col("stage")).alias("stage"), "direction", (d % 4 == 0).alias("badge"))


_fold = lambda c: rf"lower(regexp_replace({c}, '\s+', '', 'g'))"
_tier = lambda i: f"list_extract([{', '.join(map(str, V.TIERS))}], CAST({i} + 1 AS INTEGER))::DOUBLE"
_in = ", ".join(f"'{s}'" for s in V.DISPLAYABLE)
_key = lambda c: rf"coalesce(regexp_replace(CAST({c} AS VARCHAR), '\.0$', ''), '')"


@query(
    with_(
        ARTICLES,
        f"src AS (SELECT 'src' || n_nationkey AS source_id, CASE WHEN n_nationkey % 3 <> 0 THEN n_name END AS s_outlet, n_name || ' Desk' AS display, CASE WHEN n_nationkey % 7 = 0 THEN 'Staff' END AS label, n_nationkey % 5 = 0 AS is_x, {_tier('n_nationkey % 6')} AS s_tier FROM nation)",
        f"dir AS MATERIALIZED (SELECT unnest([lower(s_name), 'person' || s_suppkey]) AS key, 'Person ' || s_suppkey AS name, CASE WHEN s_suppkey % 2 = 0 THEN array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END AS outlet FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 3 = 0)",
        f"outs AS (SELECT {_fold('n_name')} AS key, n_name AS name FROM nation)",
        f"ptier AS (SELECT lower(s_name) AS key, {_tier('s_suppkey % 5')} AS tier FROM supplier WHERE s_suppkey % 6 = 0)",
        f"otier AS (SELECT {_fold('n_name')} AS key, {_tier('n_nationkey % 4')} AS tier FROM nation WHERE n_nationkey % 2 = 0)",
        """g AS MATERIALIZED (SELECT doc_id AS id, source, tier, direction, CASE WHEN doc_id % 13 <> 0 THEN stage END AS stage, coalesce(CASE WHEN doc_id % 9 = 0 THEN 'city' END, 'arsenal') AS team, doc_id % 4 = 0 AS badge,
  printf('Supplier#%09d', doc_id % 100) AS sup, CASE WHEN doc_id % 8 = 1 THEN 'GUEST G' ELSE 'Guest G' END || doc_id % 30 AS guest, CASE doc_id % 5 WHEN 0 THEN lower(['FRANCE', 'SAUDI ARABIA', 'PERU'][doc_id % 3 + 1]) WHEN 1 THEN 'Indie ' || doc_id % 3 END AS outlet FROM articles)""",
        """b AS MATERIALIZED (SELECT *, CASE id % 6 WHEN 1 THEN 'Staff' WHEN 2 THEN 'Person ' || id % 100 || ' and Guest G' || id % 30 WHEN 3 THEN upper(sup) WHEN 4 THEN sup ELSE '' END AS journalist, CASE id % 4 WHEN 1 THEN [guest] WHEN 2 THEN [sup, guest] WHEN 3 THEN [guest, sup, 'Only Guest'] ELSE [] END AS authors FROM g)""",
        f"o AS MATERIALIZED (SELECT b.*, src.*, coalesce(ou.name, b.outlet) AS own, coalesce(ou.name, b.outlet, CASE WHEN is_x THEN d.outlet END, s_outlet, display, source) AS shown FROM b LEFT JOIN src ON source_id = source LEFT JOIN outs ou ON ou.key = {_fold('b.outlet')} LEFT JOIN dir d ON d.key = {_fold('journalist')})",
        "said AS MATERIALIZED (SELECT id, unnest(list_distinct(list_concat([journalist], authors))) AS name FROM o)",
        f"spelt AS (SELECT key, (min(ROW(-n, name = upper(name), name)))[3] AS name FROM (SELECT {_fold('name')} AS key, name, count(*) AS n FROM said WHERE name <> '' GROUP BY name) WHERE key NOT IN (SELECT key FROM dir) GROUP BY key HAVING count(*) > 1)",
        f"who AS MATERIALIZED (SELECT n.name AS said, coalesce(d.name, p.name, sp.name, n.name) AS name, coalesce(ou.name, d.outlet, p.outlet) AS outlet, d.key IS NOT NULL OR (p.name IS NOT NULL AND sp.key IS NULL) AS registered, d.key IS NOT NULL OR sp.key IS NOT NULL AS direct FROM (SELECT DISTINCT name FROM said WHERE name <> '') n LEFT JOIN dir d ON d.key = {_fold('n.name')} LEFT JOIN spelt sp ON sp.key = {_fold('n.name')} LEFT JOIN (SELECT DISTINCT name, outlet FROM dir) p ON d.key IS NULL AND starts_with(n.name, p.name || ' and ') LEFT JOIN outs ou ON ou.key = {_fold('coalesce(d.outlet, p.outlet)')})",
        "known AS (SELECT id, min(i) AS i FROM (SELECT id, unnest(authors) AS author, generate_subscripts(authors, 1) AS i FROM o) JOIN who ON said = author WHERE direct GROUP BY id)",
        "f AS MATERIALIZED (SELECT o.*, CASE WHEN journalist = '' OR (journalist IS DISTINCT FROM label AND len(authors) > 0 AND NOT list_contains(authors, journalist)) THEN authors[coalesce(k.i, 1)] ELSE journalist END AS head FROM o LEFT JOIN known k USING (id))",
        "l AS (SELECT *, unnest(CASE WHEN head IS NULL THEN [] WHEN head = label THEN [head] ELSE list_concat([head], authors) END) AS one, generate_subscripts(CASE WHEN head IS NULL THEN [] WHEN head = label THEN [head] ELSE list_concat([head], authors) END, 1) AS spot FROM f)",
        "v AS (SELECT l.*, w.name, w.registered, CASE WHEN w.registered THEN coalesce(w.outlet, own) ELSE coalesce(own, s_outlet) END AS place FROM l JOIN who w ON w.said = l.one)",
        "u AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY id) AS size FROM (SELECT *, CASE WHEN one IS NOT DISTINCT FROM label OR name = place OR lower(name) = lower(display) THEN NULL ELSE place END AS at_outlet, row_number() OVER (PARTITION BY id, name ORDER BY spot) AS nth FROM v) WHERE nth = 1)",
        f"ju AS (SELECT u.*, CASE WHEN spot = 1 THEN coalesce(CASE WHEN registered THEN coalesce(p1.tier, p2.tier) END, u.tier) END AS own_tier FROM u LEFT JOIN ptier p1 ON p1.key = {_fold('journalist')} LEFT JOIN ptier p2 ON p2.key = {_fold('name')})",
        "most AS (SELECT name, (min(ROW(-n, at_outlet)))[2] AS outlet FROM (SELECT name, at_outlet, count(*) AS n FROM u WHERE at_outlet IS NOT NULL GROUP BY ALL) GROUP BY name)",
        "j AS (SELECT name AS value, count(*) AS n, bool_or(size = 1) AS solo, (max(CASE WHEN spot = 1 THEN ROW(id, own_tier) END))[2] AS tier FROM ju GROUP BY name)",
        f"ol AS (SELECT shown AS value, count(*) AS n, TRUE AS solo, (max(ROW(id, coalesce(t.tier, s_tier))))[2] AS tier FROM o LEFT JOIN otier t ON t.key = {_fold('shown')} GROUP BY shown)",
        "lists AS (SELECT 'journalist' AS axis, j.value, CASE WHEN m.outlet IS NULL THEN j.value ELSE j.value || ' (' || m.outlet || ')' END AS label, n, tier, solo, 2 AS least FROM j LEFT JOIN most m ON m.name = j.value UNION ALL SELECT 'outlet', value, value, n, tier, solo, 1 FROM ol)",
        f"plain AS (SELECT 'total' AS axis, '' AS value FROM o UNION ALL SELECT 'team', team FROM o UNION ALL SELECT 'tier', {_key('tier')} FROM o UNION ALL SELECT 'stage', stage FROM o WHERE stage IN ({_in}) AND (stage = 'collapsed' OR direction IN ('in', 'out')) UNION ALL SELECT 'other', 'other' FROM o WHERE (stage IS NULL OR stage NOT IN ({_in})) AND NOT badge)",
        f"shape AS (SELECT 'tier' AS axis, unnest([{', '.join(f"'{t:g}'" for t in V.TIERS)}]) AS value UNION ALL SELECT 'stage', unnest([{_in}]) UNION ALL SELECT 'total', '' UNION ALL SELECT 'other', 'other' UNION ALL SELECT DISTINCT 'team', team FROM o)",
        "counted AS (SELECT s.axis, s.value, count(p.axis) AS n FROM shape s LEFT JOIN plain p ON p.axis = s.axis AND p.value = s.value GROUP BY s.axis, s.value)",
        f"grp AS (SELECT * FROM (VALUES {', '.join(f"('{','.join(g)}', '{s}')" for g in R.SHOWN_GROUPS for s in g)}) t(value, stage))",
    )
    + f"""SELECT axis, value, label, n, {_key('tier')} AS tier, CASE WHEN tier <= 1.5 AND n >= least THEN 'first' WHEN axis = 'journalist' AND NOT solo THEN 'joint' WHEN axis = 'journalist' AND n = 1 THEN 'single' WHEN tier IS NOT NULL THEN 'tier' ELSE 'unlisted' END AS place FROM lists
UNION ALL SELECT axis, value, value, n, '', NULL FROM counted UNION ALL SELECT 'stage_group', g.value, g.value, CAST(sum(n) AS BIGINT), '', NULL FROM grp g JOIN counted c ON c.axis = 'stage' AND c.value = g.stage GROUP BY g.value"""
)
def sidebar(spark: SparkSession, sf: str) -> DataFrame:
    """All facets of the sidebar."""
    return R.sidebar(bylined(spark, sf), dimensions(spark, sf))
