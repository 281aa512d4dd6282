import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import people as P

PAIRS = "article_id string, seq long, pairs array<struct<full_name:string,ko:string,stage:string,role:string>>"
ROSTER = "player_id long, full_name string, surname string"


def in_turn(articles, roster):
    """Row by row: {(article, place): (player or candidate, how)}."""
    players = [(i, f.lower(), s.lower()) for i, f, s in roster]
    out = {}
    for article, _, pairs in sorted(articles, key=lambda a: a[1]):
        by_full = {}
        for who, full, _ in players:
            by_full.setdefault(full, who)
        surnames = {}
        for who, _, surname in players:
            surnames.setdefault(surname, []).append(who)
        for at, (name, *_) in enumerate(pairs):
            tokens, folded, how = name.split(), name.lower(), "full"
            who = by_full.get(folded)
            if who is None and len(tokens) == 1 and len(surnames.get(folded, [])) == 1:
                who, how = surnames[folded][0], "surname"
            elif who is None and len(tokens[-1]) > P.LONGEST_SURNAME:
                how = "long"
            elif who is None:
                who, how = folded, "candidate"
                by_full[folded] = who
                players.append((who, folded, tokens[-1].lower()))
            elif isinstance(who, str):
                how = "known"
            out[article, at] = (who, how)
    return out


def got(articles, roster):
    links, candidates = P.record_people(articles, roster)
    return {(r.article_id, r["at"]): (r.player_id if r.player_id is not None else r.candidate, r.how) for r in links.collect()}, candidates


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_pass_row_by_row(spark, seed):
    rng = random.Random(seed)
    first, last = ["Al", "Bo", "Cy", "Di"], ["White", "Silva", "Ray", "x" * 51, "Odd"][: 3 + seed]
    name = lambda: rng.choice([lambda: rng.choice(last), lambda: rng.choice(first) + " " + rng.choice(last), lambda: rng.choice(first), lambda: f"{rng.choice(first)} van {rng.choice(last)}"])()
    roster = [(i, n, rng.choice([n.split()[-1], n.split()[0]])) for i, n in enumerate(sorted({name() for _ in range(rng.randint(0, 5))}))]
    articles = []
    for k, seq in enumerate(rng.sample(range(500), 40)):
        names = list({n.lower(): n for n in (name() for _ in range(rng.randint(0, 4)))}.values())
        articles.append((f"a{k}", seq, [(n, None, "done", None) for n in names]))
    found, candidates = got(spark.createDataFrame(articles, PAIRS).repartition(3), spark.createDataFrame(roster, ROSTER))
    want = in_turn(articles, roster)
    assert found == want
    assert sorted(r.candidate for r in candidates.collect()) == sorted(w for w, how in want.values() if how == "candidate")


def test_table_equals_a_pass_row_by_row(spark):
    from newsloom.plans import people as Q

    sf = "/root/testdata/sf0.01"
    pairs = Q._pairs(spark, sf)
    roster = Q._roster(pairs)
    articles = [(r.article_id, r.seq, [tuple(p) for p in r.pairs]) for r in pairs.collect()]
    found, _ = got(pairs, roster)
    want = in_turn(articles, sorted(tuple(r) for r in roster.collect()))
    assert found == want and {how for _, how in want.values()} == {"full", "surname", "candidate", "known"}


def test_a_name_of_a_namesake_is_not_linked(spark):
    roster = spark.createDataFrame([(1, "Ben White", "White")], ROSTER)
    pair = lambda n: (n, None, "done", None)
    articles = [("a", 1, [pair("white")]), ("b", 2, [pair("Harvey White"), pair("White")]), ("c", 3, [pair("White")]), ("d", 4, [pair("WHITE"), pair("harvey white")])]
    found, candidates = got(spark.createDataFrame(articles, PAIRS), roster)
    assert found == {("a", 0): (1, "surname"), ("b", 0): ("harvey white", "candidate"), ("b", 1): (1, "surname"), ("c", 0): ("white", "candidate"), ("d", 0): ("white", "known"), ("d", 1): ("harvey white", "known")}
    assert {(r.candidate, r.first_name, r.surname, r.first_seen) for r in candidates.collect()} == {("harvey white", "Harvey", "White", "b"), ("white", None, "White", "c")}


def test_pairs_are_checked(spark):
    names = ["Gyökeres", " gyokeres ", "", None, "사카", "y" * 101, "Ødegaard", "Saka", "Rice"]
    raw = F.array(*[F.struct(F.lit(n).cast("string").alias("full_name"), F.lit(k).cast("string").alias("ko"), F.lit(s).cast("string").alias("stage"), F.lit(r).cast("string").alias("role")) for n, k, s, r in zip(names, ["요케레스", "x"] + [" "] * 4 + ["z" * 51, "오타", None], ["agreed"] * 6 + ["official", "nonsense", "done"], [" Subject ", None, None, None, None, None, "MENTION", "x", None], strict=True)])
    check = lambda official, by_title: [tuple(p) for p in spark.range(1).select(P.normal_pairs(raw, F.lit(official), F.lit(by_title), [("오타", "사카")]).alias("p")).first().p]
    assert check(False, False) == [("Gyökeres", "요케레스", "agreed", "subject"), ("Ødegaard", None, "done", "mention"), ("Saka", "사카", "other", None), ("Rice", None, "done", None)]
    assert [p[2] for p in check(True, False)] == ["official"] * 4
    assert [p[2] for p in check(False, True)] == ["agreed", "official", "other", "official"]
    assert spark.range(1).select(P.normal_pairs(F.lit(None).cast("array<struct<full_name:string,ko:string,stage:string,role:string>>"), F.lit(False), F.lit(False)).alias("p")).first().p == []
    many = F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.struct(F.concat(F.lit("N"), i).alias("full_name"), F.lit("").alias("ko"), F.lit("done").alias("stage"), F.lit("").alias("role")))
    assert len(spark.range(1).select(P.normal_pairs(many, F.lit(False), F.lit(False)).alias("p")).first().p) == P.MOST_PAIRS


def test_name_keys(spark):
    forms = F.struct(F.lit("Gabriel Jesus").alias("full_name"), F.lit("Jesus").alias("surname"), F.lit("제수스").alias("ko_name"), F.lit("가브리엘 제수스").alias("ko_full_name"))
    own, latin = P.name_keys(F.lit("가브리엘 제주스"), F.lit("G. Jesús"), forms)
    r = spark.range(1).select(own.alias("own"), latin.alias("latin")).first()
    assert r.own == ["가브리엘제주스", "제주스", "제수스", "가브리엘제수스"] and r.latin == ["g. jesus", "jesus", "gabriel jesus"]
    none = F.lit(None).cast("struct<full_name:string,surname:string,ko_name:string,ko_full_name:string>")
    own, latin = P.name_keys(F.lit("손"), F.lit("Son"), none)
    assert spark.range(1).select(own.alias("own"), latin.alias("latin")).first()[:] == ([], [])


def test_links_keep_the_last_pair(spark):
    roster = spark.createDataFrame([(1, "Bukayo Saka", "Saka")], ROSTER)
    articles = [("a", 1, [("Bukayo Saka", None, "agreed", "subject"), ("Saka", None, "done", "mention")])]
    links, _ = P.record_people(spark.createDataFrame(articles, PAIRS), roster)
    assert [tuple(r) for r in P.article_links(links).collect()] == [("a", 1, None, "done", "mention")]
    none, made = P.record_people(spark.createDataFrame([], PAIRS), roster)
    assert none.count() == made.count() == 0


def test_articles_are_read_once(spark, tmp_path):
    pair = "struct<full_name:string,ko:string,stage:string,role:string>"
    rows = [(1, 1, [("Ann Lee", None, "other", None)]), (2, 2, [("Lee", None, "other", None), ("Bo Ray", None, "other", None)])]
    spark.createDataFrame(rows, f"article_id long, seq long, pairs array<{pair}>").write.parquet(f"{tmp_path}/a")
    roster = spark.createDataFrame([(7, "Bo Ray", "Ray")], "player_id long, full_name string, surname string")
    links, candidates = P.record_people(spark.read.parquet(f"{tmp_path}/a"), roster)
    for found in (links, candidates, P.article_links(links)):
        assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.seq, r.at, r.player_id, r.candidate, r.how) for r in links.collect()) == [(1, 0, None, "ann lee", "candidate"), (2, 0, None, "ann lee", "surname"), (2, 1, 7, None, "full")]
