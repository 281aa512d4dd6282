import json
import os
import random

from pyspark.sql import functions as F

from newsloom.functions import adapters as A
from newsloom.functions import html as H
from newsloom.functions import news as N
from newsloom.functions import text as X
from newsloom.operators import cluster as C
from newsloom.operators import monitor as M
from newsloom.operators import resolve as R
from newsloom.operators import state as S
from newsloom.sources import readers
from newsloom.streaming import feeds


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_classify_cases():
    assert S.classify(None, "h", "a", 0) == ("new", ("h", 1, "a", 0))
    seen = ("h", 3, "a", 1)
    assert S.classify(seen, "h", "a", 2) == ("duplicate", seen)
    assert S.classify(seen, "g", "a", 0) == ("changed", ("g", 4, "a", 0))
    assert S.classify(seen, "g", "b", 2) == ("upgrade", ("g", 4, "b", 2))
    assert S.classify(seen, "g", "b", 1) == ("blocked", seen)


def test_canonical_urls(spark):
    cases = {
        "https://X.test/a/?utm_source=x&b=2&a=1#top": "https://x.test/a?a=1&b=2",
        "https://x.test/": "https://x.test",
        "https://x.test/p?fbclid=1&q=": "https://x.test/p",
        " https://x.test/a?z=a%20b ": "https://x.test/a?z=a+b",
    }
    for url, want in cases.items():
        assert one(spark, X.canonical_url(F.lit(url))) == want


def test_numbers(spark):
    assert one(spark, X.missing_numbers(F.lit("paid 50 and 1,200 at https://x.test/99"), F.lit("5000 or 1200"))) == []
    assert one(spark, X.missing_numbers(F.lit("7 of 8"), F.lit("8"))) == ["7"]


def test_quotes_and_retention(spark):
    assert one(spark, X.missing_quotes(F.lit('he said "not for  sale" and "ok"'), F.lit("not for sale"))) == []
    assert one(spark, X.ngram_retention(F.lit("abcdefghij"), F.lit("abcdefghzz"))) == 1 / 3
    assert one(spark, X.ngram_retention(F.lit("abc"), F.lit("abc"))) == 0.0


def test_handles_and_authors(spark):
    assert one(spark, X.cited_handles(F.lit("deal [ @one ] @two: yes"))) == ["@one"]
    assert one(spark, X.cited_handles(F.lit("Name (@two\n): yes"))) == ["@two"]
    assert one(spark, X.split_authors(F.lit("Ann Lee and Bo Ray, Ann Lee & https://x.test"))) == ["Ann Lee", "Bo Ray"]


def test_realert_levels(spark):
    rows = spark.createDataFrame([("a", 48.0, 48.0, True), ("b", 48.5, 48.0, True), ("c", 97.0, 48.0, True)], "source_id string, age_hours double, threshold_hours double, stale boolean")
    before = spark.createDataFrame([("c", 60.0, 48.0), ("b", 48.2, 48.0)], "source_id string, age_hours double, threshold_hours double")
    got = {r.source_id: (r.level, r.send, r.hours_to_next) for r in M.realerts(rows, before).collect()}
    assert got == {"a": (-1, False, 0.0), "b": (0, False, 47.5), "c": (1, True, None)}


def test_best_match_prefers_overlap_then_latest(spark):
    items = spark.createDataFrame([("h", 1, 1000, ["a", "b", "c"])], "handle string, item_id int, at long, words array<string>")
    originals = spark.createDataFrame([("h", 7, 400, ["a", "b"]), ("h", 8, 900, ["a", "b"]), ("h", 9, 1001, ["a", "b", "c"]), ("h", 6, 100, ["a", "b", "c"])], "handle string, original_id int, at long, words array<string>")
    assert [tuple(r) for r in R.best_earlier_match(items, originals, 600, 2).collect()] == [(1, 8, 2)]


def test_upsert_resets_on_change(spark):
    old = spark.createDataFrame([("u", "h1", "t", "done"), ("v", "h2", "t2", None)], "url string, hash string, title_ko string, stage string")
    new = spark.createDataFrame([("u", "h9", None, None), ("w", "h3", None, "new")], "url string, hash string, title_ko string, stage string")
    got = {r.url: tuple(r)[1:] for r in S.upsert(old, new, "url", "hash", [], ["title_ko"], ["stage"]).collect()}
    assert got == {"u": ("h9", None, "done"), "v": ("h2", "t2", None), "w": ("h3", None, "new")}


def test_html():
    page = '<html><head><title>T</title><meta property="og:image" content="i.png"></head><body><nav><p>menu</p></nav><p>One <a href="x">link</a> two.</p><img src="a.png"><img src="b.png" width="50"></body></html>'
    got = H.parse(page)
    assert (got["title"], got["og_image"], got["body"], got["n_images"]) == ("T", "i.png", "One two.", 1)
    assert H.split_paragraphs("a. " * 200)[0].endswith("a.") and max(map(len, H.split_paragraphs("a. " * 500))) <= 400
    assert H.split_paragraphs(None) == []


def test_readers(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>Hi</title><link>https://x.test/1</link><pubDate>now</pubDate><description>d</description></item></channel></rss>")
    (tmp_path / "api.json").write_text(json.dumps({"response": {"results": [{"webTitle": "Big Deal", "webUrl": "https://x.test/2", "fields": {"trailText": "<b>t</b>"}}, {"webTitle": "Other", "webUrl": "https://x.test/3"}]}}))
    (tmp_path / "map.xml").write_text("<urlset><url><loc>https://x.test/news/a</loc><lastmod>2024-01-02T00:00:00Z</lastmod></url><url><loc>https://x.test/news/b</loc><lastmod>2023-01-02T00:00:00Z</lastmod></url><url><loc>https://x.test/shop</loc><lastmod>2024-01-02T00:00:00Z</lastmod></url></urlset>")
    (tmp_path / "list.html").write_text('<a href="/n/1">One</a><a href="/n/1">Again</a><a href="/z">Z</a>')
    config = [
        {"source_id": "r", "adapter": "rss", "path": f"{tmp_path}/feed.xml"},
        {"source_id": "j", "adapter": "json_api", "path": f"{tmp_path}/api.json", "options": {"keywords": ["deal"]}},
        {"source_id": "m", "adapter": "sitemap", "path": f"{tmp_path}/map.xml", "options": {"now": "2024-01-02T12:00:00Z"}},
        {"source_id": "h", "adapter": "html_list", "path": f"{tmp_path}/list.html", "options": {"base_url": "https://x.test", "href": "/n/"}},
        {"source_id": "off", "adapter": "none", "path": "", "enabled": False},
    ]
    got = {(r.source_id, r.url, r.title) for r in readers.read_sources(spark, config).collect()}
    assert got == {("r", "https://x.test/1", "Hi"), ("j", "https://x.test/2", "Big Deal"), ("m", "https://x.test/news/a", None), ("h", "https://x.test/n/1", "One")}


def test_streams_agree_with_batch(spark, tmp_path):
    rows = [{"url": f"u{k % 3}", "seq": k, "content_hash": f"h{k % 5}", "source_id": f"s{k % 2}", "body_level": k % 3, "fetched_at": f"2024-01-0{1 + k // 10}T00:00:00"} for k in range(30)]
    (tmp_path / "landing").mkdir()
    for part in range(3):
        file = tmp_path / "landing" / f"{part}.json"
        file.write_text("\n".join(json.dumps(r) for r in rows[part * 10 : part * 10 + 10]))
        os.utime(file, (1_700_000_000 + 60 * part,) * 2)  # files are taken in the order of their times
    items = feeds.landed(spark, f"{tmp_path}/landing", files=1)

    def collect(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    batch = spark.createDataFrame([(r["url"], r["seq"], r["content_hash"], r["source_id"], r["body_level"]) for r in rows], "url string, seq long, content_hash string, source_id string, body_level int")
    assert sorted(map(tuple, collect(feeds.revisions(items), "revisions"))) == sorted(map(tuple, S.revision_fold(batch, 2).collect()))
    assert sorted(r.content_hash for r in collect(feeds.first_landings(items), "firsts")) == [f"h{k}" for k in range(5)]
    assert sum(r.n for r in collect(feeds.volumes(items), "volumes", "complete")) == 30


def test_payload_columns(spark):
    elements = F.from_json(F.lit('[{"type":"image","assets":[{"file":"a","width":10},{"file":"b","width":90}]},{"type":"video","assets":[{"file":"v","width":1}]},{"type":"image","assets":[{"file":"b","width":5}]}]'), "array<struct<type:string,assets:array<struct<file:string,width:int>>>>")
    assert one(spark, A.element_images(elements)) == ["b"]
    assert one(spark, A.page_id(F.lit("https://x.test/news/big-deal-5aBcDeFgHiJk"))) == "5aBcDeFgHiJk"
    assert one(spark, A.page_id(F.lit("https://x.test/news"))) is None
    tags = lambda *t: F.array(*[F.lit(x) for x in t])
    assert one(spark, A.accept_path(F.lit("News"), tags("Men", "Contract news"), F.lit("x"))) == "tag"
    assert one(spark, A.accept_path(F.lit("News"), tags("Men"), F.lit("He signs on"))) == "title"
    assert one(spark, A.accept_path(F.lit("News"), tags("Women"), F.lit("He signs on"))) is None
    blocks = F.from_json(F.lit('[{"type":"TEXT","innerText":"","html":"<b>Lead</b> in"},{"type":"HEADER"},{"type":"TEXT","innerText":" two "}]'), "array<struct<type:string,innerText:string,html:string>>")
    assert one(spark, A.blocks_body(blocks)) == "Lead in\n\ntwo"
    assert one(spark, A.is_post_host(F.lit("https://mobile.twitter.com/a"))) and not one(spark, A.is_post_host(F.lit("https://notx.com/a")))
    assert one(spark, A.post_url(F.lit("/index.php?document_srl=77"), "https://c.test/")) == "https://c.test/77"
    assert one(spark, A.post_url(F.lit("/1234567?x"), "https://c.test")) == "https://c.test/1234567"
    assert str(one(spark, A.post_published(F.lit("at 2024.03.01 08:30 x")))) == "2024-02-29 23:30:00"
    assert one(spark, A.is_own_post(F.lit("ME"), "me", F.lit("go #afc now"))) and not one(spark, A.is_own_post(F.lit("me"), "me", F.lit("#AFCB")))
    now = F.to_timestamp(F.lit("2024-01-01T12:00:00Z"))
    assert one(spark, A.miss_suspect(F.lit("On loan"), F.lit("2024-01-01T09:00:00Z"), now))
    assert not one(spark, A.miss_suspect(F.lit("On loan"), F.lit("2024-01-01T09:00:00"), now))
    assert one(spark, A.coverage_breach(F.lit(5), F.lit(0))) == "no_men_tag"


def test_roles(spark):
    own, latin = F.array(F.lit("사카")), F.array(F.lit("saka"))

    def role(title, original, body, said="subject"):
        return one(spark, A.role(F.lit(title), F.lit(original), F.lit(body), own, latin, F.lit(said)))

    assert role("사카 재계약", "x", "") == "subject"
    assert role("사카 재계약", "x", "", "mention") == "mention"
    assert role("다른 소식", "Sáka deal", "") == "subject"
    assert role("사카의 대체자 영입", "Saka", "") == "mention"
    assert role("소식", "x", "lead\n### 사카\n사카 이야기", "mention") == "subject"
    assert role("소식", "x", "### 사카\n다른 이야기") == "mention"


def test_news_columns(spark):
    assert one(spark, N.protagonist(F.lit("Ann and Bob move on to Cid"), ["Ann", "Bob", "Cid"], ["move"])) == "Cid"
    assert one(spark, N.protagonist(F.lit("Bob and Ann"), ["Ann", "Bob"], ["move"])) == "Bob"
    assert one(spark, N.longest_name(F.lit("at New York City"), ["York", "New York"])) == "New York"
    cases = {"[Post - Lee] (Exclusive) deal": ("Post", "Lee", False), "[디 애슬레틱 - 온스테인] x": ("The Athletic", "온스테인", False), "[디 애슬레틱-단독]x": ("The Athletic", None, True), " [독점 텔레그래프] x": ("The Telegraph", None, True), "[공홈] x": ("공홈", None, False), "no [Post] 단독": (None, None, False), "[ - ] x": (None, None, False), "": (None, None, False)}
    for title, want in cases.items():
        assert tuple(one(spark, N.parse_bracket(F.lit(title)))) == want
    assert tuple(one(spark, N.parse_bracket(F.lit(None).cast("string")))) == (None, None, False)
    assert one(spark, N.linked_label(F.lit("A|B|C"))) == "A and 2 more"
    assert one(spark, N.gate_verdict(F.lit("5 up"), F.lit("5 down"))).ok


def test_guards(spark):
    text = "A (Sky Sports - in Italian) , external and B ( Sky Sports , external ) and C (£50m) and D (BBC, external)"
    assert one(spark, N.attributions(F.lit(text))) == ["Sky Sports", "Sky Sports", "BBC"]
    assert one(spark, N.omitted_sources(F.lit(text), F.lit("Sky Sports, BBC"))) == ["Sky Sports"]
    names = {"사카": "Saka", "라이스": "Rice"}
    wrong = lambda t, o, s="": one(spark, N.title_mistranslation(F.lit(t), F.lit(o), names, F.lit(s)))
    assert wrong("조르제 영입", "Bukayo Saka joins") == ["name:Saka"]
    assert wrong("사카 영입", "Bukayo Saka and Declan Rice") == []
    assert wrong("소식", "With Saka") == []
    assert wrong("사카 임대", "Bukayo Saka leaves") == ["loan"] and wrong("사카 임대", "Bukayo Saka on loan") == []
    assert one(spark, N.unfounded_names(F.lit("사카와 라이스"), F.lit("Declan Rice"), names)) == ["사카"]


def test_fuzzy_duplicates_brute(spark):
    """Against all pairs: short and empty given names, edits at every place, equal folds, nulls, repeated names."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(3)
    names = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 7))) + rng.choice([" ", " x "]) + rng.choice(["li", "mo"]) for _ in range(150)]
    names += ["li", "", "Ana Li", "ana li", "Aná Li", None] + names[:9]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, full_name string")
    fold = lambda n: n.lower().replace("é", "e").replace("á", "a")
    kinds = {n: names.index(n) for n in names if n is not None}
    for most in (0, 1, 2, 4):
        want = {
            (a, b, kinds[a], kinds[b], distance(fold(a), fold(b)))
            for a in kinds for b in kinds
            if a.encode() < b.encode() and fold(a).split(" ")[-1] == fold(b).split(" ")[-1] and distance(fold(a), fold(b)) <= most
        }
        got = [tuple(r) for r in R.fuzzy_duplicates(rows, most).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_tiers(spark):
    entry = {"name": "Src One", "aliases": ["@src1"], "tier": 1.0, "outlet": "north"}
    known, none = R.registry([entry], [{"name": "Post", "aliases": ["post"], "tier": 2.0}]), R.registry([], [])
    text = lambda x: F.lit(x).cast("string")

    def tier(mode, known=known, said=None, title=None, body=None, outlet=None, fallback=None, own=None, place=None, journalist=None):
        num = lambda x: F.lit(x).cast("double")
        return one(spark, R.resolve_tier(F.lit(mode), text(said), text(title), text(body), text(outlet), num(fallback), num(own), text(place), text(journalist), known))

    assert tier("fmkorea", title="news of src", body="one more thing") == 4.0  # no name over the border
    assert tier("fmkorea", title="news of s rc", body="by SRC ONE") == 1.0
    assert tier("fmkorea", title="the po st says", body="x") == 2.0 and tier("fmkorea", body="the post") == 4.0
    assert tier("fixed", own=3.0, place="north", journalist="Src One") == 1.0
    assert tier("fixed", own=3.0, place="south", journalist="Src One") == 3.0
    assert tier("fixed", place="north", journalist="Src One") is None  # a source without a tier
    assert tier("x_mentions", said="by @SRC1") == 1.0 and tier("x_mentions", outlet="Post") == 2.0 and tier("x_mentions", fallback=3.5) == 3.5
    assert tier("fmkorea", none, title="x", body="y") == 4.0 and tier("x_mentions", none, said="@src1") is None and tier("fixed", none, own=2.0, journalist="x") == 2.0


def test_ladder_prefers_the_player_in_the_title(spark):
    rows = spark.createDataFrame([(1, "done", 7, 1, False, 0.0, "2024-01-05"), (1, "done", 8, 1, True, 4.0, "2024-01-01"), (1, "done", 9, 1, True, 4.0, "2024-01-02"), (1, "done", 10, 1, None, None, "2024-01-09")], "player_id int, stage string, article_id int, line int, named boolean, tier double, extracted_at string").withColumn("extracted_at", F.col("extracted_at").cast("timestamp"))
    assert [tuple(r) for r in C.stage_ladder(rows).collect()] == [(1, "done", 9, 1, 4)]


def test_cliffs_among_the_last_runs(spark):
    rows = [("a", d, 1 if d != 4 else None) for d in range(1, 7)] + [("b", d, 2) for d in (1, 2, 3, 5)] + [("c", 1, 3)]
    counts = spark.createDataFrame(rows, "source_id string, run int, n int")
    assert [tuple(r) for r in M.recent_cliffs(counts, "run").collect()] == [("b", 2)]
    assert M.recent_cliffs(counts.where("run = 1"), "run").count() == 0
    assert [tuple(r) for r in M.recent_cliffs(counts.where("run <= 2"), "run").collect()] == [("c", 3)]


def test_players_without_articles_have_views(spark):
    players = spark.createDataFrame([(1, "Ann Lee", "Lee", "in_done"), (2, "Bo Lee", "Lee", "in_link"), (3, "Cy", None, "in_link")], "player_id int, full_name string, surname string, status string")
    rows = [(1, "in_done", 7, 1, "agreed", "subject", True, 1.0, "2024-01-01"), (1, "in_done", 8, 1, "official", "subject", False, 0.0, "2024-01-02"), (1, "in_done", 9, 1, "medical", "subject", False, 0.0, "2024-01-03"), (2, "in_link", 9, 2, "rumour", "mention", False, 0.0, "2024-01-03")]
    links = spark.createDataFrame(rows, "player_id int, status string, article_id int, line int, stage string, role string, named boolean, tier double, extracted_at string").withColumn("extracted_at", F.col("extracted_at").cast("timestamp"))
    got = {r.player_id: r for r in C.player_views(players, links).collect()}
    assert [(got[i].slug, got[i].n, got[i].stage) for i in (1, 2, 3)] == [("lee-1", 3, "official"), ("lee-2", 0, None), ("player", 0, None)]
    assert [tuple(s) for s in got[1].ladder] == [("official", 8, 1), ("agreed", 7, 2)] and got[2].ladder == []


def test_helper_columns_clash_with_none_of_the_input(spark):
    clash = {c: F.lit("own") for c in ("_n", "_key", "_new", "_title", "_newest", "_open", "n", "key", "new", "row", "rank", "old", "marked", "newest", "open", "page", "said")}
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], "id int, title string, at int").withColumns(clash)
    same = lambda df, n: [r for r in df.collect() if all(r[c] == "own" for c in clash)].__len__() == n
    assert same(S.first_by(rows, ["id"], [F.desc("at")]), 2)
    assert same(S.newest_links(rows.where("at < 7"), rows.where("at = 7"), ["id"], "at"), 2)
    change = spark.createDataFrame([(1, "z")], "id int, title string")
    assert same(S.patch(rows, change, "id", overwrite=["title"]), 3) and same(S.cleared(rows, change, "id", ["title"]), 3)
    assert same(S.match_by_title(rows, spark.createDataFrame([("a ", "u", 1)], "title string, url string, seq int")), 2)
