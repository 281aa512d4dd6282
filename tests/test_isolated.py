import json

from pyspark.sql import functions as F

from newsloom.sources import isolated as L


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


RSS = "<rss><channel><item><title> One </title><link>https://a.test/1</link><pubDate>x</pubDate><description>d</description></item><item><title>Two</title><link>https://a.test/2</link></item></channel></rss>"
SITEMAP = "<urlset>" + "".join(f"<url><loc>https://c.test/news/{n}</loc><lastmod>2024-01-02T0{h}:00:00Z</lastmod></url>" for n, h in (("deal-aaaaaaaaaa", 1), ("pup-bbbbbbbbbb", 2), ("women-cccccccccc", 3), ("lost-dddddddddd", 4), ("noid", 5), ("signs-eeeeeeeeee", 6))) + "<url><loc>https://c.test/news/old-ffffffffff</loc><lastmod>2023-01-01T00:00:00Z</lastmod></url></urlset>"
ANSWERS = [
    {"glide_id": "aaaaaaaaaa", "article": {"title": "Deal", "publicationDate": "p", "taxonomies": ["Men", "Transfer news"], "articleType": "News", "articleBody": [{"type": "HEADER", "image": "i.jpg", "author": "Ann"}, {"type": "TEXT", "innerText": "Lead"}]}},
    {"glide_id": "bbbbbbbbbb", "article": {"title": "Pup visits", "taxonomies": ["Men"], "articleType": "News"}},
    {"glide_id": "cccccccccc", "article": {"title": "She signs", "taxonomies": ["Women"], "articleType": "News"}},
    {"glide_id": "eeeeeeeeee", "article": {"title": "He signs", "taxonomies": ["Men"], "articleType": "News", "articleBody": []}},
]
LIST = '<a class="hx" href="/1"> Big <b>transfer</b> </a><a href="/1">again</a><a class="hx" href="/2"></a><a class="hx">no address</a><a class=hx href="https://z.test/3">Loan talk</a><a class="hx" href="/4">weather</a>'
DETAIL = '<html><head><meta property="og:image" content="pic.jpg"><script type="application/ld+json">{"author":{"name":"Bo Ray"},"datePublished":"2024-01-01T10:00:00Z"}</script></head><body><p>Body text here.</p></body></html>'


def config(folder):
    return [
        {"source_id": "feed", "kind": "rss", "options": {"path": write(folder / "feed.xml", RSS)}},
        {"source_id": "x", "kind": "posts", "options": {"path": write(folder / "x.json", "\n".join([json.dumps({"status_id": "1", "text": "hello", "created_at": "t"}), '{"status_id": "2", "text": oops', json.dumps({"status_id": "3", "text": "card", "card_href": "https://d.test"})]))}},
        {"source_id": "club", "kind": "official", "options": {"path": write(folder / "map.xml", SITEMAP), "lookups": write(folder / "answers.json", "\n".join(map(json.dumps, ANSWERS))), "now": "2024-01-02T10:00:00Z"}},
        {"source_id": "site", "kind": "html", "options": {"path": write(folder / "list.html", LIST), "base_url": "https://s.test/", "selector": "hx", "keywords": ["Transfer", "loan"], "details": write(folder / "details.json", json.dumps({"url": "https://s.test/1", "html": DETAIL}))}},
        {"source_id": "gone", "kind": "rss", "options": {"path": f"{folder}/nothing.xml"}},
        {"source_id": "odd", "kind": "telepathy"},
        {"source_id": "off", "kind": "rss", "enabled": False, "options": {"path": f"{folder}/nothing.xml"}},
    ]


def test_sources_fail_alone(spark, tmp_path, monkeypatch):
    def silent(spark):
        raise TimeoutError

    def late(spark):
        return L.Source(spark.range(3).select(F.raise_error(F.lit("broken while running")).cast("string").alias("url")))

    monkeypatch.setattr(L, "KINDS", L.KINDS | {"silent": silent, "late": late})
    sources = [*config(tmp_path), {"source_id": "silent", "kind": "silent"}, {"source_id": "late", "kind": "late"}]
    got = L.land(spark, sources, f"{tmp_path}/out")
    items = {(r.source_id, r.url): r for r in got.items.collect()}
    assert sorted(items) == [("club", "https://c.test/news/deal-aaaaaaaaaa"), ("club", "https://c.test/news/signs-eeeeeeeeee"), ("feed", "https://a.test/1"), ("feed", "https://a.test/2"), ("site", "https://s.test/1"), ("site", "https://z.test/3"), ("x", "https://d.test"), ("x", "https://x.test/status/1")]
    errors = {r.source_id: r.error for r in got.errors.collect()}
    assert set(errors) == {"gone", "odd", "silent", "late"}
    assert errors["silent"] == "TimeoutError" and errors["odd"] == "unknown kind: telepathy" and "nothing.xml" in errors["gone"] and errors["late"]
    funnels = {(r.source_id, r.stage): r.n for r in got.funnels.collect()}
    assert {k[1]: v for k, v in funnels.items() if k[0] == "site"} == {"selected": 5, "deduped": 4, "titled": 3, "passed": 2, "landed": 2}
    assert {k[1]: v for k, v in funnels.items() if k[0] == "club"} == {"candidates": 6, "men_tagged": 3, "accepted": 2, "landed": 2}
    assert funnels["feed", "landed"] == 2
    assert [(r.source_id, "oops" in r.record) for r in got.bad.collect()] == [("x", True)]
    assert [(r.source_id, r.record) for r in got.rejects.collect()] == [("club", "https://c.test/news/pup-bbbbbbbbbb")]
    deal, signs = items["club", "https://c.test/news/deal-aaaaaaaaaa"], items["club", "https://c.test/news/signs-eeeeeeeeee"]
    assert (deal.accept_path, deal.body, deal.image_url, deal.authors, signs.accept_path, signs.body) == ("tag", "Lead", "i.jpg", ["Ann"], "title", "")
    page, bare = items["site", "https://s.test/1"], items["site", "https://z.test/3"]
    assert (page.title, page.body, page.authors, page.published, page.precision, page.image_url) == ("Big transfer", "Body text here.", ["Bo Ray"], "2024-01-01T10:00:00Z", "time", "pic.jpg")
    assert (bare.title, bare.body, bare.authors) == ("Loan talk", "", None)


def test_a_source_that_breaks_gives_none_of_its_old_rows(spark, tmp_path):
    sources = config(tmp_path)[:2]
    assert L.land(spark, sources, f"{tmp_path}/out").items.count() == 4
    sources[0]["options"]["path"] = f"{tmp_path}/nothing.xml"
    again = L.land(spark, sources, f"{tmp_path}/out", concurrency=1)
    assert {r.source_id for r in again.items.collect()} == {"x"} and again.errors.count() == 1
    none = L.land(spark, [], f"{tmp_path}/out")
    assert none.items.count() == none.errors.count() == none.funnels.count() == 0
