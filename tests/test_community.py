from datetime import datetime

from newsloom.operators import community as C

LONG = "The club has agreed a fee for the winger after talks that lasted all week. " * 4
PAGE = '<html><head><meta property="og:image" content="pic.jpg"><script type="application/ld+json">{"author":{"name":"Rory S"},"datePublished":"2024-01-01T10:00:00Z"}</script></head><body><p>%s</p></body></html>'


def post(body, strong="", date="2024.03.01 08:30"):
    return f'<div class="rd_hd"><span class="date">{date}</span></div><ul><li class="date">2020.01.01 00:00</li></ul><div class="rd_body"><strong>{strong}</strong><article><div class="xe_content wide">{body}</div></article><p>https://after.test/x</p></div><div class="xe_content">second</div>'


def items(spark, posts, originals, **k):
    given = spark.createDataFrame([(f"https://posts.test/{i}", t, h) for i, (t, h) in enumerate(posts)], "url string, title string, html string")
    landed = spark.createDataFrame(originals, "url string, html string")
    found = C.community_items(given, landed, k.get("terms", ["club", "구단"]), k.get("names", ["사카"]), "posts.test").collect()
    return [r for r in sorted(found, key=lambda r: r.post_url)]


def test_each_route(spark):
    posts = [
        ("[BBC - 목벨] 이적", post("<p>구단 소식</p><p>https://posts.test/own https://bbc.test/a</p>")),
        ("[디 애슬레틱-독점] 구단", post("<p>By Ann Lee June 19, 2026 3:19 am 본문</p><img src='i.jpg'><a href='https://posts.test/p'>x</a><a href='https://ath.test/b'>원문</a>")),
        ("[디 애슬레틱] 구단", post("본문 https://ath.test/b <img src='i.jpg'>", strong="퍼가기가 금지된 글")),
        ("[텔레그래프] 구단", post("글: 로리 휘트웰, 베렌 크로스 https://tel.test/short", date="soon")),
        ("[Mail] 사카", post("무관 https://refused.test/x")),
        ("[Mail] 날씨", post("무관 https://refused.test/x")),
        ("[공홈] 구단", post("https://bbc.test/a")),
        ("구단", post("https://bbc.test/a")),
        ("[Mail] 구단", post("no address")),
        ("[Mail] 사카 영입", None),
    ]
    originals = [("https://bbc.test/a", PAGE % LONG), ("https://ath.test/b", PAGE % LONG), ("https://tel.test/short", PAGE % "This page is gone."), ("https://refused.test/x", None)]
    got = items(spark, posts, originals)
    assert [r.outcome for r in got] == ["item"] * 5 + ["irrelevant", "official", "unresolved", "unresolved", "unresolved"]
    free, paid, blocked, short, refused = got[:5]
    assert (free.url, free.outlet, free.body_level, free.lang, free.body, free.image_url) == ("https://bbc.test/a", "BBC", 2, "en", LONG.strip(), "pic.jpg")
    assert (free.journalist, free.authors, free.published_at, free.precision) == ("목벨", ["목벨", "Rory S"], datetime(2024, 1, 1, 10), "time")
    assert (paid.url, paid.outlet, paid.exclusive, paid.body_level, paid.body, paid.images) == ("https://ath.test/b", "The Athletic", True, 1, "By Ann Lee 본문 x 원문", ["i.jpg"])
    assert (paid.authors, paid.image_url, paid.published_at) == (["Ann Lee"], "pic.jpg", datetime(2024, 2, 29, 23, 30))
    assert (blocked.images, blocked.body_level) == ([], 1)
    assert (short.body_level, short.authors, short.journalist, short.published_at, short.precision) == (1, ["로리 휘트웰", "베렌 크로스"], "로리 휘트웰", None, None)
    assert (refused.body_level, refused.authors, refused.image_url) == (1, [], None)


def test_terms_decide_and_empty_tables(spark):
    posts = [("[Mail] 날씨", post("무관 https://refused.test/x"))]
    assert items(spark, posts, [], terms=[], names=[])[0].outcome == "item"
    assert items(spark, [], []) == []


def test_discovery(spark):
    href = lambda n: f"/index.php?document_srl={n}"
    rows = [
        (0, 1, 0, "one", href(1), None, False), (0, 1, 1, "known", href(2), None, False), (0, 2, 0, None, None, None, True), (0, 3, 0, "late", href(3), None, False),
        (1, 1, 0, "one", href(1), None, False), (1, 1, 1, "Arteta's plan", href(4), "arteta", False), (1, 1, 2, "other", href(5), "arteta", False), (1, 1, 3, "no link", "/x", None, False), (1, 2, 0, "ARTE TA", "/1234567", "arteta", False),
    ]
    results = spark.createDataFrame(rows, "keyword int, page int, at int, title string, href string, must string, failed boolean")
    known = spark.createDataFrame([("known",)], "title string")
    got = sorted(map(tuple, C.discovered(results, known, "https://posts.test", 10).collect()))
    assert got == [(0, "one", "https://posts.test/1"), (1, "ARTE TA", "https://posts.test/1234567"), (1, "Arteta's plan", "https://posts.test/4")]
    assert [r.keyword for r in C.discovered(results, known, "https://posts.test", 2).collect()] == [0, 1]


def test_a_text_of_marks_alone_has_no_author(spark):
    by = "By " * 120
    free, official = items(spark, [("[BBC] 구단", post("https://bbc.test/a")), ("[공홈] 구단", post("https://bbc.test/b"))], [(f"https://bbc.test/{x}", f"<html><body><p>{by}</p></body></html>") for x in "ab"])
    assert (free.body_level, free.body, free.authors, free.journalist, official.journalist) == (2, by.strip(), [], None, None)
