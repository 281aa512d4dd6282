import pytest
from pyspark.sql import functions as F

from newsloom.functions import items as I
from newsloom.functions import news as N
from newsloom.functions import text as X
from newsloom.operators import cluster as C
from newsloom.operators import facets as A
from newsloom.operators import resolve as R
from newsloom.operators import state as S
from newsloom.sources import readers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_folding(spark):
    assert one(spark, X.fold_latin(F.lit("Šeško Modrić Gündoğan ØDEGAARD Æß"))) == "sesko modric gundogan odegaard aess"
    assert one(spark, X.strip_marks(F.lit("Guimarães Žan é"))) == "Guimaraes Zan e"


def test_numbers_without_dates_and_times(spark):
    text = F.lit("By A, Updated 7:35 pm, March 5, 2024: paid 8,000만 at https://x.test/1")
    assert one(spark, X.number_tokens(text)) == ["8000"]


def test_womens(spark):
    check = lambda t, b: one(spark, N.is_womens(F.lit(t).cast("string"), F.lit(b).cast("string")))
    assert check("WSL news", None) and check("여자팀", "") and check(None, "the Women won") and not check(None, None)
    assert not check("x", "y" * 400 + "women")


def test_registry():
    entry = {"name": "Ann Lee", "aliases": ["@ann", "ann l"], "tier": 1, "outlet": "Post"}
    known = R.registry([entry, {"name": "Bo", "aliases": ["@bo"], "tier": None}], [])
    assert known.journalists == {"@ann": 1.0, "annl": 1.0, "annlee": 1.0} and known.affiliations["annlee"] == "Post"
    with pytest.raises(ValueError):
        R.registry([entry, {"name": "C", "aliases": ["@ANN"], "tier": 2}], [])


def test_fold_goes_on_from_state(spark):
    seen = spark.createDataFrame([("u", "h", 3, "a", 1)], "url string, content_hash string, revision int, source_id string, body_level int")
    rows = spark.createDataFrame([("u", 1, "g", "late", 2), ("u", 2, "h", "a", 1), ("v", 3, "x", "a", 0)], "url string, seq long, content_hash string, source_id string, body_level int")
    got = {r.seq: (r.decision, r.revision) for r in S.revision_fold(rows, 2, seen, ["late"]).collect()}
    assert got == {2: ("duplicate", 3), 1: ("upgrade", 4), 3: ("new", 1)}


def test_whole_days_of_stories(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01 00:00:01', 'a'), (2, timestamp_ntz'2024-01-01 00:00:00', 'b') v(doc_id, published_at, event)")
    rows = rows.select("*", F.lit(1.0).alias("tier"), F.lit("done").alias("stage"), F.lit(False).alias("subject"), F.lit(False).alias("image"))
    assert [(r.doc_id, r.slot) for r in C.top_stories(rows, "event", "2024-01-12 00:00:00").collect()] == [(1, 1)]


def test_spellings(spark):
    rows = spark.createDataFrame([("JAMES SHARPE",), ("James Sharpe",), ("René",), ("Rene",), ("known",)], "word string")
    got = {r.key: (r.spelling, r.spellings) for r in A.fold_aliases(rows, ["known"]).collect()}
    assert got == {"jamessharpe": ("James Sharpe", 2), "rené": ("René", 1), "rene": ("Rene", 1)}


def test_windows_open_from_the_newest_hidden_day(spark):
    rows = spark.sql("SELECT date'2024-01-31' - n AS day FROM VALUES (0), (6), (9), (15), (16), (40) v(n)")
    days = lambda k: sorted(r.day.isoformat() for r in A.revealed(rows, "day", k).collect())
    assert days(1) == ["2024-01-25", "2024-01-31"]
    assert days(2) == ["2024-01-16", "2024-01-22", "2024-01-25", "2024-01-31"]


def test_gates(spark):
    clubs = {"리즈": ["Leeds"], "맨유": ["Manchester United"], "맨체스터 유나이티드": ["Manchester United"]}
    wrong = lambda out, src: one(spark, N.injected(F.lit(out), F.lit(src), clubs))
    assert wrong("시리즈 소식", "x") == [] and wrong("리즈가 영입", "x") == ["리즈"]
    assert wrong("맨유 영입", "맨체스터 유나이티드") == [] and wrong("맨유 영입", "the Manchester United deal") == []
    polite = lambda t: one(spark, N.has_polite_ending(F.lit(t)))
    assert polite("합류합니다. 끝") and polite("좋네요") and not polite("사실이 아니다.") and not polite('"합니다." 라고 했다')
    assert N.roster_surnames(["얀 디오망데", "케파", "A B"]) == ["디오망데"]
    side = lambda t: one(spark, N.other_club(F.lit(t), F.lit("사카"), "아스날", ["첼시", "리즈"]))
    assert side("사카 첼시 이적… 리즈") == "첼시" and side("아스날 사카 첼시") is None and side("사카 아스날행 첼시") is None and side("첼시 소식") is None


def test_items(spark):
    assert one(spark, I.stored_authors(F.lit('["A ", "", "B"]'))) == ["A", "B"] and one(spark, I.stored_authors(F.lit("{bad"))) == []
    assert one(spark, I.excerpt(F.array(F.lit("a" * 300), F.lit("b")))) == ["a" * 300]
    assert one(spark, I.excerpt(F.array(F.lit("a"), F.lit("b"), F.lit("c")))) == ["a", "b"]
    blocks = I.laid_out(F.array(F.lit("### H"), F.lit("> q"), F.lit("text (BBC - in English)")), F.array(F.lit("i")))
    assert [tuple(b) for b in one(spark, blocks)] == [("h3", "H"), ("quote", "q"), ("img", "i"), ("p", "text (BBC - in English)")]
    assert tuple(one(spark, I.itemized(blocks, F.array(F.lit("BBC"))))[-1]) == ("item", "text", "BBC - in English")
    name = lambda *x: one(spark, I.korean_full_name(*[F.lit(v).cast("string") for v in x]))
    assert name("승인", None, None) == "승인" and name(None, "성", "이름 성") == "이름 성" and name(None, "이름", "성") is None
    assert one(spark, I.is_paywalled(F.lit("https://www.nytimes.com/athletic/1"))) and not one(spark, I.is_paywalled(F.lit("https://www.nytimes.com/athletics")))
    got = one(spark, I.parsed_date(F.lit("Mon, 1 Jan 2024 09:00:00 +0900")))
    assert str(got.at) == "2024-01-01 00:00:00" and got.precision == "time"
    assert one(spark, I.parsed_date(F.lit("soon"))) is None


def test_timeline_keeps_the_first(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"status_id": "1", "text": "first"}\n{"status_id": "1", "text": "again"}\n{"status_id": "2", "text": "two"}\n')
    assert sorted(r.title for r in readers.timeline(spark, str(tmp_path), "x").collect()) == ["first", "two"]
