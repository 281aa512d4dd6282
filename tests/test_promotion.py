import json
import os
import random

from pyspark.sql import functions as F

from newsloom.functions import news as N
from newsloom.functions import text as X
from newsloom.operators import promotion as P
from newsloom.streaming.promotion import promotion_stream

DOMAINS = [("bbc.test", "BBC"), ("sun.test", "Sun"), ("nytimes.com", "NYT")]
POSTS = "post_id long, handle string, at timestamp, text string, url string, outlet string"
ORIGINALS = "original_id long, handle string, at timestamp, text string, card string"
LANDED = "card string, final_url string, title string, body string, at timestamp"
TEXT = "United agree Bruno Guimaraes deal Newcastle package worth"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def clock(minutes):
    return f"2026-07-{2 + minutes // 1440:02d} {minutes // 60 % 24:02d}:{minutes % 60:02d}:00"


def frame(spark, rows, schema):
    kinds = [f.split(" ") for f in schema.split(", ")]
    raw = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} {'string' if k == 'timestamp' else k}" for n, k in kinds))
    return raw.select([F.col(n).cast(k).alias(n) for n, k in kinds])


def test_words_and_entities(spark):
    assert one(spark, X.significant_words(F.lit("The deal: O'Neil, çava re-sign 2024 with THIS deal x1y2 João"))) == ["deal", "o'neil", "çava", "re-sign", "joão"]
    assert one(spark, N.entities(F.lit("Hope to sign Bruno Guimarães. Bruno Guimarães from St. James' Park"))) == ["Bruno Guimarães. Bruno Guimarães", "St. James' Park"]
    assert one(spark, N.entities(F.lit("Club are active"))) == []


def test_each_step_that_may_fail(spark):
    posts = [(i, h, clock(300), t, f"https://x.test/{i}", "cited") for i, (h, t) in enumerate([("@A", TEXT), ("@nobody", TEXT), ("@a", "other words altogether here"), (None, TEXT), ("@b", TEXT), ("c", TEXT), ("@d", TEXT), ("@e", TEXT), ("@f", TEXT), ("@g", TEXT), ("@h", TEXT)])]
    originals = [
        (1, "a", clock(290), TEXT, "card1"), (2, "@A", clock(200), TEXT + " extra", "card9"),
        (3, "b", clock(301), TEXT, "card1"), (4, "b", clock(119), TEXT, "card1"),
        (5, "c", clock(290), TEXT, None), (6, "c", clock(200), TEXT, "card1"),
        (7, "d", clock(290), TEXT, "gone"), (8, "e", clock(290), TEXT, "empty"), (9, "f", clock(290), TEXT, "paid"), (10, "g", clock(290), TEXT, "strange"), (11, "h", clock(120), TEXT, "untitled"),
    ]
    landed = [("card1", "https://www.bbc.test/a", "Title", "Body", clock(310)), ("empty", "https://bbc.test/b", "T", "", clock(310)), ("paid", "https://nytimes.com/athletic/1", "T", "B", clock(310)), ("strange", "https://bbc.test.evil.com/", "T", "B", clock(310)), ("untitled", "https://m.sun.test/x", "", "B", clock(310))]
    got = {r.post_id: r for r in P.promotion_chain(frame(spark, posts, POSTS), frame(spark, originals, ORIGINALS), frame(spark, landed, LANDED), DOMAINS).collect()}
    assert [got[i].missed for i in range(11)] == [None, "original", "original", "original", "original", "card", "page", "page", "paywall", "outlet", None]
    assert (got[0].url, got[0].outlet, got[0].title, got[0].body) == ("https://www.bbc.test/a", "BBC", "Title", "Body")
    assert (got[10].outlet, got[10].title) == ("Sun", TEXT)  # without a title the post's text
    assert all((got[i].url, got[i].outlet, got[i].body) == (f"https://x.test/{i}", "cited", None) for i in range(1, 10))


def test_stream_ends_at_the_batch_rows(spark, tmp_path):
    rng = random.Random(3)
    words = [f"word{c}" for c in "abcdefghijklmn"]
    text = lambda: " ".join(rng.sample(words, 8))
    posts = [(i, rng.choice(["@a", "@B", "@c"]), clock(rng.randrange(1200)), text(), f"https://x.test/{i}", "cited") for i in range(60)]
    originals = [(i, rng.choice("abd"), clock(rng.randrange(1200)), text(), rng.choice([None, "", *(f"c{k}" for k in range(9))])) for i in range(150)]
    landed = [(f"c{k}", ["https://bbc.test/", "https://sun.test/", "https://else.test/"][k % 3] + str(k), rng.choice([None, "T"]), "B" if k else "", clock(1100)) for k in range(7)]
    tables = {"posts": (posts, POSTS), "originals": (originals, ORIGINALS), "landed": (landed, LANDED)}
    last = {"posts": (999, "@z", "2100-01-01 00:00:00", "", "u", "cited"), "originals": (999, "z", "2100-01-01 00:00:00", "", None), "landed": ("z", "u", "", "", "2100-01-01 00:00:00")}
    streams = []
    for name, (rows, schema) in tables.items():
        (tmp_path / name).mkdir()
        rows = rng.sample(rows, len(rows))  # arrival in any order, within `late`
        names = [f.split(" ")[0] for f in schema.split(", ")]
        parts = [rows[k::4] for k in range(4)] + [[last[name]]]
        for k, part in enumerate(parts):
            file = tmp_path / name / f"{k}.json"
            file.write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in part))
            os.utime(file, (1_700_000_000 + 60 * k,) * 2)
        streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/{name}"))
    want = P.promotion_chain(*[frame(spark, *t) for t in tables.values()], DOMAINS)
    got = promotion_stream(*streams, DOMAINS, wait="2 days", late="2 days")
    got.writeStream.format("memory").queryName("promoted").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    rows = lambda df: sorted(map(str, df.select(want.columns).collect()))
    assert rows(spark.table("promoted")) == rows(want)
    assert {r.missed for r in want.collect()} == {None, "original", "card", "page", "outlet"}


def test_columns_that_clash(spark):
    posts = frame(spark, [(1, "@a", clock(300), TEXT, "u", "cited")], POSTS)
    for c in ("words", "item_id", "page"):
        posts = posts.withColumn(c, F.lit("own"))
    originals = frame(spark, [(1, "a", clock(290), TEXT, "c")], ORIGINALS)
    landed = frame(spark, [("c", "https://bbc.test/1", "T", "B", clock(1))], LANDED)
    got = P.promotion_chain(posts, originals, landed, DOMAINS).first()
    assert (got.outlet, got.words, got.item_id) == ("BBC", "own", "own")


def test_pages_that_landed_long_before_count(spark, tmp_path):
    """A page of ten days ago, as in batch, and not where it is kept for less."""
    posts = [(1, "@a", clock(300), TEXT, "u", "cited")]
    originals = [(1, "a", clock(290), TEXT, "c")]
    landed = [("c", "https://bbc.test/1", "T", "B", "2023-12-01 00:00:00")]
    tables = {"posts": (posts, POSTS), "originals": (originals, ORIGINALS), "landed": (landed, LANDED)}
    last = {"posts": (999, "@z", "2100-01-01 00:00:00", "", "u", "cited"), "originals": (999, "z", "2100-01-01 00:00:00", "", None), "landed": ("z", "u", "", "", "2100-01-01 00:00:00")}
    for kept, outlet in ((None, "BBC"), ("1 day", "cited")):
        streams = []
        for name, (rows, schema) in tables.items():
            (tmp_path / name).mkdir(exist_ok=True)
            names = [f.split(" ")[0] for f in schema.split(", ")]
            (tmp_path / name / "0.json").write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in [*rows, last[name]]))
            streams.append(spark.readStream.schema(schema).json(f"{tmp_path}/{name}"))
        got = promotion_stream(*streams, DOMAINS, wait="2 days", kept=kept)
        name = f"kept_{outlet}"
        got.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination()
        assert [r.outlet for r in spark.table(name).where("post_id = 1").collect()] == [outlet]
