from datetime import datetime

from pyspark.sql import functions as F

from newsloom.operators import backfills as BF
from newsloom.operators import facets as A


def test_authors_from_what_is_there(spark):
    rows = [
        (1, "fm", "David Ornstein Aug", "By David Ornstein Aug. 2, 2026 x", None),  # something stuck to the name
        (2, "fm", "온스테인", "By David Ornstein and Bo Ray x", None),
        (3, "bbc", "잭 로서, Simon C & 잭 로서", None, None),
        (4, "bbc", None, "By Ann Lee x", None),  # another source's body is not read
        (5, "fm", " ", "By Ann Lee x", None),
        (6, "bbc", "Desk", None, '["stored"]'),
        (7, "bbc", "Ann Lee Sport", None, None),
    ]
    raw = [(7, 2, ["Ann Lee"]), (7, 1, []), (7, 3, ["late"]), (6, 1, ["x"])]
    got = BF.author_backfill(spark.createDataFrame(rows, "id int, source_id string, journalist string, body string, authors_json string"), spark.createDataFrame(raw, "id int, seq int, authors array<string>"), "id", "fm")
    assert {r.id: (r.authors, r.journalist) for r in got.collect()} == {1: (["David Ornstein"], "David Ornstein"), 2: (["온스테인", "David Ornstein", "Bo Ray"], None), 3: (["잭 로서", "Simon C"], None), 5: (["Ann Lee"], None), 7: (["Ann Lee"], "Ann Lee")}


def test_only_longer_bodies_are_taken(spark):
    rows = spark.createDataFrame([(1, "ab", "t", "k"), (2, "abc", "t", "k"), (3, None, "t", "k"), (4, "a", "t", "k")], "id int, body string, title_ko string, row string")
    found = spark.createDataFrame([(1, "abc"), (2, "xyz"), (3, "z"), (5, "new"), (4, None)], "id int, body string")
    got = {tuple(r) for r in BF.longer_bodies(rows, found, "id", "body", ["title_ko"]).collect()}
    assert got == {(1, "abc", None, "k"), (2, "abc", "t", "k"), (3, "z", None, "k"), (4, "a", "t", "k")}


def test_targets_and_small_rules(spark):
    items = spark.createDataFrame([(3, "@Bo"), (1, "Ann"), (2, "@ANN"), (4, "@skip"), (5, None), (6, "@"), (7, "cy")], "position int, journalist string")
    assert [tuple(r) for r in BF.timeline_targets(items, ["SKIP"], 2).collect()] == [("Ann", 1), ("Bo", 3)]
    lists = spark.createDataFrame([(["é"],), ([],), (None,)], "a array<string>")
    assert [r.x for r in lists.select(BF.authors_json(F.col("a")).alias("x")).collect()] == ['["é"]', None, None]
    times = spark.createDataFrame([(datetime(2026, 1, 1, h), datetime(2026, 1, 1, 12)) for h in (9, 10)] + [(None, datetime(2026, 1, 1, 12))], "a timestamp_ntz, b timestamp_ntz")
    assert [r.x for r in times.select(BF.due(F.col("a"), F.col("b")).alias("x")).collect()] == [True, False, True]
    facets = spark.createDataFrame([("outlet", "BBC", "1"), ("journalist", "Ann", "1.5"), ("tier", "1", "1"), ("outlet", "Mail", "3")], "axis string, value string, tier string")
    assert {tuple(r) for r in A.tier_members(facets, ["1", "1.5"]).collect()} == {("outlet", "BBC"), ("journalist", "Ann")}
