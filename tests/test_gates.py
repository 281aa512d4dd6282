from pyspark.sql import functions as F

from newsloom.functions import news as N
from newsloom.operators import gates as G
from newsloom.operators import repairs as RP


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_grounding_names_and_clubs_join_the_verdict(spark):
    verdict = lambda *a, **k: one(spark, N.gate_verdict(F.lit("paid 50"), F.lit("50 in 2026"), *a, **k))
    assert verdict().extra == ["2026"] and not verdict().ok
    assert verdict(F.lit("Title of 2026: paid 50")).ok  # a figure of the title is not invented
    found = verdict(F.lit("2026 50"), names=F.array(F.lit("Saka")), clubs=F.lit(None).cast("array<string>"))
    assert found.names == ["Saka"] and found.clubs == [] and not found.ok
    assert one(spark, N.violations(N.gate_verdict(F.lit("abcdefghijkl 7"), F.lit("abcdefghijkl")))) == 2  # a lost figure and a copy


def test_people_of_one_surname_do_not_ground_each_other(spark):
    names = {"벤화이트": ["White"], "하비화이트": ["White"]}
    wrong = lambda **k: one(spark, N.injected(F.lit("벤화이트 복귀"), F.lit("하비화이트 소식"), names, **k))
    assert wrong() == [] and wrong(synonyms=False) == ["벤화이트"]


def test_best_attempt(spark):
    shape = "key string, n int, verdict struct<missing:array<string>,extra:array<string>,quotes:array<string>,names:array<string>,clubs:array<string>,retention:double>"
    v = lambda kept, *wrong: (list(wrong), [], [], [], [], kept)
    rows = [("a", 1, v(0.9)), ("a", 2, v(0.2, "7")), ("a", 3, v(0.1, "7")), ("b", 1, v(0.8)), ("b", 2, v(0.1)), ("c", 2, v(0.5)), ("c", 1, v(0.5)), ("d", 1, v(0.1, "1", "2"))]
    got = {r.key: (r.n, r.violations, r.tried) for r in G.best_attempts(spark.createDataFrame(rows, shape), "key", "n").collect()}
    assert got == {"a": (3, 1, 3), "b": (2, 0, 2), "c": (1, 0, 2), "d": (1, 2, 1)}


def test_titles_go_back_once(spark):
    listed = lambda *x: F.array(*[F.lit(i) for i in x]).cast("array<string>")
    final = lambda s, o, c, again: tuple(one(spark, G.final_title(F.lit("t"), listed(*s), listed(*o), listed(*c), F.lit(again))))
    assert final([], [], [], False) == ("t", []) and final(["n"], [], [], False) == (None, [])
    assert final([], ["o"], [], False) == (None, []) and final([], [], ["c"], False) == (None, [])
    assert final(["n"], ["o"], [], True) == ("t", ["n"]) and final([], ["o"], ["c"], True) == ("t", [])


def test_targets_stand_in_their_repairs_order(spark):
    rows = spark.createDataFrame([(i, i % 3, None if i == 4 else i) for i in range(10)], "id int, kind int, age int")
    repairs = {"a": (F.col("kind") == 0, -F.col("id")), "b": (F.col("age") > 7, F.col("id")), "none": (F.lit(False), F.col("id"))}
    got = sorted((r.repair, r.place, r.id) for r in RP.targets(rows, repairs, "id").collect())
    assert got == [("a", 0, 9), ("a", 1, 6), ("a", 2, 3), ("a", 3, 0), ("b", 0, 8), ("b", 1, 9)]
