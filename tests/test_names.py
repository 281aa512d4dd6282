import random

from newsloom.operators import names as N


def brute(texts, names):
    return sorted((k, n, i + 1) for k, t in texts for n in {n for n in names if n} for i in range(len(t or "")) if t.startswith(n, i))


def frames(spark, texts, names):
    return spark.createDataFrame(texts, "id int, body string"), spark.createDataFrame([(n,) for n in names], "name string")


def test_places_equal_brute_force(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abé東😀 ") for _ in range(n))
    names = [word(rng.randint(1, 14)) for _ in range(300)] + ["", None, "aaaa", "aaaaaaaa", "b" * 40]
    texts = [(i, word(rng.randint(0, 120))) for i in range(60)] + [(60, None), (61, "a" * 30), (62, "x" + "b" * 41), (62, "aaaa")]
    texts += [(100 + i, rng.choice(names[:300]) * 2) for i in range(20)]
    got = N.name_places(*frames(spark, texts, names + names[:50]), "id", "body")
    assert sorted(map(tuple, got.collect())) == brute(texts, names)
    shuffled = N.name_places(*frames(spark, texts, names), "id", "body", sent_names=100)
    assert sorted(map(tuple, shuffled.collect())) == brute(texts, names)


def test_grams_of_texts_are_not_shuffled(spark):
    told, dictionary = frames(spark, [(i, "Ann met Bob " * 50) for i in range(200)], ["Ann met", "Bob", "Zoe"])
    plan = N.name_places(told, dictionary, "id", "body")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert N.longest_names(told, dictionary, "id", "body").count() == 200


def test_protagonists_shuffle_what_was_found_only(spark):
    told, dictionary = frames(spark, [(i, "Ann met Bob " * 50) for i in range(200)], ["Ann met", "Bob"])
    turns = dictionary.where("name = 'Bob'")
    found = N.protagonists(told, dictionary, turns, "id", "body")
    assert "around" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.name for r in found.collect()} == {"Ann met"}


def test_a_hundred_thousand_names(spark):
    names = [f"Player#{i:09d}" for i in range(100_000)]  # one beginning for all
    rng = random.Random(2)
    texts = [(i, " and ".join(f"Player#{rng.randrange(150_000):09d}" for _ in range(4))) for i in range(300)]
    told, dictionary = frames(spark, texts, names)
    want = sorted((k, f"Player#{n:09d}") for k, t in texts for n in {int(x[7:]) for x in t.split(" and ")} if n < 100_000)
    assert sorted((r.id, r.name) for r in N.name_places(told, dictionary, "id", "body").collect()) == want
    small = N.name_places(told, dictionary.limit(10), "id", "body")
    plan = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert plan(N.name_places(told, dictionary, "id", "body")) < 1.2 * plan(small) + 400


def test_longest_and_protagonists(spark):
    texts = [(1, "at New York City, York joins Bob"), (2, "Bob and Ann"), (3, "Ann joins"), (4, "nobody"), (5, "Ann joins Anna"), (6, "Anna joins")]
    told, names = frames(spark, texts, ["York", "New York", "Bob", "Ann", "Anna"])
    _, turns = frames(spark, texts, ["joins", "leaves"])
    assert {tuple(r) for r in N.longest_names(told, names, "id", "body").collect()} == {(1, "New York"), (2, "Ann"), (3, "Ann"), (5, "Anna"), (6, "Anna")}
    assert {tuple(r) for r in N.protagonists(told, names, turns, "id", "body").collect()} == {(1, "Bob"), (2, "Bob"), (3, "Ann"), (5, "Anna"), (6, "Ann")}
    assert N.name_places(told, names.where("false"), "id", "body").count() == 0
    assert N.longest_names(told.where("false"), names, "id", "body").count() == 0
