import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import lexical as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    """Sorted (item_id, rank, doc_id, score); docs and items: (id, text)."""
    counted = [(i, Counter(t)) for i, t in ((i, words(t)) for i, t in docs) if t]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for at, (i, c) in enumerate(counted):
            m = 75 + 25 * sum(c.values()) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, at))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i, _) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")


def test_terms_are_those_of_the_pattern():
    every = "".join(map(chr, [*range(0x250), 0x3042, 0x1F600])) + " ÀB-c_d~E9é\x85x y​z"
    assert [t.decode() for t in X.terms(every.encode())] == words(every)


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    want = duckdb.sql(X.OP13_SQL.replace("FROM documents", f"FROM '{sf}/documents.parquet'").replace("FROM benchmark", f"FROM '{sf}/benchmark.parquet'")).fetchall()
    assert got(X.op13_ranked_search(spark, sf)) == sorted(want, key=str)


@pytest.mark.parametrize("k,block,pairs", [(3, 1 << 20, 1 << 14), (5, 300, 7)])
def test_equals_brute_force(spark, monkeypatch, k, block, pairs):
    monkeypatch.setattr(X, "PAIRS", pairs)
    rng = np.random.default_rng(k)
    vocabulary = np.array([f"w{i}" for i in range(120)])
    share = 1 / np.arange(1, 121)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=share / share.sum()))
    docs = [(i, text(int(rng.integers(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)]  # equal scores
    items = [(i, text(int(rng.integers(1, 15)))) for i in range(25)] + [(25, "absent words"), (26, docs[7][1]), (27, "W1 w1, w1!")]
    assert got(X.search(*tables(spark, docs, items), k, block=block)) == brute(docs, items, k)


def test_cut_terms_cannot_reach_the_floor():
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"t{x}" for x in rng.integers(0, 40, 12)).encode()) for i in range(30)]
    items = X.Items.of(rows)
    bound = rng.integers(0, 50, len(items.term))
    floor = rng.integers(0, 200, len(rows))
    first = X.essential(items, bound, floor)
    for i in range(len(rows)):
        own = slice(items.begin[i], items.begin[i + 1])
        assert bound[own][~first[own]].sum() < max(floor[i], 1)
        cut = bound[own][~first[own]].max(initial=0)
        assert (bound[own][first[own]] >= cut).all()


def test_thresholds_leave_few_candidates(spark, monkeypatch):
    """A floor from exactly scored documents cuts terms that the k-th impacts alone would keep."""
    floors = []
    real = X.essential
    monkeypatch.setattr(X, "essential", lambda items, bound, floor: floors.append((items, bound, floor)) or real(items, bound, floor))
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    found = X.search(docs, items)
    (own, bound, floor), last = floors[0], {r.item_id: r.score for r in found.where("rank = 20").collect()}
    assert all(f <= last[i] for i, f in zip(own.ids, floor.tolist(), strict=True))
    assert np.mean([f == last[i] for i, f in zip(own.ids, floor.tolist(), strict=True)]) > 0.5
    assert real(own, bound, floor).mean() < 0.8


def test_odd_rows(odd, empty, spark):
    items = spark.createDataFrame([(1, "alpha gone"), (2, None), (3, ""), (None, "repeated id"), (1, "alpha gone"), (4, "東京 été")], "item_id long, text string")
    for clash in ("item", "n", "term", "tf", "q", "df", "at"):
        odd, items = odd.withColumn(clash, F.lit("clash")), items.withColumn(clash, F.lit("clash"))
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert got(X.search(odd, items)) == brute(docs, asked, 20)
    assert X.search(empty, items).count() == 0
    assert X.search(odd, items.where("false")).count() == 0
    named = odd.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    assert X.search(named, items).count() == X.search(odd, items).count()
