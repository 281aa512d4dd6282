from itertools import combinations

import numpy as np

from newsloom.llm import jaccard as J


def grams(text):
    w = (text or "").lower().encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = {}
    for k, (_, t) in enumerate(rows):
        sets.setdefault(grams(t), []).append(k)
    keys = list(sets)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    near = {k: [] for k in keys}
    for a, b in combinations(keys, 2):
        if a and b and len(a & b) / len(a | b) >= 0.8:
            near[a].append(b)
            near[b].append(a)
            root[find(a)] = find(b)
    least = lambda ks: min((rows[k][0] for k in ks if rows[k][0] is not None), default=None)
    out = []
    for key, members in sets.items():
        group = [m for k in keys if find(k) == find(key) for m in sets[k]]
        for m in members:
            out.append((rows[m][0], least(members), len(members), len(members) - 1 + sum(len(sets[b]) for b in near[key]), len(near[key]), least(group), len(group)))
    return sorted(out, key=str)


def check(df):
    got = J.near_duplicates(df).select("doc_id", "copy_id", "copies", "n_links", "n_text_links", "class_id", "class_size").collect()
    assert sorted(map(tuple, got), key=str) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows(odd):
    check(odd)


def test_empty(empty):
    assert J.near_duplicates(empty).count() == 0
    assert J.one_of_each_class(empty).count() == 0


def near_copies(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 500, 200)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.integers(0, 200, k // 10):
            words[at] = f"x{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(f"v{i}" for i in rng.integers(0, 500, 30))) for k in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_copies(spark):
    check(near_copies(spark))


def test_near_copies_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    check(near_copies(spark))


def test_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_posterior_bound():
    rng = np.random.default_rng(1)
    for n in (16, 64, 128):
        least = J.least_matches(n)
        tail = lambda m: (rng.beta(m + 1, n - m + 1, 200_000) >= 0.8).mean()  # noqa: B023, E731
        assert tail(least - 1) < 1e-4 and tail(least + 6) > 1e-5
