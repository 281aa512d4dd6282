from collections import defaultdict

import numpy as np

from newsloom.llm import suffix_dedup as S


def brute(texts, window):
    raws = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for raw in raws:
        for i in range(len(raw) - window + 1):
            seen[raw[i : i + window]] += 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - window + 1):
            if seen[raw[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.append([0], gone.astype(int))) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, kept))
    return sorted(out)


def check(df, window=400, gram=32, shard=S.SHARD):
    texts = [r.text for r in df.collect()]
    got = S.remove_repeats(df, window, gram, shard).collect()
    assert sorted((r.n_bytes, sum(x.after - x.first for x in r.removed), len(r.removed), bytes(r.kept)) for r in got) == brute(texts, window)


def test_odd_rows(odd):
    check(odd)
    check(odd, 8, 4)


def test_empty(empty):
    assert S.remove_repeats(empty).count() == 0


def test_small_windows(spark):
    rng = np.random.default_rng(2)
    base = "".join(rng.choice(list("abc é"), 600))
    rows = [(k, base[a:z] + "".join(rng.choice(list("xyz"), 40)) + base[z : z + 60]) for k, (a, z) in enumerate(rng.integers(0, 500, (40, 2)).tolist())]
    rows += [(100, "a" * 500), (101, "ab" * 300), (102, base), (103, base), (104, "\0" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, 40, 8)
    check(df, 40, 8, shard=200)


def test_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(1000))


def test_crowded_keys_are_cut_again(spark, monkeypatch):
    """A passage among many different neighbours, some of which come twice, and bytes that are no UTF-8 when cut."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdé"), n))
    passage, near = word(70), word(30)
    rows = [(k, word(rng.integers(0, 40)) + passage[: rng.integers(30, 71)] + (near[: k % 30] if k % 3 else "") + word(rng.integers(0, 40))) for k in range(150)]
    rows += [(200 + k, rows[k][1][5:]) for k in range(30)] + [(300, passage * 3), (301, "a" * 300), (302, "a" * 200)]
    orders, real = [], S.find_segments
    monkeypatch.setattr(S, "find_segments", lambda r, w, g, order=0: orders.append(order) or real(r, w, g, order))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 40, 8, shard=400)
    assert orders == [0, 1, 2]
