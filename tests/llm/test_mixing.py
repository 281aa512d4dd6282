import re
from collections import defaultdict

import numpy as np

from newsloom.llm import mixing as M


def check(df, tolerance):
    rows = df.select("text", "source", "doc_id").collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(int)
    for r in rows:
        by[r.source] += size(r.text)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, M.source_targets([by[s] for s in order]), strict=True))
    got = M.mix_counts(df).collect()
    key = lambda i, n, s, t: (str(i), n, s, round(t, 6))
    assert sorted(key(r.doc_id, r.size, r.source_size, r.target) for r in got) == sorted(key(r.doc_id, size(r.text), by[r.source], targets[r.source]) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[round(r.target, 6), r.source_size] += r.taken
    for (target, _), n in taken.items():
        assert abs(n - target) <= tolerance * max(target, 1) + 2 * M.BLOCK
    again = M.mix_counts(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_rows(odd):
    check(odd, 0.5)


def test_table(small):
    check(small, 0.02)


def test_empty(empty):
    assert M.mix_counts(empty).count() == 0
    assert M.mix_documents(empty).count() == 0


def test_targets_fill_up_and_stop():
    assert M.source_targets([100, 100, 100]) == [200, 250 / 3, 500 / 3]
    assert M.source_targets([0, 10]) == [0, 15]
    assert M.source_targets([]) == []


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000):
        got = M.permute(np.arange(n), np.full(n, n), np.full(n, 5))
        assert sorted(got) == list(range(n))
        assert n < 64 or (got != np.arange(n)).any()


def test_shards_use_up_the_quota():
    quota = np.array([1000, 0, 17, 500])
    of = M.Shards(quota, 100, 3)
    drawn = [of.of(k) for k in range(of.n)]
    shards = np.array([here for here, _ in drawn])
    assert of.n == 16 and (shards.sum(0) == quota).all() and (shards[:-1].sum(1) == 100).all() and (shards >= 0).all()
    assert all((before == shards[:k].sum(0)).all() for k, (_, before) in enumerate(drawn))
    again = M.Shards(quota, 100, 3)
    assert all((again.of(k)[0] == shards[k]).all() for k in (11, 3, 15, 0))  # in any order, in any task
    assert (M.Shards(quota, 100, 4).of(3)[0] != shards[3]).any()
    assert (M.Shards(np.array([5, 0]), 100, 3).of(0)[0] == [5, 0]).all() and M.Shards(np.array([0]), 100, 3).n == 1


def test_a_shard_of_a_very_large_mix_takes_few_draws():
    quota = np.full(20, 2 * 10**13)
    of = M.Shards(quota, 1 << 18, 1)
    here, before = of.of(of.n // 3)
    assert here.sum() == 1 << 18 and before.sum() == of.n // 3 << 18 and abs(here / here.sum() - 0.05).max() < 0.01


def test_mixed_texts_hold_the_words_taken(small):
    counts = defaultdict(int)
    for r in M.mix_documents(small).collect():
        counts[r.doc_id] += len(re.findall(M.WORD, r.text))
    assert counts == {r.doc_id: r.taken for r in M.mix_counts(small).collect() if r.taken}


def test_source_numbers_take_no_python_worker(spark):
    found = M.source_numbers(spark, ["a", "b", None])
    assert found.dtypes == [("numbered", "string"), ("source_no", "int")]
    assert [tuple(r) for r in found.collect()] == [("a", 0), ("b", 1), (None, 2)]
    assert M.source_numbers(spark, []).count() == 0
    assert "PythonRDD" not in found._jdf.queryExecution().toRdd().toDebugString()
