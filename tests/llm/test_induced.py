import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import induced as I


def check(text, cap, memory=1 << 20):
    text = np.asarray(text, np.int64)
    parts = list(I.suffix_buckets(text, cap, memory))[::-1]
    at = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, int)
    lcp = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, int)
    assert sorted(at.tolist()) == list(range(len(text)))
    suffix = [tuple(text[i : i + cap].tolist()) for i in at]
    assert suffix == sorted(suffix)
    for k in range(1, len(at)):
        a, b = suffix[k - 1], suffix[k]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == n, (k, lcp[k], n)


@given(st.lists(st.integers(0, 3), max_size=60), st.sampled_from([1, 2, 5, 8, 100]))
@settings(max_examples=600, deadline=None)
def test_small_alphabets(text, cap):
    check(text, cap)


@given(st.lists(st.integers(0, 255), max_size=80))
@settings(max_examples=150, deadline=None)
def test_bytes_with_queues_on_disk(text):
    check(text * 2, 20, memory=64)


def test_repeats_and_runs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 5, 300)
    check(np.concatenate([base, [9], base, [9] * 70, base[50:250], [1] * 90]), 100)
    check(np.tile([1, 2, 3], 200), 50)
    check(np.zeros(300, int), 50)


def test_a_long_run_takes_few_turns():
    rng = np.random.default_rng(1)
    check(np.concatenate([rng.integers(0, 3, 50), [1] * 2000, rng.integers(0, 3, 50), [1] * 700, [2] * 900, [0]]), 40)
    text = np.full(2_000_000, 7, np.uint16)
    assert sum(len(at) for at, _ in I.suffix_buckets(text, 400)) == len(text)
