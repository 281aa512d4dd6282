import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsloom.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_pieces(rows):
    tok = Tokenizer.from_file(PATH)
    out = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        at, k = 0, 0
        while at < len(ids):
            part = ids[at : at + (1024 if k else first)]
            out.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            at, k = at + len(part), k + 1
    return Counter(out)


def check(df):
    got = P.pack_documents(df).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces([(r.doc_id, r.text) for r in df.collect()])
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    return len(bins), -(-total // 1024)


def test_odd_rows(odd):
    check(odd)


def test_empty_table(empty):
    assert P.pack_documents(empty).count() == 0


def test_table_packs_tightly(small):
    bins, least = check(small)
    assert bins <= least * 1.02 + 1


@given(st.lists(st.text(alphabet=st.sampled_from(list("ab 's'\n\t1éß×東\u0085\u001c.<|>")), max_size=30), max_size=5))
@settings(max_examples=200, deadline=None)
def test_cut_texts_encode_alike(texts):
    tok = Tokenizer.from_file(PATH)
    assert P.encode_texts(texts, PATH) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
@settings(deadline=None)
def test_plan_uses_every_piece_once(histogram):
    used = Counter()
    for lengths, repeats in P.plan_bins(histogram, 64):
        assert sum(lengths) <= 64 and repeats > 0
        for x in lengths:
            used[x] += repeats
    assert used == Counter(histogram)


def best_two_fit_by_hand(lengths, capacity):
    """The method piece by piece: the bins, each as sorted lengths."""
    left, bins = sorted(lengths), []
    while left:
        own, gap = [], capacity
        for x in reversed(list(left)):
            if x <= gap:
                own.append(x)
                left.remove(x)
                gap -= x
        if gap and len(own) > 1:
            room = gap + own[-1]
            pairs = [(a + b, -a, -b) for i, a in enumerate(left) for b in left[:i] if own[-1] < a + b <= room]
            if pairs:
                _, a, b = max(pairs)
                left = sorted([*left, own.pop()])
                for x in (-a, -b):
                    left.remove(x)
                    own.append(x)
        bins.append(tuple(sorted(own)))
    return bins


@given(st.lists(st.integers(1, 40), max_size=40))
@settings(max_examples=300, deadline=None)
def test_plan_fills_bins_as_tightly_as_piece_by_piece(lengths):
    plan = [tuple(sorted(b)) for b, times in P.plan_bins(Counter(lengths), 40) for _ in range(times)]
    by_hand = best_two_fit_by_hand(lengths, 40)
    assert Counter(x for b in plan for x in b) == Counter(x for b in by_hand for x in b)
    if plan:
        assert sum(plan[0]) == sum(by_hand[0])
    assert abs(len(plan) - len(by_hand)) <= 1


def test_slots_over_partitions(spark):
    rng = np.random.default_rng(3)
    sizes = [1024] * 400 + rng.integers(1, 1025, 600).tolist()
    rows = spark.createDataFrame([(k, int(n)) for k, n in enumerate(sizes)], "doc_id long, length long").repartition(7)
    got = P.best_two_fit(rows).collect()
    assert Counter((r.doc_id, r.length) for r in got) == Counter(enumerate(sizes))
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    plan = Counter(tuple(b) for b, times in P.plan_bins(Counter(sizes), 1024) for _ in range(times))
    assert Counter(tuple(n for _, n in sorted(b)) for b in bins.values()) == plan


def test_lean_tasks_leave_no_caches(spark, small):
    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, P._tokenizer(PATH)[1:]))] * b.num_rows, pa.int64())], names=["held"])

    want = Counter(tuple(r) for r in P.pack_documents(small).collect())
    assert Counter(tuple(r) for r in P.pack_documents(small, lean=True).collect()) == want
    for _ in range(3):  # workers take turns
        P.token_pieces(small.repartition(16), PATH, free=True).count()
    assert spark.range(64, numPartitions=16).mapInArrow(held, "held long").agg({"held": "max"}).first()[0] == 0
