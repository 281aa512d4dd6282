import hashlib
import unicodedata

from newsloom.llm import fingerprints as P


def canon(t):
    t = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold())
    return " ".join(t.split())


def check(df):
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect() if r.doc_id is not None), key=lambda r: -r[0])
    nulls = [r.text or "" for r in df.collect() if r.doc_id is None]
    rows += [(None, t) for t in nulls]
    want, size = {}, {}
    for _, t in rows:
        size[canon(t)] = size.get(canon(t), 0) + 1
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        edited = t[: len(t) - h] + after[:h]
        want.setdefault(i, set()).add((len(t), hashlib.sha256(edited.encode()).hexdigest(), float(canon(t) == canon(edited)), float(canon(t) == canon(after)), size[canon(t)]))
    got = P.edited_likeness(df).collect()
    assert len(got) == len(rows)
    marks = {}
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.class_size) in want[r.doc_id]
        marks.setdefault(r.doc_id, set()).add(r.fingerprint)
    for i, t in rows:
        assert P.digest(P.canonical(t)) in marks[i]


def test_odd_rows(odd):
    check(odd)


def test_empty_table(empty):
    assert P.edited_likeness(empty).count() == 0


def test_one_row(spark):
    check(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string"))


def test_table(small):
    check(small.repartition(5))


def test_canonical_folds():
    assert P.canonical("  ﬁne  Straße\nÉ") == P.canonical("FINE strasse é") == "fine strasse é"


def test_ids_that_are_texts_and_repeated_rows(spark):
    rows = [(f"id-number-{k:03d}", f"text {k % 7}") for k in range(60)] + [("id-number-007", "text 0"), (None, "x"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    got = P.edited_likeness(df).collect()
    ordered = sorted((r for r in rows if r[0]), key=lambda r: r[0], reverse=True)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for (i, t), (_, after) in zip(ordered[:40], ordered[1:41]):
        assert by[i].edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()
    assert by[None].class_size == 2 and by["id-number-007"].near_next in (0.0, 1.0)
