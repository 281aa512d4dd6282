import re
from collections import Counter

import corpus_pipeline as P
from newsloom.llm import jaccard, mixing, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_stages_on_a_table(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    kept = {}
    for name, stage in P.STAGES[:-1]:
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == COLUMNS
        kept[name] = docs.collect()
    model = quality.fit_quality(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    ids = list(given)
    scores = dict(zip(ids, model.scores([given[i].text.encode() for i in ids]), strict=True))
    assert sorted(r.doc_id for r in kept["quality"]) == sorted(i for i in ids if scores[i] >= 0.3)
    best = {}
    for r in sorted(kept["quality"], key=lambda r: (-len(r.text), r.doc_id)):
        best.setdefault(norm(r.text), r.doc_id)
    assert sorted(r.doc_id for r in kept["exact_dedup"]) == sorted(best.values())
    near = kept["near_duplicates"]
    grams = [set(jaccard.shingles(r.text).tolist()) for r in near]
    left = {r.doc_id for r in near}
    assert left <= set(best.values())
    for k, a in enumerate(grams):
        for b in grams[:k]:
            assert not a or len(a & b) / len(a | b) < 0.8
    dropped = [r for r in kept["exact_dedup"] if r.doc_id not in left]
    everything = {r.doc_id: set(jaccard.shingles(r.text).tolist()) for r in kept["exact_dedup"]}
    for r in dropped:
        a = everything[r.doc_id]
        assert not a or any(i != r.doc_id and len(a & b) / len(a | b) >= 0.8 for i, b in everything.items())
    sizes = {r.doc_id: len(re.findall(mixing.WORD, r.text)) for r in near}
    taken = Counter()
    for r in kept["mix"]:
        taken[r.doc_id] += len(re.findall(mixing.WORD, r.text))
        assert r.n_chars == len(r.text)
    assert set(taken) <= left and all(n <= 2 * sizes[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.03 * sum(sizes.values())
    packed = P.pack(spark, docs, d).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in kept["mix"])


def test_stages_on_odd_and_empty_rows(spark, odd, empty):
    d = "/root/testdata/sf0.001"
    for docs in (odd, empty):
        for _, stage in P.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, d)
            assert docs.columns == columns
        assert P.pack(spark, docs, d).count() >= 0


def test_dedup_keeps_texts_that_share_an_id(spark):
    rows = [(None, "one text of its own here"), (None, "and quite another text here"), (3, "third"), (3, "fourth"), (3, "fourth "), (4, "fourth")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    first = P.keep_first_copies(spark, docs, "")
    assert sorted(r.text for r in first.collect()) == ["and quite another text here", "fourth ", "one text of its own here", "third"]
    assert P.keep_one_of_near_copies(spark, first, "").count() == 4
