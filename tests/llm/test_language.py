import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import language as L

MIXED = ["Ünïted wörld, straße 東京タワー and привет_мир 12 x", "", "!!! 123", "été नमस्ते दुनिया", "́a", "καλημέρα κόσμε", "aa Bb aa"]


def slow_words(text):
    script = L._characters()[0]
    out, last = [], 0
    for i, ch in enumerate(text):
        s = int(script[ord(ch)])
        if s == 255:
            s = last
        assert (s > 0) == (ch.isalpha() or (last > 0 and unicodedata.category(ch)[0] == "M"))
        if s and s == last:
            out[-1][1] = i + 1
        elif s:
            out.append([i, i + 1, s])
        last = s
    return out


def slow_path(score, prior, switch):
    n, k = score.shape
    at, back = prior + score[0], []
    for t in range(1, n):
        move = at[:, None] - switch * (1 - np.eye(k))
        back.append(move.argmax(0))
        at = move.max(0) + score[t]
    path = [int(at.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], float(at.max())


def value(path, score, prior, switch):
    return prior[path[0]] + sum(score[t, p] for t, p in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:], strict=False))


def model(langs=("a", "b", "c"), seed=0):
    rng = np.random.default_rng(seed)
    tables = [np.vstack([rng.normal(-9, 1, (L.BUCKETS, len(langs))), np.zeros((1, len(langs)))]).astype(np.float32) for _ in L.ORDERS]
    writes = np.zeros((L.N_SCRIPTS + 1, len(langs)), bool)
    writes[1, :2] = writes[3, 2:] = True
    return L.LanguageModel(list(langs), tables, writes, np.log(np.full(len(langs), 1 / len(langs))).astype(np.float32))


def test_words_of_one_script():
    w = L.words(MIXED)
    got = [(o, int(s - w.text_start[o]), int(e - w.text_start[o]), int(k)) for o, s, e, k in zip(w.owner, w.start, w.end, w.script, strict=True)]
    assert got == [(i, *x) for i, t in enumerate(MIXED) for x in slow_words(t)]
    assert len(L.words([]).start) == 0


@pytest.mark.parametrize("piece", [L.SLICE, 7])
def test_word_scores_are_those_of_their_ngrams(monkeypatch, piece):
    monkeypatch.setattr(L, "SLICE", piece)
    m, w = model(), L.words(MIXED)
    got = m.scores(w)
    for k, (s, e) in enumerate(zip(w.start, w.end, strict=True)):
        z = [0, *(int(L._characters()[1][c]) for c in w.codes[s:e]), 0]
        want = np.zeros(3)
        for table, order in zip(m.tables, L.ORDERS, strict=True):
            for i in range(len(z) - order + 1):
                h = z[i]
                for c in z[i + 1 : i + order]:
                    h = (h * 0x01000193 ^ c) % 2**32
                want += table[(h * 0x9E3779B1) % 2**32 >> 32 - L.BITS]
        allowed = m.writes[w.script[k]] if m.writes[w.script[k]].any() else np.ones(3, bool)
        assert np.allclose(got[k][allowed], want[allowed] / len(L.ORDERS), rtol=1e-4)
        assert (got[k][~allowed] == L.OUTSIDE).all()


@pytest.mark.parametrize("langs", [1, 2, 4])
def test_path_is_the_best_of_all(langs):
    rng = np.random.default_rng(langs)
    m = model(tuple("abcd"[:langs]))
    m.prior = rng.normal(0, 1, langs).astype(np.float32)
    sizes = rng.integers(1, 40, 120)
    owner = np.repeat(np.cumsum(rng.integers(1, 3, 120)), sizes)
    lean = np.repeat(rng.normal(0, 1, (120, langs)), sizes, axis=0)  # texts of one language, and of several
    score = (lean * rng.choice([0, 2], len(owner))[:, None] + rng.normal(0, 1.5, (len(owner), langs))).astype(np.float32)
    score[rng.random(score.shape) < 0.02] = -40
    label = m.path(score, owner, 3.0)
    walked = 0
    for t in np.unique(owner):
        own = owner == t
        best, top = slow_path(score[own].astype(float), m.prior.astype(float), 3.0)
        assert abs(value(label[own], score[own].astype(float), m.prior, 3.0) - top) < 1e-2
        walked += len(set(best)) > 1
    assert langs == 1 or 0 < walked < 120


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in L.documents(spark, d).collect()}
    got = L.op11_language_id(spark, d).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in got if r.held_out]) > 0.98


def test_spans_of_mixed_texts(spark):
    d = "/root/testdata/sf0.01"
    docs = L.documents(spark, d)
    m = L.fit_languages(docs)
    own = {lang: docs.where(f"lang = '{lang}' AND n_chars > 400").orderBy("doc_id").first().text[:300] for lang in ("en", "fr", "de")}
    text = "\n".join(own[x] for x in ("en", "fr", "en", "de"))
    r = L.label_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), m).first()
    assert [s.lang for s in r.spans] == ["en", "fr", "en", "de"] and r.lang_pred == "en" and r.score < 0.9
    for k, s in enumerate(r.spans):
        assert abs(s.start - 301 * k) < 40 and abs(s.end - 301 * (k + 1)) < 40
    pieces = [text[s.start : s.end] for s in r.spans]
    assert sum(map(len, pieces)) > len(text) - 40


def test_scripts_narrow(spark):
    rows = [("ru", "привет мир это русский текст"), ("el", "καλημέρα κόσμε αυτό είναι κείμενο"), ("en", "hello world this is a text")]
    docs = spark.createDataFrame([(i, rows[i % 3][1], rows[i % 3][0]) for i in range(1, 60)], "doc_id long, text string, lang string")
    m = L.fit_languages(docs)
    ask = spark.createDataFrame([(1, "неизвестное слово"), (2, "ξένη λέξη"), (3, "foreign word"), (4, "שלום"), (5, "42 - 17")], "doc_id long, text string")
    got = {r.doc_id: r for r in L.label_languages(ask, m).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 5)] == ["ru", "el", "en", "und"]
    assert got[4].lang_pred in m.langs and got[5].score == 0 and got[5].spans == []


def test_odd_rows(odd, empty, spark):
    odd = odd.withColumn("lang_pred", F.lit("clash"))
    m = L.fit_languages(odd)
    assert m.langs == ["en", "fr"]
    got = L.label_languages(odd, m).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {"und"}
    same = [(r.lang_pred, r.score) for r in got if r.doc_id in (7, 8)]
    assert same[0] == same[1]
    none = L.fit_languages(empty)
    assert {(r.lang_pred, r.score) for r in L.label_languages(odd, none).collect()} == {("und", 0.0)}
    assert L.label_languages(empty, m).count() == 0
    again = L.fit_languages(odd, per_lang=1)
    assert again.langs == ["en", "fr"]
