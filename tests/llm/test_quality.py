import numpy as np

from newsloom.llm import quality as Q


def test_chunks_cover_whole_texts():
    for n in (0, 1, 4, 511, 512, 513, 1020, 1021, 5000):
        text = (np.arange(n) % 251).astype(np.uint8).tobytes()
        chunks, starts = Q.chunked([text, b"x"])
        rebuilt = np.concatenate([c[: Q.STEP] for c in chunks[: starts[1]]] + [chunks[starts[1] - 1][Q.STEP :]])
        assert rebuilt[:n].astype(np.uint8).tobytes() == text and (rebuilt[n:] == Q.PAD).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in Q.op7_quality_classifier(spark, d).collect()}
    assert len(scored) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored.values())
    labels = [r for r in spark.read.parquet(f"{d}/labels.parquet").collect() if scored[r.doc_id].held_out]
    good = [scored[r.doc_id].score for r in labels if r.quality == 1]
    bad = [scored[r.doc_id].score for r in labels if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([scored[r.doc_id].predicted == r.quality for r in labels]) > 0.9


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, None, 1), (None, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    model = Q.fit_quality(odd, labels, epochs=2)
    got = Q.score_quality(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert Q.score_quality(empty, model).count() == 0
    none = Q.fit_quality(odd, labels.where("false"))
    assert {r.score for r in Q.score_quality(odd, none).collect()} == {0.5}


def slow_score(m, text):
    """One text through the network window by window, as the docstring has it."""
    n = max(1, -(-(len(text) - Q.STRIDE) // Q.STEP))
    padded = [*text, *[Q.PAD] * (Q.STEP * n + Q.STRIDE - len(text))]
    filters = np.concatenate([m.near, m.far])  # WIDTH bytes of EMBED numbers
    pools = []
    for c in range(n):
        chunk = padded[c * Q.STEP : c * Q.STEP + Q.CHUNK]
        windows = [np.concatenate([m.embed[b] for b in chunk[at : at + Q.WIDTH]]) @ filters + m.bias for at in range(0, Q.CHUNK - Q.WIDTH + 1, Q.STRIDE)]
        pools.append(np.maximum(np.max(windows, axis=0), 0))
    logit = float(np.concatenate([np.max(pools, axis=0), np.mean(pools, axis=0)]) @ m.out) + m.shift
    return 1 / (1 + np.exp(-logit))


def test_scores_equal_a_slow_forward_pass():
    rng = np.random.default_rng(1)
    shape = (Q.STRIDE * Q.EMBED, Q.FILTERS)
    m = Q.QualityModel(rng.normal(0, 0.5, (257, Q.EMBED)), rng.normal(0, 0.2, shape), rng.normal(0, 0.2, shape), rng.normal(0, 0.1, Q.FILTERS), rng.normal(0, 0.1, 2 * Q.FILTERS), 0.3)
    m.embed[Q.PAD] = 0
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 5, 511, 512, 513, 1020, 1021, 1600)]
    assert np.allclose(m.scores(texts), [slow_score(m, t) for t in texts], atol=1e-6)
    assert np.allclose(m.scores(texts * 10)[: len(texts)], m.scores(texts))


def test_training_lowers_the_loss_and_finds_what_marks_a_class():
    rng = np.random.default_rng(2)
    noise = lambda: bytes(rng.integers(97, 123, int(rng.integers(20, 900))).astype(np.uint8))
    marked = lambda: noise() + b" !!BAD!! " + noise()
    texts, labels = [marked() if i % 2 else noise() for i in range(200)], np.array([float(i % 2) for i in range(200)], np.float32)
    loss = lambda m: float(-np.mean(np.log(np.clip(np.where(labels == 1, p := m.scores(texts), 1 - p), 1e-9, 1))))
    before, after = loss(Q.train(texts, labels, 0.5, epochs=0)), loss(Q.train(texts, labels, 0.5, epochs=25))
    assert after < 0.3 * before
    fresh = Q.train(texts, labels, 0.5, epochs=25).scores([marked() for _ in range(30)] + [noise() for _ in range(30)])
    assert (fresh[:30] > 0.5).mean() > 0.9 and (fresh[30:] < 0.5).mean() > 0.9
