import random

from newsloom.llm import packing as K


def test_words_in_lines_have_the_ids_that_they_have_alone():
    import public_tokenizers

    tok = K._tokenizer(public_tokenizers.path("byte_bpe_50k.json"))[0]
    rng = random.Random(5)
    words = [rng.choice(["", " "]) + "".join(rng.choice("abé東😀'.,19Ā") for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    words += ["'s", " 's", "​", "x" * 300]
    assert all(K._WORD.fullmatch(w) for w in words) and not K._WORD.fullmatch(" \n") and not K._WORD.fullmatch("a b")
    assert K._word_ids(tok, words) == K._ids(tok, words)
    assert K._word_ids(tok, []) == []


def test_plain_tokens_take_the_model_alone(monkeypatch):
    """The tokenizer's own cutting is left for texts that our pattern doesn't cover."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, real, cut = Tokenizer.from_file(path), K._ids, []
    text = "Straße isn't über\nder 42 &&& lines,\nça va."
    odd = "x 東京 \x1c\x7f ok"
    want = [real(tok, [t])[0] for t in (text, odd)]
    monkeypatch.setattr(K, "_ids", lambda tok, chunks: cut.extend(chunks) or real(tok, chunks))
    monkeypatch.setattr(K, "_word_ids", lambda tok, words: cut.extend(words) or real(tok, words))
    for cache in K._caches:
        cache.clear()
    assert K.encode_texts([text], path) == want[:1]
    assert cut == ["\n"]  # before, every new token went there
    assert K.encode_texts([text, odd], path) == want
    assert " 東京" in cut


def test_a_full_cache_is_emptied_without_loss(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, rng = Tokenizer.from_file(path), random.Random(7)
    monkeypatch.setattr(K, "CACHED", 60)
    word = lambda: "".join(rng.choice("abcdé東'.,\n") for _ in range(rng.randint(1, 5)))
    for _ in range(40):
        texts = [" ".join(word() for _ in range(30)).strip() for _ in range(4)]
        assert K.encode_texts(texts, path) == [K._ids(tok, [t])[0] for t in texts]
