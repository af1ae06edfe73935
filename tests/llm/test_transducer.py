"""The transducer against the library, and its lookahead against all continuations."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sheetloom.llm import transducer as X
from sheetloom.llm.token_counts import _SETTLED


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def both(request):
    path = public_tokenizers.path(request.param)
    return X.vocabulary(path), Tokenizer.from_file(path)


def ids_of(of, text):
    return np.frombuffer(b"".join(of.encode(text)), "<u4").tolist()


def same(of, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(of, text) == want, text[:80]
    assert "".join(X.decode(of, np.array(want, np.uint32))) == library.decode(want, skip_special_tokens=False)


def test_like_the_library(both):
    rng = random.Random(3)
    texts = ["", "Hello World's cAfé é ΣΑΣ İ ǅ <|endoftext|> x<|startoftext|>y ", "a" * 9_000, "aB" * 3_000 + " " + "ab" * 700, "ééé" * 900, "thethe" * 2_000,
             "日本語テスト ひらがな " * 50, "ẞ ﬁ ؀ \x1c\x85\xa0a  b\n\n", "!?" * 3_000, "12 345" * 30, "😀😀 x", "plain words and so on " * 9_000, "x " + "́" * 5]
    texts += ["".join(rng.choice("aeinthrs") for _ in range(5_000)) for _ in range(3)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0x600), 32, rng.randrange(0x2000, 0x3200)])) for _ in range(300)) for _ in range(100)]
    for text in texts:
        same(*both, text)


def test_every_settled_character(both):
    of, library = both
    for first, last in _SETTLED:
        text = " ".join(f"a{chr(c)}b 1{chr(c)}2!{chr(c)}!" for c in range(first, last + 1))
        for at in range(0, len(text), 4_000):
            same(of, library, text[at:at + 4_000])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "n", "an", "the", "in", "ing", "er", "aa", "-", "é"]), min_size=1, max_size=40), st.integers(1, 60))
def test_tokens_before_the_lookahead_are_final(parts, times):
    of = X.vocabulary(X.default_path())
    letters = ("".join(parts) * times).encode()
    whole, end, ends = of.merged(letters, True), 0, set()
    for _, size in whole:
        end += size
        ends.add(end)
    for n in {len(letters) // 2, len(letters) - 1} - {0}:
        end = 0
        for _, size in of.merged(letters[:n], False):
            end += size
            if end > n - 1 - of.lookahead:
                break
            assert end in ends


def test_window_is_bounded_and_portions_do_not_matter():
    of = X.vocabulary(X.default_path())
    rng = random.Random(8)
    word = "".join(rng.choice(["a", "an", "in", "th", "e"]) for _ in range(30_000)).encode()
    whole = [t for t, _ in of.merged(word, True)]
    for portion in (1_000, 7_777, len(word)):
        machine, out, held = X.Transducer(of), [], 0
        for at in range(0, len(word), portion):
            out += machine.feed(word[at:at + portion])
            held = max(held, len(machine.held))
        assert out + machine.finish() == whole and held < of.window


def test_decoder_takes_any_portions():
    of = X.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))  # its tokens end inside characters
    ids = np.array(ids_of(of, "日本語 😀 é " * 40), np.uint32)
    for portion in (1, 3, 50):
        machine = X.Decoder(of)
        assert "".join(machine.feed(ids[at:at + portion]) for at in range(0, len(ids), portion)) + machine.finish() == "日本語 😀 é " * 40


def test_lookahead_of_small_lists():
    assert X.sufficient_lookahead([("a", "b")]) == 1
    # b c may wait for d, and then a b for c
    assert X.sufficient_lookahead([("c", "d"), ("b", "c"), ("a", "b")]) == 3
    with pytest.raises(ValueError):
        X.sufficient_lookahead([("ab", "c"), ("a", "b")])


def test_rows(spark):
    of, library = X.vocabulary(X.default_path()), Tokenizer.from_file(X.default_path())
    texts = [(1, "One two"), (1, "One two"), (2, None), (3, ""), (None, "<|endoftext|>"), (4, "ab " * 60_000 + "x" * 50_000)]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in texts], "doc_id long, text string, bpe string, n_tokens int")
    for keep in (True, False):
        got = X.encode_and_decode(df, keep=keep).collect()
        assert len(got) == len(texts)
        for r in got:
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            assert (r["n_tokens"], r["bpe"]["n_tokens"]) == (5, len(ids))
            assert r["bpe"]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r["bpe"]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert (r["bpe"]["ids"], r["bpe"]["decoded"]) == ((ids, text) if keep else (None, None))
    assert X.encode_and_decode(df.limit(0)).count() == 0 and len(of.words) <= X.KEPT_WORDS
