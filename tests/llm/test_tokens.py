"""Prefix counts against the library, and the piece lattice against listing all paths."""

import random
import re

import pytest
import sentencepiece
from tokenizers import Tokenizer

from sheetloom.llm import pieces as P
from sheetloom.llm import token_counts as C

PARTS = ["the ", "a", "'s", "'re", "'l", "'", "!", " ", "  ", "\n", "é", "ß", "中", "1", "23", "<|endoftext|>", "<|end", "|>", "\t", "\u00a0",
         "don't", "x", "😀", "loser", "\x1c", "\x85", " .", "''ve", "\u0558", "\u2028"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(C.default_path())
    return lambda s: len(tokenizer.encode(s, add_special_tokens=False).ids)


def test_every_prefix(library):
    rng, dp = random.Random(3), C.counter(C.default_path())
    for _ in range(600):
        text, budget = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))), rng.randint(0, 9)
        want = [library(text[:i + 1]) for i in range(len(text))]
        assert dp.prefixes(text) == want, repr(text)
        assert dp.total(text) == library(text)
        assert dp.count_and_fit(text, budget) == (library(text), max((i + 1 for i, c in enumerate(want) if c <= budget), default=0))


def test_settled_characters_are_cut_like_the_library_does():
    for first, last in C._SETTLED:
        for i in range(first, last + 1, 1 if last < 0x4000 else 37):
            text = f"a{chr(i)}b 1{chr(i)}2 {chr(i)}"
            assert [text[a:b] for _, (a, b) in C.counter(C.default_path()).library.pre_tokenize_str(text)] == C._PIECES.findall(text)


def test_rows_and_stored_counts(spark, library):
    texts = [None, "", "plain words here", "x" * 5_000, "é" * 300, "word " * 4_000, "plain words here", "<|endoftext|>" * 3]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, tokens string")
    for r in C.count_tokens(df, limit=3, store=True).collect():
        text, found = r["text"] or "", r["tokens"]
        assert (found["n_bytes"], found["n_tokens"]) == (len(text.encode()), library(text))
        assert library(text[:found["fitting_chars"]]) <= 3
        assert C.stored_fit(bytes(found["prefix_counts"]), 3) == found["fitting_chars"]
        for cut in (0, 1, len(text) // 2, len(text)):
            if cut <= len(text):
                assert C.stored_count(bytes(found["prefix_counts"]), cut) == library(text[:cut])
    assert C.count_tokens(df.limit(0)).count() == 0


def all_paths(model, names, segment):
    score = {n: model.ending.get(n)[2] for n in names}
    found = []

    def walk(at, total, ids):
        if at == len(segment):
            found.append((total, tuple(ids)))
            return
        for i, n in enumerate(names):
            if segment.startswith(n, at):
                walk(at + len(n), total + score[n], [*ids, i])
        if segment[at] not in model.single:
            walk(at + 1, total + model.unknown_score, ids + model.unknown(segment[at]))

    walk(0, 0.0, [])
    return found


def test_n_best_like_listing_all_paths():
    rng = random.Random(1)
    for k in range(300):
        names = sorted({"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 3))) for _ in range(8)})
        if k % 2:
            names = [n for n in names if P.SPACE not in n.lstrip(P.SPACE)] or ["a"]
        model = P.Lattice(pieces=[(n, -float(rng.randint(1, 6))) for n in names])
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 7)))
        paths = all_paths(model, names, P.SPACE + text.replace(" ", P.SPACE))
        ids, score, others = model.encode(text, 5)
        got = [(score, tuple(ids.tolist())), *((s, tuple(P.edited(ids.tolist(), e))) for s, e in others)]
        assert [g[0] for g in got] == pytest.approx(sorted((p[0] for p in paths), reverse=True)[:5])
        left = [(round(s, 6), i) for s, i in paths]
        for s, i in got:
            left.remove((round(s, 6), i))


def test_cuts_lose_nothing():
    cut, whole, rng = P.Lattice(P.default_path()), P.Lattice(P.default_path()), random.Random(0)
    whole.segments = re.compile(".+", re.DOTALL)
    for _ in range(200):
        text = "".join(rng.choice(["is", "m²", ".", ",", "(", ")", "'s", "don't", " ", "  ", "é", "x", "1", ":", "\n", "...", "²."]) for _ in range(rng.randint(1, 9)))
        (_, a, x), (_, b, y) = cut.encode(text), whole.encode(text)
        assert (a, [s for s, _ in x]) == (b, [s for s, _ in y]), repr(text)


def test_pieces_of_rows(spark):
    texts = [None, "", " lead and trail ", "two  spaces\nline", "é中😀\x00", "word " * 3_000, "zzz" * 200, "same", "same"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, pieces string")
    rows = P.decode(P.encode(df).selectExpr("doc_id", "text", "pieces.*"), "ids").orderBy("doc_id").collect()
    assert [r["decoded"]["text"] for r in rows] == [t or "" for t in texts]
    names = sentencepiece.SentencePieceProcessor(model_file=P.default_path())
    for r in rows:
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"]) and all(0 <= i < names.get_piece_size() for i in r["ids"])
        scores = [r["score"], *(a["score"] for a in r["alternatives"])]
        assert scores == sorted(scores, reverse=True)
        seen = {tuple(r["ids"])}
        for a in r["alternatives"]:
            other = P.edited(r["ids"], [e.asDict() for e in a["edits"]])
            assert P.lattice(P.default_path()).decode(other) == r["text"]
            seen.add(tuple(other))
        assert len(seen) == len(scores) or "\x00" in r["text"]
    assert P.encode(df.limit(0)).count() == 0
