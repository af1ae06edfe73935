"""The conversation trie against a plain dictionary of all beginnings."""

import hashlib
import math
import random
import re
import zlib

import pytest

from sheetloom.llm import conv_trie as C


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append(((turn is not None, turn or 0), key, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    convs = {c: [t[1:] for t in sorted(turns)] for c, turns in convs.items()}
    nodes, children = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(k for k, _ in path[:d]), []).append((c, path[d - 1][1] if d else 0, len(path) == d))
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = (len(nodes[p]) - 1) * nodes[p][0][1] + sum(saved[q] for q in below)
    return [(min(m)[0], len(p), min(nodes[p[:-1]])[0] if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(c for c, _, end in m if end))).encode()).hexdigest()) for p, m in nodes.items()]


def many(rng, conversations, turns, texts):
    return [(c, t, rng.choice(["user", "assistant"]), f"w{rng.randrange(texts)} x") for c in range(conversations) for t in range(rng.randint(1, turns))]


# a splitter for every few turns; segments of three turns make slabs many levels deep
@pytest.mark.parametrize("segment,shard_turns", [(64, 100_000), (64, 9), (3, 25)])
def test_like_a_dictionary(spark, monkeypatch, segment, shard_turns):
    monkeypatch.setattr(C, "SEGMENT", segment)
    monkeypatch.setattr(C, "STRETCH", 16)
    rng = random.Random(2)
    rows = many(rng, 120, 5, 2) + [(c, t, "user", "same first words") for c in range(200, 260) for t in range(rng.randint(1, 14))]
    rows += [(None, 1, "user", "x"), (-7, 0, None, None), (-7, None, "user", "a"), (-45, 0, "user", "w0 x"), (-40, 0, "user", "w0 x"), (500, 1, "user", "b"),
             (500, 1, "user", "b"), (500, 1, "user", ""), (41, 0, "user", "only"), (600, 0, "user", "word " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn int, role string, text string, key int, path string")
    got = C.trie(C.rebuilt(df), shard_turns).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, plain(rows)))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert C.trie(C.rebuilt(df)).count() == 0


def test_long_conversation_of_equal_turns(spark):
    rows = [(1, t, "user", "a") for t in range(700)] + [(2, t, "user", "a") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert sorted(repr(tuple(r)) for r in C.trie(C.rebuilt(df)).collect()) == sorted(map(repr, plain(rows)))
