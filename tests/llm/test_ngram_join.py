"""The n-gram join against comparing all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from sheetloom.llm import ngram_join as J
from sheetloom.llm.components import components


def plain_set(text, size=3):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(docs, percent, size=3):
    """doc number -> (shingles, smallest id reachable, links)."""
    sets = [plain_set(t, size) for _, t in docs]
    near = {k: set() for k in range(len(docs))}
    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
    out = []
    for k, (i, _) in enumerate(docs):
        seen, todo = {k}, [k]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        out.append((i, len(sets[k]), min((docs[x][0] for x in seen if docs[x][0] is not None), default=None), len(near[k])))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    docs = []
    shared = " ".join(rng.choice(words) for _ in range(12))
    for i in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(1, 70))]
        for k in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append((100 * i + k, rng.choice([" ", "\n", "\t "]).join(copy) + (" " + shared if i % 3 == 0 else "")))
    rng.shuffle(docs)
    docs += [(7, None), (8, ""), (9, " \n"), (10, "one"), (11, "ONE"), (12, "one two"), (13, "two one"), (None, docs[0][1]), (None, "text of no id"), (None, "text of no id"), docs[1], (docs[2][0], "w1 w2 w3 w4")]
    return docs


@pytest.mark.parametrize("seed,percent,block", [(1, 90, 1_024), (2, 70, 2), (3, 80, 3)])
def test_like_all_pairs(spark, monkeypatch, seed, percent, block):
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, class string, n long")
    got = J.link_classes(df, percent=percent).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got], key=str) == plain(docs, percent)


def test_keep_one(spark):
    docs = corpus(5)
    df = spark.createDataFrame([(i, t, k, "c") for k, (i, t) in enumerate(docs)], "doc_id long, text string, mark int, cell string")
    kept = [(r["doc_id"], r["text"]) for r in J.keep_one(df).collect()]
    assert J.keep_one(df).columns == df.columns
    want = plain(docs, 90)
    groups = {c for _, n, c, _ in want if n}  # null: the two rows that are like each other only
    alone = [d for d in docs if not plain_set(d[1])]
    assert len(kept) == len(groups) + len(alone) and kept.count((None, "text of no id")) == 1
    assert {i for i, t in kept if plain_set(t)} >= groups
    assert J.keep_one(df.limit(0)).count() == 0


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(8)
    base = [str(rng.randint(0, 10_000)) for _ in range(60_000)]
    other = list(base)
    other[30_000] = "x"
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(base[:40_000]))], "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in J.link_classes(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert J.link_classes(df.limit(0)).count() == 0


def test_prefixes_meet_under_every_order():
    rng, counts = np.random.default_rng(0), np.random.default_rng(1).integers(0, 1_000, 1 << J.BUCKET_BITS)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 200), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.04], rng.integers(0, 2**63, 2, dtype=np.uint64)]))
        if J.linked(a, b):
            for order in "ABC":
                assert set(J.first_tokens(a, counts, order).tolist()) & set(J.first_tokens(b, counts, order).tolist())
            both = len(np.intersect1d(a, b))
            assert J.least_common(len(a), len(b)) <= both
            assert J.most_common(*(np.frombuffer(J.histogram(x), np.uint8)[None] for x in (a, b)))[0] >= both


def test_histograms_of_long_and_short_sets():
    a = np.arange(8_200, dtype=np.uint64) * np.uint64(7)
    cells = [np.frombuffer(J.histogram(x), np.uint8) for x in (a, a[20:])]
    assert [len(c) for c in cells] == [512, 256]
    assert J.most_common(cells[0][None], cells[1][None])[0] >= len(a) - 20
    assert J.histogram(np.zeros(300, np.uint64)) is None


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).select("v", "root").collect())
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 140)}}
