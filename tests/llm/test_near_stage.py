"""The pipeline's near-duplicate stage: sets of five-word shingles at a similarity of 0.8."""

import random
from itertools import combinations

import corpus_pipeline


def five_words(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def kept_ids(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(r["doc_id"] for r in corpus_pipeline.one_of_each(spark, df, "").collect())


def edited(words, places):
    return " ".join("changed" if i in places else w for i, w in enumerate(words))


def test_copy_with_two_edits_goes(spark):
    words = [f"w{i}" for i in range(100)]
    # 86 of 106 five-word shingles are shared, but only 92 of 104 three-word ones; three edits leave 81 of 111
    assert kept_ids(spark, [(1, " ".join(words)), (2, edited(words, {30, 60}))]) == [1]
    assert kept_ids(spark, [(1, " ".join(words)), (2, edited(words, {30, 50, 70}))]) == [1, 2]


def test_like_all_pairs_of_five_words(spark):
    rng, docs = random.Random(5), []
    for i in range(15):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 150))]
        docs += [(10 * i + k, edited(base, set(rng.sample(range(len(base)), k)))) for k in range(5)]
    sets, root = {i: five_words(t) for i, t in docs}, {i: i for i, _ in docs}
    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert kept_ids(spark, docs) == sorted(set(root.values()))
