"""Toxicity scores by weak supervision.

1. *Voters.* Words and word beginnings that stand out in the toxic rows of a labelled sample are dealt
   into several lexicon voters and several pattern voters (a pattern is the beginning that a word must
   have). A fixed list of insults, shouting and repeated exclamation marks vote as well, one voter speaks
   for clean texts when nothing suspicious occurs, and the annotators' labels are a voter like the others.
2. *Label model.* A generative model with one hidden label per text estimates by expectation maximisation
   how often each voter votes toxic, clean or not at all given the label, and how strongly voters stay
   correlated once the label is known. A voter counts less the more it repeats others.
3. *Classifier.* A logistic model over words, word beginnings and whether any voter's occurs is fitted to
   the posterior labels and scores whole texts.

Scale: steps 1 to 3 use at most ``SAMPLE`` labelled documents, chosen by the smallest hash of their id
(a documented bound), one of each set of copies among them; they are written once, their counts are made
by Spark and at most ``FEATURES`` of them come to the driver.
Scoring is row by row over all words of the whole text, without a shuffle.

Defined results: null and empty texts get the score of a text without words; without labelled rows of
both kinds every score is the share of toxic ones (0 without rows) and nothing is rejected below 0.5.
A document labelled twice counts as toxic if one label says so.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes, held_out, rows_of
from sheetloom.session import written

SAMPLE = 16_000
FEATURES = 20_000
SIGNIFICANT = 24.0  # likelihood ratio that a feature must reach, far beyond what the best of a million unrelated ones shows
LEXICONS, PATTERNS = 10, 10
BEGINNINGS = (4, 5, 6, 7, 8)
MIN_HASHES = 4  # that two texts must share to be copies of each other
ANY = "+any"  # the feature of a text in which some voter's word or beginning occurs
KEPT_COUNTS = 400_000  # features that a task counts before it hands them on

# Common English insults.
INSULTS = frozenset("idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting "
                    "clown jerk fool imbecile bastard bitch asshole bullshit crap damn fuck fucking shit slut whore".split())

_ODD = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)][:MIN_HASHES]
_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"\b[A-Z]{4,}\b(?:\W+[A-Z]{4,}\b){2}")
_EXCLAIM = re.compile(r"!{3,}")

RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def features(text: str) -> set[str]:
    """Distinct words, and their beginnings marked by a trailing ``*``."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass
class Model:
    """Weights of the classifier, and what the label model found out about the voters."""

    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)
    suspicious: frozenset[str] = frozenset()  # what stands for ANY
    accuracy: dict[str, float] = field(default_factory=dict)  # share of a voter's votes that the hidden label agrees with
    correlation: np.ndarray | None = None

    @cached_property
    def known(self) -> frozenset[str]:
        return frozenset(self.weights) | self.suspicious

    def score(self, text: str) -> float:
        words = set(_WORD.findall(text.lower()))
        found = words & self.known
        for n in BEGINNINGS:
            found |= {w[:n] + "*" for w in words if len(w) > n} & self.known
        total = sum([self.weights.get(f, 0.0) for f in found])
        if not self.suspicious.isdisjoint(found):
            total += self.weights.get(ANY, 0.0)
        # the sum's last bits depend on the order of a set
        return float(1 / (1 + np.exp(-np.clip(round(self.bias + total, 9), -40, 40))))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents outside the held-out fifth, written once.

    Of documents with the same label and the same smallest hashes over three-word shingles, ``MIN_HASHES`` of
    them, one is kept, whether their texts are equal or nearly so: words of a text that many rows repeat would
    look telling otherwise. A passage that different documents share seldom holds all of these hashes.
    """
    known = (labels.where(~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic")))
    chosen = known.orderBy(F.xxhash64("id", F.lit("toxicity")), "id").limit(sample)
    # at most ``sample`` ids are broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "id").select("text", "toxic")

    def make():
        def work(batch):
            keys = []
            for text in as_bytes(batch.column("text")).to_pylist():
                words = text.split()
                found = np.array([zlib.crc32(b" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))], np.uint32)
                keys.append(b"".join((found * odd).min().tobytes() for odd in _ODD))
            yield {"text": batch.column("text").to_pylist(), "toxic": batch.column("toxic").to_pylist(), "copies": keys}
        return work

    rows = written(rows_of(found, "text string, toxic int, copies binary", make), "toxicity-sample")
    one = rows.groupBy("copies", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("own"))
    return written(one.select("own.text", "toxic"), "toxicity-copies")


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): the sample's documents of each kind that a feature occurs in."""
    def make():
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def hand_on():
            names = list(counts[0].keys() | counts[1].keys())
            yield {"feature": names, "toxic": [counts[1][n] for n in names], "clean": [counts[0][n] for n in names]}
            counts[0].clear()
            counts[1].clear()

        def work(batch):
            for text, toxic in zip(as_bytes(batch.column("text")).to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[toxic].update(features(text.decode("utf-8", "replace")))
                if len(counts[0]) + len(counts[1]) > KEPT_COUNTS:
                    yield from hand_on()

        work.rest = hand_on
        return work

    return rows_of(rows, "feature string, toxic long, clean long", make).groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def deal(name: str, hands: int) -> int:
    return zlib.crc32(name.encode()) % hands


@dataclass
class Voters:
    """Words and beginnings by voter; ``names`` are the voters' names in the order of the votes."""

    words: dict[str, int]
    beginnings: dict[str, int]

    @property
    def names(self) -> list[str]:
        return [*(f"lexicon {i}" for i in range(LEXICONS)), *(f"pattern {i}" for i in range(PATTERNS)), "insults", "shouting", "exclamation",
                "nothing found", "annotator"]

    def vote(self, text: str, found: set[str], toxic: int) -> list[int]:
        """1 toxic, -1 clean, 0 no vote."""
        votes = [0] * (LEXICONS + PATTERNS)
        for f in found:
            if (i := self.words.get(f)) is not None:
                votes[i] = 1
            if (i := self.beginnings.get(f)) is not None:
                votes[LEXICONS + i] = 1
        votes += [int(not INSULTS.isdisjoint(found)), int(bool(_SHOUT.search(text))), int(bool(_EXCLAIM.search(text)))]
        return [*votes, 0 if any(votes) else -1, 1 if toxic else -1]


def choose_voters(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> Voters:
    """Features at least eight times as frequent in toxic texts as in clean ones, dealt out by their hash."""
    words, beginnings = {}, {}
    for name, toxic, clean in counts:
        if toxic / max(n_toxic, 1) >= 8 * (clean + 0.5) / max(n_clean, 1):
            if name.endswith("*"):
                beginnings[name] = deal(name, PATTERNS)
            else:
                words[name] = deal(name, LEXICONS)
    return Voters(words, beginnings)


def label_model(votes: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior toxicity of each row of votes, voters' accuracies, and their correlations given the label."""
    n, m = votes.shape
    shown = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)  # rows, voters, kinds of vote
    # to begin with, what most voters that vote say, those that repeat each other counting less; without votes clean
    spread = votes.std(axis=0)
    alike = np.abs(np.corrcoef(votes[:, spread > 0].T)) if (spread > 0).sum() > 1 else np.eye(int((spread > 0).sum()))
    weight, correlation = np.ones(m), np.eye(m)
    weight[spread > 0] = 1 / np.maximum(1, 1 + (np.clip((alike - 0.7) / 0.3, 0, None).sum(axis=1) - 1))
    posterior = np.where(votes @ weight > 0, 0.9, 0.1)
    for k in range(rounds):
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        chance = []
        for p in (1 - posterior, posterior):
            table = np.einsum("n,nmk->mk", p, shown) + 0.5
            chance.append(table / table.sum(axis=1, keepdims=True))
        if k >= 2:  # correlations of what the label leaves unexplained
            mean = [t[:, 2] - t[:, 0] for t in chance]
            rest = votes - ((1 - posterior)[:, None] * mean[0] + posterior[:, None] * mean[1])
            spread = np.sqrt((rest * rest).mean(axis=0)) + 1e-9
            correlation = (rest.T @ rest) / n / spread[:, None] / spread[None, :]
            weight = 1 / (1 + np.clip(np.abs(correlation) - 0.05, 0, None).sum(axis=1) - 0.95)
        say = np.einsum("nmk,mk->nm", shown, np.log(chance[1]) - np.log(chance[0]))
        posterior = 1 / (1 + np.exp(-np.clip(say @ weight + np.log(prior / (1 - prior)), -30, 30)))
    agree = (np.where(votes > 0, posterior[:, None], 0) + np.where(votes < 0, 1 - posterior[:, None], 0)).sum(axis=0)
    return posterior, agree / np.maximum((votes != 0).sum(axis=0), 1), correlation


def fit_linear(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, width: int, steps: int = 800) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam; the features of document ``rows[i]`` include ``columns[i]``."""
    weights, bias = np.zeros(width), float(np.log(target.mean() / (1 - target.mean())))
    a, b, n = np.zeros(width + 1), np.zeros(width + 1), len(target)
    for step in range(1, steps + 1):
        score = np.bincount(rows, weights[columns], n) + bias
        wrong = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - target) / n
        slope = np.r_[np.bincount(columns, wrong[rows], width) + 2e-5 * weights, wrong.sum()]
        a += 0.1 * (slope - a)
        b += 0.01 * (slope * slope - b)
        move = 0.05 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    rows = labelled_sample(docs, labels, sample, id_col, text_col, label_col)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = size.get(0, 0), size.get(1, 0)
    if not n_clean or not n_toxic:
        return Model(bias=20.0 if n_toxic else -20.0)
    base = n_toxic / (n_toxic + n_clean)
    both = F.col("toxic") + F.col("clean")

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    telling = 2 * (part(F.col("toxic"), both * base) + part(F.col("clean"), both * (1 - base)))
    counted = (feature_counts(rows).withColumn("telling", telling).where(F.col("telling") >= SIGNIFICANT)
               .orderBy(F.desc("telling"), "feature").limit(FEATURES).collect())
    counts = [(r["feature"], r["toxic"], r["clean"]) for r in counted]
    voters = choose_voters(counts, n_toxic, n_clean)
    suspicious = frozenset({*voters.words, *voters.beginnings, *INSULTS})
    index = {name: i for i, name in enumerate([*(name for name, _, _ in counts), ANY])}

    def make():
        def work(batch):
            votes, found = [], []
            for text, toxic in zip(as_bytes(batch.column("text")).to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                text = text.decode("utf-8", "replace")
                has = features(text)
                votes.append(bytes(v + 1 for v in voters.vote(text, has, toxic)))
                told = [index[f] for f in has if f in index] + ([index[ANY]] if not suspicious.isdisjoint(has) else [])
                found.append(np.array(sorted(told), "<i4").tobytes())
            yield {"votes": votes, "found": found}
        return work

    # any order of tasks gives the same model
    got = sorted((bytes(r["votes"]), bytes(r["found"])) for r in rows_of(rows, "votes binary, found binary", make).limit(2 * sample).collect())
    votes = np.array([np.frombuffer(v, np.uint8) for v, _ in got], np.int8) - 1
    posterior, accuracy, correlation = label_model(votes)
    each = [np.frombuffer(f, "<i4") for _, f in got]
    weights, bias = fit_linear(np.repeat(np.arange(len(each)), [len(f) for f in each]), np.concatenate(each), np.clip(posterior, 1e-3, 1 - 1e-3), len(index))
    return Model(bias, {name: float(weights[i]) for name, i in index.items() if abs(weights[i]) > 1e-4}, suspicious,
                 dict(zip(voters.names, accuracy.tolist(), strict=True)), correlation)


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """Rows of ``docs`` with a struct: score (0 to 1) and predicted (1 from 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = shared.value

        def work(batch):
            scores = [scorer.score((t or b"").decode("utf-8", "replace")) for t in as_bytes(batch.column(text_col)).to_pylist()]
            return {"score": scores, "predicted": [int(s >= 0.5) for s in scores]}
        return work

    return append_struct(docs, into, RESULT, make, text_col)
