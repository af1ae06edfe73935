"""Decontamination against a plain scan by the contamination rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sheetloom.llm import decontaminate as D


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, size):
    words, hit, found = plain_words(text), set(), set()
    for item, own in items:
        w = plain_words(own)
        for i in range(max(1, len(w) - size + 1) if w and item is not None else 0):
            window = w[i:i + size]
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("shard", [200_000, 7])
def test_like_a_plain_scan(spark, shard):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice(["a", "B", "é", "a b", "7"]) + rng.choice([" ", ", ", "\n", "  ", "-"]) for _ in range(n))
    items = [(i, text(rng.randint(1, 9))) for i in range(6)] + [(6, None), (7, ""), (8, "--"), (None, "a b a"), (0, "é 7 é")]
    docs = [(i, text(rng.randint(0, 60)), "x", i) for i in range(40)] + [(40, None, None, 1), (40, "", "x", 1), (None, "a b", "x", 1)]
    docs += [(41, text(3_000), "x", 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, contamination string, n_hit long")
    got = D.find_contamination(df, spark.createDataFrame(items, "item_id long, text string"), size=4, shard=shard)
    assert got.columns == ["doc_id", "text", "n_hit", "contamination"]
    rows = got.select("doc_id", "text", "contamination.*").collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"]) == plain(r["text"], items, 4)
        kept = [w for s in r["spans"] for w in plain_words(r["text"][s["start"]:s["end"]])]
        assert len(kept) == r["n_hit"]


def test_window_that_a_third_of_the_items_share(spark):
    items = [(i, f"read the text below {i} and {i * 7} then choose") for i in range(40)] + [(100 + i, f"other words {i} {i} here") for i in range(80)]
    docs = [(1, "Please READ the text, below."), (2, "x other words 5 5 here"), (3, "read the text below 3 and 21 then"), (4, "clean")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.windows(bench, 4)
    shards = D.shard_count(found, 40)
    sizes = {r["s"]: r["count"] for r in found.groupBy(D.shard_of(shards).alias("s")).count().collect()}
    assert shards > 4 and max(sizes.values()) < 80  # by windows alone, 40 pairs and their neighbours would meet in one
    got = D.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench, size=4, shard=80)
    for r in got.select("doc_id", "text", "contamination.*").collect():
        assert (r["n_words"], r["n_hit"], r["items"]) == plain(r["text"], items, 4)


def test_spans_in_the_original_text(spark):
    docs = spark.createDataFrame([(1, "Né, THE quick—brown fox! ends")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "quick—brown FOX")], "item_id long, text string")
    r = D.find_contamination(docs, items).select("contamination.*").first()
    assert [(s["start"], s["end"]) for s in r["spans"]] == [(8, 23)] and r["items"] == ["5"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_contamination(docs, none).select("contamination.n_hit").first()[0] == 0
    assert D.find_contamination(docs.limit(0), none).count() == 0


def test_rule(spark):
    rule = D.is_contaminated(F.col("h"), F.col("w"))
    rows = spark.createDataFrame([(0, 0), (1, 20), (1, 21), (2, 40)], "h long, w long").select(rule.alias("x")).collect()
    assert [r["x"] for r in rows] == [False, True, False, True]
