"""The labelled sample holds one row of each set of copies, and different documents with a common passage."""

import random

from pyspark.sql import functions as F

from sheetloom.llm import toxicity
from sheetloom.llm.common import held_out


def sample_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").where(~held_out(F.col("doc_id")))
    rows = toxicity.labelled_sample(docs, docs.selectExpr("doc_id", "1 as toxic"))
    return [r["text"] for r in docs.collect()], [r["text"] for r in rows.collect()]


def test_exact_copies_are_one_row(spark):
    given, got = sample_of(spark, ["the same few words for all"] * 40 + ["quite another text"] * 10)
    assert len(given) > 30 and sorted(got) == sorted(set(given))


def test_common_passage_does_not_thin_the_sample(spark):
    rng = random.Random(1)
    passage = " ".join(f"common{i}" for i in range(12))
    given, got = sample_of(spark, [passage + "".join(f" w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)])
    assert sorted(got) == sorted(given)
