"""Pieces that replace one-task work are checked against brute force."""

import random

from pyspark.sql import Window, functions as F

from sheetloom.operators.ranking import rank_by_number, rank_by_text
from sheetloom.operators.substring import contained_tokens
from sheetloom.plans import bindings as b
from sheetloom.plans import facts_queries


def _ranked(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rank_by_number_over_many_stretches(spark):
    df = spark.range(3000).select((F.col("id") % 3 != 0).cast("string").alias("g"), (F.col("id") * 7 % 30011).cast("int").alias("o"))
    window = Window.partitionBy("g").orderBy("o")
    want = _ranked(df.withColumn("n", F.row_number().over(window)), ["g", "o", "n"])
    assert _ranked(rank_by_number(df, ["g"], "o", "n", chunk=64), ["g", "o", "n"]) == want


def test_rank_by_text_ranged_equals_window(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("t"))
    want = _ranked(df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("t"))), ["g", "t", "n"])
    assert _ranked(rank_by_text(df, ["g"], ["t"], "n"), ["g", "t", "n"]) == want


def test_contained_tokens_equals_contains(spark):
    rng = random.Random(5)
    word = lambda k: "".join(rng.choice("abc-") for _ in range(k))
    texts = [("r%d" % (i % 2), i, word(rng.randint(0, 30))) for i in range(60)]
    tokens = [("r%d" % (i % 3), word(rng.randint(0, 9))) for i in range(80)]
    got = contained_tokens(spark.createDataFrame(texts, "run string, id int, text string"),
                           spark.createDataFrame(tokens, "run string, token string"), ["run"], ["id"])
    want = {(r, i, t) for r, i, x in texts for q, t in tokens if q == r and t and t in x}
    assert {(r.run, r.id, r.token) for r in got.collect()} == want and want


def test_slips_of_one_file_are_read_in_many_tasks(spark):
    small = "/root/testdata/sf0.001"
    for made in (facts_queries.slips(spark, small), facts_queries.texts(spark, small).where("run_id not like 'doc-%'")):
        per_task = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) >= spark.sparkContext.defaultParallelism and max(per_task) < sum(per_task) / 3
    plain = spark.sql(b.SLIPS, orders=spark.read.parquet(f"{small}/orders.parquet"))
    slips = facts_queries.slips(spark, small)
    assert slips.columns == plain.columns and not plain.exceptAll(slips).count() and not slips.exceptAll(plain).count()
