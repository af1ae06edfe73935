"""Registered queries against their SQL, and the pipeline against plain stages."""

import tempfile
from pathlib import Path

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from sheetloom.llm import decontaminate, language_id, ngram_join, pieces, toxicity
from sheetloom.llm.common import table

SMALL = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="given tables are absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in SMALL.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in driver.queries() if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_revisits", "op4_ngram_join", "op5_chat_format", "op6_url_rules", "op7_block_search", "op12_conversation_trie"])
def test_query_like_its_sql(spark, duck, name):
    df = driver.queries()[name](spark, str(SMALL))
    result = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(map(repr, result.fetchall()))


def test_pipeline_like_plain_stages(spark):
    from test_decontaminate import plain
    from test_ngram_join import plain as plain_groups

    docs = table(spark, str(SMALL), "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.fit(docs, table(spark, str(SMALL), "labels"))
    kept = {i: r for i, r in rows.items() if model.score(r["text"] or "") < 0.5}
    clean = spark.createDataFrame(list(kept.values()), docs.schema)
    found = language_id.identify(clean, language_id.fit(clean)).collect()
    sure = {r["doc_id"] for r in found if r["language"]["lang_pred"] != "und" and r["language"]["score"] >= corpus_pipeline.LEAST_SCORE}
    groups = plain_groups([(i, kept[i]["text"]) for i in sorted(sure)], corpus_pipeline.NEAR_PERCENT, corpus_pipeline.NEAR_SIZE)
    one = sorted({c if n else i for i, n, c, _ in groups})
    items = [tuple(r) for r in table(spark, str(SMALL), "benchmark").select("item_id", "text").collect()]
    want = []
    for i in one:
        n_words, n_hit, _ = plain(kept[i]["text"], items, 13)
        if not (n_hit and 20 * n_hit >= n_words):
            want.append(i)
    got = corpus_pipeline.run(spark, str(SMALL)).select("doc_id", "text", "piece_ids", "n_pieces").collect()
    assert sorted(r["doc_id"] for r in got) == want
    lattice = pieces.lattice(pieces.default_path())
    assert all(lattice.decode(r["piece_ids"]) == r["text"] and len(r["piece_ids"]) == r["n_pieces"] for r in got)


def test_stages_take_odd_rows_and_keep_columns(spark):
    odd = [(1, None, "en", "s", 0, "a"), (2, "", None, "s", 0, "b"), (3, "word " * 50_000, "en", None, 1, "c"), (None, "and so on", "en", "s", 9, "d"),
           (4, "just a few plain words", "en", "s", None, "e"), (4, "just a few plain words", "en", "s", None, "e")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, toxicity string")
    sf_dir = tempfile.mkdtemp(prefix="stages-")
    spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, "plain words that occur nowhere")], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, sf_dir)
            out.collect()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
    kept = ngram_join.keep_one(docs).count()
    assert kept == 5 and decontaminate.WINDOW == 13
