"""op10 answers from the prefix counts of every whole text."""

from sheetloom.llm import text_queries, token_counts


def test_query_makes_every_prefix_count(spark, monkeypatch, tmp_path):
    texts = [None, "", "plain words here", "é中 it's " * 400, "a  b<|endoftext|>c"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made, count_tokens = [], token_counts.count_tokens
    monkeypatch.setattr(token_counts, "count_tokens", lambda *a, **k: made.append(count_tokens(*a, **k)) or made[-1])
    got = {r["doc_id"]: r for r in text_queries.op10(spark, str(tmp_path)).collect()}
    dp = token_counts.counter(token_counts.default_path())
    for r in made[0].collect():
        text, found = r["text"] or "", r["tokens"]
        assert found["prefix_counts"] is not None and len(found["prefix_counts"]) == 4 * len(text)
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["fitting_chars"]) == dp.count_and_fit(text, token_counts.LIMIT)
    assert len(got) == len(texts)
