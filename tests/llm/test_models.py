"""Toxicity and language identification on held-out rows and on odd inputs."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import language_id as L
from sheetloom.llm import toxicity as X
from sheetloom.llm.common import held_out, table

DATA = "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="given tables are absent")
ODD = [(1, None, None), (2, "", "en"), (3, "123 !?", "en"), (4, "é" * 300_000, "fr"), (None, "some words", "en")]


def test_held_out_languages(spark):
    docs = table(spark, DATA, "documents")
    rows = L.identify(docs, L.fit(docs)).where(held_out(F.col("doc_id"))).select((F.col("language.lang_pred") == F.col("lang")).cast("int").alias("ok"))
    assert rows.agg(F.avg("ok")).first()[0] > 0.98


def test_language_of_odd_rows(spark):
    docs = table(spark, DATA, "documents")
    odd = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, lang string, language string")
    got = {r["doc_id"]: (r["language"]["lang_pred"], r["language"]["score"]) for r in L.identify(odd, L.fit(docs, sample=500)).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] in ("de", "en", "es", "fr") and 0 < got[4][1] <= 1 and got[None][0] != "und"
    nothing = docs.limit(0)
    assert L.fit(nothing) is None and L.identify(nothing, None).count() == 0
    assert {r["language"]["lang_pred"] for r in L.identify(odd, None).collect()} == {"und"}


def test_every_byte_is_in_one_window():
    rng = np.random.default_rng(2)
    net = L.train(rng.integers(1, 255, (40, L.WINDOW + 3), dtype=np.uint8), np.arange(40) % 2, ["a", "b"], epochs=1)
    text = bytes(rng.integers(97, 122, 1_500, dtype=np.uint8))
    data, owner = L.lay_out([text, b"q"])
    pooled = np.zeros((1, L.FILTERS * len(L.WIDTHS)))
    for k, f in enumerate(net.filters):  # every place of every filter, one by one
        padded = text + b"\0" * 3
        answers = [sum(f[j][padded[p + j]] for j in range(len(f))) for p in range(len(text))]
        pooled[0, k * L.FILTERS:(k + 1) * L.FILTERS] = np.max(answers, axis=0)
    pair = net.tables()
    windows = len(owner[owner == 0])
    logs = net.window_logs(data, pair)
    assert logs.shape == (windows + 1, 2)
    again, _ = L.lay_out([text])
    assert np.allclose(net.window_logs(again, pair), logs[:windows])
    # the largest answers over all windows are those over all places
    found = [pair[(again[:-1].astype(int) << 8) | again[1:]]]
    assert found[0][:len(text), :L.FILTERS].max(axis=0) == pytest.approx(pooled[0, :L.FILTERS], abs=1e-4)


def test_held_out_toxicity(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = X.fit(docs, labels)
    scored = X.score_texts(docs.select("doc_id", "text"), model).where(held_out(F.col("doc_id"))).join(labels, "doc_id")
    rows = scored.select("toxic", "toxicity.score", "toxicity.predicted").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    # some of the 97 are labelled toxic without a word that any other toxic text has
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert model.accuracy["insults"] > 0.9 and model.correlation.shape[0] == len(model.accuracy)


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, lang string, toxicity string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for model in (X.fit(docs, labels), X.fit(docs, labels.limit(0)), X.fit(docs.limit(0), labels), X.Model(0.0, {"some": 2.0})):
        rows = X.score_texts(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["toxicity"]["score"] <= 1 for r in rows)
        by_id = {r["doc_id"]: r["toxicity"]["score"] for r in rows}
        assert by_id[1] == by_id[2]
    assert by_id[None] > by_id[2]


def test_label_model_finds_good_and_bad_voters():
    rng = np.random.default_rng(0)
    truth = rng.random(4_000) < 0.3
    right = [0.95, 0.9, 0.85, 0.55]
    votes = np.stack([np.where(rng.random(4_000) < r, truth, ~truth) * 2 - 1 for r in right], axis=1).astype(np.int8)
    votes = np.concatenate([votes, votes[:, 3:4], votes[:, 3:4]], axis=1)  # two voters that repeat the worst
    votes[rng.random(votes.shape) < 0.2] = 0
    posterior, accuracy, correlation = X.label_model(votes)
    assert ((posterior > 0.5) == truth).mean() > 0.93
    assert accuracy[0] > accuracy[2] > accuracy[3]
    assert correlation[3, 4] > 0.4 > abs(correlation[0, 1])
