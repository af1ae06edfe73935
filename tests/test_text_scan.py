"""Facts read by Python workers are those of the rules as column expressions, and need no exchange."""

import pytest
from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import facts, text_scan
from sheetloom.plans import facts_queries as fq
from tests.test_fact_words import ODD

DOCS = "run_id string, doc_id bigint, filename string, status string, provider string, text string, confidence double"
TEXTS = [
    *ODD, None, "\n\n", "A : one\nAB: two  \t three\nfour\n\nfive\n" + "L" * 41 + ": kept\n" + "M" * 43 + ": too long",
    "Wholesale Per Unit Price - 21415\nFull Catalogue - 28490 (6 Pcs)\nSingle Piece - #1515\n6 Pes x 21415 = #8490\nTotal Designs: 6 Pcs",
    "Price: Rs. 2500 /-\nSingle Piece: 2500\nrate INR 7.5 per pc\nRATE ₹ 1,250.50 % W.S. Price: 12", "COLOUR shade: Red fabric: linen\nBrand name Rajni GST 5 %, tax 120%",
    "Design No. D-12 d.no 7 D/NO 8 dn: x9\nStyle code S1 art no. 5 Art Silk drape", "item code #77\r\nGeorgette – new\r\nWork — Zari = yes", "Product Name: Kurta\nMRP 99.999",
    "price " + "-" * 50_000 + " 12", "Rate: 123456789012345678901234567890123456789012\nPack of 99999999999999999999 pcs\nset of 4"]


def docs(spark, texts):
    return spark.createDataFrame([("r", i, f"d{i}.jpg", "SUCCESS", "t", t, 0.9) for i, t in enumerate(texts)], DOCS)


def by_columns(documents):
    """All facts by the rules as column expressions, put together by an aggregate."""
    rest = ["value", "raw_text", "confidence", "rule"]
    return (facts._rows(facts.with_facts(documents), "facts").groupBy(*facts.DOC, "field", F.lower("value").alias("k"))
            .agg(F.min_by(F.struct(*rest), "fact_ord").alias("f"), F.min("fact_ord").alias("fact_ord"))
            .select(*facts.DOC, "fact_ord", "field", *[f"f.{x}" for x in rest]))


def test_the_same_facts_and_values(spark):
    d = docs(spark, TEXTS)
    found, want = facts.all_facts(d), by_columns(d)
    assert sorted(map(str, found.drop("review_status").collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, facts.first_facts(d).collect())) == sorted(map(str, facts.first_per_field(want).collect()))
    values = facts.slip_values(d, want, facts.reconciled_prices(d))
    assert sorted(map(str, facts.read_values(d).collect())) == sorted(map(str, values.collect()))
    assert sorted(map(str, facts.read_rows(d).collect())) == sorted(map(str, facts.slip_rows(d, values).collect()))
    summary = [facts.document_summary(*x).select(*facts.DOC, "text_length", "fact_count", F.map_entries("fields")) for x in ((d,), (d, want))]
    assert sorted(map(str, summary[0].collect())) == sorted(map(str, summary[1].collect()))


@pytest.mark.parametrize("rule", [*fv.FACT_RULES, *fv.PRICE_RULES], ids=lambda r: r[2])
def test_places_where_words_begin_lose_no_match(rule):
    find = text_scan._finder(rule[3])
    for text in TEXTS:
        if text and text.isascii():
            assert [m.span() for m in find(text, text.lower(), True)] == [m.span() for m in find(text, text.lower(), False)]


def test_rows_that_are_the_same_document(spark):
    d = docs(spark, ["SKU: a1\nBrand: Xy", "SKU: b2"]).withColumn("doc_id", F.lit(1).cast("bigint"))
    assert {(r.field, r.value) for r in facts.all_facts(d).collect()} == {("sku", "a1"), ("sku", "b2"), ("brand", "Xy"), ("brand_name", "Xy")}
    assert {r.field for r in facts.first_facts(d).collect()} == {"sku", "brand", "brand_name"}


@pytest.mark.parametrize("name", ["all_facts", "first_fact_per_field", "document_summary", "slip_to_raw_row", "slip_price_precedence"])
def test_what_a_document_says_stays_in_its_partition(spark, monkeypatch, name):
    d = docs(spark, TEXTS)
    monkeypatch.setattr(fq, "texts", lambda s, sf: d)
    assert "Exchange" not in getattr(fq, name)(spark, "")._jdf.queryExecution().executedPlan().toString()
