"""Rules look at one letter before they look for their words, and find the same."""

import pytest
from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators import facts

ODD = ["ſKU: a-12", "İtem code 77\nıtem no. x9", "xsku: a12 sku b12", "ART no. 5a, DN 12, d/no: 7z", "₹ 500 İNR 20 Rſ. 9.50 rs. 1,200",
       "Pack of 4 ſet of 6", "Colour: Teal", "", "MRP: ₹ 1,450/- Rate 12"]


@pytest.mark.parametrize("rule", [*fv.FACT_RULES, *fv.PRICE_RULES], ids=lambda r: r[2])
def test_a_rule_looks_at_the_first_letter_and_finds_the_same(spark, rule):
    sought = facts._java(rule[3])
    assert sought.startswith("(?U)(?i)(?=(?-iU:[")
    plain = sought.replace(sought[8:sought.index("])") + 3], "", 1)
    assert plain.startswith(c.unicode_re(rule[3])[:12])
    texts = spark.createDataFrame([(x,) for x in ODD], "text string")
    found = texts.select(*[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(n) for n, p in (("a", sought), ("b", plain))]).collect()
    assert all(r.a == r.b for r in found)


def test_lines_behind_a_label(spark):
    text = "Fabric :  Art  Silk \n  soft \t drape\nBrand - X: y\n\nloose\nWork Type_1 =\nZari"
    docs = spark.createDataFrame([("r", 1, text)], "run_id string, doc_id long, text string")
    got = [(r.line_no, r.label, r.field, r.value, r.raw_text) for r in facts.label_blocks(docs).orderBy("line_no").collect()]
    assert got == [(0, "Fabric", "fabric", "Art Silk soft drape", "Fabric :  Art  Silk\nsoft \t drape"), (2, "Brand", "brand", "X: y", "Brand - X: y"),
                   (5, "Work Type_1", "work_type_1", "Zari", "Work Type_1 =\nZari")]
