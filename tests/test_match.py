import pytest
from pyspark.sql import functions as F

from sheetloom.operators import images as im
from sheetloom.operators import match

V = ("run_id string, product_ord bigint, variant_ord int, variant_code string, supplier_sku string, variant_name string, "
     "color string, image_sku string, primary_image_url string")
FACTS = "run_id string, doc_id bigint, filename string, fact_ord bigint, field string, value string"


def found(spark, paths, products, variants, facts=()):
    images = im.inventory(spark.createDataFrame(
        [("r", "src", p, 10) for p in paths], "run_id string, source_identity string, relative_path string, file_size_bytes bigint"))
    ps = spark.createDataFrame([("r", o, f"P{o}", g, c) for o, g, c in products],
                               "run_id string, product_ord bigint, product_id string, product_group string, catalog_name string")
    vs = spark.createDataFrame([("r", *v) for v in variants], V)
    fs = match.image_facts(images, spark.createDataFrame([("r", *f) for f in facts], FACTS))
    result = match.match_images(images, ps, vs, fs)
    named = result.join(images.select("run_id", "image_id", "original_filename"), ["run_id", "image_id"])
    return {r.original_filename: r for r in named.collect()}, result, images, vs


def codes(spark, result, images, variants, facts=(), asked=None):
    fs = match.image_facts(images, spark.createDataFrame([("r", *f) for f in facts], FACTS))
    rows = match.candidates(result, images, variants, fs, asked).join(images.select("run_id", "image_id", "original_filename"), ["run_id", "image_id"])
    out = {}
    for r in rows.orderBy("product_ord", "variant_ord").collect():
        out.setdefault(r.original_filename, []).append(r.variant_code)
    return out


SHARED = [(1, 1, "SETHNI-V-1", "AM-1726I", "Red", "Red", None, None), (1, 2, "SETHNI-V-2", "AM-1726I", "Blue", "Blue", None, "https://h/x/main.png"),
          (2, 1, "OTHER-1", "ZZ-9", "Red", "Red", None, None)]
PRODUCTS = [(1, "SETHNI-LS", "Sethnic Lifestyle"), (2, None, "Bunawat Eradi")]


def test_priorities(spark):
    got, *_ = found(spark, [
        "SETHNI-V-1.png", "SETHNI-V-2_front.jpg", "main.png", "Sethnic Lifestyle/red one.jpg", "Bunawat Eradi/any.jpg",
        "Sethnic Lifestyle/red and blue.jpg", "Sethnic Lifestyle/photo_1.jpg", "AM-1726I_2.jpg", "AM-1726I.jpg", "zz-9.jpg", "red.jpg",
        "scan7.jpg", "notes.txt"], PRODUCTS, SHARED, [(1, "scan7.jpg", 1, "sku", " sethni-v-2 ")])
    assert "notes.txt" not in got and len(got) == 12
    want = {
        "SETHNI-V-1.png": ("MATCHED", "EXACT_VARIANT_CODE", "SETHNI-V-1", 1.0),
        "SETHNI-V-2_front.jpg": ("MATCHED", "EXACT_VARIANT_CODE", "SETHNI-V-2", 1.0),
        "main.png": ("MATCHED", "SOURCE_URL_EXACT", "SETHNI-V-2", 1.0),
        "red one.jpg": ("MATCHED", "SCOPED_PRODUCT_COLOR_TOKEN", "SETHNI-V-1", 0.85),
        "any.jpg": ("MATCHED", "SCOPED_SINGLE_VARIANT_PRODUCT", "OTHER-1", 0.9),
        "red and blue.jpg": ("AMBIGUOUS", "SCOPED_PRODUCT_AMBIGUOUS", None, 0.5),
        "photo_1.jpg": ("AMBIGUOUS", "SCOPED_MULTI_VARIANT_AMBIGUOUS", None, 0.5),
        "AM-1726I_2.jpg": ("MATCHED", "SUPPLIER_SKU_INDEXED_SEQUENCE", "SETHNI-V-2", 0.75),
        "AM-1726I.jpg": ("AMBIGUOUS", "SHARED_SUPPLIER_SKU_AMBIGUOUS", None, 0.4),
        "zz-9.jpg": ("MATCHED", "SUPPLIER_SKU_SINGLE_VARIANT", "OTHER-1", 0.8),
        "red.jpg": ("UNMATCHED", None, None, 0.0),
        "scan7.jpg": ("MATCHED", "OCR_CANDIDATE_EXACT", "SETHNI-V-2", 0.85)}
    for name, expected in want.items():
        r = got[name]
        assert (r.status, r.match_strategy, r.variant_code, r.confidence) == expected, name


def test_candidates_of_ambiguous_images(spark):
    paths = ["Sethnic Lifestyle/red and blue.jpg", "Sethnic Lifestyle/photo_1.jpg", "AM-1726I.jpg", "Sethnic Lifestyle/told.jpg",
             "SETHNI-V-1.png", "red.jpg"]
    facts = [(1, "told.jpg", 1, "sku", " am-1726i "), (1, "told.jpg", 2, "code", "SETHNI-V-1"), (1, "told.jpg", 3, "code", "nothing")]
    got, result, images, vs = found(spark, paths, PRODUCTS, SHARED, facts)
    both = ["SETHNI-V-1", "SETHNI-V-2"]
    listed = codes(spark, result, images, vs, facts)
    assert listed == {"red and blue.jpg": both, "photo_1.jpg": both, "AM-1726I.jpg": both, "told.jpg": both}
    assert {n: got[n].candidate_count for n in listed} == {n: 2 for n in listed}
    one = images.where(F.col("original_filename") == "photo_1.jpg")
    assert codes(spark, result, images, vs, facts, one) == {"photo_1.jpg": both}


def test_variants_with_equal_tokens_are_candidates_once(spark):
    """Colour, name and code of a variant may be one token, and several tokens of a path may name it."""
    variants = [(1, 1, "RED", "S", "Red", "Red", "RED", None), (1, 2, "B", "S", "Red", "Blue", None, None), (1, 3, "C", "T", None, None, None, None)]
    got, result, images, vs = found(spark, ["Big Cat/pic red blue.jpg"], [(1, None, "Big Cat")], variants)
    assert codes(spark, result, images, vs) == {"pic red blue.jpg": ["RED", "B", "C"]}
    assert got["pic red blue.jpg"].candidate_count == 3


def test_a_newer_document_without_facts_counts(spark):
    images = im.inventory(spark.createDataFrame([("r", "src", p, 10) for p in ("a.jpg", "b.jpg")],
                                                "run_id string, source_identity string, relative_path string, file_size_bytes bigint"))
    facts = spark.createDataFrame([("r", 1, "a.jpg", 1, "sku", "S1"), ("r", 2, "b.jpg", 1, "sku", "S2")], FACTS)
    documents = spark.createDataFrame([("r", 1, "a.jpg"), ("r", 3, "A.jpg"), ("r", 2, "b.jpg")], "run_id string, doc_id bigint, filename string")
    assert {r.value for r in match.image_facts(images, facts).collect()} == {"S1", "S2"}
    assert {r.value for r in match.image_facts(images, facts, documents).collect()} == {"S2"}


def test_sequence_index(spark):
    variants = [(1, i, f"RAJTEX-N-V0{i}", None, f"Design 0{i}", None, None, None) for i in (1, 2, 3)]
    got, *_ = found(spark, ["Rajtex-N-001.png", "Rajtex-N-002.png", "Rajtex-N-009.png"], [(1, "Rajtex-N", "Rajtex Noor")], variants)
    assert [(got[n].variant_code, got[n].match_strategy, got[n].confidence) for n in ("Rajtex-N-001.png", "Rajtex-N-002.png")] == [
        ("RAJTEX-N-V01", "SCOPED_DESIGN_SEQUENCE_INDEX", 0.9), ("RAJTEX-N-V02", "SCOPED_DESIGN_SEQUENCE_INDEX", 0.9)]
    assert got["Rajtex-N-009.png"].status == "AMBIGUOUS"


def test_gallery_order(spark):
    names = ["SETHNI-V-1-10.png", "SETHNI-V-1.png", "SETHNI-V-1-2.png", "SETHNI-V-1-1.png"]
    _, result, images, vs = found(spark, names, PRODUCTS, SHARED)
    ordered = match.gallery(result, images, vs)
    rows = ordered.orderBy("sort_index").collect()
    assert [r.original_filename for r in rows] == ["SETHNI-V-1.png", "SETHNI-V-1-1.png", "SETHNI-V-1-2.png", "SETHNI-V-1-10.png"]
    assert [r.is_primary for r in rows] == [True, False, False, False]
    filled = match.backfill_image_sku(vs, ordered).where(F.col("variant_code") == "SETHNI-V-1").first()
    assert filled.image_sku == "sethni-v-1"


@pytest.mark.parametrize("copies", [400])
def test_ambiguous_images_do_not_multiply(spark, copies):
    variants = [(1, i, f"C-{i:04d}", "S", "Standard", "Red", None, None) for i in range(1, copies + 1)]
    got, *_ = found(spark, [f"Big Cat/red standard {i}x.jpg" for i in range(20)], [(1, None, "Big Cat")], variants)
    assert len(got) == 20 and {r.candidate_count for r in got.values()} == {copies}
