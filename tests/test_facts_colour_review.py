import pytest
from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import colour, facts, merge, review, uploads
from sheetloom.operators import normalize as n

DOCS = "run_id string, doc_id bigint, filename string, status string, provider string, text string, confidence double"


def docs(spark, *texts):
    return spark.createDataFrame([("r", i, f"d{i}.jpg", "SUCCESS", "t", t, 0.9) for i, t in enumerate(texts)], DOCS)


def test_pattern_mix(spark):
    text = "COLLECTION: Aura\nStyle No: ST-9\nSKU: AB-77\nMaterial: Art Silk\nRate: ₹ 2,850/-\nTax: 5%\nPack of 4"
    got = {r.field: r.value for r in facts.first_per_field(facts.all_facts(docs(spark, text))).collect()}
    assert got["catalog_name"] == "Aura" and got["design_number"] == "ST-9" and got["sku"] == "AB-77"
    assert (got["fabric"], got["price"], got["gst_percent"], got["total_designs"]) == ("Art Silk", "2850.00", "5.00", "4")


def test_misread_currency_needs_evidence(spark):
    misread = ("Wholesale Per Unit Price - 21415\nFull Catalogue - 28490 (6 Pcs)\nSingle Piece - #1515\n"
               "6 Pes x 21415 = #8490\nTotal Designs: 6 Pcs")
    honest = "Price: Rs. 2500 /-\nSingle Piece: 2500"
    d = docs(spark, misread, honest)
    got = {r.doc_id: r for r in facts.reconciled_prices(d).collect()}
    assert (got[0].wholesale_price, got[0].full_catalogue_price, got[0].single_piece_price, got[0].supplier_price) == (1415.0, 8490.0, 1515.0, 1515.0)
    assert "corrected from 21415.0 to 1415.0" in got[0].price_notes
    assert (got[1].single_piece_price, got[1].price_notes) == (2500.0, None)


def test_long_currency_run_does_not_overflow(spark):
    assert facts.price_facts(docs(spark, "price " + "-" * 50000 + " 12")).count() == 1


def test_wrapped_value_and_blank_line(spark):
    text = "Weight - 0.6 KG per pc\n  (3.6 KG   total catalogue)\n\nnot attached\nWork - Zari"
    got = {r.field: r.value for r in facts.label_blocks(docs(spark, text)).collect()}
    assert got == {"weight": "0.6 KG per pc (3.6 KG total catalogue)", "work": "Zari"}


def test_slip_to_placeholder_variants(spark):
    text = "Catalogue - Rajtex Ajrakh\nBrand - Rajtex\nWholesale - % 580\nSingle Piece - ¥ 680\nFull Catalogue - = 3480\nTotal Designs - 6 Pcs"
    d = docs(spark, text, "", "nothing here")
    found = facts.all_facts(d)
    rows = facts.slip_rows(d, facts.slip_values(d, found, facts.reconciled_prices(d)))
    products, variants = n.normalise(rows)
    assert products.first().supplier_price == 680.0 and variants.count() == 6
    assert {(r.doc_id, r.reason) for r in facts.slip_rejects(d, found).collect()} == {
        (1, "No extractable product data found"), (2, "No recognizable catalogue fields found")}


def picture(spark, paint, width=50, height=40):
    rows = [("r", 1, width, height, x, y, *paint(x, y)) for x in range(width) for y in range(height)]
    return spark.createDataFrame(rows, "run_id string, image_id bigint, width int, height int, x int, y int, r int, g int, b int")


@pytest.mark.parametrize("rgb,names", [
    ((220, 20, 30), {"Red"}), ((30, 180, 50), {"Green"}), ((30, 80, 220), {"Blue", "Navy Blue"}), ((240, 220, 40), {"Yellow", "Mustard"}),
    ((240, 240, 240), {"White"}), ((35, 35, 35), {"Black"}), ((130, 130, 130), {"Grey"})])
def test_solid_colours(spark, rgb, names):
    r = colour.dominant(picture(spark, lambda x, y: rgb)).first()
    assert r.status == "EXTRACTED" and r.canonical_color in names


def test_two_halves_and_tiny_image(spark):
    r = colour.dominant(picture(spark, lambda x, y: (220, 20, 30) if x < 25 else (30, 80, 220))).first()
    assert (r.status, r.canonical_color) == ("UNCERTAIN", None) and r.notes.startswith("Multi-tonal")
    assert colour.dominant(picture(spark, lambda x, y: (1, 2, 3), 5, 5)).first().status == "FAILED"


MANIFEST = ("run_id string, manifest_ord bigint, image_id string, proposed_variant_code string, approval_status string, "
            "approved_by string, assignment_hash string, image_sku string, match_status string")
LOG = "run_id string, image_id string, decision_ord bigint, action string, reviewer string, new_variant_code string, image_sku string, reason string"


def entries(spark, *rows):
    df = spark.createDataFrame([("r", i, f"img{i}", code, status, None, None, None, "MATCHED") for i, (code, status) in enumerate(rows)], MANIFEST)
    return df.withColumn("assignment_hash", review.assignment_hash(F.col("image_id"), F.col("proposed_variant_code")))


def test_reassign_approve_tamper(spark):
    start = entries(spark, ("A", "PENDING"), (None, "PENDING"), ("A", "PENDING"))
    log = spark.createDataFrame([
        ("r", "img0", 1, "approve", "u", None, "S1", None), ("r", "img0", 2, "reassign", "u", "B", None, None),
        ("r", "img1", 3, "approve", "u", None, None, None), ("r", "img1", 4, "reject", "w", None, None, "blurred"),
        ("r", "img2", 5, "reassign", "u", "C", None, None), ("r", "img2", 6, "approve", "v", None, None, None)], LOG)
    done = review.apply_decisions(start, log)
    got = {r.image_id: r for r in done.withColumn("ok", review.is_valid()).collect()}
    assert (got["img0"].proposed_variant_code, got["img0"].approval_status, got["img0"].approved_by, got["img0"].ok) == ("B", "PENDING", None, False)
    assert (got["img1"].approval_status, got["img1"].notes) == ("REJECTED", "blurred")
    assert (got["img2"].proposed_variant_code, got["img2"].approval_status, got["img2"].ok) == ("C", "APPROVED", True)
    tampered = done.withColumn("proposed_variant_code", F.lit("Z"))
    assert tampered.where(review.is_valid()).count() == 0


def test_destination_keys_and_collisions(spark):
    rows = [(1, "Amra Wholesale", "Mahotsav Kriti", "Mahots-K-S3207", "Mahots-K-S3207.png", "x"),
            (2, "Vendor & Co., Surat", "Summer #1 (2026)", "VAR/01 Special", "My Image (1) copy.PNG", "y"),
            (3, "Amra Wholesale", "Mahotsav Kriti", "Mahots-K-S3207", "Mahots-K-S3207.png", "x"),
            (4, "Amra Wholesale", "Mahotsav Kriti", "Mahots-K-S3207", "Mahots-K-S3207.png", "z")]
    blobs = spark.createDataFrame(rows, "ord bigint, supplier_name string, catalog_name string, variant_code string, filename string, content string")
    got = {r.ord: r for r in uploads.plan(blobs).collect()}
    assert got[1].destination_key == "products/Amra-Wholesale/Mahotsav-Kriti/Mahots-K-S3207/Mahots-K-S3207.png"
    assert got[2].destination_key == "products/Vendor-Co-Surat/Summer-1-2026/VAR-01-Special/My-Image-1-copy.png"
    assert [(got[i].status, got[i].is_idempotent_reuse) for i in (1, 3, 4)] == [("UPLOADED", False), ("UPLOADED", True), ("COLLISION", False)]


def test_merge_conflict_and_consolidation(spark):
    schema = "product_id string, catalog_name string, variant_code string"
    a = spark.createDataFrame([("P1", "A", "V1")], schema)
    b = spark.createDataFrame([("P2", "B", "V2"), ("P1", "A", "V1")], schema)
    assert merge.checked_merge([a, b]).count() == 3 and merge.merge([a, b], dedupe=True).count() == 2
    with pytest.raises(merge.MergeConflict, match="P1"):
        merge.checked_merge([a, spark.createDataFrame([("P1", "Z", "V9")], schema)])
    width = len(fv.IMPORT_COLUMNS)
    good, bad = fv.IMPORT_COLUMNS, ["no", *fv.IMPORT_COLUMNS[1:]]
    rows = spark.createDataFrame([
        ("a", 2, good, ["1"] * width), ("a", 3, good, [" "] * width), ("a", 4, good, ["1"] * width),
        ("b", 2, bad, ["1"] * width), ("c", 2, good, [None] * width)], "source string, row_number int, header array<string>, cells array<string>")
    assert merge.consolidate(rows).count() == 2
    assert {r.source: r.rows for r in merge.source_checks(rows).collect()} == {"a": 2, "b": 1, "c": 0}
    with pytest.raises(merge.ConsolidationError, match=r"\[b\] Schema mismatch. Col 1"):
        merge.consolidate(rows, strict=True)


def test_labels_and_prices_stay_in_their_rows(spark):
    text = "Fabric: soft\n  silk \n\nnot a label\nBrand = One\r\nTwo\nWeight - 1 kg\n" + "plain line\n" * 3_000 + "Care: cold"
    d = docs(spark, text, None, "", "\n\n")
    blocks = facts.label_blocks(d)
    got = {r.field: (r.line_no, r.value, r.raw_text[:12]) for r in blocks.collect()}
    assert got["fabric"] == (0, "soft silk", "Fabric: soft") and got["brand"] == (4, "One Two", "Brand = One\n") and got["care"][:2] == (3_007, "cold")
    assert got["weight"][1].startswith("1 kg plain line plain line") and got["weight"][1].count("plain line") == 3_000
    for df in (blocks, facts.reconciled_prices(d)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_word_boxes_of_equal_documents_of_two_runs(spark):
    documents = spark.createDataFrame([("a", 1, "OK", "t"), ("b", 1, "OK", "t"), ("c", 1, "OK", "")],
                                      "run_id string, doc_id bigint, status string, text string")
    words = spark.createDataFrame([("a", 1, "w", 50.0), ("b", 1, "w", 90.0), ("b", 1, " ", 10.0), ("b", 1, "x", -1.0)],
                                  "run_id string, doc_id bigint, word string, conf double")
    got = {r.run_id: (r.status, r.word_count, r.confidence) for r in facts.document_confidence(documents, words).collect()}
    assert got == {"a": ("SUCCESS", 1, 0.5), "b": ("SUCCESS", 1, 0.9), "c": ("NO_TEXT_FOUND", 0, 0.8)}
