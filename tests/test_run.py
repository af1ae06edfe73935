from sheetloom.operators import enrich, review, run
from sheetloom.sources import files

ENTRY = ("run_id string, image_id string, manifest_ord bigint, original_filename string, proposed_variant_code string, "
         "approval_status string, hashed string")


def entries(spark, rows):
    df = spark.createDataFrame([("r", *r) for r in rows], ENTRY)
    return df.withColumn("assignment_hash", review.assignment_hash(df["image_id"], df["hashed"])).drop("hashed")


def test_uploads_follow_the_gallery(spark):
    """The first match of A is not approved, so A has no primary image; b3 comes to C by a reassignment."""
    manifest = entries(spark, [("a1", 1, "a1.png", "A", "REJECTED", "A"), ("a2", 2, "a2.png", "A", "APPROVED", "A"), ("b1", 3, "b1.png", "B", "APPROVED", "B"),
                               ("b2", 4, "b2.png", "B", "APPROVED", "stale"), ("b3", 5, "b3.png", "C", "APPROVED", "C"), ("x", 6, "x.png", "GHOST", "APPROVED", "GHOST")])
    variants = spark.createDataFrame([("r", 1, k + 1, c, None, []) for k, c in enumerate("ABCA")],
                                     "run_id string, product_ord bigint, variant_ord int, variant_code string, primary_image_url string, gallery_image_urls array<string>")
    galleries = spark.createDataFrame([("r", 1, 1, "A", "a1", 0), ("r", 1, 1, "A", "a2", 1), ("r", 1, 2, "B", "b1", 0), ("r", 1, 2, "B", "b2", 1), ("r", 1, 2, "B", "b3", 2)],
                                      "run_id string, product_ord bigint, variant_ord int, variant_code string, image_id string, sort_index int")
    uploads = run.planned_uploads(manifest, variants, galleries)
    got = {(r.variant_code, r.image_id): (r.sort_index, r.is_primary, r.origin) for r in uploads.collect()}
    assert got == {("A", "a2"): (1, False, "image_matcher"), ("B", "b1"): (0, True, "image_matcher"), ("C", "b3"): (0, True, "manifest_approval")}
    hosted = {r.variant_ord: (r.primary_image_url, r.gallery_image_urls)
              for r in run.with_hosted(variants, uploads, run.hosted_galleries(uploads)).collect()}
    assert hosted[1] == (None, [f"{run.HOST}a2.png"]) and hosted[2] == (f"{run.HOST}b1.png", []) and hosted[3] == (f"{run.HOST}b3.png", [])


def test_evidence_of_the_text_survives_the_manifest_file(spark, tmp_path):
    facts = spark.createDataFrame([("r", "i", 7, 1, "sku", "S1"), ("r", "i", 7, 2, "sku", "S2"), ("r", "i", 7, 3, "fabric", "Silk"), ("r", "j", 8, 1, None, "x")],
                                  "run_id string, image_id string, doc_id bigint, fact_ord bigint, field string, value string")
    documents = spark.createDataFrame([("r", 7, "reader", 0.5)], "run_id string, doc_id bigint, provider string, confidence double")
    findings = spark.createDataFrame([("r", "i", "MATCHED", "P", "Cat", "A", "S1", "S", 1.0, 1, "why"), ("r", "j", "UNMATCHED", *[None] * 5, 0.0, 0, "none")],
                                     "run_id string, image_id string, status string, product_id string, catalog_name string, variant_code string, supplier_sku string, "
                                     "match_strategy string, confidence double, candidate_count int, reason string")
    images = spark.createDataFrame([("r", "i", "p/i.png", "i.png"), ("r", "j", "j.png", "j.png")], "run_id string, image_id string, relative_path string, original_filename string")
    made = review.create_manifest(findings, images, facts, documents)
    numbered = made.withColumn("manifest_ord", made["evidence_count"])
    files.write_manifest(numbered, str(tmp_path / "m"))
    read = {r.image_id: r for r in files.read_manifest(spark, str(tmp_path / "m")).collect()}
    assert read["i"].ocr_evidence.asDict() == {"provider": "reader", "confidence": 0.5, "candidates": {"fabric": "Silk", "sku": "S2"}}
    assert read["i"].image_sku == "S1" and read["j"].ocr_evidence is None


def test_attributes_of_the_variant_count_over_those_of_the_product(spark):
    df = spark.createDataFrame([({"work": "Zari", "size": "M"}, {"size": "L"}), (None, {"size": "L"}), ({"work": "Zari"}, None), (None, None)],
                               "below map<string,string>, above map<string,string>")
    got = [r.x for r in df.select(enrich.overlaid(df["below"], df["above"]).alias("x")).collect()]
    assert got == [{"work": "Zari", "size": "L"}, {"size": "L"}, {"work": "Zari"}, {}]
