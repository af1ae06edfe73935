"""Only documents that an approved image is looked up in are read for facts, and they are the same as before."""

from pyspark.sql import functions as F

from sheetloom.operators import enrich, facts, review
from sheetloom.plans import review_queries as rq
from sheetloom.plans.facts_queries import slips

SMALL = "/root/testdata/sf0.001"
MANIFEST = ("run_id string, image_id string, manifest_ord bigint, original_filename string, image_path string, "
            "proposed_variant_code string, approval_status string, assignment_hash string")


def test_documents_of_approved_images_by_name_or_path(spark):
    rows = [("r", "i1", 1, "A.jpg", "all/A.jpg", "V1", "APPROVED", ""), ("r", "i2", 2, "b.jpg", "all/C.jpg", "V2", "APPROVED", ""),
            ("r", "i3", 3, "d.jpg", "all/d.jpg", "V3", "PENDING", "")]
    manifest = spark.createDataFrame(rows, MANIFEST).withColumn("assignment_hash", review.assignment_hash(F.col("image_id"), F.col("proposed_variant_code")))
    documents = spark.createDataFrame(
        [("r", 1, "a.JPG"), ("r", 2, "a.jpg"), ("r", 3, "ALL/c.jpg"), ("r", 4, "d.jpg"), ("s", 5, "a.jpg"), ("r", 6, "loose.jpg")],
        "run_id string, doc_id bigint, filename string")
    assert sorted(r.doc_id for r in enrich.asked_documents(documents, manifest).collect()) == [2, 3]


def test_the_same_candidates_as_from_all_documents(spark):
    entries = rq.manifest(spark, SMALL)
    documents = slips(spark, SMALL)
    asked = enrich.asked_documents(documents, entries)
    assert 0 < asked.count() < documents.count()
    both = [sorted(map(str, enrich.documents_with_candidates(d, facts.all_facts(d)).join(
        asked.select("run_id", F.lower("filename").alias("doc_key")), ["run_id", "doc_key"], "left_semi").collect())) for d in (documents, asked)]
    assert both[0] == both[1]
