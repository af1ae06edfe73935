"""Refined variants: approved images, text facts, colours, uploads and findings joined per variant.

Every side table is aggregated to one row per join key first, so the chain of
left joins never multiplies variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.functions import clean as c
from sheetloom.operators.images import stem
from sheetloom.operators.review import picked_approvals

CODE = ["run_id", "variant_code"]
FACT_FIELDS = {
    "design": ["design_number", "design_no", "design"],
    "sku": ["supplier_sku", "sku", "item_code"],
    "color": ["color", "colour"],
    "fabric": ["fabric", "saree_fabric"],
    "rate": ["rate", "price", "wholesale_rate"],
}


def asked_documents(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents that an approved image of a variant is looked up in: those of its name or path, of several the last.

    Only ids and names are compared here, so that texts nobody looks up are not read for facts.
    """
    approved = picked_approvals(manifest).where(F.col("approved").isNotNull())
    names = F.array(F.lower("approved.original_filename"), F.lower("approved.image_path"))
    asked = approved.select("run_id", F.explode(names).alias("doc_key")).where(F.col("doc_key").isNotNull()).distinct()
    named = documents.select("run_id", "doc_id", F.lower("filename").alias("doc_key"))
    newest = (named.join(asked, ["run_id", "doc_key"], "left_semi").groupBy("run_id", "doc_key")
              .agg(F.max("doc_id").alias("doc_id")).select("run_id", "doc_id").distinct())
    return documents.join(newest, ["run_id", "doc_id"], "left_semi")


def documents_with_candidates(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """Last fact of each kind per document; of documents with one name the last."""
    def last(kind: str) -> Column:
        value = F.col("value").try_cast("double") if kind == "rate" else c.pystrip("value")
        take = F.col("field").isin(FACT_FIELDS[kind]) & value.isNotNull()
        return F.max_by(F.when(take, value), F.when(take, F.col("fact_ord"))).alias(f"doc_{kind}")

    per_doc = facts.groupBy("run_id", "doc_id").agg(*[last(k) for k in FACT_FIELDS])
    newest = documents.groupBy("run_id", F.lower("filename").alias("doc_key")).agg(F.max("doc_id").alias("doc_id"))
    return (newest.join(documents.select("run_id", "doc_id", "status", "provider", "confidence",
                                   *[x for x in ("text",) if x in documents.columns]), ["run_id", "doc_id"])
            .join(per_doc, ["run_id", "doc_id"], "left")
            .select("run_id", "doc_key", F.col("status").alias("doc_status"), F.col("provider").alias("doc_provider"),
                    F.col("confidence").alias("doc_confidence"),
                    (F.col("text") if "text" in documents.columns else F.lit(None).cast("string")).alias("doc_text"),
                    *[f"doc_{k}" for k in FACT_FIELDS]))


def issue_counts(issues: DataFrame) -> DataFrame:
    """Errors and other findings per variant code, or per SKU when no code is named."""
    key = F.coalesce(F.nullif("variant_code", F.lit("")), F.nullif("supplier_sku", F.lit("")), F.lit("global"))
    return issues.groupBy("run_id", key.alias("issue_key")).agg(
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") != "ERROR").alias("warnings"))


def with_approval(variants: DataFrame, manifest: DataFrame) -> DataFrame:
    """Approval ladder: approved, stale, pending, rejected, unassigned."""
    joined = variants.join(picked_approvals(manifest), CODE, "left")
    status = (F.when(F.col("valid_count") > 0, F.lit("APPROVED")).when(F.col("has_stale"), F.lit("STALE_HASH_MISMATCH"))
              .when(F.col("has_pending"), F.lit("PENDING")).when(F.col("has_rejected"), F.lit("REJECTED"))
              .otherwise(F.lit("UNASSIGNED")))
    reason = (F.when(status == "STALE_HASH_MISMATCH", F.lit("Stale image approval detected: assignment hash mismatch"))
              .when(status == "PENDING", F.lit("Image assignment pending human review"))
              .when(status == "REJECTED", F.lit("Image assignment was explicitly rejected"))
              .when(status == "UNASSIGNED", F.lit("No approved image assigned"))
              .when(F.col("valid_count") > 1, F.concat(
                  F.lit("Duplicate approved image assignments detected: "), F.col("valid_count").cast("string"),
                  F.lit(" approved images assigned to variant '"), F.col("variant_code"), F.lit("'"))))
    return joined.withColumns({"ladder_status": status, "ladder_reason": reason})


def with_candidates(joined: DataFrame, doc_candidates: DataFrame) -> DataFrame:
    """Text candidates of the approved image: its document, else the manifest's own evidence."""
    by_name = doc_candidates.select("run_id", F.col("doc_key").alias("name_key"),
                                    F.struct(*[x for x in doc_candidates.columns if x.startswith("doc_") and x != "doc_key"]).alias("by_name"))
    by_path = by_name.select("run_id", F.col("name_key").alias("path_key"), F.col("by_name").alias("by_path"))
    found = (joined.withColumns({"name_key": F.lower("approved.original_filename"), "path_key": F.lower("approved.image_path")})
             .join(by_name, ["run_id", "name_key"], "left").join(by_path, ["run_id", "path_key"], "left")
             .withColumn("doc", F.coalesce("by_name", "by_path")).drop("name_key", "path_key", "by_name", "by_path"))
    has_doc, own = F.col("doc").isNotNull(), F.col("approved.ocr_evidence").isNotNull()
    evidence = F.col("approved.ocr_evidence")

    def pick(doc: str, other: Column | None = None) -> Column:
        return F.when(has_doc, F.col(f"doc.{doc}")).otherwise(F.lit(None) if other is None else F.when(own, other))

    def said(*names: str) -> Column:
        """First of the fields that the evidence fills."""
        return F.coalesce(*[F.nullif(F.try_element_at(evidence["candidates"], F.lit(n)), F.lit("")) for n in names])

    return found.withColumns({
        "ocr_status": F.when(has_doc, F.col("doc.doc_status")).when(own, F.lit("SUCCESS")).otherwise(F.lit("NOT_RUN")),
        "ocr_provider": pick("doc_provider", F.coalesce(evidence["provider"], F.lit("manifest_record"))),
        "candidate_design_number": pick("doc_design", said("design_number")), "candidate_sku": pick("doc_sku", said("supplier_sku", "sku")),
        "candidate_color": pick("doc_color", said("color")), "candidate_fabric": pick("doc_fabric", said("fabric")),
        "candidate_rate": pick("doc_rate"), "ocr_confidence": pick("doc_confidence", evidence["confidence"]).cast("double"),
        "raw_ocr_text": pick("doc_text").cast("string")}).drop("doc")


def with_colour(found: DataFrame, colours: DataFrame, heroes: DataFrame) -> DataFrame:
    """Colour and image SKU from the approved image, else from the first matched one."""
    result = F.struct("status", "canonical_color", "confidence", "hex_code", "is_ambiguous", "notes")
    per_image = colours.groupBy("run_id", "image_id").agg(F.min(result).alias("result"))
    hero = (heroes.join(per_image, ["run_id", "image_id"], "left")
            .select(*CODE, F.col("original_filename").alias("hero_name"), F.col("result").alias("hero_colour")))
    joined = (found.withColumn("approved_image", F.col("approved.image_id"))
              .join(per_image.select("run_id", F.col("image_id").alias("approved_image"), F.col("result").alias("pixels")),
                    ["run_id", "approved_image"], "left")
              .join(hero, CODE, "left"))
    approved, matched = F.col("approved").isNotNull(), F.col("hero_name").isNotNull()
    recorded = F.when(F.col("approved.detected_color") != "", F.struct(
        F.lit("EXTRACTED").alias("status"), F.col("approved.detected_color").alias("canonical_color"),
        F.coalesce("approved.evidence_confidence", F.lit(0.8)).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("hex_code"), F.lit(False).alias("is_ambiguous"),
        F.lit("Pre-analyzed image color from manifest").alias("notes")))
    status_only = F.when(F.col("approved.evidence_status") != "", F.struct(
        F.col("approved.evidence_status").alias("status"), F.lit(None).cast("string").alias("canonical_color"),
        F.coalesce("approved.evidence_confidence", F.lit(0.0)).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("hex_code"), F.lit(True).alias("is_ambiguous"),
        F.lit(None).cast("string").alias("notes")))
    shown = joined.withColumn("colour", F.when(approved, F.coalesce(recorded, F.col("pixels"), status_only))
                              .when(matched, F.col("hero_colour")))
    clear = (F.col("colour.status") == "EXTRACTED") & ~F.col("colour.is_ambiguous") & (F.col("colour.canonical_color") != "")
    sku = (F.when(approved, F.coalesce(F.nullif(c.pystrip("approved.image_sku"), F.lit("")),
                                       F.nullif(c.pystrip("candidate_sku"), F.lit(""))))
           .when(matched, F.coalesce(F.nullif("image_sku", F.lit("")), stem(F.col("hero_name")))))
    return shown.withColumns({
        "refined_image_sku": sku,
        "refined_color": F.when(clear, F.col("colour.canonical_color")),
        "image_color_status": F.coalesce("colour.status", F.lit("NOT_ANALYZED"))})


def with_hosting(df: DataFrame) -> DataFrame:
    url = F.col("primary_image_url")
    hosted = F.coalesce((url.startswith("https://") | url.startswith("http://")) & c.is_hosted_url(url), F.lit(False))
    return df.withColumns({"is_uploaded": hosted, "blob_url": F.when(hosted, url),
                           "gallery_blob_urls": F.filter("gallery_image_urls", lambda u: c.is_hosted_url(u))})


def with_findings(df: DataFrame, issues: DataFrame) -> DataFrame:
    """Numbers of findings by variant code plus those by supplier SKU."""
    counts = issue_counts(issues)
    by_code = counts.select("run_id", F.col("issue_key").alias("variant_code"), F.col("errors").alias("e1"), F.col("warnings").alias("w1"))
    by_sku = counts.select("run_id", F.col("issue_key").alias("supplier_sku"), F.col("errors").alias("e2"), F.col("warnings").alias("w2"))
    zero = F.lit(0)
    return (df.join(by_code, CODE, "left").join(by_sku, ["run_id", "supplier_sku"], "left")
            .withColumns({"validation_errors": F.coalesce("e1", zero) + F.coalesce("e2", zero),
                          "validation_warnings": F.coalesce("w1", zero) + F.coalesce("w2", zero)})
            .drop("e1", "e2", "w1", "w2"))


def _differs(a: str, b: str) -> Column:
    return F.coalesce((F.col(a) != "") & (F.col(b) != "") & (F.lower(a) != F.lower(b)), F.lit(False))


def with_reasons(df: DataFrame) -> DataFrame:
    """Ordered review reasons; any reason asks for review."""
    approved, matched = F.col("approved").isNotNull(), F.col("hero_name").isNotNull()

    def say(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    colour_told = F.col("colour").isNotNull()
    reasons = F.array_compact(F.array(
        F.col("ladder_reason"),
        F.when(approved & _differs("candidate_sku", "supplier_sku"), say(
            "SKU discrepancy: supplier has '", F.col("supplier_sku"), "' vs OCR candidate '", F.col("candidate_sku"), "'")),
        F.when(approved & _differs("candidate_color", "original_color"), say(
            "Color discrepancy: supplier has '", F.col("original_color"), "' vs OCR candidate '", F.col("candidate_color"), "'")),
        F.when(approved & F.col("refined_image_sku").isNull(), say(
            "Image SKU missing for approved image '", F.col("approved.original_filename"), "'; required for publication")),
        F.when(approved & colour_told & _differs("refined_color", "original_color"), say(
            "Image color discrepancy: image pixels suggest '", F.col("refined_color"), "' vs supplier '", F.col("original_color"), "'")),
        F.when(approved & colour_told & F.col("refined_color").isNull(), F.coalesce(
            "colour.notes", say("Image color analysis ", F.lower("colour.status"), "; manual color verification required"))),
        F.when(approved & ~colour_told, F.lit("Image pixel color could not be analyzed (file not accessible)")),
        F.when(~approved & ~matched, F.lit("Missing image assignment")),
        F.when(F.col("selling_price").isNull(), F.lit("Selling price requires manual review (never auto-calculated)")),
        F.when(F.col("validation_errors") > 0, say(
            "Validation errors present (", F.col("validation_errors").cast("string"), ")"))))
    return df.withColumn("review_reasons", reasons).withColumn("requires_review", F.size("review_reasons") > 0)


REFINED_COLUMNS = [
    "run_id", "product_id", "product_ord", "variant_ord", "catalog_name", "product_name", "variant_code", "variant_name",
    "product_group", "brand_name", "product_type", "category_slug", "description", "supplier_sku", "supplier_price",
    "supplier_cost", "gst_percent", "original_color", "size", "selling_price", "stock_quantity", "has_approved_image",
    "image_id", "image_filename", "image_path", "approval_status", "approved_by", "approved_at", "assignment_hash",
    "image_sku", "color", "image_color_status", "image_color_confidence", "image_color_hex", "image_color_notes",
    "ocr_status", "ocr_provider", "ocr_confidence", "candidate_design_number", "candidate_sku", "candidate_color",
    "candidate_fabric", "candidate_rate", "raw_ocr_text", "attributes", "is_uploaded", "blob_url", "gallery_count", "requires_review", "review_reasons", "validation_errors",
    "validation_warnings",
]


# of the product, under its own or another name
PRODUCT_FIELDS = ["catalog_name", "product_name", "product_group", "brand_name", "product_type", "category_slug", "supplier_price",
                  "gst_percent", "description"]
NO_SLUG = "sarees"  # stands in for an empty category slug


def with_attributes(df: DataFrame) -> DataFrame:
    """Attributes of the product under those of the variant, under what its image says of SKU and colour."""
    approved, matched = F.col("approved").isNotNull(), F.col("hero_name").isNotNull()
    told = [("candidate_image_sku", F.when(approved | matched, F.col("refined_image_sku"))),
            ("image_color_candidate", F.when(approved | matched, F.col("refined_color")))]
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in told]), lambda e: e["value"].isNotNull())
    return df.withColumn("attributes", overlaid(overlaid(F.col("product_attributes"), F.col("attributes")), F.map_from_entries(entries)))


def overlaid(below: Column, above: Column) -> Column:
    """Entries of both maps; those of ``above`` count where both have a name."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    top = F.coalesce(above, empty)
    return F.map_concat(F.map_filter(F.coalesce(below, empty), lambda k, v: ~F.map_contains_key(top, k)), top)


def refine(variants: DataFrame, products: DataFrame, manifest: DataFrame, documents: DataFrame, facts: DataFrame, colours: DataFrame,
           heroes: DataFrame, issues: DataFrame) -> DataFrame:
    """One refined row per variant.

    ``heroes(run_id, variant_code, image_id, original_filename)`` is the first
    matched image of a variant.
    """
    parents = products.select("run_id", "product_ord", F.col("attributes").alias("product_attributes"), *PRODUCT_FIELDS)
    variants = variants.join(parents, ["run_id", "product_ord"], "left").withColumn(
        "category_slug", F.coalesce(F.nullif("category_slug", F.lit("")), F.lit(NO_SLUG)))
    original = F.coalesce(F.nullif(F.try_element_at("raw_attributes", F.lit("original_color")), F.lit("")),
                          F.nullif("color", F.lit("")))
    base = with_approval(variants.withColumn("original_color", original), manifest)
    told = with_candidates(base, documents_with_candidates(documents, facts))
    seen = with_findings(with_hosting(with_attributes(with_colour(told, colours, heroes))), issues)
    return with_reasons(seen).select(
        *[F.col("refined_image_sku").alias("image_sku") if x == "image_sku" else
          F.col("refined_color").alias("color") if x == "color" else
          F.col("approved").isNotNull().alias(x) if x == "has_approved_image" else
          F.col("approved.image_id").alias(x) if x == "image_id" else
          F.col("approved.original_filename").alias(x) if x == "image_filename" else
          F.col(f"approved.{x}").alias(x) if x in ("approved_by", "approved_at", "image_path", "assignment_hash") else
          F.when(F.col("approved").isNotNull() & F.col("colour").isNull(), F.lit("Image file inaccessible for local pixel color analysis"))
          .otherwise(F.col("colour.notes")).alias(x) if x == "image_color_notes" else
          F.col("ladder_status").alias(x) if x == "approval_status" else
          F.col("colour.confidence").alias(x) if x == "image_color_confidence" else
          F.col("colour.hex_code").alias(x) if x == "image_color_hex" else
          F.size("gallery_blob_urls").alias(x) if x == "gallery_count" else F.col(x)
          for x in REFINED_COLUMNS])


def summary(refined: DataFrame) -> DataFrame:
    return refined.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_variants"), F.count_if("has_approved_image").alias("approved_image_variants"),
        F.count_if(F.col("ocr_status") == "SUCCESS").alias("ocr_enriched_variants"),
        F.count_if("is_uploaded").alias("uploaded_variants"),
        F.count_if("requires_review").alias("variants_requiring_review"))


def write_refined(refined: DataFrame, path: str) -> None:
    """All variants, those that need review, and the audit numbers."""
    from sheetloom.session import written

    once = written(refined, "refined")
    once.write.partitionBy("run_id").parquet(f"{path}/refined_variants")
    once.where("requires_review").write.partitionBy("run_id").parquet(f"{path}/review_required")
    summary(once).write.parquet(f"{path}/audit_summary")
