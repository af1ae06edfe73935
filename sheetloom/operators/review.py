"""Review manifest: creation, decisions, checks, and what may be uploaded.

manifest  run_id, manifest_ord, image_id, image_path, original_filename, catalog_name, proposed_variant_code,
          match_status, approval_status, approved_by, approved_at, assignment_hash, image_sku, ...
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.operators.ranking import rank_by_number

IMAGE = ["run_id", "image_id"]


def assignment_hash(image: Column, code: Column) -> Column:
    pair = F.concat(image, F.lit(":"), F.coalesce(F.nullif(code, F.lit("")), F.lit("UNASSIGNED")))
    return F.concat(F.lit("hash_"), F.left(F.sha2(pair, 256), F.lit(16)))


def is_valid() -> Column:
    """Approved, assigned, and the hash still fits the assignment."""
    fits = F.col("assignment_hash") == assignment_hash(F.col("image_id"), F.col("proposed_variant_code"))
    return F.coalesce((F.col("approval_status") == "APPROVED") & (F.col("proposed_variant_code") != "") & fits,
                      F.lit(False))


def text_evidence(facts: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """What the text of an image's document says: ``ocr_evidence`` of provider, confidence and the last value of each field.

    ``documents(run_id, doc_id, provider, confidence)`` name the reader; without them both are null.
    """
    last = facts.where(F.col("field").isNotNull()).groupBy(*IMAGE, "field").agg(
        F.max_by("value", "fact_ord").alias("value"), F.max("doc_id").alias("doc_id"))
    said = last.groupBy(*IMAGE).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("candidates"), F.max("doc_id").alias("doc_id"))
    if documents is None:
        read = said.withColumns({"provider": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    else:
        read = said.join(documents.select("run_id", "doc_id", "provider", F.col("confidence").cast("double").alias("confidence")),
                         ["run_id", "doc_id"], "left")
    return read.select(*IMAGE, F.struct("provider", "confidence", "candidates").alias("ocr_evidence"))


def create_manifest(findings: DataFrame, images: DataFrame, facts: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """One pending entry per image; a printed SKU found on the image is kept, and all that its text says as evidence."""
    printed = facts.groupBy(*IMAGE).agg(
        *[F.min_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("fact_ord"))).alias(n)
          for f, n in (("supplier_sku", "sku_a"), ("sku", "sku_b"))],
        F.count(F.lit(1)).alias("evidence_count"))
    named = findings.join(images.select(*IMAGE, F.col("relative_path").alias("image_path"), "original_filename"), IMAGE)
    told = named.join(printed, IMAGE, "left").join(text_evidence(facts, documents), IMAGE, "left")
    return told.select(
        *IMAGE, "image_path", "original_filename", "catalog_name", F.col("product_id").alias("proposed_product_id"),
        F.col("variant_code").alias("proposed_variant_code"), F.col("status").alias("match_status"), "match_strategy",
        "confidence", F.coalesce("sku_a", "sku_b").alias("image_sku"), "ocr_evidence",
        F.coalesce("evidence_count", F.lit(0)).alias("evidence_count"),
        F.lit("PENDING").alias("approval_status"),
        assignment_hash(F.col("image_id"), F.col("variant_code")).alias("assignment_hash"),
        F.col("reason").alias("notes"))


def _with_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Text columns that ``df`` lacks, as nulls."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def apply_decisions(manifest: DataFrame, decisions: DataFrame) -> DataFrame:
    """Manifest after a log of decisions.

    ``decisions(run_id, image_id, decision_ord, action, reviewer, decided_at, new_variant_code, image_sku, detected_color, reason)``; the last
    three and the time may be absent.

    An approval counts only when the image has a code at that moment: its own or
    one from an earlier reassignment.  Everything else is the last effective
    decision, found with aggregates, so a long log of one image stays spread out.
    """
    manifest = _with_columns(manifest, ("approved_at", "detected_color", "notes"))
    decisions = _with_columns(decisions, ("decided_at", "detected_color", "reason"))
    acts = decisions.where(F.col("action").isin("approve", "reject", "reassign"))
    given = acts.groupBy(*IMAGE).agg(
        F.min(F.when(F.col("action") == "reassign", F.col("decision_ord"))).alias("first_reassign"))
    known = manifest.select(*IMAGE, (F.coalesce("proposed_variant_code", F.lit("")) != "").alias("has_code"))
    in_force = (acts.join(given, IMAGE).join(known, IMAGE).where(
        (F.col("action") != "approve") | F.col("has_code")
        | F.coalesce(F.col("first_reassign") < F.col("decision_ord"), F.lit(False))))

    def last(value: Column, when: Column) -> Column:
        return F.max_by(F.when(when, value), F.when(when, F.col("decision_ord")))

    action = F.col("action")
    # a decision without a note leaves the entry's note as it is
    note = F.when(action == "reassign", F.concat(
        F.lit("Reassigned to "), F.col("new_variant_code"), F.lit(" by "), F.col("reviewer"),
        F.lit("; awaiting re-approval"))).otherwise(F.col("reason"))
    state = in_force.groupBy(*IMAGE).agg(
        F.max_by(F.struct("action", "reviewer", "decided_at"), "decision_ord").alias("final"),
        last(F.col("new_variant_code"), action == "reassign").alias("new_code"),
        last(F.col("image_sku"), (action == "approve") & F.col("image_sku").isNotNull()).alias("new_sku"),
        last(F.col("detected_color"), (action == "approve") & F.col("detected_color").isNotNull()).alias("new_color"),
        last(note, note.isNotNull()).alias("new_note"),
        F.max(action != "reject").alias("rehashed"))
    code = F.coalesce("new_code", "proposed_variant_code")
    final = F.col("final.action")
    status = (F.when(final == "approve", F.lit("APPROVED")).when(final == "reject", F.lit("REJECTED"))
              .when(final == "reassign", F.lit("PENDING")).otherwise(F.col("approval_status")))
    by = (F.when(final.isNull(), F.col("approved_by")).when(final != "reassign", F.col("final.reviewer")))
    at = F.when(final.isNull(), F.col("approved_at")).when(final != "reassign", F.col("final.decided_at"))
    hashed = F.when(F.col("rehashed"), assignment_hash(F.col("image_id"), code)).otherwise(F.col("assignment_hash"))
    return (manifest.join(state, IMAGE, "left")
            .withColumns({"approval_status": status, "approved_by": by, "approved_at": at, "assignment_hash": hashed,
                          "image_sku": F.coalesce("new_sku", "image_sku"), "notes": F.coalesce("new_note", "notes"),
                          "detected_color": F.coalesce("new_color", "detected_color")})
            .withColumn("proposed_variant_code", code)
            .drop("final", "new_code", "new_sku", "new_note", "new_color", "rehashed"))


def check(manifest: DataFrame, variants: DataFrame) -> DataFrame:
    """Approved without a code, unknown codes, several approved images of one variant."""
    code = F.coalesce("proposed_variant_code", F.lit(""))
    no_code = manifest.where((code == "") & (F.col("approval_status") == "APPROVED")).select(
        "run_id", F.col("image_id").alias("subject"), F.concat(
            F.lit("Image '"), F.col("image_id"), F.lit("' is marked APPROVED but has no assigned variant code.")).alias("message"))
    known = variants.select("run_id", F.col("variant_code").alias("proposed_variant_code"))
    unknown = manifest.where(code != "").join(known, ["run_id", "proposed_variant_code"], "left_anti").select(
        "run_id", F.col("image_id").alias("subject"), F.concat(
            F.lit("Image '"), F.col("image_id"), F.lit("' assigned to unknown variant '"),
            F.col("proposed_variant_code"), F.lit("'")).alias("message"))
    several = (manifest.where(is_valid()).groupBy("run_id", "proposed_variant_code")
               .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
               .select("run_id", F.col("proposed_variant_code").alias("subject"), F.concat(
                   F.lit("Multiple approved images ("), F.col("n").cast("string"),
                   F.lit(") assigned to single variant '"), F.col("proposed_variant_code"), F.lit("'")).alias("message")))
    return no_code.unionByName(unknown).unionByName(several)


def summary(manifest: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    approved = F.count_if(is_valid())
    return manifest.groupBy("run_id").agg(
        total.alias("total_images"),
        *[F.count_if(F.col("match_status") == s).alias(f"{s.lower()}_count") for s in ("MATCHED", "AMBIGUOUS", "UNMATCHED")],
        approved.alias("approved_count"),
        F.count_if(F.col("approval_status") == "PENDING").alias("pending_approval_count"),
        F.count_if(F.col("approval_status") == "REJECTED").alias("rejected_count"),
        F.bround(approved / total * 100, 2).alias("approval_rate_percent"))


def picked_approvals(manifest: DataFrame) -> DataFrame:
    """Per variant: review flags, number of valid approvals, and the first of them."""
    valid = is_valid()
    approved = F.col("approval_status") == "APPROVED"
    entry = F.struct(*[x for x in manifest.columns if x not in ("run_id", "proposed_variant_code")])
    return (manifest.where(F.col("proposed_variant_code") != "").withColumn("is_valid", valid)
            .groupBy("run_id", F.col("proposed_variant_code").alias("variant_code")).agg(
                F.count_if("is_valid").alias("valid_count"),
                F.bool_or(approved & ~F.col("is_valid")).alias("has_stale"),
                F.bool_or(F.col("approval_status") == "PENDING").alias("has_pending"),
                F.bool_or(F.col("approval_status") == "REJECTED").alias("has_rejected"),
                F.min_by(F.when(F.col("is_valid"), entry), F.when(F.col("is_valid"), F.col("manifest_ord"))).alias("approved")))


def upload_list(galleries: DataFrame, manifest: DataFrame, variants: DataFrame) -> DataFrame:
    """Images to upload per variant, approved reassignments behind the matched ones.

    ``galleries(run_id, variant_code, image_id, sort_index)`` are the matched
    images.  ``approved`` tells whether the strict approval gate lets a row pass.
    """
    valid = manifest.where(is_valid()).select(
        *IMAGE, F.col("proposed_variant_code").alias("variant_code"), "manifest_ord")
    known = variants.select("run_id", "variant_code").distinct()
    late = (valid.join(known, ["run_id", "variant_code"], "left_semi")
            .join(galleries.select("run_id", "variant_code", "image_id"), ["run_id", "variant_code", "image_id"], "left_anti"))
    ranked = rank_by_number(late, ["run_id", "variant_code"], "manifest_ord", "place")
    sizes = galleries.groupBy("run_id", "variant_code").agg(F.count(F.lit(1)).alias("size"))
    tail = (ranked.join(sizes, ["run_id", "variant_code"], "left")
            .withColumn("sort_index", (F.coalesce("size", F.lit(0)) + F.col("place") - 1).cast("int"))
            .select("run_id", "variant_code", "image_id", "sort_index", F.lit("manifest_approval").alias("origin")))
    listed = galleries.select("run_id", "variant_code", "image_id", F.col("sort_index").cast("int").alias("sort_index"),
                              F.lit("image_matcher").alias("origin")).unionByName(tail)
    passes = valid.select("run_id", "variant_code", "image_id", F.lit(True).alias("approved"))
    return (listed.join(passes, ["run_id", "variant_code", "image_id"], "left")
            .withColumns({"approved": F.coalesce("approved", F.lit(False)), "is_primary": F.col("sort_index") == 0}))


def backfilled_urls(uploads: DataFrame) -> DataFrame:
    """Hosted URLs per variant: the primary in slot 0, the others by image place."""
    done = uploads.where((F.col("status") == "UPLOADED") & (F.col("blob_url") != ""))
    primary = done.where("is_primary").groupBy("run_id", "variant_code").agg(
        F.max_by("blob_url", "sort_index").alias("url")).withColumn("slot", F.lit(0))
    rest = rank_by_number(done.where(~F.col("is_primary")), ["run_id", "variant_code"], "sort_index", "slot")
    return primary.select("run_id", "variant_code", "slot", "url").unionByName(
        rest.select("run_id", "variant_code", "slot", F.col("blob_url").alias("url")))


def upload_summary(uploads: DataFrame) -> DataFrame:
    def number(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return uploads.groupBy("run_id").agg(
        F.count_if(F.col("status") != "SKIPPED").alias("total_attempted"),
        number("UPLOADED").alias("successful_uploads"), number("SKIPPED").alias("skipped_count"),
        number("FAILED").alias("failed_count"), number("COLLISION").alias("collision_count"),
        (F.count_if(F.col("status").isin("FAILED", "COLLISION")) == 0).alias("is_all_successful"))
