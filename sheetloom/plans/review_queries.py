"""Queries of the review manifest and of enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom.operators import enrich, match, review
from sheetloom.operators.ranking import rank_by_number
from sheetloom.plans import bindings as b
from sheetloom.plans import oracle_base as o
from sheetloom.plans.facts_queries import slips
from sheetloom.plans.match_queries import image_facts, image_rows
from sheetloom.plans.normalise_queries import products_variants
from sheetloom.plans.oracle_base import cte, sql
from sheetloom.plans.registry import query
from sheetloom.session import written


def _hash(image: str, code: str) -> str:
    return f"'hash_' || left(sha256({image} || ':' || {code}), 16)"


cte("r_manifest", "", f"select * exclude (hash_code), {_hash('image_id', 'hash_code')} as assignment_hash from ({b.oracle_text(b.MANIFEST)})")
cte("r_valid", "r_manifest", f"""
select *, ocr_provider is not null as has_evidence, approval_status = 'APPROVED' and coalesce(proposed_variant_code, '') <> ''
  and assignment_hash = {_hash('image_id', 'proposed_variant_code')} as ok from r_manifest""")


def manifest(spark, sf):
    bound = b.bind(spark, sf, b.MANIFEST)
    said = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.col(n).alias("value")) for k, n in _SAID.items()]), lambda e: e["value"].isNotNull())
    evidence = F.struct(F.col("ocr_provider").alias("provider"), F.col("ocr_confidence").alias("confidence"), F.map_from_entries(said).alias("candidates"))
    return bound.withColumns({"assignment_hash": review.assignment_hash(F.col("image_id"), F.col("hash_code")),
                              "ocr_evidence": F.when(F.col("ocr_provider").isNotNull(), evidence)}).drop("hash_code", "ocr_provider", "ocr_confidence", *_SAID.values())


_SAID = {"sku": "ocr_sku", "color": "ocr_color", "design_number": "ocr_design", "fabric": "ocr_fabric"}


def flat_evidence(df):
    """Text evidence of manifest entries as plain columns."""
    said = F.transform(F.array_sort(F.map_entries("ocr_evidence.candidates")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return df.withColumns({"ocr_provider": F.col("ocr_evidence.provider"), "ocr_confidence": F.col("ocr_evidence.confidence"),
                           "ocr_candidates": F.array_join(said, "|")}).drop("ocr_evidence")


@query("create_manifest", sql(f"""
select f.run_id, f.image_id, i.relative_path as image_path, i.original_filename, f.catalog_name, f.product_id as proposed_product_id,
  f.variant_code as proposed_variant_code, f.status as match_status, f.match_strategy, f.confidence,
  s.sku as image_sku, coalesce(s.n, 0) as evidence_count, e.said as ocr_candidates, d.provider as ocr_provider, d.confidence as ocr_confidence, 'PENDING' as approval_status,
  {_hash('f.image_id', "coalesce(f.variant_code, 'UNASSIGNED')")} as assignment_hash, f.reason as notes
from m_findings f join m_images i using (run_id, image_id)
left join (select run_id, image_id, arg_min(value, fact_ord) filter (where field = 'sku') as sku, count(*) as n, max(doc_id) as doc_id from m_facts group by 1, 2) s using (run_id, image_id)
left join (select run_id, image_id, string_agg(field || '=' || coalesce(value, ''), '|' order by field) as said from (
  select run_id, image_id, field, arg_max(value, fact_ord) as value from m_facts group by 1, 2, 3) group by 1, 2) e using (run_id, image_id)
left join b_slips d on d.run_id = f.run_id and d.doc_id = s.doc_id""",
    "m_findings m_images m_facts b_slips"))
def create_manifest(spark, sf):
    products, variants = products_variants(spark, sf)
    images = image_rows(spark, sf)
    facts = written(image_facts(spark, sf, images), "facts")
    found = match.match_images(images, products, variants, facts)
    return flat_evidence(review.create_manifest(found, images, facts, slips(spark, sf)))


@query("valid_approvals", sql("select run_id, image_id, proposed_variant_code as variant_code from r_valid where ok", "r_valid"))
def valid_approvals(spark, sf):
    return manifest(spark, sf).where(review.is_valid()).select(
        "run_id", "image_id", F.col("proposed_variant_code").alias("variant_code"))


cte("r_acts", "r_manifest", f"""
select d.*, m.run_id, m.image_id, coalesce(m.proposed_variant_code, '') <> '' as has_code
from ({b.oracle_text(b.DECISIONS)}) d join r_manifest m on m.manifest_ord = d.image_ord where action <> 'none'""")
cte("r_force", "r_acts", """
select * from r_acts a where action <> 'approve' or has_code
  or exists (select 1 from r_acts p where p.image_ord = a.image_ord and p.action = 'reassign' and p.decision_ord < a.decision_ord)""")
cte("r_state", "r_force", """
select image_ord, arg_max(action, decision_ord) as final, arg_max(reviewer, decision_ord) as who,
  arg_max(new_variant_code, decision_ord) filter (where action = 'reassign') as code,
  arg_max(image_sku, decision_ord) filter (where action = 'approve' and image_sku is not null) as sku,
  arg_max(case when action = 'reassign' then 'Reassigned to ' || new_variant_code || ' by ' || reviewer || '; awaiting re-approval' else reason end, decision_ord)
    filter (where action = 'reassign' or reason is not null) as note,
  arg_max(detected_color, decision_ord) filter (where action = 'approve' and detected_color is not null) as color, arg_max(decided_at, decision_ord) as decided,
  bool_or(action <> 'reject') as rehashed
from r_force group by 1""")


def _decisions(spark, sf, entries):
    places = entries.select("run_id", "image_id", F.col("manifest_ord").alias("image_ord"))
    return b.bind(spark, sf, b.DECISIONS).join(places, "image_ord")


@query("apply_review_decisions", sql(f"""
select m.run_id, m.image_id, coalesce(s.code, m.proposed_variant_code) as proposed_variant_code,
  case final when 'approve' then 'APPROVED' when 'reject' then 'REJECTED' when 'reassign' then 'PENDING' else approval_status end as approval_status,
  case when final is null then approved_by when final <> 'reassign' then who end as approved_by,
  case when final is null then approved_at when final <> 'reassign' then decided end as approved_at, coalesce(s.color, m.detected_color) as detected_color,
  coalesce(s.sku, m.image_sku) as image_sku, coalesce(s.note, m.notes) as notes,
  case when rehashed then {_hash('m.image_id', "coalesce(s.code, m.proposed_variant_code, 'UNASSIGNED')")} else assignment_hash end as assignment_hash
from r_manifest m left join r_state s on s.image_ord = m.manifest_ord""", "r_manifest r_state"))
def apply_review_decisions(spark, sf):
    entries = manifest(spark, sf)
    return review.apply_decisions(entries, _decisions(spark, sf, entries)).select(
        "run_id", "image_id", "proposed_variant_code", "approval_status", "approved_by", "approved_at", "detected_color", "image_sku", "notes",
        "assignment_hash")


@query("check_manifest", sql("""
select run_id, image_id as subject, 'Image ''' || image_id || ''' is marked APPROVED but has no assigned variant code.' as message
from r_valid where proposed_variant_code is null and approval_status = 'APPROVED'
union all
select run_id, image_id, 'Image ''' || image_id || ''' assigned to unknown variant ''' || proposed_variant_code || ''''
from r_valid r where proposed_variant_code is not null
  and not exists (select 1 from o_variants v where v.run_id = r.run_id and v.variant_code = r.proposed_variant_code)
union all
select run_id, proposed_variant_code, 'Multiple approved images (' || count(*) || ') assigned to single variant ''' || proposed_variant_code || ''''
from r_valid where ok group by 1, 2 having count(*) > 1""", "r_valid o_variants"))
def check_manifest(spark, sf):
    return review.check(manifest(spark, sf), products_variants(spark, sf)[1])


@query("manifest_summary", sql("""
select run_id, count(*) as total_images, count(*) filter (where match_status = 'MATCHED') as matched_count,
  count(*) filter (where match_status = 'AMBIGUOUS') as ambiguous_count, count(*) filter (where match_status = 'UNMATCHED') as unmatched_count,
  count(*) filter (where ok) as approved_count, count(*) filter (where approval_status = 'PENDING') as pending_approval_count,
  count(*) filter (where approval_status = 'REJECTED') as rejected_count,
  round_even(count(*) filter (where ok) / count(*) * 100, 2) as approval_rate_percent from r_valid group by 1""", "r_valid"))
def manifest_summary(spark, sf):
    return review.summary(manifest(spark, sf))


_PICK = "image_id, manifest_ord, original_filename, image_path, approved_by, approved_at, assignment_hash, image_sku, detected_color, evidence_confidence, evidence_status, has_evidence, ocr_provider, ocr_confidence, ocr_sku, ocr_color, ocr_design, ocr_fabric"
cte("r_picked", "r_valid", f"""
select run_id, proposed_variant_code as variant_code, count(*) filter (where ok) as valid_count,
  coalesce(bool_or(approval_status = 'APPROVED' and not ok), false) as has_stale, bool_or(approval_status = 'PENDING') as has_pending,
  bool_or(approval_status = 'REJECTED') as has_rejected,
  arg_min({{{', '.join(f"'{x}': {x}" for x in _PICK.split(', '))}}}, manifest_ord) filter (where ok) as a
from r_valid where proposed_variant_code is not null group by 1, 2""")


@query("pick_approved", sql("""
select run_id, variant_code, valid_count, a.image_id as image_id, valid_count > 1 as is_duplicate from r_picked where valid_count > 0""", "r_picked"))
def pick_approved(spark, sf):
    return review.picked_approvals(manifest(spark, sf)).where(F.col("valid_count") > 0).select(
        "run_id", "variant_code", "valid_count", F.col("approved.image_id").alias("image_id"),
        (F.col("valid_count") > 1).alias("is_duplicate"))


cte("r_gallery", "r_manifest", """
select run_id, matched_code as variant_code, image_id, row_number() over (partition by run_id, matched_code order by manifest_ord) - 1 as sort_index,
  original_filename from r_manifest where match_status = 'MATCHED'""")


def _gallery(entries):
    matched = entries.where(F.col("match_status") == "MATCHED").select(
        "run_id", F.col("matched_code").alias("variant_code"), "image_id", "original_filename", "manifest_ord")
    ranked = rank_by_number(matched, ["run_id", "variant_code"], "manifest_ord", "place")
    return ranked.withColumn("sort_index", F.col("place") - 1)


cte("r_late", "r_valid r_gallery o_variants", """
select run_id, proposed_variant_code as variant_code, image_id, manifest_ord from r_valid r where ok
  and exists (select 1 from o_variants v where v.run_id = r.run_id and v.variant_code = r.proposed_variant_code)
  and not exists (select 1 from r_gallery g where g.run_id = r.run_id and g.variant_code = r.proposed_variant_code and g.image_id = r.image_id)""")
cte("r_listed", "r_late r_gallery", """
select run_id, variant_code, image_id, sort_index, 'image_matcher' as origin from r_gallery
union all
select l.run_id, l.variant_code, l.image_id, coalesce(s.size, 0) - 1 + row_number() over (partition by l.run_id, l.variant_code order by manifest_ord), 'manifest_approval'
from r_late l left join (select run_id, variant_code, count(*) as size from r_gallery group by 1, 2) s using (run_id, variant_code)""")


@query("upload_eligibility", sql("""
select l.run_id, l.variant_code, l.image_id, sort_index, origin, coalesce(r.ok, false) as approved, sort_index = 0 as is_primary
from r_listed l left join r_valid r on r.run_id = l.run_id and r.image_id = l.image_id and r.proposed_variant_code = l.variant_code and r.ok""",
    "r_valid r_listed"))
def upload_eligibility(spark, sf):
    entries = written(manifest(spark, sf), "manifest")
    return review.upload_list(written(_gallery(entries), "gallery"), entries, products_variants(spark, sf)[1])


cte("r_uploads", "", b.oracle_text(b.UPLOADS))


@query("backfill_urls", sql("""
select run_id, variant_code, 0 as slot, arg_max(blob_url, sort_index) as url from r_uploads where status = 'UPLOADED' and is_primary group by 1, 2
union all
select run_id, variant_code, row_number() over (partition by run_id, variant_code order by sort_index), blob_url
from r_uploads where status = 'UPLOADED' and not is_primary""", "r_uploads"))
def backfill_urls(spark, sf):
    return review.backfilled_urls(b.bind(spark, sf, b.UPLOADS))


@query("upload_summary", sql("""
select run_id, count(*) filter (where status <> 'SKIPPED') as total_attempted, count(*) filter (where status = 'UPLOADED') as successful_uploads,
  count(*) filter (where status = 'SKIPPED') as skipped_count, count(*) filter (where status = 'FAILED') as failed_count,
  count(*) filter (where status = 'COLLISION') as collision_count, count(*) filter (where status in ('FAILED', 'COLLISION')) = 0 as is_all_successful
from r_uploads group by 1""", "r_uploads"))
def upload_summary(spark, sf):
    return review.upload_summary(b.bind(spark, sf, b.UPLOADS))


# -------------------------------------------------------------- enrichment
cte("e_docs", "b_slips s_facts", """
select d.*, f.* exclude (doc_id) from (
  select run_id, lower(filename) as doc_key, arg_max(doc_id, doc_id) as doc_id, arg_max(status, doc_id) as doc_status, arg_max(provider, doc_id) as doc_provider,
    arg_max(confidence, doc_id) as doc_confidence, arg_max(text, doc_id) as doc_text
  from b_slips group by 1, 2) d
left join (select doc_id,
    arg_max(value, fact_ord) filter (where field in ('design_number', 'design_no', 'design')) as doc_design,
    arg_max(value, fact_ord) filter (where field in ('supplier_sku', 'sku', 'item_code')) as doc_sku,
    arg_max(value, fact_ord) filter (where field in ('color', 'colour')) as doc_color,
    arg_max(value, fact_ord) filter (where field in ('fabric', 'saree_fabric')) as doc_fabric,
    arg_max(try_cast(value as double), fact_ord) filter (where field in ('rate', 'price', 'wholesale_rate') and try_cast(value as double) is not null) as doc_rate
  from s_facts group by 1) f on f.doc_id = d.doc_id""")
cte("e_colours", "", b.oracle_text(b.COLOURS))
cte("e_issues", "", f"""
select run_id, coalesce(variant_code, supplier_sku) as k, count(*) filter (where severity = 'ERROR') as e, count(*) filter (where severity <> 'ERROR') as w
from ({b.oracle_text(b.ISSUES)}) group by 1, 2""")
cte("e_heroes", "r_gallery", "select run_id, variant_code, image_id, original_filename from r_gallery where sort_index = 0")
cte("e_1", "o_variants o_products r_picked e_docs e_heroes", """
select v.*, pr.catalog_name, pr.product_name, pr.product_group, pr.brand_name, pr.product_type, coalesce(nullif(pr.category_slug, ''), 'sarees') as category_slug,
  pr.description, pr.supplier_price, pr.gst_percent, d.doc_confidence, d.doc_text, p.valid_count, p.a, coalesce(nullif(v.color, ''), null) as original_color, h.original_filename as hero_name, h.image_id as hero_image,
  case when valid_count > 0 then 'APPROVED' when has_stale then 'STALE_HASH_MISMATCH' when has_pending then 'PENDING' when has_rejected then 'REJECTED' else 'UNASSIGNED' end as ladder,
  d.doc_key is not null as has_doc, d.doc_status, d.doc_provider, d.doc_design, d.doc_sku, d.doc_color, d.doc_fabric, d.doc_rate
from o_variants v left join o_products pr on pr.run_id = v.run_id and pr.product_ord = v.product_ord
left join r_picked p on p.run_id = v.run_id and p.variant_code = v.variant_code
left join e_docs d on d.run_id = v.run_id and d.doc_key = lower(p.a.original_filename)
left join e_heroes h on h.run_id = v.run_id and h.variant_code = v.variant_code""")
cte("e_2", "e_1 e_colours e_issues", """
select e.*, a is not null as approved, hero_name is not null as matched,
  case when has_doc then doc_status when a.has_evidence then 'SUCCESS' else 'NOT_RUN' end as ocr_status,
  case when has_doc then doc_provider when a.has_evidence then coalesce(a.ocr_provider, 'manifest_record') end as ocr_provider,
  case when has_doc then doc_design else a.ocr_design end as candidate_design_number, case when has_doc then doc_sku else a.ocr_sku end as candidate_sku,
  case when has_doc then doc_color else a.ocr_color end as candidate_color, case when has_doc then doc_fabric else a.ocr_fabric end as candidate_fabric, doc_rate as candidate_rate,
  case when has_doc then doc_confidence else a.ocr_confidence end as ocr_confidence, doc_text as raw_ocr_text,
  case when a is not null then case
      when a.detected_color <> '' then {'s': 'EXTRACTED', 'c': a.detected_color, 'f': coalesce(a.evidence_confidence, 0.8)::double, 'h': null, 'm': false, 'n': 'Pre-analyzed image color from manifest'}
      when c.status is not null then {'s': c.status, 'c': c.canonical_color, 'f': c.confidence, 'h': c.hex_code, 'm': c.is_ambiguous, 'n': c.notes}
      when a.evidence_status <> '' then {'s': a.evidence_status, 'c': null, 'f': coalesce(a.evidence_confidence, 0.0)::double, 'h': null, 'm': true, 'n': null} end
    when hero_name is not null and hc.status is not null then {'s': hc.status, 'c': hc.canonical_color, 'f': hc.confidence, 'h': hc.hex_code, 'm': hc.is_ambiguous, 'n': hc.notes} end as col,
  coalesce(i1.e, 0) + coalesce(i2.e, 0) as validation_errors, coalesce(i1.w, 0) + coalesce(i2.w, 0) as validation_warnings
from e_1 e left join e_colours c on c.run_id = e.run_id and c.image_id = e.a.image_id
left join e_colours hc on hc.run_id = e.run_id and hc.image_id = e.hero_image
left join e_issues i1 on i1.run_id = e.run_id and i1.k = e.variant_code left join e_issues i2 on i2.run_id = e.run_id and i2.k = e.supplier_sku""")
cte("e_3", "e_2", r"""
select *, case when approved then coalesce(nullif(trim(a.image_sku), ''), nullif(trim(candidate_sku), ''))
    when matched then coalesce(nullif(image_sku, ''), regexp_replace(hero_name, '(.)\.[^.]+$', '\1')) end as new_sku,
  case when col.s = 'EXTRACTED' and not col.m and col.c <> '' then col.c end as new_color,
  coalesce(regexp_matches(primary_image_url, '^https?://') and contains(primary_image_url, 'blob'), false) as hosted
from e_2""")
# as many entries as a product has attributes, and none of a variant's own: the image's words come on top
cte("e_named", "o_attributes", "select run_id, product_id, name, min(value) as value from o_attributes group by 1, 2, 3")
cte("e_attributes", "e_3 e_named", """
select run_id, product_id, variant_ord, string_agg(name || '=' || value, '|' order by name) as attributes from (
  select e.run_id, e.product_id, e.variant_ord, n.name, n.value from e_3 e join e_named n on n.run_id = e.run_id and n.product_id = e.product_id
  where n.name not in (case when (approved or matched) and new_sku is not null then 'candidate_image_sku' else '' end,
    case when (approved or matched) and new_color is not null then 'image_color_candidate' else '' end)
  union all select run_id, product_id, variant_ord, 'candidate_image_sku', new_sku from e_3 where approved or matched
  union all select run_id, product_id, variant_ord, 'image_color_candidate', new_color from e_3 where approved or matched)
where value is not null group by 1, 2, 3""")
cte("e_refined", "e_3 e_attributes", """
select run_id, product_id, product_ord, variant_ord, variant_code, variant_name, supplier_sku, original_color, size, supplier_cost, selling_price,
  catalog_name, product_name, product_group, brand_name, product_type, category_slug, description, supplier_price, gst_percent, stock_quantity,
  a.image_path as image_path, a.approved_at as approved_at, a.assignment_hash as assignment_hash, case when approved and col is null then 'Image file inaccessible for local pixel color analysis' else col.n end as image_color_notes, ocr_confidence, raw_ocr_text,
  coalesce(attributes, '') as attributes,
  approved as has_approved_image, a.image_id as image_id, a.original_filename as image_filename, ladder as approval_status, a.approved_by as approved_by,
  new_sku as image_sku, new_color as color, coalesce(col.s, 'NOT_ANALYZED') as image_color_status, col.f as image_color_confidence, col.h as image_color_hex,
  ocr_status, ocr_provider, candidate_design_number, candidate_sku, candidate_color, candidate_fabric, candidate_rate,
  hosted as is_uploaded, case when hosted then primary_image_url end as blob_url, len(list_filter(gallery_image_urls, lambda u: contains(u, 'blob'))) as gallery_count,
  validation_errors, validation_warnings,
  concat_ws('; ',
    case ladder when 'STALE_HASH_MISMATCH' then 'Stale image approval detected: assignment hash mismatch' when 'PENDING' then 'Image assignment pending human review'
      when 'REJECTED' then 'Image assignment was explicitly rejected' when 'UNASSIGNED' then 'No approved image assigned'
      else case when valid_count > 1 then 'Duplicate approved image assignments detected: ' || valid_count || ' approved images assigned to variant ''' || variant_code || '''' end end,
    case when approved and candidate_sku <> '' and supplier_sku <> '' and lower(candidate_sku) <> lower(supplier_sku)
      then 'SKU discrepancy: supplier has ''' || supplier_sku || ''' vs OCR candidate ''' || candidate_sku || '''' end,
    case when approved and candidate_color <> '' and lower(candidate_color) <> lower(original_color)
      then 'Color discrepancy: supplier has ''' || original_color || ''' vs OCR candidate ''' || candidate_color || '''' end,
    case when approved and new_sku is null then 'Image SKU missing for approved image ''' || a.original_filename || '''; required for publication' end,
    case when approved and lower(new_color) <> lower(original_color)
      then 'Image color discrepancy: image pixels suggest ''' || new_color || ''' vs supplier ''' || original_color || '''' end,
    case when approved and col is not null and new_color is null then coalesce(col.n, 'Image color analysis ' || lower(col.s) || '; manual color verification required') end,
    case when approved and col is null then 'Image pixel color could not be analyzed (file not accessible)' end,
    case when not approved and not matched then 'Missing image assignment' end,
    case when selling_price is null then 'Selling price requires manual review (never auto-calculated)' end,
    case when validation_errors > 0 then 'Validation errors present (' || validation_errors || ')' end) as review_reasons
from e_3 left join e_attributes using (run_id, product_id, variant_ord)""")


def refined(spark, sf):
    from sheetloom.operators import facts as fx

    entries = written(manifest(spark, sf), "manifest")
    documents = written(enrich.asked_documents(slips(spark, sf), entries), "asked")
    heroes = _gallery(entries).where(F.col("sort_index") == 0)
    products, variants = products_variants(spark, sf)
    return enrich.refine(
        variants, products, entries, documents, fx.all_facts(documents), b.bind(spark, sf, b.COLOURS),
        heroes, b.bind(spark, sf, b.ISSUES))


def shown(df):
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return df.withColumns({"review_reasons": F.array_join("review_reasons", "; "), "attributes": F.array_join(pairs, "|")})


def _part(columns: str):
    return sql(f"select {columns} from e_refined", "e_refined")


_ID = "run_id, product_id, variant_ord, variant_code"
for _name, _columns in {
        "approval_ladder": "has_approved_image, image_id, image_filename, approval_status, approved_by",
        "approved_fact_candidates": "ocr_status, ocr_provider, candidate_design_number, candidate_sku, candidate_color, candidate_fabric, candidate_rate",
        "resolve_image_sku": "image_sku", "resolve_colour": "original_color, color, image_color_status, image_color_confidence, image_color_hex",
        "hosted_status": "is_uploaded, blob_url, gallery_count",
        "review_reasons": "review_reasons, validation_errors, validation_warnings"}.items():
    query(_name, _part(f"{_ID}, {_columns}"))(
        lambda spark, sf, _c=f"{_ID}, {_columns}": shown(refined(spark, sf)).select(*_c.split(", ")))


@query("discrepancy_flags", sql(
    "select run_id, product_id, variant_ord, count(*) as flags from (select run_id, product_id, variant_ord, unnest(string_split(review_reasons, '; ')) as r "
    "from e_refined) where r like '%discrepancy:%' group by 1, 2, 3", "e_refined"))
def discrepancy_flags(spark, sf):
    flags = F.size(F.filter("review_reasons", lambda r: r.contains("discrepancy:"))).cast("bigint")
    return (refined(spark, sf).select("run_id", "product_id", "variant_ord", flags.alias("flags"))
            .where(F.col("flags") > 0))


_ALL = ", ".join(x for x in enrich.REFINED_COLUMNS if x != "requires_review")


@query("enrich_variants", _part(_ALL + ", review_reasons <> '' as requires_review"))
def enrich_variants(spark, sf):
    return shown(refined(spark, sf))


@query("refined_review_required", sql("select run_id, product_id, variant_ord, review_reasons from e_refined where review_reasons <> ''", "e_refined"))
def refined_review_required(spark, sf):
    return shown(refined(spark, sf).where("requires_review")).select("run_id", "product_id", "variant_ord", "review_reasons")


@query("refined_summary", sql("""
select run_id, count(*) as total_variants, count(*) filter (where has_approved_image) as approved_image_variants,
  count(*) filter (where ocr_status = 'SUCCESS') as ocr_enriched_variants, count(*) filter (where is_uploaded) as uploaded_variants,
  count(*) filter (where review_reasons <> '') as variants_requiring_review from e_refined group by 1""", "e_refined"))
def refined_summary(spark, sf):
    return enrich.summary(refined(spark, sf))
