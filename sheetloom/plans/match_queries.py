"""Queries of image listings and image matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import images as im
from sheetloom.operators import match
from sheetloom.plans import bindings as b
from sheetloom.plans import oracle_base as o
from sheetloom.plans.normalise_queries import products_variants
from sheetloom.plans.oracle_base import cte, sql
from sheetloom.plans.registry import query
from sheetloom.session import written


def image_rows(spark, sf):
    return im.inventory(b.bind(spark, sf, b.IMAGES))


def image_facts(spark, sf, images):
    return match.image_facts(images, b.bind(spark, sf, b.SLIP_FACTS))


def _natural(x: str) -> str:
    bare = "regexp_replace(w, '^0+(.)', '\\1')"
    parts = (f"list_aggregate(list_transform(regexp_extract_all(lower({x}), '\\d+|\\D+'), lambda w: "
             f"case when regexp_matches(w, '^[0-9]') then lpad(cast(len({bare}) as varchar), 10, '0') || {bare} else w end), "
             "'string_agg', chr(1))")
    return f"case when regexp_matches({x}, '^[0-9]') then chr(1) || {parts} else {parts} end"


cte("m_files", "b_images", r"""
select *, 'x' as dummy, lower(regexp_extract(original_filename, '^.+(\.[^.]+)$', 1)) as file_extension
from (select *, split_part(relative_path, '/', -1) as original_filename from b_images)""")
cte("m_images", "m_files", rf"""
select * exclude (dummy), 'img_' || left(sha256(source_identity || ':' || relative_path), 16) as image_id,
  lower(trim(regexp_replace(left(original_filename, len(original_filename) - len(file_extension)), '[^\w\-.]+', '_', 'g'), '_')) as normalized_stem,
  list_transform(list_filter(regexp_split_to_array(relative_path, '[/\s\-_,.]+'), lambda w: w <> ''), lambda w: lower(w)) as tokens,
  {o.token_of('relative_path')} as path_text, {_natural('relative_path')} as natural_key
from m_files where file_extension in {o.in_list(fv.IMAGE_EXTENSIONS)}""")
cte("m_stems", "m_images", f"select *, {o.token_of('normalized_stem')} as stem_text from m_images")
cte("m_docs", "", b.oracle_text(b.SLIP_FACTS))
cte("m_facts", "m_images m_docs", """
select i.run_id, i.image_id, d.doc_id, d.fact_ord, d.field, d.value, lower(trim(d.value)) as token
from (select distinct run_id, image_id, lower(original_filename) as key from m_images) i
join (select run_id, lower(filename) as key, max(doc_id) as doc_id from m_docs group by 1, 2) l using (run_id, key)
join m_docs d on d.run_id = l.run_id and d.doc_id = l.doc_id""")
cte("m_variants", "o_variants", f"""
select *, lower(trim(variant_code)) as code_key, nullif(lower(trim(image_sku)), '') as sku_key,
  lower(regexp_extract(primary_image_url, '([^/]+)/*$', 1)) as url_name,
  {o.token_of('color')} as color_token, {o.token_of('variant_name')} as name_token, {o.token_of('variant_code')} as code_token
from o_variants""")
cte("m_exact", "m_stems m_variants", """
select run_id, image_id, min(place) as place from (
  select i.run_id, i.image_id, {'p': v.product_ord, 'v': v.variant_ord, 'r': case
      when stem in (code_key) or starts_with(stem, code_key || '_') or starts_with(stem, code_key || '-') then 1
      when stem in (sku_key) or starts_with(stem, sku_key || '_') or starts_with(stem, sku_key || '-') then 2
      when url_name <> '' and url_name = lower(i.original_filename) then 3 end} as place
  from (select *, normalized_stem as stem from m_stems) i join m_variants v using (run_id))
where place.r is not null group by 1, 2""")
cte("m_scope", "m_stems o_products", f"""
select run_id, image_id, min(product_ord) as product_ord
from m_stems join (select run_id, product_ord, {o.token_of('product_group')} as g, {o.token_of('catalog_name')} as c from o_products) using (run_id)
where (g <> '' and (contains(path_text, g) or contains(stem_text, g)))
   or (c <> '' and (contains(path_text, c) or contains(stem_text, c)))
group by 1, 2""")
cte("m_sizes", "m_variants", "select run_id, product_ord, count(*) as size, min(variant_ord) as lone from m_variants group by 1, 2")
cte("m_scoped", "m_scope m_stems m_sizes", """
select s.run_id, s.image_id, s.product_ord, path_text, stem_text, size, lone
from m_scope s join m_stems using (run_id, image_id) join m_sizes using (run_id, product_ord)""")
cte("m_tokens", "m_scoped m_variants", """
select run_id, product_ord, image_id, count(*) as n, min(variant_ord) as first, bool_or(shared) as by_shared from (
  select s.run_id, s.product_ord, s.image_id, v.variant_ord,
    coalesce(color_token <> '' and (contains(path_text, color_token) or contains(stem_text, color_token)), false) or
    coalesce(name_token <> '' and (contains(path_text, name_token) or contains(stem_text, name_token)), false) as shared,
    code_token <> '' and (contains(path_text, code_token) or contains(stem_text, code_token)) as own
  from m_scoped s join m_variants v using (run_id, product_ord))
where shared or own group by 1, 2, 3""")
cte("m_byfact", "m_scoped m_variants m_facts", """
select run_id, product_ord, image_id, count(distinct variant_ord) as n, min(variant_ord) as first
from m_scoped s join m_facts f using (run_id, image_id) join m_variants v using (run_id, product_ord)
where f.token <> '' and f.token in (lower(variant_code), lower(supplier_sku), lower(image_sku), lower(variant_name))
group by 1, 2, 3""")
cte("m_number", "m_scoped m_variants", f"""
select s.run_id, s.product_ord, s.image_id, v.variant_ord
from (select *, try_cast(regexp_extract(stem_text, '(?:[_\\-]|^0*)(\\d{{1,4}})$', 1) as integer) as no,
        string_split(stem_text, '-') as w from m_scoped) s
join m_variants v on v.run_id = s.run_id and v.product_ord = s.product_ord and v.variant_ord = s.no
where not coalesce(len(w) >= 2 and list_contains([{', '.join(o.lit(x) for x in fv.PHOTO_WORDS)}], w[len(w) - 1]), false)
  and (contains(lower(variant_code), 'v' || no) or contains(lower(variant_code), 'v' || {o.two('no')}) or contains(lower(variant_code), '-' || no)
    or contains(lower(variant_code), '-' || {o.two('no')}) or contains(lower(variant_code), {o.two('no')})
    or contains(lower(variant_name), 'design ' || no) or contains(lower(variant_name), 'design ' || {o.two('no')}))""")
cte("m_free", "m_images m_variants m_facts", """
select run_id, image_id, min({'f': fact_ord, 'p': product_ord, 'v': variant_ord, 'field': field, 'value': value}) as best
from m_facts join m_variants v using (run_id)
where token <> '' and token in (lower(variant_code), lower(image_sku)) group by 1, 2""")
cte("m_sku", "m_images m_variants", r"""
select run_id, image_id, count(*) as n, count(distinct variant_code) as codes, min({'p': product_ord, 'v': variant_ord, 's': supplier_sku}) as first,
  max({'p': product_ord, 'v': variant_ord}) as last, any_value(try_cast(regexp_extract(original_filename, '[_\-](\d+)(?:\.\w+)?$', 1) as integer)) as number
from m_images join m_variants v using (run_id)
where trim(supplier_sku) <> '' and (list_contains(tokens, lower(trim(supplier_sku))) or contains(normalized_stem, lower(trim(supplier_sku))))
group by 1, 2""")
cte("m_raw", "m_images m_exact m_scoped m_tokens m_byfact m_number m_free m_sku m_sizes", """
select i.run_id, i.image_id,
  case when e.place is not null then 1 when s.size = 1 then 2 when t.n is not null then 3 when s.size is not null and bf.n is not null then 4
    when nu.variant_ord is not null then 5 when s.size is not null then 6 when fr.best is not null then 7 when k.codes = 1 then 8
    when k.number between 1 and ks.size then 9 when k.n is not null then 10 else 11 end as step,
  e.place, s.product_ord as sp, s.size, s.lone, t.n as tn, t.first as tf, t.by_shared, bf.n as bn, bf.first as bff, nu.variant_ord as nv,
  fr.best, k.n as kn, k.first as kf, k.last as kl, k.number as kno
from m_images i left join m_exact e using (run_id, image_id) left join m_scoped s using (run_id, image_id)
left join m_tokens t using (run_id, image_id) left join m_byfact bf using (run_id, image_id) left join m_number nu using (run_id, image_id)
left join m_free fr using (run_id, image_id) left join m_sku k using (run_id, image_id)
left join m_sizes ks on ks.run_id = k.run_id and ks.product_ord = k.first.p""")
cte("m_found", "m_raw", """
select run_id, image_id,
  case when step in (1, 2, 5, 7, 8, 9) or (step = 3 and tn = 1) or (step = 4 and bn = 1) then 'MATCHED' when step = 11 then 'UNMATCHED' else 'AMBIGUOUS' end as status,
  case step when 1 then place.p when 7 then best.p when 8 then kl.p when 9 then kf.p when 10 then null when 11 then null else sp end as product_ord,
  case step when 1 then place.v when 2 then lone when 3 then case when tn = 1 then tf end when 4 then case when bn = 1 then bff end
    when 5 then nv when 7 then best.v when 8 then kl.v when 9 then kno end as variant_ord,
  case step when 1 then case place.r when 1 then 'EXACT_VARIANT_CODE' when 2 then 'EXACT_IMAGE_SKU' else 'SOURCE_URL_EXACT' end
    when 2 then 'SCOPED_SINGLE_VARIANT_PRODUCT'
    when 3 then case when tn > 1 then 'SCOPED_PRODUCT_AMBIGUOUS' when by_shared then 'SCOPED_PRODUCT_COLOR_TOKEN' else 'OCR_CANDIDATE_VARIANT_MATCH' end
    when 4 then case when bn > 1 then 'SCOPED_PRODUCT_AMBIGUOUS' else 'OCR_CANDIDATE_VARIANT_MATCH' end
    when 5 then 'SCOPED_DESIGN_SEQUENCE_INDEX' when 6 then 'SCOPED_MULTI_VARIANT_AMBIGUOUS' when 7 then 'OCR_CANDIDATE_EXACT'
    when 8 then 'SUPPLIER_SKU_SINGLE_VARIANT' when 9 then 'SUPPLIER_SKU_INDEXED_SEQUENCE' when 10 then 'SHARED_SUPPLIER_SKU_AMBIGUOUS' end as match_strategy,
  cast(case step when 1 then 1.0 when 2 then 0.9 when 3 then case when tn = 1 then 0.85 else 0.5 end when 4 then case when bn = 1 then 0.85 else 0.5 end
    when 5 then 0.9 when 6 then 0.5 when 7 then 0.85 when 8 then 0.8 when 9 then 0.75 when 10 then 0.4 else 0 end as double) as confidence,
  cast(case step when 3 then tn when 4 then bn when 6 then size when 10 then kn when 11 then 0 else 1 end as bigint) as candidate_count,
  case when step = 10 then kf.s end as sku,
  case step when 5 then cast(nv as varchar) when 7 then best.field || ' ' || best.value when 9 then cast(kno as varchar) end as note
from m_raw""")
_T = {
    "EXACT_VARIANT_CODE": "'Matched exact variant_code ''' || variant_code || ''''",
    "EXACT_IMAGE_SKU": "'Matched exact image_sku ''' || image_sku || ''''",
    "SOURCE_URL_EXACT": "'Matched remote primary_image_url filename ''' || url_name || ''''",
    "SCOPED_SINGLE_VARIANT_PRODUCT": "'Matched single-variant catalogue ''' || catalog_name || ''' (variant ''' || variant_code || ''')'",
    "SCOPED_DESIGN_SEQUENCE_INDEX": "'Matched scoped catalogue ''' || catalog_name || ''' sequence index ' || note || ' with variant ''' || variant_code || ''''",
    "OCR_CANDIDATE_VARIANT_MATCH": "'Matched scoped catalog ''' || catalog_name || ''' with variant ''' || variant_code || ''''",
    "SCOPED_PRODUCT_COLOR_TOKEN": "'Matched scoped catalog ''' || catalog_name || ''' with variant ''' || variant_code || ''''",
    "SCOPED_PRODUCT_AMBIGUOUS": "'Image belongs to catalog ''' || catalog_name || ''' but matches ' || candidate_count || ' variants'",
    "SCOPED_MULTI_VARIANT_AMBIGUOUS": "'Image belongs to catalogue ''' || catalog_name || ''' (' || candidate_count || ' variants), but lacks variant-distinguishing tokens'",
    "OCR_CANDIDATE_EXACT": "'Matched OCR candidate ' || note || ' to variant ''' || variant_code || ''''",
    "SUPPLIER_SKU_SINGLE_VARIANT": "'Matched single variant ''' || variant_code || ''' for supplier SKU ''' || f_sku || ''''",
    "SUPPLIER_SKU_INDEXED_SEQUENCE": "'Matched variant index ' || note || ' (''' || variant_code || ''') for supplier SKU ''' || coalesce(f_sku, 'None') || ''''",
    "SHARED_SUPPLIER_SKU_AMBIGUOUS": "'Image matches supplier SKU ''' || f_sku || ''' but ' || candidate_count || ' variants share it without disambiguator'",
}
cte("m_findings", "m_found o_products m_variants", f"""
select run_id, image_id, status, product_id, catalog_name, variant_code, f_sku as supplier_sku, match_strategy, confidence, candidate_count,
  case match_strategy {' '.join(f"when '{s}' then {t}" for s, t in _T.items())} else 'No reliable variant identity found' end as reason,
  product_ord, variant_ord
from (select f.*, p.product_id, p.catalog_name, v.variant_code, coalesce(v.supplier_sku, f.sku) as f_sku, v.image_sku, v.url_name
  from m_found f left join o_products p using (run_id, product_ord) left join m_variants v using (run_id, product_ord, variant_ord))""")


@query("image_inventory", sql(f"""
select run_id, relative_path, original_filename, file_extension, file_size_bytes, file_extension in {o.in_list(fv.IMAGE_EXTENSIONS)} as kept,
  case when file_extension not in {o.in_list(fv.IMAGE_EXTENSIONS)} then 'Unsupported file extension ''' || file_extension || '''' end as reason
from m_files""", "m_files"))
def image_inventory(spark, sf):
    paths = b.bind(spark, sf, b.IMAGES)
    columns = ["run_id", "relative_path", "original_filename", "file_extension", "file_size_bytes"]
    kept = im.inventory(paths).select(*columns, F.lit(True).alias("kept"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(im.ignored_files(paths).select(*columns, F.lit(False).alias("kept"), "reason"))


@query("image_identity", sql(
    "select run_id, relative_path, image_id, normalized_stem, array_to_string(tokens, ' ') as tokens from m_images", "m_images"))
def image_identity(spark, sf):
    return image_rows(spark, sf).select(
        "run_id", "relative_path", "image_id", "normalized_stem", F.array_join("tokens", " ").alias("tokens"))


@query("natural_order", sql("""select run_id, relative_path, row_number() over (partition by run_id order by natural_key, relative_path, image_id) as natural_ord
from m_images""", "m_images"))
def natural_order(spark, sf):
    return im.natural_order(image_rows(spark, sf)).select("run_id", "relative_path", "natural_ord")


@query("image_lookup", sql("""
select run_id, identifier, arg_min(image_id, (natural_key, relative_path, image_id)) as image_id
from (select distinct run_id, filename as identifier from m_docs) d join m_images i using (run_id)
where lower(trim(identifier)) in (lower(image_id), lower(original_filename), lower(relative_path)) group by 1, 2""", "m_images m_docs"))
def image_lookup(spark, sf):
    wanted = b.bind(spark, sf, b.SLIP_FACTS).select("run_id", F.col("filename").alias("identifier")).distinct()
    return im.lookup(image_rows(spark, sf), wanted)


def _inputs(spark, sf):
    products, variants = products_variants(spark, sf)
    images = image_rows(spark, sf)
    return images, products, variants, image_facts(spark, sf, images)


@query("match_exact_identity", sql("""
select run_id, image_id, place.p as product_ord, place.v as variant_ord,
  case place.r when 1 then 'EXACT_VARIANT_CODE' when 2 then 'EXACT_IMAGE_SKU' else 'SOURCE_URL_EXACT' end as match_strategy from m_exact""", "m_exact"))
def match_exact_identity(spark, sf):
    images, _, variants, _ = _inputs(spark, sf)
    return match.exact_identity(images, variants).select("run_id", "image_id", "product_ord", "variant_ord", "match_strategy")


@query("match_product_scope", sql("select * from m_scope", "m_scope"))
def match_product_scope(spark, sf):
    images, products, _, _ = _inputs(spark, sf)
    return match.product_scope(images, products.select("run_id", "product_ord", "product_group", "catalog_name"))


def _scoped(spark, sf):
    images, products, variants, facts = _inputs(spark, sf)
    variants = written(variants, "variants")
    scoped = written(match.scoped_texts(images, match.product_scope(images, products)), "scoped")
    return scoped, variants, facts


@query("match_scoped_tokens", sql("select run_id, product_ord, image_id, n, first, by_shared from m_tokens", "m_tokens"))
def match_scoped_tokens(spark, sf):
    scoped, variants, _ = _scoped(spark, sf)
    return match.token_hits(scoped, variants)


@query("match_scoped_facts", sql("select run_id, product_ord, image_id, n, first from m_byfact", "m_byfact"))
def match_scoped_facts(spark, sf):
    scoped, variants, facts = _scoped(spark, sf)
    return match.fact_hits(scoped, variants, facts).drop("by_shared")


@query("match_sequence_index", sql("select * from m_number", "m_number"))
def match_sequence_index(spark, sf):
    scoped, variants, _ = _scoped(spark, sf)
    return match.sequence_hits(scoped, variants)


@query("match_unscoped_facts", sql("""
select run_id, image_id, best.p as product_ord, best.v as variant_ord, best.field || ' ' || best.value as note from m_free""", "m_free"))
def match_unscoped_facts(spark, sf):
    images, _, variants, facts = _inputs(spark, sf)
    return match.unscoped_facts(images, variants, facts).select("run_id", "image_id", "product_ord", "variant_ord", "note")


@query("match_supplier_sku", sql("""
select run_id, image_id, case when codes = 1 or number between 1 and size then 'MATCHED' else 'AMBIGUOUS' end as status,
  case when codes = 1 then 'SUPPLIER_SKU_SINGLE_VARIANT' when number between 1 and size then 'SUPPLIER_SKU_INDEXED_SEQUENCE'
    else 'SHARED_SUPPLIER_SKU_AMBIGUOUS' end as match_strategy,
  case when codes = 1 then last.p when number between 1 and size then first.p end as product_ord,
  case when codes = 1 then last.v when number between 1 and size then number end as variant_ord
from m_sku k join m_sizes s on s.run_id = k.run_id and s.product_ord = k.first.p""".replace("select run_id", "select k.run_id"), "m_sku m_sizes"))
def match_supplier_sku(spark, sf):
    images, _, variants, _ = _inputs(spark, sf)
    return match.supplier_sku(images, written(variants, "variants")).select(
        "run_id", "image_id", "status", "match_strategy", "product_ord", "variant_ord")


def findings(spark, sf):
    images, products, variants, facts = _inputs(spark, sf)
    return match.match_images(images, products, variants, facts)


@query("match_all", sql("select * from m_findings", "m_findings"))
def match_all(spark, sf):
    return findings(spark, sf)


# an image's own step says which of its candidates count
cte("m_candidates", "m_raw m_scoped m_variants m_facts m_images", """
select r.run_id, r.image_id, v.product_ord, v.variant_ord, v.variant_code
from (select * from m_raw where step in (3, 4, 6) and not (step = 3 and tn = 1) and not (step = 4 and bn = 1)) r
join m_scoped s on s.run_id = r.run_id and s.image_id = r.image_id
join m_variants v on v.run_id = r.run_id and v.product_ord = r.sp
where case r.step when 6 then true
  when 3 then coalesce(color_token <> '' and (contains(path_text, color_token) or contains(stem_text, color_token)), false)
    or coalesce(name_token <> '' and (contains(path_text, name_token) or contains(stem_text, name_token)), false)
    or coalesce(code_token <> '' and (contains(path_text, code_token) or contains(stem_text, code_token)), false)
  else exists (select 1 from m_facts f where f.run_id = r.run_id and f.image_id = r.image_id and f.token <> ''
    and f.token in (lower(variant_code), lower(supplier_sku), lower(image_sku), lower(variant_name))) end
union all
select run_id, image_id, place.p, place.v, variant_code from (
  select r.run_id, r.image_id, v.variant_code, min({'p': v.product_ord, 'v': v.variant_ord}) as place
  from (select * from m_raw where step = 10) r join m_images i on i.run_id = r.run_id and i.image_id = r.image_id join m_variants v on v.run_id = r.run_id
  where trim(v.supplier_sku) <> '' and (list_contains(i.tokens, lower(trim(v.supplier_sku))) or contains(i.normalized_stem, lower(trim(v.supplier_sku))))
  group by 1, 2, 3)""")


@query("match_candidates", sql("select * from m_candidates", "m_candidates"))
def match_candidates(spark, sf):
    """Every variant that an ambiguous image fits."""
    images, _, variants, facts = (written(x, "in") for x in _inputs(spark, sf))
    return match.candidates(written(findings(spark, sf), "findings"), images, variants, facts)


@query("match_summary", sql("""
select run_id, count(*) as total_images, count(*) filter (where status = 'MATCHED') as matched_count,
  count(*) filter (where status = 'AMBIGUOUS') as ambiguous_count, count(*) filter (where status = 'UNMATCHED') as unmatched_count,
  round_even(count(*) filter (where status = 'MATCHED') / count(*) * 100, 2) as match_rate_percent
from m_found group by run_id""", "m_found"))
def match_summary(spark, sf):
    return match.summary(findings(spark, sf))


def _place(base: str) -> str:
    tail = (f"case when starts_with(normalized_stem, {base} || '-') or starts_with(normalized_stem, {base} || '_') "
            f"then substr(normalized_stem, len({base}) + 2) end")
    return (f"case when normalized_stem = {base} then 0 when regexp_matches({tail}, '^[0-9]+$') then 1 end, "
            f"case when normalized_stem = {base} then 0 when regexp_matches({tail}, '^[0-9]+$') then cast({tail} as bigint) end")


def _placed(base: str, prefix: str) -> str:
    a, b_ = _place(base).split(", case when normalized_stem = ", 1)
    return f"{a} as {prefix}_class, case when normalized_stem = {b_} as {prefix}_no"


cte("m_gallery", "m_found m_images m_variants", f"""
select *, cast(row_number() over (partition by run_id, product_ord, variant_ord
    order by cls, coalesce(no, 0), nk, relative_path, image_id) - 1 as integer) as sort_index from (
  select *, coalesce(c_class, s_class, 2) as cls, case when c_class is not null then c_no else s_no end as no,
    case when c_class is not null or s_class is not null then {_natural('original_filename')} else natural_key end as nk
  from (select f.run_id, f.image_id, f.product_ord, f.variant_ord, v.variant_code, i.original_filename, i.normalized_stem, i.relative_path,
      i.natural_key, {_placed('lower(v.variant_code)', 'c')}, {_placed("nullif(lower(v.image_sku), '')", 's')}
    from m_found f join m_images i using (run_id, image_id) join m_variants v using (run_id, product_ord, variant_ord)
    where f.status = 'MATCHED'))""")


def galleries(spark, sf):
    images, products, variants, facts = _inputs(spark, sf)
    variants = written(variants, "variants")
    found = match.match_images(images, products, variants, facts)
    return match.gallery(written(found, "findings"), images, variants), variants


@query("gallery_order", sql(
    "select run_id, product_ord, variant_ord, image_id, sort_index, sort_index = 0 as is_primary from m_gallery", "m_gallery"))
def gallery_order(spark, sf):
    return galleries(spark, sf)[0].select("run_id", "product_ord", "variant_ord", "image_id", "sort_index", "is_primary")


@query("backfill_image_sku", sql("""
select v.run_id, v.product_ord, v.variant_ord, coalesce(nullif(v.image_sku, ''), g.normalized_stem) as image_sku
from m_variants v left join m_gallery g on g.run_id = v.run_id and g.product_ord = v.product_ord and g.variant_ord = v.variant_ord
  and g.sort_index = 0""", "m_variants m_gallery"))
def backfill_image_sku(spark, sf):
    ordered, variants = galleries(spark, sf)
    return match.backfill_image_sku(variants, ordered).select("run_id", "product_ord", "variant_ord", "image_sku")
