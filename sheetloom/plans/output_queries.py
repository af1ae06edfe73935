"""Queries of colour, uploads and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import colour, merge, uploads
from sheetloom.plans import bindings as b
from sheetloom.plans import quality_queries  # noqa: F401  (its table expressions)
from sheetloom.plans.oracle_base import cte, sql
from sheetloom.plans.registry import query

# ------------------------------------------------------------------ colour
cte("c_box", "b_pixels", """
select *, (width - cw) // 2 as x0, least(case when height > 100 then cast(floor(height * 0.30) as bigint) else (height - ch) // 2 end, height - ch) as y0
from (select *, cast(floor(width * 0.6) as bigint) as cw, cast(floor(height * 0.6) as bigint) as ch from b_pixels)""")
cte("c_crop", "c_box", """
select *, greatest(r, g, b) as top, least(r, g, b) as low from c_box
where width >= 10 and height >= 10 and x >= x0 and x < x0 + cw and y >= y0 and y < y0 + ch""")
cte("c_hsv", "c_crop", """
select *, (case when top = low then 0.0::double
    when top = r then case when (g - b) / (top - low)::double < 0 then (g - b) / (top - low)::double + 6.0 else (g - b) / (top - low)::double end
    when top = g then (b - r) / (top - low)::double + 2.0 else (r - g) / (top - low)::double + 4.0 end) * 60.0 as h,
  case when top > 0 then (top - low) / top::double else 0.0 end as s, top / 255.0::double as v from c_crop""")
cte("c_mask", "c_hsv", """
select *, v >= 0.12 and v <= 0.95 and not (s < 0.28 and v > 0.48 and h >= 18 and h <= 55) as ok from c_hsv""")
cte("c_named", "c_mask", """
select *, ok and s >= 0.12 as chroma, case when ok and s >= 0.12 then case
    when h >= 345 or h <= 15 then case when v < 0.40 and s > 0.40 then 'Maroon' else 'Red' end
    when h <= 45 then case when v < 0.55 then case when s >= 0.25 then 'Rust' else 'Brown' end else 'Orange' end
    when h <= 70 then case when s > 0.30 then case when v < 0.65 and h < 55 then 'Mustard' else 'Yellow' end else 'Beige' end
    when h <= 85 then 'Olive' when h <= 165 then 'Green' when h <= 195 then 'Teal'
    when h <= 255 then case when v < 0.50 then 'Navy Blue' else 'Blue' end
    when h <= 295 then 'Purple' when h <= 325 then 'Magenta' else 'Pink' end end as colour from c_mask""")
_FAMILY = "case colour " + " ".join(f"when '{k}' then '{v}'" for k, v in fv.COLOUR_FAMILIES.items()) + " else colour end"
cte("c_counts", "c_named", f"""
select run_id, image_id, colour, {_FAMILY} as family, count(*) as n, sum(r) as sr, sum(g) as sg, sum(b) as sb from c_named group by 1, 2, 3""")
cte("c_totals", "c_named", """
select run_id, image_id, count(*) as total, count(*) filter (where ok) as valid, count(*) filter (where chroma) as chromatic,
  sum(top) filter (where ok) as sv from c_named group by 1, 2""")
cte("c_votes", "c_counts", """
select run_id, image_id, list(family order by votes desc, family) as f, list(votes order by votes desc, family) as n,
  list(best order by votes desc, family) as best from (
  select run_id, image_id, family, sum(n) as votes, arg_min({'c': colour, 'n': n, 'r': sr, 'g': sg, 'b': sb}, (-n, colour)) as best
  from c_counts where colour is not null group by 1, 2, 3) group by 1, 2""")
cte("c_judged", "b_pixels c_totals c_votes", """
select i.*, t.* exclude (run_id, image_id), v.f, v.n, v.best, case
    when side < 10 then 'tiny' when total is null then 'empty' when chromatic < total * 0.10 and valid < total * 0.15 then 'background'
    when chromatic < total * 0.10 then 'neutral' when v.n[1] < chromatic * 0.35 or (len(v.n) > 1 and v.n[1] - v.n[2] < chromatic * 0.15) then 'unsure' else 'sure' end as kind,
  case when sv / valid > 0.75 * 255 then 'White' when sv / valid < 0.25 * 255 then 'Black' else 'Grey' end as tone, cast(floor(sv / valid) as bigint) as grey
from (select run_id, image_id, min(least(width, height)) as side from b_pixels group by 1, 2) i
left join c_totals t using (run_id, image_id) left join c_votes v using (run_id, image_id)""")


def _hundredths(scale: int) -> str:
    p = f"(n[1] * {scale})"
    return (f"(({p} // chromatic) + case when 2 * ({p} % chromatic) > chromatic or (2 * ({p} % chromatic) = chromatic "
            f"and ({p} // chromatic) % 2 = 1) then 1 else 0 end) / 100.0")


def _hex(x: str) -> str:
    return f"lower(lpad(to_hex(cast(floor({x}) as bigint)), 2, '0'))"


cte("c_result", "c_judged", f"""
select run_id, image_id, case kind when 'tiny' then 'FAILED' when 'empty' then 'FAILED' when 'background' then 'BACKGROUND_ONLY' when 'unsure' then 'UNCERTAIN' else 'EXTRACTED' end as status,
  case kind when 'neutral' then tone when 'sure' then best[1].c end as canonical_color,
  case kind when 'neutral' then '#' || {_hex('grey')} || {_hex('grey')} || {_hex('grey')}
    when 'sure' then '#' || {_hex('best[1].r / best[1].n')} || {_hex('best[1].g / best[1].n')} || {_hex('best[1].b / best[1].n')} end as hex_code,
  cast(case kind when 'neutral' then 0.65 when 'unsure' then {_hundredths(100)} when 'sure' then least(1.0, {_hundredths(120)}) else 0 end as double) as confidence,
  kind in ('unsure', 'background') as is_ambiguous,
  case kind when 'tiny' then 'Image dimensions too small for reliable color analysis' when 'empty' then 'No pixels inside the crop'
    when 'background' then 'Image consists almost entirely of extreme highlights or shadows' when 'neutral' then 'Low-saturation neutral palette identified as ' || tone
    when 'unsure' then case when len(n) > 1 then 'Multi-tonal image: ''' || f[1] || ''' (' || (n[1] * 100 // chromatic)::bigint || '%) vs ''' || f[2] || ''' (' || (n[2] * 100 // chromatic)::bigint || '%); requires manual review'
      else 'Low dominant color confidence (' || (n[1] * 100 // chromatic)::bigint || '%); requires manual review' end
    else 'Dominant color ''' || best[1].c || ''' accounts for ' || (n[1] * 100 // chromatic)::bigint || '% of foreground palette' end as notes
from c_judged""")


def pixels(spark, sf):
    return b.bind(spark, sf, b.PIXELS)


@query("crop_pixels", sql("select run_id, image_id, x, y, r, g, b from c_crop", "c_crop"))
def crop_pixels(spark, sf):
    return colour.crop(pixels(spark, sf)).select("run_id", "image_id", "x", "y", "r", "g", "b")


@query("pixel_hsv", sql(
    "select run_id, image_id, x, y, round(h, 6) as h, round(s, 6) as s, round(v, 6) as v, ok as is_valid, chroma as is_chromatic from c_named", "c_named"))
def pixel_hsv(spark, sf):
    shown = colour.with_hsv(colour.crop(pixels(spark, sf)))
    return shown.select("run_id", "image_id", "x", "y", *[F.round(x, 6).alias(x) for x in "hsv"], "is_valid", "is_chromatic")


@query("classify_pixels", sql("select run_id, image_id, colour, family, n from c_counts where colour is not null", "c_counts"))
def classify_pixels(spark, sf):
    return colour.colour_counts(pixels(spark, sf)).where(F.col("n_voting") > 0).select(
        "run_id", "image_id", "colour", "family", "n")


@query("neutral_tone", sql("""select run_id, image_id, status, canonical_color, hex_code, confidence from c_result
where notes like 'Low-saturation%' or status = 'BACKGROUND_ONLY'""", "c_result"))
def neutral_tone(spark, sf):
    return colour.dominant(pixels(spark, sf)).where(
        F.col("notes").startswith("Low-saturation") | (F.col("status") == "BACKGROUND_ONLY")).select(
        "run_id", "image_id", "status", "canonical_color", "hex_code", "confidence")


@query("dominant_colour", sql("select * from c_result", "c_result"))
def dominant_colour(spark, sf):
    return colour.dominant(pixels(spark, sf))


# ----------------------------------------------------------------- uploads
def _dashed(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(trim({x}), '[^\\w\\-]+', '-', 'g'), '-+', '-', 'g'), '-')"


def _segment(x: str) -> str:
    return f"nullif(case when coalesce({x}, '') = '' then 'unknown' else {_dashed(x)} end, '')"


cte("u_keys", "b_blobs", f"""
select ord, content, ext, concat_ws('/', 'products', {_segment('supplier_name')}, {_segment('catalog_name')}, {_segment('variant_code')},
    {_dashed('left(filename, len(filename) - len(ext))')} || ext) as destination_key, sha256(content) as content_hash,
  case ext {' '.join(f"when '{k}' then '{v}'" for k, v in fv.CONTENT_TYPES.items())} else '{fv.CONTENT_TYPE_OTHER}' end as content_type
from (select *, lower(regexp_extract(filename, '^.+(\\.[^.]+)$', 1)) as ext from b_blobs)""")


def _blobs(spark, sf):
    return b.bind(spark, sf, b.BLOBS)


@query("destination_keys", sql("select ord, destination_key from u_keys", "u_keys"))
def destination_keys(spark, sf):
    return _blobs(spark, sf).select("ord", uploads.destination_key().alias("destination_key"))


@query("content_types", sql("select content_type, count(*) as n from u_keys group by 1", "u_keys"))
def content_types(spark, sf):
    return _blobs(spark, sf).groupBy(uploads.content_type(F.col("filename")).alias("content_type")).agg(
        F.count(F.lit(1)).alias("n"))


@query("upload_collisions", sql("""
select ord, destination_key, content_type, strlen(content) as file_size_bytes, content_hash,
  case when content_hash = first then 'UPLOADED' else 'COLLISION' end as status, content_hash = first and ord <> first_ord as is_idempotent_reuse,
  case when content_hash <> first then 'Destination key ''' || destination_key || ''' already contains different content (existing hash: ' || left(first, 8)
    || '..., new hash: ' || left(content_hash, 8) || '...)' end as error_message
from (select *, first_value(content_hash) over w as first, min(ord) over (partition by destination_key) as first_ord from u_keys
  window w as (partition by destination_key order by ord))""", "u_keys"))
def upload_collisions(spark, sf):
    return uploads.plan(_blobs(spark, sf))


# ------------------------------------------------------------------- merge
cte("g_rows", "", b.oracle_text(b.DATASETS))


def _datasets(spark, sf):
    rows = b.bind(spark, sf, b.DATASETS)
    return [rows.where(F.col("dataset_ord") == i).drop("dataset_ord") for i in range(3)]


@query("merge_canonical", sql("select * from g_rows", "g_rows"))
def merge_canonical(spark, sf):
    return merge.merge(_datasets(spark, sf))


@query("merge_conflicts", sql("""
select 'product_id' as kind, product_id as id, min(catalog_name) as first, max(catalog_name) as last from g_rows group by 2 having min(catalog_name) <> max(catalog_name)
union all
select 'variant_code', variant_code, min(product_id), max(product_id) from g_rows group by 2 having min(product_id) <> max(product_id)""", "g_rows"))
def merge_conflicts(spark, sf):
    return merge.conflicts(merge.merge(_datasets(spark, sf)))


@query("regroup_flat_canonical", sql("""
select run_id, product_id, variant_ord, coalesce(nullif(variant_code, ''), 'VAR-' || variant_ord) as variant_code, coalesce(nullif(variant_name, ''), 'Standard') as variant_name
from (select run_id, coalesce(given_product_id, catalog_name) as product_id, variant_code, variant_name,
  row_number() over (partition by run_id, coalesce(given_product_id, catalog_name) order by row_number) as variant_ord from g_rows)""", "g_rows"))
def regroup_flat_canonical(spark, sf):
    rows = b.bind(spark, sf, b.DATASETS).drop("product_id").withColumnRenamed("given_product_id", "product_id")
    return merge.regroup_flat(rows).select("run_id", "product_id", "variant_ord", "variant_code", "variant_name")


cte("g_import", "b_import", "select *, cast(split_part(source, '-', 2) as bigint) % 15 = 4 as bad_header from b_import")


def _import_rows(spark, sf):
    bound = b.bind(spark, sf, b.IMPORT_SOURCES)
    named = {"product_name": "product_name", "supplier_price": "supplier_price", "No": "no"}
    cells = F.array(*[F.when(F.col("blank_row"), F.lit(" ")).otherwise(F.col(named[n]) if n in named else F.lit(""))
                      for n in fv.IMPORT_COLUMNS])
    good = F.array(*[F.lit(n) for n in fv.IMPORT_COLUMNS])
    bad = F.array(*[F.lit("selling_proce" if n == "selling_price" else n) for n in fv.IMPORT_COLUMNS])
    wrong = F.split("source", "-")[1].cast("bigint") % 15 == 4
    return bound.select("source", "row_number", F.when(wrong, bad).otherwise(good).alias("header"), cells.alias("cells"))


@query("consolidate_import", sql("""
select source, row_number, no as "No", product_name, supplier_price from g_import where not blank_row and not bad_header""", "g_import"))
def consolidate_import(spark, sf):
    return merge.consolidate(_import_rows(spark, sf)).select("source", "row_number", "No", "product_name", "supplier_price")


@query("consolidation_summary", sql("""
select source, count(*) filter (where not blank_row) as rows, case when bool_or(bad_header) then 'Schema mismatch. Col 19: expected ''selling_price'', found ''selling_proce'''
  when count(*) filter (where not blank_row) = 0 then '0 product data rows' end as problem from g_import group by 1""", "g_import"))
def consolidation_summary(spark, sf):
    return merge.source_checks(_import_rows(spark, sf))


@query("clean_gallery", sql("""
select run_id, product_ord, variant_ord, array_to_string(list_filter(gallery_image_urls, lambda u: u <> '' and u is distinct from primary_image_url), ' ') as gallery
from d_variants""", "d_variants"))
def clean_gallery(spark, sf):
    from sheetloom.operators.exports import clean_gallery as cleaned

    return b.dq_variants(spark, sf).select(
        "run_id", "product_ord", "variant_ord", F.array_join(cleaned(), " ").alias("gallery"))
