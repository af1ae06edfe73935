"""Queries of file scans, output tables and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import exports, metrics, review
from sheetloom.operators import normalize as n
from sheetloom.plans import bindings as b
from sheetloom.plans import oracle_base as o
from sheetloom.plans import quality_queries as qq
from sheetloom.plans import review_queries as rq
from sheetloom.plans.match_queries import image_rows
from sheetloom.plans.normalise_queries import products_variants
from sheetloom.plans.oracle_base import cte, sql
from sheetloom.plans.registry import query
from sheetloom.session import new_path, written
from sheetloom.sources import delimited, files, flat

# ------------------------------------------------------------ sheet files
_DELIMITERS = {"0": ",", "1": "\t", "2": ";", "3": "|"}


def _sheet_folder(spark, sf):
    """Writes the listing as delimited sheets: a folder each, in parts cut by size, with an own delimiter per run.

    In every seventh row the cells hold line breaks in place of spaces.
    """
    rows = b.sheet_rows(spark, sf)
    style = F.when(F.col("run_id") == "run-hot", F.lit("0")).otherwise(
        (F.regexp_extract("run_id", r"(\d+)$", 1).cast("int") % 4).cast("string"))
    sep = F.element_at(F.create_map(*[F.lit(x) for kv in _DELIMITERS.items() for x in kv]), style)
    space = F.when(F.col("row_number") % 7 == 0, F.lit("\n")).otherwise(F.lit(" "))

    def line(cells, space=F.lit(" ")):
        return F.array_join(F.transform(cells, lambda x: F.concat(F.lit('"'), F.replace(F.replace(
            F.coalesce(x, F.lit("")), F.lit('"'), F.lit('""')), F.lit(" "), space), F.lit('"'))), "\u0000")

    data = rows.select("run_id", "row_number", F.replace(line(F.col("cells"), space), F.lit("\u0000"), sep).alias("value"))
    heads = rows.groupBy("run_id").agg(F.min_by("headers", "row_number").alias("headers")).select(
        "run_id", F.lit(1).alias("row_number"), F.replace(line(F.col("headers")), F.lit("\u0000"), sep).alias("value"))
    path = new_path(spark, "sheets")
    (data.unionByName(heads).repartitionByRange("run_id", "row_number").sortWithinPartitions("run_id", "row_number")
     .drop("row_number").write.partitionBy("run_id").text(path))
    return path


def _run_of_path():
    return F.regexp_extract(delimited.FILE, r"run_id=([^/]+)/", 1)


cte("f_rows", "b_listing", "select *, row_number() over (partition by run_id order by row_number) + 1 as line_no from b_listing")


@query("scan_catalogue_cells", sql("""
select c.run_id, f.line_no as row_number, c.pos, c.header, case when c.row_number % 7 = 0 then replace(c.value, ' ', chr(10)) else c.value end as value from b_cells c join f_rows f on f.run_id = c.run_id and f.row_number = c.row_number""".replace(
    "c.header", "trim(c.header) as header"), "b_cells f_rows"))
def scan_catalogue_cells(spark, sf):
    rows = delimited.scan(spark, _sheet_folder(spark, sf), _run_of_path(), folders=True)
    return delimited.cells(rows).drop(delimited.FILE)


@query("infer_delimiter", sql("""
select distinct run_id, case style when 1 then chr(9) when 2 then ';' when 3 then '|' else ',' end as delimiter from b_listing""", "b_listing"))
def infer_delimiter(spark, sf):
    heads = delimited.lines(spark, _sheet_folder(spark, sf), folders=True).where(F.col("line_no") == 1)
    return delimited.infer_delimiters(heads).select(_run_of_path().alias("run_id"), "delimiter").distinct()


cte("f_attr", "b_attr", "select *, trim(key) as k from b_attr")


@query("pivot_attribute_rows", sql(
    "select source_file, k as key, arg_max(value, row_number) as value from f_attr where k <> '' group by 1, 2", "f_attr"))
def pivot_attribute_rows(spark, sf):
    return delimited.pivot_attributes(b.bind(spark, sf, b.ATTRIBUTE_FILES))


cte("f_names", "b_attr", f"""
select source_file, replace(lower(trim(key)), ' ', '_') as name, count(*) as n,
  bool_or(trim(value) <> '' and replace(lower(trim(key)), ' ', '_') in {o.in_list(fv.STRICT_NUMERIC)} and try_cast(trim(value) as double) is null) as bad
from b_attr group by 1, 2""")


@query("strict_attribute_check", sql(f"""
select source_file, 'duplicate attribute ' || name as reason from f_names where n > 1
union all select source_file, 'not a number: ' || name from f_names where bad
union all select s.source_file, 'missing column ' || w.name from (select distinct source_file from b_attr) s, {o.values([(x,) for x in fv.STRICT_REQUIRED])} as w(name)
  where not exists (select 1 from f_names f where f.source_file = s.source_file and f.name = w.name)""", "f_names b_attr"))
def strict_attribute_check(spark, sf):
    return delimited.strict_rejects(b.bind(spark, sf, b.ATTRIBUTE_FILES))


@query("reject_empty_sources", sql("""
select run_id, 'Input source contains no data rows (empty or header-only)' as reason from d_runs where run_id not in (select run_id from b_listing)""",
    "d_runs b_listing"))
def reject_empty_sources(spark, sf):
    return delimited.empty_sources(b.bind(spark, sf, b.RUNS).select("run_id"), b.sheet_rows(spark, sf), "run_id")


# --------------------------------------------------------------- documents
_HOST = "https://x.blob.example.com/"


def _documents(spark, sf):
    products, variants = products_variants(spark, sf)
    gallery = rq._gallery(rq.manifest(spark, sf))
    placed = gallery.join(variants.select("run_id", "variant_code", "product_ord", "variant_ord"), ["run_id", "variant_code"]).select(
        "run_id", "product_ord", "variant_ord", F.col("sort_index").cast("int").alias("sort_index"), "image_id", "original_filename",
        (F.col("sort_index") == 0).alias("is_primary"), F.concat(F.lit(_HOST), "image_id").alias("blob_url"))
    return exports.canonical_documents(products, variants, placed)


cte("x_images", "r_gallery o_variants", """
select v.run_id, v.product_ord, v.variant_ord, count(g.image_id) as n from o_variants v
left join r_gallery g on g.run_id = v.run_id and g.variant_code = v.variant_code group by 1, 2, 3""")
cte("x_nested", "o_variants x_images o_products", """
select p.run_id, p.product_id, coalesce(cast((variant_ord - 1) // 500 as integer), 0) as variant_part, count(variant_ord) as variants, coalesce(sum(n), 0) as images,
  coalesce(string_agg(variant_code, ' ' order by variant_ord), '') as codes
from o_products p left join (select * from o_variants v join x_images using (run_id, product_ord, variant_ord)) v using (run_id, product_ord) group by 1, 2, 3""")


def _nested_shape(documents):
    return documents.select(
        "run_id", "product_id", "variant_part", F.coalesce(F.size("variants"), F.lit(0)).cast("bigint").alias("variants"),
        F.aggregate(F.coalesce("variants", F.array().cast(documents.schema["variants"].dataType)), F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(F.size(v["images"]), F.lit(0))).alias("images"),
        F.coalesce(F.array_join(F.transform("variants", lambda v: v["variant_code"]), " "), F.lit("")).alias("codes"))


@query("export_canonical_nested", sql("select * from x_nested", "x_nested"))
def export_canonical_nested(spark, sf):
    return _nested_shape(_documents(spark, sf))


_P = [x for x in exports.CANONICAL_PRODUCT if x not in ("attributes", "moq")]
_W = ["variant_ord", "variant_code", "supplier_sku", "variant_name", "image_sku", "color", "size", "supplier_cost", "selling_price", "stock_quantity", "publish",
      "review_status", "primary_image_url"]


@query("read_canonical_nested", sql(f"""
select v.run_id, {', '.join(f'p.{x}' for x in _P)}, coalesce(nullif(p.moq, 0), 1) as moq, {', '.join(f'v.{x}' for x in _W)}, n as images, coalesce(i.shown, '') as shown,
  array_to_string(list_filter(gallery_image_urls, lambda u: u <> '' and u is distinct from v.primary_image_url), ' ') as gallery, coalesce(a.attributes, '') as product_attributes
from o_variants v join x_images using (run_id, product_ord, variant_ord) join o_products p using (run_id, product_ord)
left join (select run_id, product_id, string_agg(name || '=' || value, '|' order by name) as attributes from e_named group by 1, 2) a
  on a.run_id = p.run_id and a.product_id = p.product_id
left join (select run_id, variant_code, string_agg(image_id || ' ' || (sort_index = 0) || ' {_HOST}' || image_id, '|' order by sort_index) as shown
  from r_gallery group by 1, 2) i on i.run_id = v.run_id and i.variant_code = v.variant_code""", "o_variants x_images o_products e_named r_gallery"))
def read_canonical_nested(spark, sf):
    """Every field of the documents, written as JSON and read back."""
    path = new_path(spark, "canonical")
    exports.write_canonical_json(_documents(spark, sf), path)
    variants = files.canonical_variants(files.canonical_documents(spark, path))
    pairs = F.transform(F.array_sort(F.map_entries("product_attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    shown = F.transform("images", lambda i: F.concat_ws(" ", i["image_id"], i["is_primary"].cast("string"), i["blob_url"]))
    return variants.select("run_id", *_P, "moq", *_W, F.coalesce(F.size("images"), F.lit(0)).cast("bigint").alias("images"),
                           F.array_join(shown, "|").alias("shown"), F.array_join("gallery_image_urls", " ").alias("gallery"),
                           F.coalesce(F.array_join(pairs, "|"), F.lit("")).alias("product_attributes"))


@query("canonical_summary", sql("""
select run_id, '1.0' as export_version, coalesce(p.n, 0) as total_products, coalesce(v.n, 0) as total_variants, error_count, warning_count, info_count, is_valid
from d_summary left join (select run_id, count(*) as n from d_products group by 1) p using (run_id)
left join (select run_id, count(*) as n from d_variants group by 1) v using (run_id)""", "d_summary d_products d_variants"))
def canonical_summary(spark, sf):
    products, variants = b.dq_products(spark, sf), b.dq_variants(spark, sf)
    made = exports.canonical_summary(products, variants, qq.summary(spark, sf))
    return made.select("run_id", "export_version", "total_products", "total_variants",
                       *[F.col(f"validation_summary.{x}").alias(x) for x in ("error_count", "warning_count", "info_count", "is_valid")])


@query("read_manifest", sql("""
select run_id, manifest_ord, image_id, image_path, original_filename, catalog_name, proposed_variant_code, match_status, match_strategy, confidence, image_sku, detected_color,
  approval_status, approved_by, approved_at, assignment_hash, notes, ok as is_valid, ocr_provider, ocr_confidence,
  case when has_evidence then concat_ws('|', 'color=' || ocr_color, 'design_number=' || ocr_design, 'fabric=' || ocr_fabric, 'sku=' || ocr_sku) end as ocr_candidates
from r_valid""", "r_valid"))
def read_manifest(spark, sf):
    path = new_path(spark, "manifest-json")
    files.write_manifest(rq.manifest(spark, sf), path)
    return rq.flat_evidence(files.read_manifest(spark, path)).withColumn("is_valid", review.is_valid()).drop("proposed_product_id")


@query("manifest_rejects", sql("""
select run_id, cast(floor(manifest_ord / 1000) as bigint) as block, 'Not a readable manifest' as reason, count(*) as entries_read
from r_valid group by 1, 2""", "r_valid"))
def manifest_rejects(spark, sf):
    """Every document is written twice, once whole and once cut off at its end."""
    path = new_path(spark, "manifest-json")
    files.write_manifest(rq.manifest(spark, sf), f"{path}/whole")
    documents = spark.read.text(f"{path}/whole")
    documents.select(F.expr("left(value, length(value) - 2)").alias("value")).write.text(f"{path}/cut")
    block = F.floor(F.regexp_extract("text", r'"manifest_ord":(\d+)', 1).cast("bigint") / files.ENTRIES_PER_DOCUMENT)
    rejects = files.manifest_rejects(spark, path).select(
        F.regexp_extract("text", r'"run_id":"([^"]*)"', 1).alias("run_id"), block.alias("block"), "reason")
    read = files.read_manifest(spark, path).groupBy(
        "run_id", F.floor(F.col("manifest_ord") / files.ENTRIES_PER_DOCUMENT).alias("block")).agg(F.count(F.lit(1)).alias("entries_read"))
    return rejects.join(read, ["run_id", "block"], "left")


# ------------------------------------------------------------- flat tables
cte("x_attr", "o_attributes", "select run_id, product_id, lower(name) as name, min(value) as value from o_attributes where value <> '' group by 1, 2, 3")
cte("x_parent", "o_products x_attr", """
select p.run_id, p.product_ord, p.product_id, p.supplier_name, p.catalog_name, p.product_group, p.product_name, p.product_type, p.category_slug,
  p.brand_name, p.description, p.supplier_price, p.gst_percent, p.no,
  max(value) filter (where name = 'fabric') as fabric0, max(value) filter (where name = 'saree_fabric') as fabric1,
  max(value) filter (where name = 'blouse_fabric') as blouse, max(value) filter (where name = 'work') as work,
  max(value) filter (where name = 'occasion') as occasion, max(value) filter (where name = 'size') as psize
from (select *, row_number() over (partition by run_id order by product_ord) as no from o_products) p left join x_attr a on a.run_id = p.run_id and a.product_id = p.product_id group by all""")
cte("x_titled", "x_parent", o.titled(
    "(select *, coalesce(fabric0, fabric1, '') as fabric, " + o.title_cols("catalog_name", "brand_name", "coalesce(fabric0, fabric1)", "work", "product_type")
    + " from x_parent)", "catalog_name"))
_FLAT = ("supplier_name, catalog_name, product_group, product_name, variant_name, variant_code, supplier_sku, image_sku, product_type, category_slug, "
         "brand_name, color, size, description, supplier_price, supplier_cost, gst_percent, selling_price, stock_quantity, publish, review_status, primary_image_url")
_CLEAN = "list_filter(gallery_image_urls, lambda u: u <> '' and u is distinct from primary_image_url)"


@query("export_canonical_flat", sql(f"""
select v.run_id, v.product_ord, v.variant_ord, {_FLAT}, primary_image_url as image_url, {', '.join(f'{_CLEAN}[{i}] as image{i}_url' for i in range(1, 5))},
  array_to_string(list_transform({_CLEAN}, lambda u: coalesce(u, '')), ' ') as gallery,
  (select count(*) from o_attributes a where a.run_id = v.run_id and a.product_id = v.product_id
     and a.name not in {o.in_list(_FLAT.split(', ') + ['image_url'])}) as attribute_count,
  (select coalesce(string_agg(name || '=' || value, '|' order by name), '') from o_attributes a where a.run_id = v.run_id and a.product_id = v.product_id
     and a.name not in {o.in_list(_FLAT.split(', ') + ['image_url'])}) as attributes
from o_variants v join x_parent using (run_id, product_ord)""", "o_variants x_parent o_attributes"))
def export_canonical_flat(spark, sf):
    table = exports.canonical_flat(*products_variants(spark, sf))
    whole = F.array_join(F.transform("gallery_image_urls", lambda u: F.coalesce(u, F.lit(""))), " ")
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return table.withColumns({"attribute_count": F.size("attributes").cast("bigint"), "gallery": whole, "attributes": F.array_join(pairs, "|")}).drop(
        "gallery_image_urls")


_FLAT_TEXTS = [x for x in fv.FLAT_COLUMNS if x not in ("supplier_price", "supplier_cost", "gst_percent", "selling_price", "stock_quantity", "publish")]
_FLAT_BACK = ", ".join(f"nullif({x}, '') as {x}" if x in _FLAT_TEXTS else x for x in fv.FLAT_COLUMNS)


@query("read_canonical_flat", sql(f"""
select v.run_id, v.product_ord, v.variant_ord, {_FLAT_BACK},
  array_to_string(list_transform({_CLEAN}, lambda u: coalesce(u, '')), ' ') as gallery,
  (select coalesce(string_agg(name || '=' || value, '|' order by name), '') from o_attributes a where a.run_id = v.run_id and a.product_id = v.product_id
     and a.name not in {o.in_list(_FLAT.split(', ') + ['image_url'])}) as attributes
from o_variants v join x_parent using (run_id, product_ord)""", "o_variants x_parent o_attributes"))
def read_canonical_flat(spark, sf):
    """The flat table written as files and read back by its headers."""
    path = new_path(spark, "flat")
    exports.write_csv(exports.canonical_flat(*products_variants(spark, sf)), path)
    back = flat.canonical_flat(spark, path)
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return back.select("run_id", "product_ord", "variant_ord", *fv.FLAT_COLUMNS,
                       F.array_join(F.transform("gallery_image_urls", lambda u: F.coalesce(u, F.lit(""))), " ").alias("gallery"),
                       F.array_join(pairs, "|").alias("attributes"))


@query("product_number", sql('select run_id, product_id, no as "No" from x_parent', "x_parent"))
def product_number(spark, sf):
    return exports.product_numbers(products_variants(spark, sf)[0]).select("run_id", "product_id", "No")


cte("x_stand_in", "m_images", """
select run_id, row_number() over (partition by run_id order by natural_key, relative_path, image_id) as variant_ord,
  left(original_filename, len(original_filename) - len(file_extension)) as stand_in from m_images""")


@query("positional_image_fallback", sql("""
select v.run_id, v.product_ord, v.variant_ord, coalesce(nullif(v.image_sku, ''), s.stand_in, '') as image_sku
from o_variants v left join x_stand_in s on s.run_id = v.run_id and s.variant_ord = v.variant_ord""", "o_variants x_stand_in"))
def positional_image_fallback(spark, sf):
    variants = products_variants(spark, sf)[1]
    return exports.with_stand_ins(variants, image_rows(spark, sf)).select(
        "run_id", "product_ord", "variant_ord", F.coalesce(F.nullif("image_sku", F.lit("")), "stand_in_sku", F.lit("")).alias("image_sku"))


_REMOTE = "({0} like 'http://%' or {0} like 'https://%' or contains({0}, 'blob.vercel-storage.com'))"
cte("x_hosted", "r_uploads", f"""
select run_id, variant_code, list(blob_url order by sort_index) as hosted from r_uploads where {_REMOTE.format('blob_url')} group by 1, 2""")
cte("x_hero", "o_variants x_hosted", f"""
select *, case when len(own) > 0 then own else list_filter(coalesce(hosted, []), lambda u: u <> hero_url) end as gallery
from (select v.*, h.hosted, case when coalesce({_REMOTE.format('primary_image_url')}, false) then primary_image_url else coalesce(h.hosted[1], '') end as hero_url,
    list_filter(gallery_image_urls, lambda u: {_REMOTE.format('u')}) as own
  from o_variants v left join x_hosted h on h.run_id = v.run_id and h.variant_code = v.variant_code)""")
_SLOTS = ", ".join(f"coalesce(gallery[{i}], '') as image{i}_url" for i in range(1, 5))


@query("hero_and_gallery", sql(f"select run_id, product_ord, variant_ord, hero_url, {_SLOTS} from x_hero", "x_hero"))
def hero_and_gallery(spark, sf):
    shown = exports.with_hero(products_variants(spark, sf)[1], b.bind(spark, sf, b.UPLOADS))
    return shown.select("run_id", "product_ord", "variant_ord", "hero_url", *[
        F.coalesce(F.get("gallery", F.lit(i)), F.lit("")).alias(f"image{i + 1}_url") for i in range(4)])


_DESCRIPTION = o.description("x.description", "brand_name", "catalog_name", "fabric", "blouse", "work", "occasion", "product_type", "x.supplier_price")
_I26 = {
    "No": "no", "varient_name": "case when color <> '' then color when lower(variant_name) not like 'design %' then variant_name else '' end",
    "product_name": "case when trim(product_name) <> trim(catalog_name) then product_name else title end",
    "product_group": f"coalesce(product_group, {o.group_name('catalog_name')})",
    "supplier_sku": f"coalesce(nullif(supplier_sku, ''), {o.sku_of('catalog_name')}, '')", "category_slug": "coalesce(nullif(category_slug, ''), 'sarees')",
    "brand_name": "coalesce(brand_name, '')", "blouse_fabric": "coalesce(blouse, '')", "work": "coalesce(work, '')", "occasion": "coalesce(occasion, '')",
    "size": "coalesce(nullif(size, ''), psize, '')", "description": f"coalesce(nullif(x.description, ''), {_DESCRIPTION})",
    "supplier_price": "coalesce(x.supplier_price, supplier_cost)",
    "gst_percent": f"coalesce(cast({o.whole('gst_percent')} as bigint) || '% Extra', '')", "selling_price": f"coalesce({o.money('selling_price')}, '')",
    "image-sku": "coalesce(nullif(image_sku, ''), stand_in, '')", "image_url": "hero_url", "publish": "false",
    **{f"image{i}_url": f"coalesce(gallery[{i}], '')" for i in range(1, 5)}}


@query("export_import26", sql("select v.run_id, v.product_ord, v.variant_ord, " + ", ".join(
    f'{_I26.get(c, c)} as "{c}"' for c in fv.IMPORT_COLUMNS) + """
from x_hero v join x_titled x using (run_id, product_ord) left join x_stand_in s on s.run_id = v.run_id and s.variant_ord = v.variant_ord""",
    "x_hero x_titled x_stand_in"))
def export_import26(spark, sf):
    products, variants = products_variants(spark, sf)
    return exports.import_table(products, variants, image_rows(spark, sf), b.bind(spark, sf, b.UPLOADS))


STORE = ["supplier_name", "catalog_name", "coalesce(product_group, '') as product_group", "product_name", "variant_name",
          "coalesce(supplier_sku, '') as supplier_sku", "coalesce(image_sku, '') as image_sku", "coalesce(nullif(category_slug, ''), 'sarees') as category_slug",
          "coalesce(brand_name, '') as brand_name", "coalesce(fabric0, '') as fabric", "coalesce(blouse, '') as blouse_fabric", "coalesce(work, '') as work",
          "coalesce(occasion, '') as occasion", "coalesce(nullif(size, ''), psize, '') as size", "coalesce(description, '') as description",
          f"coalesce({o.money('coalesce(supplier_price, supplier_cost)')}, '') as supplier_price", f"coalesce({o.money('gst_percent')}, '') as gst_percent",
          f"coalesce({o.money('selling_price')}, '') as selling_price", "false as publish", "main as main_image_url"]


cte("x_first", "r_uploads", "select run_id, variant_code, min({'s': sort_index, 'u': blob_url}).u as first_upload from r_uploads where blob_url <> '' group by 1, 2")


@query("export_store_import", sql(f"select run_id, product_ord, variant_ord, {', '.join(STORE)}, " + ", ".join(
    f"coalesce(list_filter(gallery_image_urls, lambda u: contains(u, 'blob') and u <> main)[{i}], '') as image_{i}_url" for i in range(1, 6)) + """
from (select v.*, case when contains(primary_image_url, 'blob') then primary_image_url else coalesce(f.first_upload, '') end as main
  from o_variants v left join x_first f on f.run_id = v.run_id and f.variant_code = v.variant_code) join x_parent using (run_id, product_ord)""",
    "o_variants x_parent x_first"))
def export_store_import(spark, sf):
    return exports.store_import(*products_variants(spark, sf), b.bind(spark, sf, b.UPLOADS))


@query("formula_safe_text", sql("""
select run_id, row_number, case when regexp_matches(c_price, '^[=+\\-@]') then '''' || c_price else c_price end as price,
  case when regexp_matches(c_sprice, '^[=+\\-@]') then '''' || c_sprice else c_sprice end as selling from b_listing""", "b_listing"))
def formula_safe_text(spark, sf):
    listing = b.bind(spark, sf, b.LISTING)
    return exports.safe_table(listing.select("run_id", "row_number", F.col("c_price").alias("price"), F.col("c_sprice").alias("selling")))


@query("raw_trace", sql("select run_id, count(*) as lines, count(c_sku) as with_sku from b_listing group by 1", "b_listing"))
def raw_trace(spark, sf):
    """Writes the trace of the extracted rows and counts what arrived."""
    path = new_path(spark, "trace")
    named = b.bind(spark, sf, b.LISTING).drop("k", "cat", "style", "source_file")
    exports.write_trace(named, path)
    back = spark.read.option("sep", "\t").option("header", "true").schema(named.drop("run_id").schema).csv(path)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"run_id=([^/]+)/", 1)
    return back.select(run.alias("run_id"), "c_sku").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count("c_sku").alias("with_sku"))


# ----------------------------------------------------------- batch reports
cte("k_named", "b_batch b_paths", """
select b.*, trim(coalesce(name, '')) as n, trim(coalesce(supplier_adapter, '')) as a, trim(coalesce(source, '')) as s, trim(coalesce(images, '')) as i,
  row_number() over (partition by batch_name, lower(trim(coalesce(name, ''))) order by entry_no) as use_no,
  trim(coalesce(source, '')) in (select path from b_paths) as s_ok, trim(coalesce(images, '')) in (select path from b_paths) as i_ok from b_batch b""")
_BATCH = [
    ("n = ''", "'''name'' cannot be empty or whitespace.'"),
    ("n <> '' and (left(n, 1) in ('<', '[') or right(n, 1) in ('>', ']'))", "'''name'' appears to be an unresolved placeholder: ''' || n || ''''"),
    ("n <> '' and use_no > 1", "'Duplicate catalogue name detected: ''' || n || ''''"),
    ("n <> '' and a = ''", "'''supplierAdapter'' cannot be empty.'"),
    (f"n <> '' and a <> '' and replace(lower(a), '-', '_') not in {o.in_list(fv.PROFILE_SPELLINGS)}", "'Unsupported supplierAdapter ''' || a || ''''"),
    ("n <> '' and s = ''", "'''source'' path cannot be empty.'"),
    ("n <> '' and s <> '' and not s_ok", "'Source file does not exist: ''' || s || ''''"),
    (f"n <> '' and s <> '' and s_ok and lower(regexp_extract(s, '(\\.[^./]+)$', 1)) not in {o.in_list(fv.SOURCE_EXTENSIONS)}",
     "'Unsupported source file extension ''' || lower(regexp_extract(s, '(\\.[^./]+)$', 1)) || ''''"),
    ("n <> '' and i <> '' and not i_ok", "'Configured images folder does not exist: ''' || i || ''''")]


@query("validate_batch_manifest", sql("\nunion all ".join(
    f"select batch_name, entry_no, {m} as message from k_named where {w}" for w, m in _BATCH), "k_named"))
def validate_batch_manifest(spark, sf):
    return files.batch_findings(b.bind(spark, sf, b.BATCH), b.bind(spark, sf, b.BATCH_PATHS))


cte("k_metrics", "d_runs d_summary r_valid r_uploads", """
select run_id, source_rows as total_source_rows, coalesce(total_products, 0) as total_products, coalesce(total_variants, 0) as total_variants,
  coalesce(error_count, 0) as total_validation_errors, coalesce(warning_count, 0) as total_validation_warnings,
  coalesce(m.images, 0) as total_images_discovered, coalesce(m.matched, 0) as total_images_matched, coalesce(m.ambiguous, 0) as total_images_ambiguous,
  coalesce(m.approved, 0) as total_images_approved, coalesce(u.done, 0) as total_images_uploaded, coalesce(error_count, 0) = 0 as is_valid
from d_runs left join d_summary using (run_id)
left join (select run_id, count(*) as images, count(*) filter (where match_status = 'MATCHED') as matched,
  count(*) filter (where match_status = 'AMBIGUOUS') as ambiguous, count(*) filter (where ok) as approved from r_valid group by 1) m using (run_id)
left join (select run_id, count(*) filter (where status = 'UPLOADED') as done from r_uploads group by 1) u using (run_id)""")


def _metrics(spark, sf):
    runs = b.bind(spark, sf, b.RUNS)
    return metrics.run_metrics(
        runs, qq.summary(spark, sf), review.summary(rq.manifest(spark, sf)),
        review.upload_summary(b.bind(spark, sf, b.UPLOADS)), written(rq.refined(spark, sf).groupBy("run_id").agg(
            F.count_if("requires_review").alias("variants_requiring_review")), "refined"))


@query("run_metrics", sql("""
select k.*, coalesce(r.n, 0) as total_variants_requiring_review, is_valid as success
from k_metrics k left join (select run_id, count(*) filter (where review_reasons <> '') as n from e_refined group by 1) r using (run_id)""", "k_metrics e_refined"))
def run_metrics(spark, sf):
    return _metrics(spark, sf)


@query("batch_summary", sql("""
select b.batch_name as run_id, b.entry_no, b.name, case when k.is_valid then 'SUCCESS' else 'FAILED' end as status, p.profile, k.total_products, k.total_variants,
  case when k.run_id is null then 'Not processed' when not k.is_valid then 'Validation failed with ' || k.total_validation_errors || ' error(s)' end as error
from b_batch b left join k_metrics k on k.run_id = b.batch_name left join o_profile p on p.run_id = b.batch_name""", "b_batch k_metrics o_profile"))
def batch_summary(spark, sf):
    entries = b.bind(spark, sf, b.BATCH).select(F.col("batch_name").alias("run_id"), "entry_no", "name")
    return metrics.batch_summary(entries, _metrics(spark, sf), n.detect_profiles(b.sheet_rows(spark, sf)))
