"""Queries of row normalisation and of the scalar cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.functions import titles
from sheetloom.operators import normalize as n
from sheetloom.operators import provenance
from sheetloom.operators.reports import cleaning_report
from sheetloom.plans import bindings as b
from sheetloom.plans import oracle_base as o
from sheetloom.plans.oracle_base import cte, sql
from sheetloom.plans.registry import query
from sheetloom.session import written

# Runs whose profile was named when they were started.
CHOSEN = """
select 'run-' || lpad(cast(s_nationkey as string), 6, '0') as run_id,
  case min(s_suppkey) % 4 when 0 then 'amra-wholesale' when 1 then ' Default ' when 2 then 'amr' else 'nobody' end as spelling
from {supplier} group by s_nationkey
"""


def _rows(spark, sf):
    return b.sheet_rows(spark, sf)


def _keyed(spark, sf):
    return n.keyed_rows(_rows(spark, sf))


def _written_keyed(spark, sf):
    """For queries that read the keyed rows more than once."""
    return written(_keyed(spark, sf), "keyed")


def products_variants(spark, sf):
    """Products and variants of the given tables; variants are written, as several branches read them."""
    products, variants = n.normalise(_rows(spark, sf))
    return products, written(variants, "variants")


@query("normalize_headers", sql("select distinct run_id, header, nkey as key from b_cells", "b_cells"))
def normalize_headers(spark, sf):
    layout = n.detect_profiles(_rows(spark, sf))
    return (layout.select("run_id", F.explode(F.array_distinct("headers")).alias("header"))
            .withColumn("key", c.header_key("header")))


@query("alias_coalesce", sql("select run_id, row_number, field, header, value from o_hit", "o_hit"))
def alias_coalesce(spark, sf):
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), n.header(f).alias("header"), n.value(f).alias("value"))
                      for f in n.FIELDS])
    return _keyed(spark, sf).select(
        "run_id", "row_number", F.inline(F.filter(pairs, lambda p: p["header"].isNotNull())))


_LOOKED_UP = ["SUPPLIER SKU", "item code", "Brand", "brand name", "work"]


@query("attribute_lookup", sql(
    "select run_id, row_number, lower(header) as name, value from b_cells where value is not null and lower(header) in "
    + o.in_list([x.lower() for x in _LOOKED_UP]), "b_cells"))
def attribute_lookup(spark, sf):
    rows = _rows(spark, sf).withColumn("row_map", F.map_from_arrays("headers", "cells"))
    wanted = F.array(*[F.struct(F.lit(x.lower()).alias("name"), n.attribute("row_map", x.lower()).alias("value"))
                       for x in _LOOKED_UP])
    return rows.select("run_id", "row_number", F.inline(F.filter(wanted, lambda w: w["value"].isNotNull())))


@query("generic_supplier_price", sql(f"""
select run_id, row_number, coalesce({o.cf('single_piece_price')}, {o.cf('supplier_price')}, {o.cf('wholesale_price')}) as supplier_price
from o_wide where profile = '{fv.GENERIC}'""", "o_wide"))
def generic_supplier_price(spark, sf):
    price = F.coalesce(*[c.clean_float(n.text(f)) for f in ("single_piece_price", "supplier_price", "wholesale_price")])
    return (_keyed(spark, sf).where(F.col("profile") == fv.GENERIC)
            .select("run_id", "row_number", price.alias("supplier_price")))


@query("profile_defaults", sql(
    "select run_id, product_id, supplier_name, product_type, category_slug, moq from o_products", "o_products"))
def profile_defaults(spark, sf):
    return n.build_products(_written_keyed(spark, sf)).select(
        "run_id", "product_id", "supplier_name", "product_type", "category_slug", "moq")


@query("unmapped_attributes", sql("select run_id, row_number, header, value from o_unmapped", "o_unmapped"))
def unmapped_attributes(spark, sf):
    return _keyed(spark, sf).select("run_id", "row_number", F.explode(n.raw_unmapped()).alias("header", "value"))


_CATEGORY = ", ".join(f"'{a}'" for a in fv.CATEGORY_ATTRIBUTES)
cte("o_attributes", "o_products o_unmapped", f"""
select run_id, product_id, name, value from (
  select run_id, product_id, unnest([{_CATEGORY}]) as name,
    unnest([raw_fabric, raw_blouse, raw_work, raw_occasion, raw_size, raw_saree_length, raw_blouse_length, raw_stitch_type]) as value
  from o_products where wh) where value is not null
union all
select p.run_id, product_id, header, value from o_products p join o_unmapped u on u.run_id = p.run_id and u.row_number = p.product_ord
  where not wh or header not in ({_CATEGORY})
union all
select run_id, product_id, name, value from (
  select run_id, product_id, unnest(['wholesale_price', 'single_piece_price', 'full_catalogue_price', 'size']) as name,
    unnest([{o.money('n_ws')}, {o.money('n_single')}, {o.money('n_full')}, c_size]) as value
  from o_products where not wh) where value is not null""")


@query("merge_attributes", sql("select * from o_attributes", "o_attributes"))
def merge_attributes(spark, sf):
    return n.build_products(_written_keyed(spark, sf)).select(
        "run_id", "product_id", F.explode("attributes").alias("name", "value"))


@query("variant_cost", sql(
    "select run_id, product_id, variant_ord, supplier_cost from o_variants", "o_variants"))
def variant_cost(spark, sf):
    return products_variants(spark, sf)[1].select("run_id", "product_id", "variant_ord", "supplier_cost")


@query("remote_urls", sql("""
select run_id, row_number, url, url like 'http://%' or url like 'https://%' or contains(url, 'blob.vercel-storage.com') as is_remote
from (select run_id, row_number, unnest([c_image_url, c_img1, c_img2]) as url from b_listing) where url is not null""", "b_listing"))
def remote_urls(spark, sf):
    listing = b.bind(spark, sf, b.LISTING)
    return (listing.select("run_id", "row_number", F.explode(F.array_compact(
        F.array("c_image_url", "c_img1", "c_img2"))).alias("url"))
        .withColumn("is_remote", c.is_remote_url("url")))



cte("o_chosen", "", b.oracle_text(CHOSEN))


@query("detect_profile", sql(f"""
select p.run_id, signature_headers, supplier_named,
  case when ch.run_id is null then profile when spelling in ('amra-wholesale', 'amr') then '{fv.WHOLESALE}'
       when spelling = ' Default ' then '{fv.GENERIC}' end as profile
from o_profile p left join o_chosen ch using (run_id)""", "o_profile o_chosen"))
def detect_profile(spark, sf):
    return n.detect_profiles(_rows(spark, sf), b.bind(spark, sf, CHOSEN)).drop("headers", "keys")


@query("group_key", sql("select run_id, row_number, profile, group_key from o_keyed", "o_keyed"))
def group_key(spark, sf):
    return _keyed(spark, sf).select("run_id", "row_number", "profile", "group_key")


_PRODUCT = "run_id, profile, group_key, product_id, product_ord, row_count, source_file, " + ", ".join(n.PRODUCT_FIELDS)


@query("build_products", sql(f"select {_PRODUCT} from o_products", "o_products"))
def build_products(spark, sf):
    return n.build_products(_written_keyed(spark, sf)).select(*_PRODUCT.split(", "))


_VARIANT = [x for x in n.VARIANT_COLUMNS if x not in ("attributes", "raw_attributes", "gallery_image_urls")]


def _variant_sql(where: str) -> str:
    return sql("select " + ", ".join(_VARIANT) + ", array_to_string(gallery_image_urls, ' ') as gallery from o_variants where "
               + where, "o_variants")


def _variants(spark, sf, where):
    variants = products_variants(spark, sf)[1].where(where)
    return variants.select(*_VARIANT, F.array_join("gallery_image_urls", " ").alias("gallery"))


@query("build_variants_generic", _variant_sql(f"profile = '{fv.GENERIC}' and not is_placeholder"))
def build_variants_generic(spark, sf):
    return _variants(spark, sf, f"profile = '{fv.GENERIC}' and not is_placeholder")


@query("build_variants_wholesale", _variant_sql(f"profile = '{fv.WHOLESALE}' and not is_placeholder"))
def build_variants_wholesale(spark, sf):
    return _variants(spark, sf, f"profile = '{fv.WHOLESALE}' and not is_placeholder")


@query("expand_placeholders", _variant_sql("is_placeholder"))
def expand_placeholders(spark, sf):
    return _variants(spark, sf, "is_placeholder")


@query("declared_count", sql("select run_id, row_number, header, value, n from o_count", "o_count"))
def declared_count(spark, sf):
    return (_keyed(spark, sf).select("run_id", "row_number", n.declared().alias("d"))
            .where(F.col("d").isNotNull()).select("run_id", "row_number", "d.*"))


_TITLES = "select distinct run_id, c_catalogue from b_listing"


def _catalogues(spark, sf):
    return b.bind(spark, sf, b.LISTING).select("run_id", "c_catalogue").distinct()


@query("derive_product_group", sql(
    f"select run_id, c_catalogue, {o.group_name('c_catalogue')} as product_group from ({_TITLES})", "b_listing"))
def derive_product_group(spark, sf):
    return _catalogues(spark, sf).withColumn("product_group", titles.product_group("c_catalogue"))


@query("fallback_sku", sql(
    f"select run_id, c_catalogue, {o.sku_of('c_catalogue')} as sku from ({_TITLES})", "b_listing"))
def fallback_sku(spark, sf):
    return _catalogues(spark, sf).withColumn("sku", titles.fallback_sku("c_catalogue"))


@query("synthesize_title", sql("select run_id, row_number, title from (" + o.titled(
    "(select *, " + o.title_cols("c_catalogue", "c_brand", "c_fabric", "c_work", "c_type") + " from b_listing)",
    "c_catalogue") + ")", "b_listing"))
def synthesize_title(spark, sf):
    return b.bind(spark, sf, b.LISTING).select(
        "run_id", "row_number", titles.product_title("c_catalogue", "c_brand", "c_fabric", "c_work", "c_type").alias("title"))


_PRICE = "cast(c_stock as double) * 100 + 0.5 * (k % 2)"


@query("synthesize_description", sql("select run_id, row_number, " + o.description(
    "c_desc", "c_brand", "c_catalogue", "c_fabric", "c_blouse", "c_work", "c_dispatch", "c_type", "price")
    + f" as description from (select *, {_PRICE} as price from b_listing)", "b_listing"))
def synthesize_description(spark, sf):
    listing = b.bind(spark, sf, b.LISTING).withColumn("price", F.expr(_PRICE))
    return listing.select("run_id", "row_number", titles.product_description(
        "c_desc", "c_brand", "c_catalogue", "c_fabric", "c_blouse", "c_work", "c_dispatch", "c_type", "price")
        .alias("description"))


# ------------------------------------------------------------- provenance
def _mark(field: str, kind: str, key: str, raw: str, note: str, where: str, source: str, ids: str) -> str:
    return (f"select run_id, {ids}, '{field}' as field, '{kind}' as source_type, {key} as raw_key, {raw} as raw_value, "
            f"{note} as notes from {source} where {where}")


_P = "'product' as entity, row_number, cast(null as int) as variant_ord"
_W = "'variant' as entity, row_number, variant_ord"
_N = "cast(null as varchar)"


def _src(field, where, source, ids, name=None, note=_N):
    return _mark(name or field, "SOURCE", f"h_{field}", field, note, f"{where} and {field} is not null", source, ids)


def _auto(field, kind, note, where, source, ids):
    return _mark(field, kind, _N, _N, note, where, source, ids)


_G, _H = "not wh", "wh"
_marks = [
    *[_src(f, _G, "o_p2", _P) for f in ("supplier_name", "catalog_name", "product_name")],
    _auto("supplier_name", "AUTO_FILLED", "'Default generic supplier'", "not wh and supplier_name is null", "o_p2", _P),
    _mark("catalog_name", "DERIVED", "h_product_name", "product_name", "'Derived from product name'",
          "not wh and catalog_name is null and product_name is not null", "o_p2", _P),
    _auto("catalog_name", "AUTO_FILLED", "'Generated fallback'", "not wh and catalog_name is null and product_name is null", "o_p2", _P),
    _src("single_piece_price", "not wh and n_single is not null", "o_p2", _P, "supplier_price", "'Set from supplier single piece price'"),
    _src("supplier_price", "not wh and n_single is null and n_price is not null", "o_p2", _P),
    _src("wholesale_price", "not wh and n_single is null and n_price is null and n_ws is not null", "o_p2", _P,
         "supplier_price", "'Set from supplier wholesale price'"),
    _auto("product_name", "DERIVED", "'Copied from catalog name'", "not wh and product_name is null", "o_p2", _P),
    *[_src(f, _H, "o_p2", _P) for f in ("supplier_name", "catalog_name", "product_group", "brand_name", "product_type",
                                        "category_slug", "description", "supplier_price", "gst_percent", "moq", "dispatch_location")],
    *[_auto(f, "AUTO_FILLED", f"'{t}'", f"wh and {f} is null", "o_p2", _P) for f, t in (
        ("supplier_name", "Default Amra Wholesale"), ("catalog_name", "Generated catalog name"),
        ("product_type", "Default Saree"), ("category_slug", "Default sarees"), ("moq", "Default MOQ = 1"))],
    _src("product_name", "wh and v_name <> f_cat", "o_p2", _P),
    _auto("product_name", "DERIVED", "'Synthesized from Brand + Work + Fabric + Type'", "wh and (v_name is null or v_name = f_cat)", "o_p2", _P),
    *[_src(a, _H, "o_p2", _P, f"attr_{a}") for a in fv.CATEGORY_ATTRIBUTES],
]
cte("o_own", "o_rows2 o_variants", f"""
select r.*, v.variant_ord, v.variant_code as final_code, regexp_replace(v.variant_code, '-V[0-9]+$', '') as used_prefix,
  {o.cf('r.selling_price')} as n_sell
from o_rows2 r join o_variants v on v.run_id = r.run_id and v.row_number = r.row_number where not r.ph""")
_own = [
    *[m for wh, note in ((_G, "Supplier SKU absent in record"), (_H, "Missing in row; not invented")) for m in (
        _src("supplier_sku", f"{wh} and r_sku is not null", "o_own", _W),
        _auto("supplier_sku", "MANUAL_REVIEW", f"'{note}'", f"{wh} and r_sku is null", "o_own", _W))],
    _src("variant_code", "not wh and r_code is not null", "o_own", _W),
    _auto("variant_code", "DERIVED", "'Derived from supplier SKU + index ' || variant_ord",
          "not wh and r_code is null and r_sku is not null", "o_own", _W),
    _auto("variant_code", "DERIVED", "'Derived from prefix ''' || used_prefix || ''' and index ' || variant_ord",
          "not wh and r_code is null and r_sku is null", "o_own", _W),
    _src("variant_name", _G, "o_own", _W),
    _mark("variant_name", "DERIVED", "h_color", "color", "'Derived from color'",
          "not wh and variant_name is null and color is not null", "o_own", _W),
    _auto("variant_name", "AUTO_FILLED", "'Default option name'", "not wh and variant_name is null and color is null", "o_own", _W),
    *[_src(f, _G, "o_own", _W) for f in ("color", "size", "stock_quantity")],
    _src("supplier_price", _G, "o_own", _W, "supplier_cost"),
    *[m for wh, note in ((_G, "pricing configuration"), (_H, "admin review")) for m in (
        _src("selling_price", f"{wh} and n_sell is not null", "o_own", _W),
        _auto("selling_price", "MANUAL_REVIEW", f"'Selling price unset; requires {note}'", f"{wh} and n_sell is null", "o_own", _W))],
    _src("image_sku", _H, "o_own", _W),
    _auto("variant_code", "DERIVED", "'Derived variant code from prefix ''' || used_prefix || ''' and index ' || variant_ord",
          "wh and r_image is null", "o_own", _W),
    _src("image_sku", "wh and r_image = final_code", "o_own", _W, "variant_code"),
    _mark("variant_code", "DERIVED", "h_image_sku", "image_sku",
          "'Disambiguated duplicate supplier image_sku ''' || r_image || ''' with variant index ' || variant_ord",
          "wh and r_image <> final_code", "o_own", _W),
    _src("variant_name", "wh and r_name is not null", "o_own", _W),
    _auto("variant_name", "AUTO_FILLED", "'Default design variant name ' || variant_ord", "wh and r_name is null", "o_own", _W),
    _src("primary_image_url", _H, "o_own", _W),
    *[_src(f"gallery_{i}", f"wh and {o.cs(f'gallery_{i}')} is not null", "o_own", _W, f"gallery_image{i}_url") for i in range(1, 5)],
    _src("variant_cost", _H, "o_own", _W, "supplier_cost"),
]


@query("field_provenance", sql("\nunion all ".join(_marks + _own), "o_p2 o_own"))
def field_provenance(spark, sf):
    keyed = _written_keyed(spark, sf)
    variants = n.build_variants(keyed, n.build_products(keyed))
    return provenance.field_provenance(keyed, variants)


# ------------------------------------------------------------ scalar jobs
def _report(raw: str, cleaned: str) -> str:
    return sql(f"""select run_id, count(v) as accepted, count(*) filter (where coalesce(trim(raw), '') = '') as missing,
  count(*) filter (where v is null and coalesce(trim(raw), '') <> '') as rejected, min(v) as lowest, max(v) as highest
from (select run_id, {raw} as raw, {cleaned} as v from b_listing) group by run_id""", "b_listing")


for _name, _raw, _clean, _text in (
        ("clean_strings", "c_sku", c.clean_str, o.cs),
        ("clean_numbers", "c_price", c.clean_float, o.cf),
        ("clean_integers", "c_moq", c.clean_int, o.ci),
        ("parse_counts", "c_count", c.declared_count, o.count_of),
        ("clean_tokens", "c_catalogue", c.clean_token, o.token_of),
        ("clean_amounts", "c_wholesale", c.clean_amount,
         lambda x: f"(case when try_cast(replace(trim({x}), ',', '') as double) > 0 then try_cast(replace(trim({x}), ',', '') as double) end)")):
    query(_name, _report(_raw, _text(_raw)))(
        lambda spark, sf, _raw=_raw, _clean=_clean: cleaning_report(b.bind(spark, sf, b.LISTING), _raw, _clean(_raw)))


@query("gst_label", sql(f"""
select run_id, label, count(*) as n from (select run_id, coalesce(cast({o.whole(o.cf('c_gst'))} as bigint) || '% Extra', '') as label
from b_listing) group by all""", "b_listing"))
def gst_label(spark, sf):
    listing = b.bind(spark, sf, b.LISTING).select("run_id", c.clean_float("c_gst").alias("gst"))
    return listing.groupBy("run_id", c.gst_label("gst").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("catalogue_report", sql("""
select run_id, count(distinct product_id) as total_products, count(*) as total_variants,
  count(*) filter (where selling_price is null) as unpriced, count(*) filter (where is_placeholder) as placeholders,
  count(*) filter (where supplier_cost < 0) as negative_costs
from o_variants group by run_id""", "o_variants"))
def catalogue_report(spark, sf):
    """Flagship: raw sheets to products and variants, reported per run."""
    products, variants = products_variants(spark, sf)
    made = products.groupBy("run_id").agg(F.count(F.lit(1)).alias("total_products"))
    seen = variants.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_variants"),
        F.count_if(F.col("selling_price").isNull()).alias("unpriced"),
        F.count_if("is_placeholder").alias("placeholders"),
        F.count_if(F.col("supplier_cost") < 0).alias("negative_costs"))
    return made.join(seen, "run_id")
