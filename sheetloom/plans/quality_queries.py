"""Queries of the data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import legacy, quality
from sheetloom.plans import bindings as b
from sheetloom.plans.oracle_base import cte, in_list, sql
from sheetloom.plans.registry import query

cte("d_products", "", b.oracle_text(b.DQ_PRODUCTS))
cte("d_variants", "", "select * exclude (g1, g2, g3), list_filter([g1, g2, g3], lambda u: u is not null) as gallery_image_urls from ("
    + b.oracle_text(b.DQ_VARIANTS) + ")")
cte("d_runs", "", b.oracle_text(b.RUNS))
cte("d_numbered", "d_products", "select *, row_number() over (partition by run_id order by product_ord) as product_no from d_products")
cte("d_named", "d_variants d_products", """
select v.*, p.catalog_name, coalesce(trim(v.variant_code), '') as code, coalesce(trim(v.supplier_sku), '') as sku,
  row_number() over (partition by v.run_id, lower(trim(v.variant_code)) order by v.product_ord, v.variant_ord) as use_no
from d_variants v join d_products p using (run_id, product_ord)""")

_NONE_SKU = "cast(null as varchar)"


def _product_rule(where: str, code: str, message: str, field: str, row: str = "cast(null as int)") -> str:
    return (f"select run_id, product_ord, cast(null as int) as variant_ord, 'ERROR' as severity, '{code}' as code, "
            f"{message} as message, '{field}' as field, {_NONE_SKU} as supplier_sku, {_NONE_SKU} as variant_code, "
            f"{row} as source_row from d_numbered where {where}")


def _variant_rule(where: str, severity: str, code: str, message: str, field: str, sku: str = "sku", var: str = "code",
                  source: str = "d_named") -> str:
    return (f"select run_id, product_ord, variant_ord, '{severity}' as severity, '{code}' as code, {message} as message, "
            f"'{field}' as field, {sku} as supplier_sku, {var} as variant_code, cast(null as int) as source_row "
            f"from {source} where {where}")


def _money(x: str) -> str:
    return f"cast(cast({x} as decimal(38,2)) as varchar)"


_V = "'Variant ''' || code || ''''"
_R = "'Variant ''' || variant_code || ''''"
RULES = {
    "NO_PRODUCTS": (
        "select run_id, cast(null as bigint) as product_ord, cast(null as int) as variant_ord, 'ERROR' as severity, "
        "'NO_PRODUCTS' as code, 'No processable products found in dataset' as message, 'products' as field, "
        f"{_NONE_SKU} as supplier_sku, {_NONE_SKU} as variant_code, cast(null as int) as source_row "
        "from d_runs where run_id not in (select run_id from d_products)"),
    "MISSING_PRODUCT_NAME": _product_rule(
        "coalesce(trim(product_name), '') = ''", "MISSING_PRODUCT_NAME",
        "'Product at index ' || product_no || ' is missing a product_name'", "product_name", "product_no"),
    "MISSING_CATALOG_NAME": _product_rule(
        "coalesce(trim(catalog_name), '') = ''", "MISSING_CATALOG_NAME",
        "'Product at index ' || product_no || ' is missing a catalog_name'", "catalog_name", "product_no"),
    "MISSING_SUPPLIER_NAME": _product_rule(
        "coalesce(trim(supplier_name), '') = ''", "MISSING_SUPPLIER_NAME",
        "'Product ''' || catalog_name || ''' is missing a supplier_name'", "supplier_name"),
    "INVALID_SUPPLIER_PRICE": _product_rule(
        "supplier_price < 0", "INVALID_SUPPLIER_PRICE",
        f"'Product ''' || catalog_name || ''' has negative supplier_price (' || {_money('supplier_price')} || ')'", "supplier_price"),
    "INVALID_GST_PERCENT": _product_rule(
        "gst_percent < 0 or gst_percent > 100", "INVALID_GST_PERCENT",
        f"'Product ''' || catalog_name || ''' has invalid GST percent (' || {_money('gst_percent')} || '%)'", "gst_percent"),
    "INVALID_CATEGORY_SLUG": _product_rule(
        "category_slug <> '' and (regexp_matches(trim(category_slug), '[^\\w\\-]') or trim(category_slug) <> lower(trim(category_slug)))",
        "INVALID_CATEGORY_SLUG",
        "'Category slug ''' || category_slug || ''' contains invalid uppercase or special characters'", "category_slug"),
    "NO_VARIANTS": _product_rule(
        "(run_id, product_ord) not in (select (run_id, product_ord) from d_variants)", "NO_VARIANTS",
        "'Product ''' || catalog_name || ''' has no child variants'", "variants"),
    "SHARED_SUPPLIER_SKU": (
        "select run_id, product_ord, cast(null as int) as variant_ord, 'INFO' as severity, 'SHARED_SUPPLIER_SKU' as code, "
        "'Product ''' || any_value(catalog_name) || ''' has multiple variants sharing supplier SKU(s): ' "
        "|| string_agg(supplier_sku, ', ' order by supplier_sku) as message, 'supplier_sku' as field, "
        f"{_NONE_SKU} as supplier_sku, {_NONE_SKU} as variant_code, cast(null as int) as source_row "
        "from (select run_id, product_ord, catalog_name, supplier_sku from d_named where supplier_sku <> '' "
        "group by all having count(*) > 1) s group by run_id, product_ord"),
    "MISSING_VARIANT_CODE": _variant_rule(
        "code = ''", "ERROR", "MISSING_VARIANT_CODE",
        "'Variant #' || variant_ord || ' in product ''' || catalog_name || ''' is missing variant_code'", "variant_code", var=_NONE_SKU),
    "DUPLICATE_VARIANT_CODE": _variant_rule(
        "code <> '' and use_no > 1", "ERROR", "DUPLICATE_VARIANT_CODE",
        "'Variant code ''' || code || ''' is duplicated'", "variant_code"),
    "MISSING_VARIANT_NAME": _variant_rule(
        "coalesce(trim(variant_name), '') = ''", "ERROR", "MISSING_VARIANT_NAME", f"{_V} || ' is missing variant_name'", "variant_name"),
    "MISSING_SUPPLIER_SKU": _variant_rule(
        "sku = ''", "WARNING", "MISSING_SUPPLIER_SKU", f"{_V} || ' has no supplier_sku defined'", "supplier_sku", sku=_NONE_SKU),
    "INVALID_STOCK_QUANTITY": _variant_rule(
        "stock_quantity < 0", "ERROR", "INVALID_STOCK_QUANTITY",
        f"{_V} || ' has negative stock quantity (' || stock_quantity || ')'", "stock_quantity"),
    "MISSING_STOCK_QUANTITY": _variant_rule(
        "stock_quantity is null", "WARNING", "MISSING_STOCK_QUANTITY",
        f"{_V} || ' has no stock quantity defined (defaults to 0)'", "stock_quantity"),
    "INVALID_SUPPLIER_COST": _variant_rule(
        "supplier_cost < 0", "ERROR", "INVALID_SUPPLIER_COST",
        f"{_V} || ' has negative supplier_cost (' || {_money('supplier_cost')} || ')'", "supplier_cost"),
    "INVALID_SELLING_PRICE": _variant_rule(
        "selling_price < 0", "ERROR", "INVALID_SELLING_PRICE",
        f"{_V} || ' has negative selling_price (' || {_money('selling_price')} || ')'", "selling_price"),
    "MISSING_SELLING_PRICE": _variant_rule(
        "selling_price is null", "WARNING", "MISSING_SELLING_PRICE",
        f"{_V} || ' is missing selling_price (requires commercial review)'", "selling_price"),
    "PUBLISHED_WITHOUT_SELLING_PRICE": _variant_rule(
        "publish and selling_price is null", "WARNING", "PUBLISHED_WITHOUT_SELLING_PRICE",
        f"{_V} || ' is marked publish=True but has no selling_price'", "publish"),
    "MISSING_PRIMARY_BLOB_URL": _variant_rule(
        "coalesce(primary_image_url, '') = ''", "WARNING", "MISSING_PRIMARY_BLOB_URL",
        f"{_R} || ' has no uploaded primary_image_url'", "primary_image_url", "supplier_sku", "variant_code"),
    "PRIMARY_IMAGE_IN_GALLERY": _variant_rule(
        "primary_image_url <> '' and list_contains(gallery_image_urls, primary_image_url)", "ERROR", "PRIMARY_IMAGE_IN_GALLERY",
        f"{_R} || ' primary_image_url is duplicated in gallery_image_urls'", "gallery_image_urls", "supplier_sku", "variant_code"),
    "DUPLICATE_GALLERY_IMAGE": _variant_rule(
        "n > 1", "ERROR", "DUPLICATE_GALLERY_IMAGE",
        f"{_R} || ' has duplicate gallery image URL: ' || url", "gallery_image_urls", "supplier_sku", "variant_code",
        source="(select *, row_number() over (partition by run_id, product_ord, variant_ord, url) as n "
               "from (select *, unnest(gallery_image_urls) as url from d_named))"),
}
_DEPS = "d_runs d_numbered d_variants d_named"


def _inputs(spark, sf):
    return b.dq_products(spark, sf), b.dq_variants(spark, sf)


def _rule_query(code: str):
    def run(spark, sf):
        products, variants = _inputs(spark, sf)
        if code == "NO_PRODUCTS":
            found = quality.missing_products(b.bind(spark, sf, b.RUNS), products)
        elif code == "NO_VARIANTS":
            found = quality.products_without_variants(products, variants)
        elif code == "SHARED_SUPPLIER_SKU":
            found = quality.shared_sku_issues(products, variants)
        elif RULES[code].endswith(("d_named", "d_named))")) or "from d_named" in RULES[code]:
            found = quality.variant_issues(products, variants, require_hosted=True)
        else:
            found = quality.product_issues(products)
        return found.where(F.col("code") == code)

    return run


for _code, _text in RULES.items():
    query(f"dq_{_code.lower()}", sql(_text, _DEPS))(_rule_query(_code))

cte("d_issues", _DEPS, "\nunion all ".join(t for c_, t in RULES.items() if c_ != "MISSING_PRIMARY_BLOB_URL"))
cte("d_summary", "d_runs d_products d_variants d_issues", """
select run_id, coalesce(p.n, 0) as total_products, coalesce(v.n, 0) as total_variants,
  coalesce(e, 0) as error_count, coalesce(w, 0) as warning_count, coalesce(f, 0) as info_count, coalesce(e, 0) = 0 as is_valid
from d_runs
left join (select run_id, count(*) as n from d_products group by 1) p using (run_id)
left join (select run_id, count(*) as n from d_variants group by 1) v using (run_id)
left join (select run_id, count(*) filter (where severity = 'ERROR') as e, count(*) filter (where severity = 'WARNING') as w,
    count(*) filter (where severity = 'INFO') as f from d_issues group by 1) i using (run_id)""")


def issues(spark, sf):
    products, variants = _inputs(spark, sf)
    return quality.all_issues(products, variants, b.bind(spark, sf, b.RUNS))


@query("dq_all", sql("select * from d_issues", "d_issues"))
def dq_all(spark, sf):
    return issues(spark, sf)


@query("dq_shared_sku_list", sql(
    "select run_id, product_ord, supplier_sku, count(*) as variant_count from d_variants "
    "where supplier_sku <> '' group by all having count(*) > 1", "d_variants"))
def dq_shared_sku_list(spark, sf):
    return quality.shared_skus(b.dq_variants(spark, sf))


def summary(spark, sf):
    products, variants = _inputs(spark, sf)
    return quality.validation_summary(b.bind(spark, sf, b.RUNS), products, variants, issues(spark, sf))


@query("validation_summary", sql("select * from d_summary", "d_summary"))
def validation_summary(spark, sf):
    return summary(spark, sf)


@query("validation_summary_long", sql("""
select run_id, unnest(['Overall Status', 'Total Products', 'Total Variants', 'Validation Errors', 'Validation Warnings', 'Validation Infos']) as metric,
  unnest([case when is_valid then 'PASSED' else 'FAILED' end, total_products::varchar, total_variants::varchar,
    error_count::varchar, warning_count::varchar, info_count::varchar]) as value from d_summary""", "d_summary"))
def validation_summary_long(spark, sf):
    return quality.summary_long(summary(spark, sf))


def _reject(source: str, where: str, reason: str, ord_: str) -> str:
    return f"select run_id, product_ord, {ord_} as variant_ord, '{reason}' as reason from {source} where {where}"


_NULL_ORD = "cast(null as int)"
_REJECTS = [
    *[_reject("d_products", f"coalesce(trim({n}), '') = ''", f"blank {n}", _NULL_ORD)
      for n in ("supplier_name", "catalog_name", "product_name")],
    _reject("d_products", "supplier_price < 0", "negative supplier_price", _NULL_ORD),
    _reject("d_products", "not gst_percent between 0 and 100", "gst_percent out of range", _NULL_ORD),
    _reject("d_products", "moq < 1", "moq below 1", _NULL_ORD),
    *[_reject("d_variants", f"coalesce(trim({n}), '') = ''", f"blank {n}", "variant_ord") for n in ("variant_code", "variant_name")],
    *[_reject("d_variants", f"{n} < 0", f"negative {n}", "variant_ord") for n in ("supplier_cost", "selling_price", "stock_quantity")],
    "select run_id, product_ord, cast(null as int), 'repeated variant_code ' || lower(trim(variant_code)) from d_variants "
    "where trim(variant_code) <> '' group by run_id, product_ord, lower(trim(variant_code)) having count(*) > 1",
]


@query("dq_model_constraints", sql("\nunion all ".join(_REJECTS), "d_products d_variants"))
def dq_model_constraints(spark, sf):
    return quality.model_rejects(*_inputs(spark, sf))


# ------------------------------------------------------------- older table
cte("l_rows", "", "select * exclude (image_sku), image_sku as \"image-sku\", coalesce(trim(supplier_sku), 'nan') as sku from ("
    + b.oracle_text(b.LEGACY) + ")")


def _legacy_rule(where: str, field: str, severity: str, issue: str, source: str = "l_rows") -> str:
    return (f"select run_id, row_number as excel_row, sku as supplier_sku, '{field}' as field, '{severity}' as severity, "
            f"{issue} as issue from {source} where {where}")


def _blank(n: str) -> str:
    return f"coalesce(trim(\"{n}\"), '') = ''"


_REQUIRED = "\nunion all ".join(
    _legacy_rule(_blank(f), f, "ERROR", f"'Missing required field: {f}'") for f in fv.LEGACY_REQUIRED)
_DUPLICATE = _legacy_rule("sku <> '' and lower(sku) <> 'nan' and n > 1", "supplier_sku", "ERROR", "'Duplicate SKU in batch'",
                          "(select *, row_number() over (partition by run_id, lower(sku) order by row_number) as n from l_rows)")
_NUMERIC = "\nunion all ".join(_legacy_rule(
    f"not {_blank(f)} and (try_cast(trim({f}) as double) is null or try_cast(trim({f}) as double) < 0 or try_cast(trim({f}) as double) {x})",
    f, "ERROR", f"'Invalid numeric value: ' || {f}") for f, x in (("supplier_price", "= 0"), ("gst_percent", "> 100")))
_REVIEW = "\nunion all ".join(
    _legacy_rule(_blank(f), f, "WARNING", f"'Pending later workflow step: {f}'") for f in fv.LEGACY_REVIEW)
_PUBLISH = _legacy_rule(f"not {_blank('publish')} and lower(trim(publish)) not in {in_list(['false', '0', 'no'])}", "publish",
                        "ERROR", "'Product must remain unpublished during processing'")


def _legacy(spark, sf):
    return b.bind(spark, sf, b.LEGACY).withColumnRenamed("image_sku", "image-sku")


for _name, _fn, _text in (
        ("required", legacy.missing_required, _REQUIRED), ("duplicate_sku", legacy.duplicate_skus, _DUPLICATE),
        ("numeric", legacy.bad_numbers, _NUMERIC), ("review", legacy.pending_review, _REVIEW),
        ("publish", legacy.published_drafts, _PUBLISH)):
    query(f"dq_legacy_{_name}", sql(_text, "l_rows"))(
        lambda spark, sf, _fn=_fn: _fn(_legacy(spark, sf)))


@query("dq_legacy_summary", sql(f"""
select run_id, products_checked, coalesce(errors, 0) as errors, coalesce(warnings, 0) as warnings
from (select run_id, count(*) as products_checked from l_rows group by 1) left join
(select run_id, count(*) filter (where severity = 'ERROR') as errors, count(*) filter (where severity = 'WARNING') as warnings
 from ({_REQUIRED} union all {_DUPLICATE} union all {_NUMERIC} union all {_REVIEW} union all {_PUBLISH}) group by 1) using (run_id)""",
    "l_rows"))
def dq_legacy_summary(spark, sf):
    return legacy.summary(_legacy(spark, sf))


_M21 = ", ".join(
    [f"'{v}' as \"{n}\"" if (v := fv.LEGACY_CONSTANTS.get(n)) is not None else
     {"supplier_name": "c_supplier", "catalog_name": "c_catalogue", "supplier_sku": "c_sku", "product_type": "c_type",
      "brand_name": "c_brand", "fabric": "c_fabric", "blouse_fabric": "c_blouse", "work": "c_work",
      "occasion": "cast(null as varchar)", "supplier_price": "c_price", "gst_percent": "c_gst"}[n] + f" as \"{n}\""
     for n in fv.LEGACY_COLUMNS])


@query("legacy_map21", sql(f"select run_id, row_number, {_M21} from b_listing", "b_listing"))
def legacy_map21(spark, sf):
    listing = b.bind(spark, sf, b.LISTING)
    named = {"c_supplier": "supplier_name", "c_catalogue": "catalogue_name", "c_brand": "brand_name",
             "c_sku": "supplier_sku", "c_type": "product_type", "c_fabric": "saree_fabric",
             "c_blouse": "blouse_fabric", "c_work": "work", "c_price": "supplier_price", "c_gst": "gst_percent"}
    return legacy.map21(listing.select("run_id", "row_number", *[F.col(k).alias(v) for k, v in named.items()]))
