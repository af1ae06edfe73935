"""Where each field value came from, one row per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators import normalize as n

SOURCE, DERIVED, AUTO, REVIEW = "SOURCE", "DERIVED", "AUTO_FILLED", "MANUAL_REVIEW"


def _mark(field: str, kind: str, key: Column | None = None, raw: Column | None = None,
          note: Column | str | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(field).alias("field"), F.lit(kind).alias("source_type"),
        (none if key is None else key).alias("raw_key"), (none if raw is None else raw).alias("raw_value"),
        (F.lit(note).cast("string") if note is None or isinstance(note, str) else note).alias("notes"))


def _found(field: str) -> Column:
    return n.header(field).isNotNull()


def _source(field: str, name: str | None = None, note: str | None = None) -> Column:
    return _mark(name or field, SOURCE, n.header(field), n.value(field), note)


def _source_or(field: str, otherwise: Column) -> Column:
    return F.when(_found(field), _source(field)).otherwise(otherwise)


def _long(df: DataFrame, ids: list[Column | str], wholesale: list[Column], generic: list[Column]) -> DataFrame:
    marks = F.when(n.is_wholesale(), F.array(*wholesale)).otherwise(F.array(*generic))
    return df.select(*ids, F.inline(F.filter(marks, lambda m: m.isNotNull())))


def product_provenance(keyed: DataFrame) -> DataFrame:
    first = n.first_rows(keyed)
    parsed = lambda f: c.clean_float(n.text(f)).isNotNull()
    generic = [
        _source_or("supplier_name", _mark("supplier_name", AUTO, note="Default generic supplier")),
        F.when(_found("catalog_name"), _source("catalog_name"))
        .when(_found("product_name"), _mark("catalog_name", DERIVED, n.header("product_name"),
                                            n.value("product_name"), "Derived from product name"))
        .otherwise(_mark("catalog_name", AUTO, note="Generated fallback")),
        F.when(parsed("single_piece_price"),
               _source("single_piece_price", "supplier_price", "Set from supplier single piece price"))
        .when(parsed("supplier_price"), _source("supplier_price"))
        .when(parsed("wholesale_price"),
              _source("wholesale_price", "supplier_price", "Set from supplier wholesale price")),
        _source_or("product_name", _mark("product_name", DERIVED, note="Copied from catalog name")),
    ]
    given = n.text("product_name").isNotNull() & ~n.text("product_name").eqNullSafe(
        F.coalesce(n.text("catalog_name"), F.concat(F.lit("Amra Catalog "), F.col("row_number").cast("string"))))
    wholesale = [
        _source_or("supplier_name", _mark("supplier_name", AUTO, note="Default Amra Wholesale")),
        _source_or("catalog_name", _mark("catalog_name", AUTO, note="Generated catalog name")),
        *[F.when(_found(f), _source(f)) for f in ("product_group", "brand_name")],
        _source_or("product_type", _mark("product_type", AUTO, note="Default Saree")),
        _source_or("category_slug", _mark("category_slug", AUTO, note="Default sarees")),
        F.when(given, _source("product_name")).otherwise(
            _mark("product_name", DERIVED, note="Synthesized from Brand + Work + Fabric + Type")),
        *[F.when(_found(f), _source(f)) for f in ("description", "supplier_price", "gst_percent")],
        _source_or("moq", _mark("moq", AUTO, note="Default MOQ = 1")),
        F.when(_found("dispatch_location"), _source("dispatch_location")),
        *[F.when(_found(a), _source(a, f"attr_{a}")) for a in fv.CATEGORY_ATTRIBUTES],
    ]
    return _long(first, ["run_id", F.lit("product").alias("entity"), "row_number",
                         F.lit(None).cast("int").alias("variant_ord")], wholesale, generic)


def variant_provenance(keyed: DataFrame, variants: DataFrame) -> DataFrame:
    """Marks of the variants that come from a row of their own."""
    own = (variants.where(~F.col("is_placeholder"))
           .select("run_id", "row_number", "variant_ord", "variant_code"))
    rows = keyed.join(own, ["run_id", "row_number"])
    no = F.col("variant_ord").cast("string")

    def sku(note: str) -> Column:
        return F.when(n.text("supplier_sku").isNotNull(), _source("supplier_sku")).otherwise(
            _mark("supplier_sku", REVIEW, note=note))

    def selling(note: str) -> Column:
        return F.when(c.clean_float(n.text("selling_price")).isNotNull(), _source("selling_price")).otherwise(
            _mark("selling_price", REVIEW, note=note))

    generic = [
        sku("Supplier SKU absent in record"),
        F.when(n.text("variant_code").isNotNull(), _source("variant_code"))
        .when(n.text("supplier_sku").isNotNull(), _mark("variant_code", DERIVED, note=F.concat(
            F.lit("Derived from supplier SKU + index "), no)))
        .otherwise(_mark("variant_code", DERIVED, note=F.concat(
            F.lit("Derived from prefix '"), F.regexp_replace("variant_code", "-V[0-9]+$", ""),
            F.lit("' and index "), no))),
        F.when(_found("variant_name"), _source("variant_name"))
        .when(_found("color"), _mark("variant_name", DERIVED, n.header("color"), n.value("color"), "Derived from color"))
        .otherwise(_mark("variant_name", AUTO, note="Default option name")),
        *[F.when(_found(f), _source(f)) for f in ("color", "size")],
        F.when(_found("supplier_price"), _source("supplier_price", "supplier_cost")),
        F.when(_found("stock_quantity"), _source("stock_quantity")),
        selling("Selling price unset; requires pricing configuration"),
    ]
    image = n.text("image_sku")
    wholesale = [
        sku("Missing in row; not invented"),
        F.when(_found("image_sku"), _source("image_sku")),
        F.when(image.isNull(), _mark("variant_code", DERIVED, note=F.concat(
            F.lit("Derived variant code from prefix '"), F.regexp_replace("variant_code", "-V[0-9]+$", ""),
            F.lit("' and index "), no)))
        .when(F.col("variant_code") == image, _source("image_sku", "variant_code"))
        .otherwise(_mark("variant_code", DERIVED, n.header("image_sku"), n.value("image_sku"), F.concat(
            F.lit("Disambiguated duplicate supplier image_sku '"), image, F.lit("' with variant index "), no))),
        F.when(n.text("variant_name").isNotNull(), _source("variant_name")).otherwise(
            _mark("variant_name", AUTO, note=F.concat(F.lit("Default design variant name "), no))),
        F.when(_found("primary_image_url"), _source("primary_image_url")),
        *[F.when(n.text(f"gallery_{i}").isNotNull(), _source(f"gallery_{i}", f"gallery_image{i}_url"))
          for i in range(1, 5)],
        F.when(_found("variant_cost"), _source("variant_cost", "supplier_cost")),
        selling("Selling price unset; requires admin review"),
    ]
    return _long(rows, ["run_id", F.lit("variant").alias("entity"), "row_number", "variant_ord"], wholesale, generic)


def field_provenance(keyed: DataFrame, variants: DataFrame) -> DataFrame:
    return product_provenance(keyed).unionByName(variant_provenance(keyed, variants))
