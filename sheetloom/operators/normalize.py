"""Raw sheet rows to products and variants.

Input everywhere: ``run_id, source_file, row_number, headers, keys, cells``.
All joins and groups start with ``run_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.functions import titles
from sheetloom.operators.ranking import CHUNK, rank_by_number
from sheetloom.session import written

EXPAND_BLOCK = 1024
PRODUCT_FIELDS = [
    "supplier_name", "catalog_name", "product_name", "product_group", "brand_name", "product_type",
    "category_slug", "description", "supplier_price", "gst_percent", "moq", "dispatch_location",
]


def _keys(aliases: list[str]) -> list[str]:
    return list(dict.fromkeys(c.header_key_text(a) for a in aliases))


MAPPED = {
    fv.GENERIC: sorted({k for a in fv.GENERIC_ALIASES.values() for k in _keys(a)} | set(fv.GENERIC_RESERVED)),
    fv.WHOLESALE: sorted({k for a in fv.WHOLESALE_ALIASES.values() for k in _keys(a)}),
}


# ---------------------------------------------------------------- layouts
FIELDS = list(dict.fromkeys([*fv.GENERIC_ALIASES, *fv.WHOLESALE_ALIASES]))


def is_wholesale() -> Column:
    return F.col("profile") == fv.WHOLESALE


def _alias_lists(aliases: dict[str, list[str]]) -> Column:
    none = F.array().cast("array<string>")
    return F.array(*[F.array(*[F.lit(k) for k in _keys(aliases[f])]) if f in aliases else none for f in FIELDS])


def _columns_of(aliases: Column) -> Column:
    """0-based columns that answer to these header keys, best alias first."""
    at = F.transform(aliases, lambda k: (F.array_position(F.col("keys"), k) - F.lit(1)).cast("int"))
    return F.filter(at, lambda p: p >= 0)


def _unmapped_columns(profile: str) -> Column:
    """Columns no alias list reads; of equal headers the first one counts."""
    mapped = F.array(*[F.lit(k) for k in MAPPED[profile]])

    def keep(p: Column) -> Column:
        header = F.get("headers", p)
        key = F.when(F.get("keys", p) == "", c.header_key(header)).otherwise(F.get("keys", p))
        return (F.array_position("headers", header) == p + F.lit(1)) & ~F.array_contains(mapped, key)

    columns = F.transform("headers", lambda h, i: i)
    return F.filter(columns, keep)


def layouts(rows: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """One row per run: its profile and which columns feed which field.

    Aliases are resolved here once per sheet; rows then only pick columns.
    """
    per_run = detect_profiles(rows, chosen).where(F.col("profile").isNotNull())
    wanted = F.when(is_wholesale(), _alias_lists(fv.WHOLESALE_ALIASES)).otherwise(_alias_lists(fv.GENERIC_ALIASES))
    counts = F.array(*[F.lit(k) for k in _keys(fv.DECLARED_COUNT_ALIASES)])
    return per_run.select(
        "run_id", "profile", "headers",
        F.transform(wanted, _columns_of).alias("field_columns"),
        _columns_of(counts).alias("count_columns"),
        F.when(is_wholesale(), _unmapped_columns(fv.WHOLESALE))
        .otherwise(_unmapped_columns(fv.GENERIC)).alias("unmapped_columns"))


def _stretch() -> Column:
    return F.coalesce(F.floor(F.col("row_number") / F.lit(CHUNK)), F.lit(0)).alias("_stretch")


def with_fields(rows: DataFrame, sheet_layouts: DataFrame) -> DataFrame:
    """Rows with the column that feeds each field of their profile.

    ``at[i]`` is the column of field ``FIELDS[i]``: the first alias column with
    a non-blank cell.  ``texts`` are the cleaned cells.

    A sheet's layout goes to each stretch of its rows, so that a long sheet is
    spread over tasks.  The hint makes the layouts the side that is hashed:
    by the planner's guess for computed arrays, a whole sheet is small enough
    to be sent through the driver.
    """
    stretches = rows.select("run_id", _stretch()).groupBy("run_id", "_stretch").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    placed = stretches.join(sheet_layouts.hint("shuffle_hash"), "run_id")
    return (rows.drop("headers", "keys").withColumn("_stretch", _stretch())
            .join(placed.hint("shuffle_hash"), ["run_id", "_stretch"]).drop("_stretch")
            .withColumn("at", F.transform("field_columns", lambda ps: F.get(
                F.filter(ps, lambda p: F.coalesce(c.pystrip(F.get("cells", p)) != "", F.lit(False))), F.lit(0))))
            .withColumn("texts", F.transform("cells", c.clean_str))
            .drop("field_columns"))


def _column(field: str) -> Column:
    return F.get(F.col("at"), F.lit(FIELDS.index(field)))


def header(field: str) -> Column:
    """Header under which a field was found."""
    return F.get("headers", _column(field))


def value(field: str) -> Column:
    """Raw cell of a field."""
    return F.get("cells", _column(field))


def text(field: str) -> Column:
    """Cleaned text of a field."""
    return F.get("texts", _column(field))


def declared() -> Column:
    """Header, cell and number of the first count column that parses."""
    found = F.transform("count_columns", lambda p: F.struct(
        F.get("headers", p).alias("header"), F.get("cells", p).alias("value"),
        c.declared_count(F.get("cells", p)).alias("n")))
    return F.get(F.filter(found, lambda x: x["n"].isNotNull()), F.lit(0))


def raw_unmapped() -> Column:
    """Cells no alias list reads, under their own header."""
    filled = F.filter("unmapped_columns", lambda p: F.get("cells", p).isNotNull())
    return F.map_from_entries(F.transform(filled, lambda p: F.struct(
        F.get("headers", p).alias("key"), F.get("cells", p).alias("value"))))


# --------------------------------------------------------------- profiles
def profile_of_spelling(spelling: Column) -> Column:
    """Profile chosen by name; unknown names give null."""
    key = F.replace(F.lower(c.pystrip(spelling)), F.lit("-"), F.lit("_"))
    table = F.create_map(*[F.lit(x) for kv in fv.PROFILE_SPELLINGS.items() for x in kv])
    inside = F.when(
        (key != "") & (F.lit(fv.WHOLESALE).contains(key) | key.contains(fv.WHOLESALE)), F.lit(fv.WHOLESALE)
    ).when((key != "") & (F.lit(fv.GENERIC).contains(key) | key.contains(fv.GENERIC)), F.lit(fv.GENERIC))
    return F.coalesce(F.try_element_at(table, key), inside)


def _with_least(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the least row number of their group, and the group's ``row_count``.

    The numbers are found first, in hashed groups of two numbers each: an
    aggregate that holds whole rows would sort all of them.
    """
    least = rows.groupBy(*group).agg(F.min("row_number").alias("row_number"), F.count(F.lit(1)).alias("row_count"))
    return rows.join(least.hint("shuffle_hash"), [*group, "row_number"])


def detect_profiles(rows: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """One profile per run: signature headers, or the first row's supplier name.

    ``chosen(run_id, spelling)`` overrides the detection for its runs; an
    unknown spelling leaves the profile null, and such a run is not processed.
    """
    signature = F.array(*[F.lit(k) for k in fv.WHOLESALE_SIGNATURE])
    def cell(key: str) -> Column:
        return c.nonblank(F.get(F.col("cells"), (F.array_position("keys", F.lit(key)) - F.lit(1)).cast("int")))

    supplier = F.coalesce(cell("supplier_name"), cell("supplier"))
    per_run = _with_least(rows, ["run_id"]).groupBy("run_id").agg(
        F.min_by(F.struct("headers", "keys", supplier.alias("supplier")), "row_number").alias("first"),
    ).select(
        "run_id", "first.headers", "first.keys",
        F.size(F.array_intersect("first.keys", signature)).alias("signature_headers"),
        F.coalesce(F.lower("first.supplier").contains(fv.WHOLESALE_SUPPLIER_WORD), F.lit(False))
        .alias("supplier_named"))
    detected = F.when((F.col("signature_headers") >= 2) | F.col("supplier_named"),
                      F.lit(fv.WHOLESALE)).otherwise(F.lit(fv.GENERIC))
    if chosen is None:
        return per_run.withColumn("profile", detected)
    choice = chosen.select("run_id", F.lit(True).alias("is_chosen"),
                           profile_of_spelling(F.col("spelling")).alias("choice"))
    return (per_run.join(choice, "run_id", "left")
            .withColumn("profile", F.when(F.col("is_chosen"), F.col("choice")).otherwise(detected))
            .drop("choice", "is_chosen"))


def group_key() -> Column:
    generic = F.coalesce(
        text("catalog_name"), text("product_group"), text("product_name"),
        F.concat(F.lit("sku_"), text("supplier_sku")),
        F.concat(F.lit("row_"), F.col("row_number").cast("string")))
    wholesale = F.coalesce(
        text("product_group"), text("catalog_name"), text("supplier_sku"),
        F.concat(F.lit("amra_catalog_"), F.col("row_number").cast("string")))
    return F.when(is_wholesale(), wholesale).otherwise(generic)


def keyed_rows(rows: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """Rows with their profile, field columns and product key."""
    return with_fields(rows, layouts(rows, chosen)).withColumn("group_key", group_key())


# --------------------------------------------------------------- products
def first_rows(keyed: DataFrame) -> DataFrame:
    """First row of each product, with its row count and place in the run."""
    carried = ["source_file", "row_number", "headers", "cells", "at", "texts", "count_columns", "unmapped_columns"]
    group = ["run_id", "profile", "group_key"]
    return (_with_least(keyed, group).groupBy(*group)
            .agg(F.min_by(F.struct(*carried), F.col("row_number")).alias("first"),
                 F.max("row_count").alias("row_count"))
            .select("run_id", "profile", "group_key", "row_count", "first.*")
            .withColumn("product_ord", F.col("row_number")))


def product_id() -> Column:
    return F.sha2(F.concat_ws("|", "run_id", "profile", "group_key"), 256)


def attribute(m: str, *names: str) -> Column:
    """Non-empty entry of an attribute map, ignoring case, first name first."""
    entries = F.map_entries(F.col(m))

    def find(name: str) -> Column:
        found = F.filter(entries, lambda e: F.lower(e["key"]) == name)
        return F.nullif(F.get(found, F.lit(0))["value"], F.lit(""))

    return F.coalesce(*[find(n) for n in names])


def _put(m: Column, entries: list[tuple[str, Column]]) -> Column:
    """Map with the non-null ``entries`` written over it."""
    present = F.filter(
        F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in entries]),
        lambda e: e["value"].isNotNull())
    new = F.map_from_entries(present)
    kept = F.map_filter(m, lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, new)


def _add_missing(m: Column, other: Column) -> Column:
    """Map with the entries of ``other`` that it lacks."""
    return F.map_concat(m, F.map_filter(other, lambda k, v: ~F.array_contains(F.map_keys(m), k)))


def with_product_fields(first: DataFrame) -> DataFrame:
    """Product columns from the first row of each product."""
    n = F.col("row_number").cast("string")
    names = first.select(
        "*", product_id().alias("product_id"),
        text("supplier_name").alias("v_supplier"),
        text("catalog_name").alias("v_catalog"),
        text("product_name").alias("v_name"),
        text("product_group").alias("v_group"),
        text("brand_name").alias("brand_name"),
        text("product_type").alias("v_type"),
        value("category_slug").alias("v_slug"),
        text("description").alias("v_description"),
        c.clean_float(text("single_piece_price")).alias("single_piece_price"),
        c.clean_float(text("wholesale_price")).alias("wholesale_price"),
        c.clean_float(text("full_catalogue_price")).alias("full_catalogue_price"),
        c.clean_float(text("supplier_price")).alias("v_price"),
        c.clean_float(text("gst_percent")).alias("gst_percent"),
        c.clean_int(text("moq")).alias("v_moq"),
        text("dispatch_location").alias("dispatch_location"),
        raw_unmapped().alias("v_unmapped"),
        text("size").alias("v_size"),
        *[value(a).alias(f"a_{a}") for a in fv.CATEGORY_ATTRIBUTES if a != "size"],
        value("size").alias("a_size"),
    )
    wholesale, generic = fv.PROFILE_DEFAULTS[fv.WHOLESALE], fv.PROFILE_DEFAULTS[fv.GENERIC]
    named = names.select(
        "*",
        F.coalesce("v_supplier", F.when(is_wholesale(), F.lit(wholesale["supplier_name"]))
                   .otherwise(F.lit(generic["supplier_name"]))).alias("supplier_name"),
        F.when(is_wholesale(), F.coalesce("v_catalog", F.concat(F.lit("Amra Catalog "), n)))
        .otherwise(F.coalesce("v_catalog", "v_name", F.concat(F.lit("Catalog-"), n))).alias("catalog_name"),
        F.coalesce("v_type", F.when(is_wholesale(), F.lit(wholesale["product_type"]))
                   .otherwise(F.lit(generic["product_type"]))).alias("product_type"),
        F.when(is_wholesale(), F.col("v_price"))
        .otherwise(F.coalesce("single_piece_price", "v_price", "wholesale_price")).alias("supplier_price"),
    )
    prices = [(p, c.amount_text(p)) for p in ("wholesale_price", "single_piece_price", "full_catalogue_price")]
    raw = F.when(is_wholesale(), F.col("v_unmapped")).otherwise(_put(F.col("v_unmapped"), prices))
    typed = named.select(
        "*",
        F.when(is_wholesale(), F.when(F.col("v_name") != F.col("catalog_name"), F.col("v_name")))
        .otherwise(F.coalesce("v_name", "catalog_name")).alias("given_name"),
        titles.product_title("catalog_name", "brand_name", c.clean_str("a_fabric"), c.clean_str("a_work"),
                             "product_type").alias("made_title"),
        F.when(is_wholesale(), F.coalesce("v_group", titles.product_group("catalog_name")))
        .otherwise(F.col("v_group")).alias("product_group"),
        F.when(is_wholesale(), F.coalesce(c.clean_str("v_slug"), F.lit(wholesale["category_slug"])))
        .otherwise(c.header_key(F.coalesce("v_slug", "product_type"))).alias("category_slug"),
        F.when(is_wholesale(), F.coalesce(F.nullif("v_moq", F.lit(0)), F.lit(wholesale["moq"])))
        .otherwise(F.col("v_moq")).alias("moq"),
        raw.alias("raw_attributes"),
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    copied = F.map_filter(F.col("raw_attributes"), lambda k, v: k != fv.ATTRIBUTE_NOT_COPIED)
    attributes = F.when(
        is_wholesale(),
        _add_missing(_put(empty, [(a, F.col(f"a_{a}")) for a in fv.CATEGORY_ATTRIBUTES]), copied),
    ).otherwise(_put(copied, [("size", F.col("v_size"))]))
    full = typed.select("*", attributes.alias("attributes"),
                        F.coalesce("given_name", "made_title").alias("product_name"))
    made = titles.product_description(
        "v_description", "brand_name", "catalog_name", attribute("attributes", "fabric", "saree_fabric"),
        attribute("attributes", "blouse_fabric"), attribute("attributes", "work"),
        attribute("attributes", "occasion"), "product_type", "supplier_price")
    return full.withColumn("description", F.when(is_wholesale(), F.coalesce("v_description", made))
                           .otherwise(F.col("v_description")))


PRODUCT_COLUMNS = ["run_id", "profile", "group_key", "product_id", "product_ord", "row_count", "source_file",
                   *PRODUCT_FIELDS, "attributes", "raw_attributes"]


def build_products(keyed: DataFrame) -> DataFrame:
    return with_product_fields(first_rows(keyed)).select(*PRODUCT_COLUMNS)


# --------------------------------------------------------------- variants
def expand(df: DataFrame, count: Column, out: str) -> DataFrame:
    """``count`` copies of each row, numbered from 1.

    The numbers come in two steps so that no array grows beyond a block,
    whatever number a supplier typed.
    """
    last = F.floor((count - F.lit(1)) / F.lit(EXPAND_BLOCK)).cast("int")
    blocks = df.withColumn("_count", count).withColumn("_block", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("_block") * F.lit(EXPAND_BLOCK) + F.lit(1)
    end = F.least(F.col("_count"), start + F.lit(EXPAND_BLOCK - 1))
    return blocks.withColumn(out, F.explode(F.sequence(start, end))).drop("_count", "_block")


def is_placeholder() -> Column:
    """One-row catalogue that declares a number of designs instead of listing them."""
    count = F.col("declared.n")
    generic = F.col("r_code").isNull() & (
        (count > 1) | ((count == 1) & c.clean_str(F.col("r_name_raw")).isNull()))
    wholesale = (count > 1) | (F.col("r_name_raw").isNull() & F.col("r_sku_raw").isNull())
    return F.coalesce(
        (F.col("row_count") == 1) & F.when(is_wholesale(), wholesale).otherwise(generic), F.lit(False))


def rows_with_variant_fields(keyed: DataFrame) -> DataFrame:
    """Variant-level values of each row and its place in its product."""
    fields = keyed.select(
        "run_id", "profile", "group_key", "row_number",
        text("supplier_sku").alias("r_sku"), value("supplier_sku").alias("r_sku_raw"),
        text("variant_code").alias("r_code"),
        value("variant_name").alias("r_name_raw"),
        text("color").alias("r_color"),
        text("size").alias("r_size"),
        F.when(is_wholesale(), value("variant_cost")).otherwise(value("supplier_price")).alias("r_cost_raw"),
        c.clean_int(text("stock_quantity")).alias("r_stock"),
        c.clean_float(text("selling_price")).alias("r_selling"),
        text("image_sku").alias("r_image_sku"),
        text("primary_image_url").alias("r_url"),
        F.array_compact(F.array(*[text(f"gallery_{i}") for i in range(1, 5)])).alias("r_gallery"),
        declared().alias("declared"),
        raw_unmapped().alias("r_unmapped"),
    )
    return rank_by_number(fields, ["run_id", "profile", "group_key"], "row_number", "row_ord")


VARIANT_COLUMNS = [
    "run_id", "profile", "product_id", "product_ord", "variant_ord", "variant_code", "supplier_sku",
    "variant_name", "color", "size", "supplier_cost", "selling_price", "stock_quantity", "image_sku",
    "primary_image_url", "gallery_image_urls", "publish", "review_status", "attributes", "raw_attributes",
    "is_placeholder", "row_number",
]


def build_variants(keyed: DataFrame, products: DataFrame) -> DataFrame:
    """Variants of both profiles, with placeholders expanded."""
    parent = products.select(
        "run_id", "profile", "group_key", "product_id", "product_ord", "row_count", "product_group",
        "catalog_name", "supplier_price", attribute("attributes", "size").alias("parent_size"))
    first_use = (keyed.where(is_wholesale())
                 .select("run_id", "profile", "group_key", "row_number",
                         F.lower(text("image_sku")).alias("image_key"))
                 .where(F.col("image_key").isNotNull())
                 .groupBy("run_id", "profile", "group_key", "image_key")
                 .agg(F.min("row_number").alias("first_use")))
    rows = (rows_with_variant_fields(keyed)
            .join(parent, ["run_id", "profile", "group_key"])
            .withColumn("image_key", F.lower("r_image_sku"))
            .join(first_use, ["run_id", "profile", "group_key", "image_key"], "left")
            .withColumn("is_placeholder", is_placeholder()))
    declared = F.when(F.col("declared.n") > 0, F.col("declared.n")).otherwise(F.lit(1))
    copies = expand(rows, F.when(F.col("is_placeholder"), declared).otherwise(F.lit(1)), "copy_no")
    ordinal = F.when(F.col("is_placeholder"), F.col("copy_no")).otherwise(F.col("row_ord"))
    numbered = copies.withColumn("variant_ord", ordinal.cast("int"))
    v_no = F.concat(F.lit("-V"), c.two_digits("variant_ord"))
    placeholder = F.col("is_placeholder")

    generic_prefix = F.when(placeholder, F.coalesce("product_group", "r_sku", "catalog_name")).otherwise(
        F.coalesce("product_group", "catalog_name"))
    empty_prefix = F.when(placeholder, F.concat(F.lit("PROD-"), c.two_digits("variant_ord"))).otherwise(
        F.concat(F.lit("SKU-"), F.col("row_number").cast("string")))
    prefixed = F.concat(F.coalesce(F.nullif(c.code_prefix(generic_prefix), F.lit("")), empty_prefix), v_no)
    generic_code = F.when(placeholder, prefixed).otherwise(
        F.coalesce("r_code", F.concat(F.col("r_sku"), v_no), prefixed))
    slug = F.trim(F.regexp_replace(F.upper("catalog_name"), c.unicode_re(r"[^\w]+"), "-"), F.lit("-"))
    wholesale_code = (
        F.when(placeholder, F.concat(slug, v_no))
        .when(F.col("r_image_sku").isNull(), F.concat(F.col("product_group"), v_no))
        .when(F.col("first_use") == F.col("row_number"), F.col("r_image_sku"))
        .otherwise(F.concat(F.col("r_image_sku"), F.lit("-"), F.col("variant_ord").cast("string"))))
    clean_name = c.clean_str(F.col("r_name_raw"))
    design = F.concat(F.lit("Design "), c.two_digits("variant_ord"))
    name = (F.when(placeholder, design)
            .when(is_wholesale(), F.coalesce(clean_name, F.concat(F.lit("Design "), F.col("variant_ord").cast("string"))))
            .otherwise(F.coalesce(clean_name, F.col("r_color"),
                                  F.concat(F.lit("Option "), F.col("variant_ord").cast("string")))))
    color = F.when(placeholder, F.lit(None)).when(is_wholesale(), clean_name).otherwise(F.col("r_color"))
    cost = F.when(placeholder | F.col("r_cost_raw").isNull(), F.col("supplier_price")).otherwise(
        c.clean_float(F.col("r_cost_raw")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    only = ~placeholder & is_wholesale()
    out = numbered.select(
        "run_id", "profile", "product_id", "product_ord", "variant_ord",
        F.when(is_wholesale(), wholesale_code).otherwise(generic_code).alias("variant_code"),
        F.col("r_sku").alias("supplier_sku"), name.alias("variant_name"), color.alias("color"),
        F.when(placeholder, F.col("parent_size")).when(~is_wholesale(), F.col("r_size")).alias("size"),
        cost.alias("supplier_cost"),
        F.when(~placeholder, F.col("r_selling")).alias("selling_price"),
        F.when(~placeholder & ~is_wholesale(), F.col("r_stock")).alias("stock_quantity"),
        F.when(only, F.col("r_image_sku")).alias("image_sku"),
        F.when(only, F.col("r_url")).alias("primary_image_url"),
        F.when(only, F.col("r_gallery")).otherwise(F.array().cast("array<string>")).alias("gallery_image_urls"),
        F.lit(False).alias("publish"), F.lit("PENDING").alias("review_status"), empty.alias("attributes"),
        F.when(placeholder & is_wholesale(), empty).otherwise(F.col("r_unmapped")).alias("v_unmapped"),
        "is_placeholder", "row_number")
    return (out.withColumn("raw_attributes", _put(F.col("v_unmapped"), [("original_color", F.col("color"))]))
            .select(*VARIANT_COLUMNS))


def normalise(rows: DataFrame, chosen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Products and variants of all runs.

    The keyed rows feed five branches (first rows, places, first uses, rows,
    provenance) and cleaning their cells is the dear part, so they are written
    once; so are the products, which the variants and every output join.
    """
    keyed = written(keyed_rows(rows, chosen), "keyed")
    products = written(build_products(keyed), "products")
    return products, build_variants(keyed, products)
