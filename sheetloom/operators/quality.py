"""Data-quality rules over product and variant tables, all runs at once.

Row rules are evaluated in one pass: an array of rule hits per row, exploded.
Rules over groups (duplicates, shared SKUs, empty products) use aggregates with
map-side combine and joins on unique keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.functions import clean as c
from sheetloom.operators.ranking import rank_by_number

ISSUE = ("struct<severity:string,code:string,message:string,field:string,supplier_sku:string,"
         "variant_code:string,source_row:int>")
ISSUE_COLUMNS = ["run_id", "product_ord", "variant_ord", "severity", "code", "message", "field",
                 "supplier_sku", "variant_code", "source_row"]


def _say(*parts: Column | str) -> Column:
    """Message text; a missing value reads ``None``."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def _issue(when: Column, severity: str, code: str, message: Column, field: str, sku: Column | None = None,
           variant: Column | None = None, row: Column | None = None) -> Column:
    none = F.lit(None)
    return F.when(when, F.struct(
        F.lit(severity).alias("severity"), F.lit(code).alias("code"), message.alias("message"),
        F.lit(field).alias("field"),
        (none if sku is None else sku).cast("string").alias("supplier_sku"),
        (none if variant is None else variant).cast("string").alias("variant_code"),
        (none if row is None else row).cast("int").alias("source_row")))


def _emit(df: DataFrame, rules: list[Column]) -> DataFrame:
    hits = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return df.select("run_id", "product_ord", "variant_ord", F.explode(hits).alias("i")).select(
        "run_id", "product_ord", "variant_ord", "i.*")


def missing_products(runs: DataFrame, products: DataFrame) -> DataFrame:
    """Runs that gave no product at all."""
    empty = runs.join(products.select("run_id"), "run_id", "left_anti")
    rule = _issue(F.lit(True), "ERROR", "NO_PRODUCTS", F.lit("No processable products found in dataset"), "products")
    return _emit(empty.withColumns({"product_ord": F.lit(None).cast("bigint"), "variant_ord": F.lit(None).cast("int")}),
                 [rule])


def product_issues(products: DataFrame) -> DataFrame:
    """Rules on single products; ``product_no`` is the product's place in its run."""
    numbered = rank_by_number(products, ["run_id"], "product_ord", "product_no")
    name, no = F.col("catalog_name"), F.col("product_no")
    slug = c.pystrip("category_slug")
    return _emit(numbered.withColumn("variant_ord", F.lit(None).cast("int")), [
        _issue(c.is_blank("product_name"), "ERROR", "MISSING_PRODUCT_NAME",
               _say("Product at index ", no, " is missing a product_name"), "product_name", row=no),
        _issue(c.is_blank("catalog_name"), "ERROR", "MISSING_CATALOG_NAME",
               _say("Product at index ", no, " is missing a catalog_name"), "catalog_name", row=no),
        _issue(c.is_blank("supplier_name"), "ERROR", "MISSING_SUPPLIER_NAME",
               _say("Product '", name, "' is missing a supplier_name"), "supplier_name"),
        _issue(F.col("supplier_price") < 0, "ERROR", "INVALID_SUPPLIER_PRICE",
               _say("Product '", name, "' has negative supplier_price (", c.amount_text("supplier_price"), ")"),
               "supplier_price"),
        _issue((F.col("gst_percent") < 0) | (F.col("gst_percent") > 100), "ERROR", "INVALID_GST_PERCENT",
               _say("Product '", name, "' has invalid GST percent (", c.amount_text("gst_percent"), "%)"),
               "gst_percent"),
        _issue((F.col("category_slug") != "") & (slug.rlike(c.unicode_re(r"[^\w\-]")) | (slug != F.lower(slug))),
               "ERROR", "INVALID_CATEGORY_SLUG",
               _say("Category slug '", F.col("category_slug"), "' contains invalid uppercase or special characters"),
               "category_slug"),
    ])


def products_without_variants(products: DataFrame, variants: DataFrame) -> DataFrame:
    empty = products.join(variants.select("run_id", "product_ord"), ["run_id", "product_ord"], "left_anti")
    return _emit(empty.withColumn("variant_ord", F.lit(None).cast("int")), [
        _issue(F.lit(True), "ERROR", "NO_VARIANTS",
               _say("Product '", F.col("catalog_name"), "' has no child variants"), "variants")])


def shared_skus(variants: DataFrame) -> DataFrame:
    """Supplier SKUs used by several variants of one product, with their number."""
    return (variants.where(F.col("supplier_sku") != "")
            .groupBy("run_id", "product_ord", "supplier_sku").agg(F.count(F.lit(1)).alias("variant_count"))
            .where(F.col("variant_count") > 1))


def shared_sku_issues(products: DataFrame, variants: DataFrame) -> DataFrame:
    """One note per product; the SKUs themselves are in :func:`shared_skus`."""
    per_product = shared_skus(variants).groupBy("run_id", "product_ord").agg(
        F.array_join(F.sort_array(F.collect_list("supplier_sku")), ", ").alias("skus"))
    named = per_product.join(products.select("run_id", "product_ord", "catalog_name"), ["run_id", "product_ord"])
    return _emit(named.withColumn("variant_ord", F.lit(None).cast("int")), [
        _issue(F.lit(True), "INFO", "SHARED_SUPPLIER_SKU",
               _say("Product '", F.col("catalog_name"), "' has multiple variants sharing supplier SKU(s): ",
                    F.col("skus")), "supplier_sku")])


def with_duplicate_flag(variants: DataFrame) -> DataFrame:
    """Mark every use of a variant code after its first use in the run."""
    key = F.lower(c.pystrip("variant_code"))
    first = (variants.where(~c.is_blank("variant_code")).groupBy("run_id", key.alias("code_key"))
             .agg(F.min(F.struct("product_ord", "variant_ord")).alias("first_use")))
    return (variants.withColumn("code_key", key).join(first, ["run_id", "code_key"], "left")
            .withColumn("is_duplicate", F.coalesce(
                F.struct("product_ord", "variant_ord") > F.col("first_use"), F.lit(False)))
            .drop("code_key", "first_use"))


def variant_issues(products: DataFrame, variants: DataFrame, require_hosted: bool = False) -> DataFrame:
    """Rules on single variants, the duplicate-code rule included."""
    named = with_duplicate_flag(variants).join(
        products.select("run_id", "product_ord", "catalog_name"), ["run_id", "product_ord"])
    code = F.coalesce(c.pystrip("variant_code"), F.lit(""))
    sku = F.coalesce(c.pystrip("supplier_sku"), F.lit(""))
    raw_code, raw_sku = F.col("variant_code"), F.col("supplier_sku")

    def rule(when: Column, severity: str, name: str, tail: Column, field: str, own_sku: bool = True) -> Column:
        return _issue(when, severity, name, F.concat(F.lit("Variant '"), code, F.lit("'"), tail), field,
                      sku if own_sku else None, code)

    stock, cost, price = F.col("stock_quantity"), F.col("supplier_cost"), F.col("selling_price")
    gallery, primary = F.col("gallery_image_urls"), F.col("primary_image_url")
    repeated = F.filter(gallery, lambda u, i: F.array_contains(F.slice(gallery, F.lit(1), i), u))
    fixed = [
        _issue(code == "", "ERROR", "MISSING_VARIANT_CODE",
               _say("Variant #", F.col("variant_ord"), " in product '", F.col("catalog_name"),
                    "' is missing variant_code"), "variant_code", sku),
        _issue((code != "") & F.col("is_duplicate"), "ERROR", "DUPLICATE_VARIANT_CODE",
               _say("Variant code '", code, "' is duplicated"), "variant_code", sku, code),
        rule(c.is_blank("variant_name"), "ERROR", "MISSING_VARIANT_NAME", F.lit(" is missing variant_name"), "variant_name"),
        rule(sku == "", "WARNING", "MISSING_SUPPLIER_SKU", F.lit(" has no supplier_sku defined"), "supplier_sku", False),
        rule(stock < 0, "ERROR", "INVALID_STOCK_QUANTITY", _say(" has negative stock quantity (", stock, ")"), "stock_quantity"),
        rule(stock.isNull(), "WARNING", "MISSING_STOCK_QUANTITY",
             F.lit(" has no stock quantity defined (defaults to 0)"), "stock_quantity"),
        rule(cost < 0, "ERROR", "INVALID_SUPPLIER_COST",
             _say(" has negative supplier_cost (", c.amount_text(cost), ")"), "supplier_cost"),
        rule(price < 0, "ERROR", "INVALID_SELLING_PRICE",
             _say(" has negative selling_price (", c.amount_text(price), ")"), "selling_price"),
        rule(price.isNull(), "WARNING", "MISSING_SELLING_PRICE",
             F.lit(" is missing selling_price (requires commercial review)"), "selling_price"),
        rule(F.col("publish") & price.isNull(), "WARNING", "PUBLISHED_WITHOUT_SELLING_PRICE",
             F.lit(" is marked publish=True but has no selling_price"), "publish"),
        _issue(F.lit(require_hosted) & (F.coalesce(primary, F.lit("")) == ""), "WARNING", "MISSING_PRIMARY_BLOB_URL",
               _say("Variant '", raw_code, "' has no uploaded primary_image_url"), "primary_image_url", raw_sku, raw_code),
        _issue((primary != "") & F.array_contains(gallery, primary), "ERROR", "PRIMARY_IMAGE_IN_GALLERY",
               _say("Variant '", raw_code, "' primary_image_url is duplicated in gallery_image_urls"),
               "gallery_image_urls", raw_sku, raw_code),
    ]
    repeats = F.transform(repeated, lambda u: F.struct(
        F.lit("ERROR").alias("severity"), F.lit("DUPLICATE_GALLERY_IMAGE").alias("code"),
        _say("Variant '", raw_code, "' has duplicate gallery image URL: ", u).alias("message"),
        F.lit("gallery_image_urls").alias("field"), raw_sku.alias("supplier_sku"), raw_code.alias("variant_code"),
        F.lit(None).cast("int").alias("source_row")))
    hits = F.concat(F.filter(F.array(*fixed), lambda r: r.isNotNull()), repeats)
    return named.select("run_id", "product_ord", "variant_ord", F.explode(hits).alias("i")).select(
        "run_id", "product_ord", "variant_ord", "i.*")


def all_issues(products: DataFrame, variants: DataFrame, runs: DataFrame | None = None,
               require_hosted: bool = False) -> DataFrame:
    """Every finding of every run."""
    parts = [product_issues(products), products_without_variants(products, variants),
             shared_sku_issues(products, variants), variant_issues(products, variants, require_hosted)]
    if runs is not None:
        parts.insert(0, missing_products(runs, products))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*ISSUE_COLUMNS)


def validation_summary(runs: DataFrame, products: DataFrame, variants: DataFrame, issues: DataFrame) -> DataFrame:
    """One report row per run."""
    def number(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("run_id").agg(F.count(F.lit(1)).alias(name))

    by_severity = issues.groupBy("run_id").agg(*[
        F.count_if(F.col("severity") == s).alias(n)
        for s, n in (("ERROR", "error_count"), ("WARNING", "warning_count"), ("INFO", "info_count"))])
    counts = ["total_products", "total_variants", "error_count", "warning_count", "info_count"]
    return (runs.select("run_id")
            .join(number(products, "total_products"), "run_id", "left")
            .join(number(variants, "total_variants"), "run_id", "left")
            .join(by_severity, "run_id", "left")
            .select("run_id", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in counts])
            .withColumn("is_valid", F.col("error_count") == 0))


def summary_long(summary: DataFrame) -> DataFrame:
    """Report as (metric, value) lines."""
    lines = [("Overall Status", F.when(F.col("is_valid"), F.lit("PASSED")).otherwise(F.lit("FAILED")))] + [
        (label, F.col(name).cast("string")) for label, name in (
            ("Total Products", "total_products"), ("Total Variants", "total_variants"),
            ("Validation Errors", "error_count"), ("Validation Warnings", "warning_count"),
            ("Validation Infos", "info_count"))]
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in lines])
    return summary.select("run_id", F.inline(pairs))


def model_rejects(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Rows that break a constraint of the data model; their run counts as failed."""
    def broken(df: DataFrame, ord_col: Column, rules: list[tuple[Column, str]]) -> DataFrame:
        hits = F.filter(F.array(*[F.when(w, F.lit(n)) for w, n in rules]), lambda x: x.isNotNull())
        return df.select("run_id", "product_ord", ord_col.cast("int").alias("variant_ord"), F.explode(hits).alias("reason"))

    below = lambda name: F.col(name) < 0
    product_rules = [(c.is_blank(n), f"blank {n}") for n in ("supplier_name", "catalog_name", "product_name")] + [
        (below("supplier_price"), "negative supplier_price"),
        ((F.col("gst_percent") < 0) | (F.col("gst_percent") > 100), "gst_percent out of range"),
        (F.col("moq") < 1, "moq below 1")]
    variant_rules = [(c.is_blank(n), f"blank {n}") for n in ("variant_code", "variant_name")] + [
        (below(n), f"negative {n}") for n in ("supplier_cost", "selling_price", "stock_quantity")]
    repeated = (variants.where(~c.is_blank("variant_code"))
                .groupBy("run_id", "product_ord", F.lower(c.pystrip("variant_code")).alias("k"))
                .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                .select("run_id", "product_ord", F.lit(None).cast("int").alias("variant_ord"),
                        F.concat(F.lit("repeated variant_code "), F.col("k")).alias("reason")))
    return (broken(products, F.lit(None), product_rules)
            .unionByName(broken(variants, F.col("variant_ord"), variant_rules)).unionByName(repeated))
