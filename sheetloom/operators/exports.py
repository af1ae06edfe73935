"""Flat and nested output tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.functions import titles
from sheetloom.operators.normalize import attribute
from sheetloom.operators.ranking import rank_by_number

VARIANTS_PER_DOCUMENT = 500
IMAGES_PER_DOCUMENT = 500
GALLERY_SLOTS = 4
PRODUCT = ["run_id", "product_ord"]
VARIANT = ["run_id", "product_ord", "variant_ord"]


def clean_gallery() -> Column:
    """Gallery without empty entries and without the primary URL."""
    return F.filter("gallery_image_urls", lambda u: (u != "") & ~u.eqNullSafe(F.col("primary_image_url")))


def formula_safe(text: c.C) -> Column:
    """Text that a spreadsheet would run as a formula gets a leading apostrophe."""
    value = c.col(text)
    return F.when(value.rlike("^[" + "".join("\\" + x for x in fv.FORMULA_PREFIXES) + "]"), F.concat(F.lit("'"), value)).otherwise(value)


def safe_table(df: DataFrame) -> DataFrame:
    """Table for a text sink: nested values as JSON, texts formula-safe."""
    def cell(field) -> Column:
        kind = field.dataType.typeName()
        value = F.to_json(field.name) if kind in ("map", "array", "struct") else F.col(f"`{field.name}`")
        return (formula_safe(value) if kind == "string" else value).alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def join_parent(variants: DataFrame, products: DataFrame, columns: list[str | Column]) -> DataFrame:
    return variants.join(products.select(*PRODUCT, *columns), PRODUCT)


def write_trace(rows: DataFrame, path: str) -> None:
    """Extracted rows as tab-separated files per run, white space kept."""
    (rows.write.partitionBy("run_id").option("sep", "\t").option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_canonical_json(documents: DataFrame, path: str) -> None:
    """Nested documents as JSON lines, one folder per run."""
    documents.withColumn("run", F.col("run_id")).write.partitionBy("run").json(path)


def write_csv(table: DataFrame, path: str) -> None:
    """Flat table as CSV, texts safe for spreadsheets, white space kept and quotes doubled."""
    (safe_table(table).write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))


# ------------------------------------------------------------------ nested
CANONICAL_PRODUCT = ["product_id", "supplier_name", "catalog_name", "product_name", "product_group", "brand_name", "product_type",
                     "category_slug", "description", "supplier_price", "gst_percent", "moq", "dispatch_location", "attributes"]
_IMAGE_URLS = ("blob_url", "source_url")


def canonical_documents(products: DataFrame, variants: DataFrame, images: DataFrame) -> DataFrame:
    """Product documents with their variants and images nested.

    A product with very many variants, or a variant with very many images, is
    written as several parts (``variant_part``, ``image_part``) of bounded size;
    the parts together hold everything, and their reader puts them together.
    A product without variants has one part without any, and one without a
    least order has 1. Images may have a ``blob_url`` and a ``source_url``.
    """
    fields = {n: F.col(n) for n in CANONICAL_PRODUCT if n in products.columns}
    if "moq" in fields:
        fields["moq"] = F.coalesce(F.nullif("moq", F.lit(0)), F.lit(1))
    products = products.select(*PRODUCT, *[v.alias(n) for n, v in fields.items()])
    images = images.withColumns({n: F.lit(None).cast("string") for n in _IMAGE_URLS if n not in images.columns})
    pages = (images.groupBy(*VARIANT, F.floor(F.col("sort_index") / IMAGES_PER_DOCUMENT).cast("int").alias("image_part"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 "sort_index", "image_id", "original_filename", "is_primary", *_IMAGE_URLS))).alias("images")))
    body = F.struct(
        "variant_ord", "variant_code", "supplier_sku", "variant_name", "image_sku", "color", "size", "supplier_cost",
        "selling_price", "stock_quantity", "publish", "review_status", "primary_image_url",
        clean_gallery().alias("gallery_image_urls"), "images", "attributes")
    none = F.lit(0)
    return (products.join(_parts(variants, pages, body), PRODUCT, "left")
            .withColumns({"variant_part": F.coalesce("variant_part", none), "image_part": F.coalesce("image_part", none)}))


def canonical_summary(products: DataFrame, variants: DataFrame, validation: DataFrame) -> DataFrame:
    """Head of a run's documents: their version, the totals, and what the quality rules found.

    ``validation`` is :func:`quality.validation_summary`; its runs are those of the result.
    """
    def number(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("run_id").agg(F.count(F.lit(1)).alias(name))

    found = F.struct(*[x for x in validation.columns if x != "run_id"]).alias("validation_summary")
    return (validation.select("run_id", found).join(number(products, "total_products"), "run_id", "left")
            .join(number(variants, "total_variants"), "run_id", "left")
            .select("run_id", F.lit("1.0").alias("export_version"), F.coalesce("total_products", F.lit(0)).alias("total_products"),
                    F.coalesce("total_variants", F.lit(0)).alias("total_variants"), "validation_summary"))


def _parts(variants: DataFrame, pages: DataFrame, body: Column) -> DataFrame:
    return (variants.join(pages, VARIANT, "left")
            .withColumn("image_part", F.coalesce("image_part", F.lit(0)))
            .withColumn("variant_part", F.floor((F.col("variant_ord") - 1) / VARIANTS_PER_DOCUMENT).cast("int"))
            .groupBy(*PRODUCT, "variant_part", "image_part")
            .agg(F.array_sort(F.collect_list(body), lambda a, b: a["variant_ord"] - b["variant_ord"]).alias("variants")))


# -------------------------------------------------------------------- flat
def _slots(gallery: Column | str, count: int, name: str) -> list[Column]:
    return [F.get(c.col(gallery), F.lit(i)).alias(name.format(i + 1)) for i in range(count)]


def canonical_flat(products: DataFrame, variants: DataFrame) -> DataFrame:
    """23 leading columns, a slot for every gallery image, the whole gallery, and the merged attributes as one map.

    There are as many slots as the longest gallery has images, and four at least; they are found in ``variants`` when
    the table is planned. An attribute under the name of a column that its row fills is left to that column.
    """
    parent = ["supplier_name", "catalog_name", "product_group", "product_name", "product_type", "category_slug",
              "brand_name", "description", "supplier_price", "gst_percent", F.col("attributes").alias("p_attributes")]
    slots = max(GALLERY_SLOTS, variants.agg(F.max(F.size(clean_gallery()))).first()[0] or 0)
    joined = join_parent(variants, products, parent).withColumn("gallery", clean_gallery())
    front = [*fv.FLAT_COLUMNS, F.col("primary_image_url").alias("image_url")]
    names = F.array(*[F.lit(x) for x in front if isinstance(x, str)], F.lit("image_url"))
    none = F.create_map().cast("map<string,string>")

    def free(k: Column) -> Column:
        slot = F.regexp_extract(k, "^image([1-9][0-9]*)_url$", 1).try_cast("int")
        return ~F.array_contains(names, k) & ~F.coalesce(slot <= F.size("gallery"), F.lit(False))

    own = F.map_filter(F.coalesce("p_attributes", none), lambda k, v: free(k))
    extra = F.map_filter(F.coalesce("attributes", none), lambda k, v: free(k) & ~F.map_contains_key("p_own", k))
    return (joined.withColumn("p_own", own).select(
        *VARIANT, *front, *_slots("gallery", slots, "image{}_url"), F.col("gallery").alias("gallery_image_urls"),
        F.map_concat("p_own", extra).alias("attributes")))


def first_hosted(uploads: DataFrame) -> DataFrame:
    """The first hosted image of each variant."""
    return uploads.where(c.is_remote_url("blob_url")).groupBy("run_id", "variant_code").agg(
        F.min_by("blob_url", "sort_index").alias("first_hosted"))


def hosted_tops(uploads: DataFrame, heroes: DataFrame, keep: int = GALLERY_SLOTS) -> DataFrame:
    """First hosted images of a variant by place, other than its hero; as many as the output has columns for.

    ``heroes(run_id, variant_code, hero_url)``: variants that share a code may have different ones.
    """
    own = ["run_id", "variant_code", "hero_url"]
    done = uploads.where(c.is_remote_url("blob_url")).join(heroes, own[:2]).where(F.col("blob_url") != F.col("hero_url"))
    ranked = rank_by_number(done, own, "sort_index", "place").where(F.col("place") <= keep)
    return ranked.groupBy(*own).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "blob_url"))), lambda x: x["blob_url"]).alias("hosted"))


def with_hero(variants: DataFrame, uploads: DataFrame | None = None) -> DataFrame:
    """Hero URL and gallery of the import table: remote URLs only, hosted images as fallback."""
    none = F.array().cast("array<string>")
    own = F.filter("gallery_image_urls", lambda u: c.is_remote_url(u))
    code = ["run_id", "variant_code"]
    if uploads is None:
        joined = variants.withColumn("first_hosted", F.lit(None).cast("string"))
    else:
        joined = variants.join(first_hosted(uploads), code, "left")
    hero = F.when(c.is_remote_url("primary_image_url"), F.col("primary_image_url")).otherwise(F.coalesce("first_hosted", F.lit("")))
    picked = joined.withColumns({"hero_url": hero, "own_gallery": own}).drop("first_hosted")
    if uploads is None:
        picked = picked.withColumn("hosted", none)
    else:
        tops = hosted_tops(uploads, picked.select(*code, "hero_url").distinct())
        picked = picked.join(tops, [*code, "hero_url"], "left")
    return (picked.withColumn("gallery", F.when(F.size("own_gallery") > 0, F.col("own_gallery")).otherwise(F.coalesce("hosted", none)))
            .drop("own_gallery", "hosted"))


def product_numbers(products: DataFrame) -> DataFrame:
    """Running number of each product in its run."""
    return rank_by_number(products, ["run_id"], "product_ord", "No")


def positional_images(images: DataFrame) -> DataFrame:
    """The i-th image of a run in natural order stands in for the i-th variant."""
    from sheetloom.operators.images import natural_order, stem

    return natural_order(images).select(
        "run_id", F.col("natural_ord").alias("variant_ord"), stem(F.col("original_filename")).alias("stand_in_sku"))


SALTS = 16


def with_stand_ins(variants: DataFrame, images: DataFrame) -> DataFrame:
    """Variants with the stem of the image that stands in for them.

    All first variants of a run meet one image; salts spread them.
    """
    spread = positional_images(images).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = variants.withColumn("salt", F.pmod(F.xxhash64("product_ord"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["run_id", "variant_ord", "salt"], "left").drop("salt")


def import_table(products: DataFrame, variants: DataFrame, images: DataFrame | None = None,
                 uploads: DataFrame | None = None) -> DataFrame:
    """The 26-column import table."""
    blank = F.lit("")
    fabric = F.coalesce(attribute("attributes", "fabric"), attribute("attributes", "saree_fabric"), blank)
    shown = product_numbers(products).select(
        *PRODUCT, "No", "supplier_name", "catalog_name", "product_type", "category_slug", "brand_name",
        "product_name", "supplier_price", "gst_percent", F.col("description").alias("own_description"),
        F.coalesce("product_group", titles.product_group("catalog_name")).alias("product_group"),
        titles.fallback_sku("catalog_name").alias("stand_in_supplier_sku"), fabric.alias("fabric"),
        *[F.coalesce(attribute("attributes", a), blank).alias(a if a != "size" else "parent_size")
          for a in ("blouse_fabric", "work", "occasion", "size")])
    titled = shown.select("*", F.when(
        c.pystrip("product_name") != c.pystrip("catalog_name"), F.col("product_name")).otherwise(titles.product_title(
            "catalog_name", "brand_name", "fabric", "work", "product_type")).alias("shown_name"),
        F.coalesce(F.nullif("own_description", blank), titles.product_description(
            "own_description", "brand_name", "catalog_name", "fabric", "blouse_fabric", "work", "occasion",
            "product_type", "supplier_price")).alias("description"))
    rows = with_hero(variants, uploads).join(titled.drop("product_name"), PRODUCT)
    if images is not None:
        rows = with_stand_ins(rows, images)
    else:
        rows = rows.withColumn("stand_in_sku", F.lit(None).cast("string"))
    name = F.when(F.col("color") != "", F.col("color")).when(
        ~F.lower("variant_name").startswith("design "), F.col("variant_name")).otherwise(blank)
    out = {
        "product_name": F.col("shown_name"), "varient_name": name,
        "supplier_sku": F.coalesce(F.nullif("supplier_sku", blank), "stand_in_supplier_sku", blank),
        "category_slug": F.coalesce(F.nullif("category_slug", blank), F.lit("sarees")),
        "brand_name": F.coalesce("brand_name", blank),
        "size": F.coalesce(F.nullif("size", blank), "parent_size", blank),
        "supplier_price": F.coalesce("supplier_price", "supplier_cost"), "gst_percent": c.gst_label("gst_percent"),
        "selling_price": F.coalesce(c.amount_text("selling_price"), blank),
        "image-sku": F.coalesce(F.nullif("image_sku", blank), "stand_in_sku", blank), "image_url": F.col("hero_url"),
        "publish": F.lit(False),
        **{f"image{i + 1}_url": F.coalesce(F.get("gallery", F.lit(i)), blank) for i in range(GALLERY_SLOTS)}}
    return rows.select("run_id", *VARIANT[1:], *[out.get(n, F.col(f"`{n}`")).alias(n) for n in fv.IMPORT_COLUMNS])


_STORE_ATTRIBUTES = ("fabric", "blouse_fabric", "work", "occasion", "size")


def first_upload(uploads: DataFrame) -> DataFrame:
    """The first uploaded image of each variant that has any."""
    return uploads.where(F.col("blob_url") != "").groupBy("run_id", "variant_code").agg(
        F.min(F.struct("sort_index", "blob_url"))["blob_url"].alias("first_upload"))


def store_import(products: DataFrame, variants: DataFrame, uploads: DataFrame | None = None, slots: int = 5) -> DataFrame:
    """Store import: only hosted URLs, never published.

    A variant without a hosted primary image shows its first uploaded one;
    attributes that its product lacks are the variant's own.
    """
    blank = F.lit("")
    parent = ["supplier_name", "catalog_name", "product_group", "product_name", "category_slug", "brand_name",
              "description", "supplier_price", "gst_percent",
              *[attribute("attributes", a).alias(f"parent_{a}") for a in _STORE_ATTRIBUTES]]
    rows = join_parent(variants, products, parent)
    if uploads is None:
        rows = rows.withColumn("first_upload", blank)
    else:
        rows = rows.join(first_upload(uploads), ["run_id", "variant_code"], "left")
    rows = rows.withColumn("main_image_url", F.when(c.is_hosted_url("primary_image_url"), F.col("primary_image_url"))
                           .otherwise(F.coalesce("first_upload", blank)))
    rows = rows.withColumn("gallery", F.filter(
        "gallery_image_urls", lambda u: c.is_hosted_url(u) & (u != F.col("main_image_url"))))
    text = {x: F.coalesce(x, blank) for x in ("product_group", "supplier_sku", "image_sku", "brand_name", "description")}
    text |= {a: F.coalesce(f"parent_{a}", attribute("attributes", a), blank) for a in _STORE_ATTRIBUTES[:-1]}
    text["category_slug"] = F.coalesce(F.nullif("category_slug", blank), F.lit("sarees"))
    text["size"] = F.coalesce(F.nullif("size", blank), "parent_size", blank)
    text["supplier_price"] = F.coalesce(c.amount_text(F.coalesce("supplier_price", "supplier_cost")), blank)
    text["gst_percent"] = F.coalesce(c.amount_text("gst_percent"), blank)
    text["selling_price"] = F.coalesce(c.amount_text("selling_price"), blank)
    text["publish"] = F.lit(False)
    return rows.select(*VARIANT, *[(text[x] if x in text else F.col(x)).alias(x) for x in fv.STORE_COLUMNS],
                       *[F.coalesce(F.get("gallery", F.lit(i)), blank).alias(f"image_{i + 1}_url") for i in range(slots)])
