"""Flat canonical tables: one row per variant, columns found by their headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom import fixed_values as fv
from sheetloom.sources import delimited

_NUMBERS = {"supplier_price": "double", "supplier_cost": "double", "gst_percent": "double", "selling_price": "double",
            "stock_quantity": "int", "publish": "boolean"}
_PLACES = {"product_ord": "bigint", "variant_ord": "int"}
_IMAGE = r"^image(\d+)(?:_url)?$"


def _plain(text: Column) -> Column:
    """Text without the apostrophe that keeps spreadsheets from running it."""
    prefixes = "".join("\\" + x for x in fv.FORMULA_PREFIXES)
    return F.when(text.rlike(f"^'[{prefixes}]"), F.substr(text, F.lit(2))).otherwise(text)


def _cell(name: str | Column) -> Column:
    """Cell under a header, null without it; the first of equal headers."""
    at = F.array_position("headers", F.lit(name) if isinstance(name, str) else name)
    return F.get("cells", (at - 1).cast("int"))


def of_rows(rows: DataFrame) -> DataFrame:
    """Variants of sheet rows whose headers name the flat columns, in any order and number.

    ``image1``, ``image2``, ... become the gallery by their numbers, whatever gaps there are, unless a
    column holds the whole gallery; columns without another use become attributes, beside those of
    a column ``attributes``. Files of one scan may differ in both. Missing columns, blank cells and
    numbers that cannot be read are null.
    """
    own = ["run_id", "product_id", "image_url", "gallery_image_urls", "attributes", *_PLACES, *fv.FLAT_COLUMNS]
    known = F.array(*[F.lit(x) for x in own])
    numbered = F.transform("headers", lambda h, i: F.struct(
        F.regexp_extract(h, _IMAGE, 1).try_cast("int").alias("n"), _plain(F.get("cells", i)).alias("url")))
    slots = F.transform(F.array_sort(F.filter(numbered, lambda x: x["n"].isNotNull() & x["url"].isNotNull())), lambda x: x["url"])
    gallery = F.coalesce(F.from_json(_cell("gallery_image_urls"), "array<string>"), slots)
    names = F.array_distinct(F.filter("headers", lambda h: ~F.array_contains(known, h) & ~h.rlike(_IMAGE) & _cell(h).isNotNull()))
    extra = F.map_from_arrays(names, F.transform(names, lambda h: _plain(_cell(h))))
    listed = F.coalesce(F.from_json(_cell("attributes"), "map<string,string>"), F.create_map().cast("map<string,string>"))
    found = rows.withColumns({"extra": extra, "listed": listed})
    attributes = F.map_concat("listed", F.map_filter("extra", lambda k, v: ~F.array_contains(F.map_keys("listed"), k)))
    columns = [(_cell(x).try_cast(_NUMBERS[x]) if x in _NUMBERS else _plain(_cell(x))).alias(x) for x in fv.FLAT_COLUMNS]
    return found.select(
        F.coalesce(_cell("run_id"), "run_id").alias("run_id"), delimited.FILE, "row_number", _cell("product_id").alias("product_id"),
        *[_cell(x).try_cast(t).alias(x) for x, t in _PLACES.items()], *columns,
        gallery.alias("gallery_image_urls"), attributes.alias("attributes"))


def canonical_flat(spark: SparkSession, paths: str | list[str], run_id: Column | None = None) -> DataFrame:
    """Rows of flat files; :func:`sheetloom.operators.merge.regroup_flat` groups them to products."""
    return of_rows(delimited.scan(spark, paths, run_id))
