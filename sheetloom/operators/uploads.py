"""Where files are hosted: destination keys, content types, reuse and collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators.images import stem, suffix


def _dashed(text: Column) -> Column:
    dashes = F.regexp_replace(c.pystrip(text), c.unicode_re(r"[^\w\-]+"), "-")
    return F.trim(F.regexp_replace(dashes, "-+", "-"), F.lit("-"))


def segment(text: str) -> Column:
    return F.when(F.coalesce(F.col(text), F.lit("")) == "", F.lit("unknown")).otherwise(_dashed(F.col(text)))


def destination_key(prefix: str = "products") -> Column:
    """prefix / supplier / catalogue / variant / file, each part sanitised."""
    name = F.col("filename")
    file = F.concat(_dashed(stem(name)), suffix(name))
    parts = F.array(*[_dashed(F.lit(p)) for p in prefix.replace("\\", "/").split("/")],
                    segment("supplier_name"), segment("catalog_name"), segment("variant_code"), file)
    return F.array_join(F.filter(parts, lambda p: p != ""), "/")


def content_type(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in fv.CONTENT_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, suffix(name)), F.lit(fv.CONTENT_TYPE_OTHER))


def plan(blobs: DataFrame, prefix: str = "products") -> DataFrame:
    """Result of each upload: the first content of a key wins.

    The same content again is reused, other content under a used key collides.
    """
    keyed = blobs.select(
        "ord", destination_key(prefix).alias("destination_key"), content_type(F.col("filename")).alias("content_type"),
        F.sha2("content", 256).alias("content_hash"), F.length(F.encode("content", "UTF-8")).alias("file_size_bytes"))
    first = keyed.groupBy("destination_key").agg(
        F.min(F.struct("ord", "content_hash")).alias("first"))
    same = F.col("content_hash") == F.col("first.content_hash")
    message = F.concat(
        F.lit("Destination key '"), F.col("destination_key"), F.lit("' already contains different content (existing hash: "),
        F.left("first.content_hash", F.lit(8)), F.lit("..., new hash: "), F.left("content_hash", F.lit(8)), F.lit("...)"))
    return keyed.join(first, "destination_key").select(
        "ord", "destination_key", "content_type", "file_size_bytes", "content_hash",
        F.when(same, F.lit("UPLOADED")).otherwise(F.lit("COLLISION")).alias("status"),
        (same & (F.col("ord") != F.col("first.ord"))).alias("is_idempotent_reuse"),
        F.when(~same, message).alias("error_message"))
