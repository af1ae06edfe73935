"""Image listings: identity, filtering, natural order, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators.ranking import rank_by_text


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """Extension with its dot, lower case; none for names like ``.jpg``."""
    return F.lower(F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1))


def stem(name: Column) -> Column:
    return F.left(name, F.length(name) - F.length(suffix(name)))


def image_id(source_identity: Column, path: Column) -> Column:
    return F.concat(F.lit("img_"), F.left(F.sha2(F.concat(source_identity, F.lit(":"), path), 256), F.lit(16)))


def listed_files(paths: DataFrame) -> DataFrame:
    """Add file name, extension and whether the file is an image."""
    clean_path = F.trim(F.replace(F.col("relative_path"), F.lit("\\"), F.lit("/")), F.lit("/"))
    return (paths.withColumn("relative_path", clean_path)
            .withColumn("original_filename", file_name(F.col("relative_path")))
            .withColumn("file_extension", suffix(F.col("original_filename")))
            .withColumn("is_image", F.col("file_extension").isin(fv.IMAGE_EXTENSIONS)))


def inventory(paths: DataFrame) -> DataFrame:
    """Images with identity, matching stem and tokens."""
    kept = listed_files(paths).where("is_image").drop("is_image")
    bare = F.regexp_replace(stem(F.col("original_filename")), c.unicode_re(r"[^\w\-.]+"), "_")
    words = F.split("relative_path", c.unicode_re(r"[/\s\-_,.]+"))
    return kept.withColumns({
        "image_id": image_id(F.col("source_identity"), F.col("relative_path")),
        "normalized_stem": F.lower(F.trim(bare, F.lit("_"))),
        "tokens": F.transform(F.filter(words, lambda w: w != ""), F.lower)})


def ignored_files(paths: DataFrame) -> DataFrame:
    return (listed_files(paths).where(~F.col("is_image"))
            .withColumn("reason", F.concat(F.lit("Unsupported file extension '"), F.col("file_extension"), F.lit("'"))))


def natural_order(images: DataFrame) -> DataFrame:
    """Place of each image in the natural order of its run."""
    keyed = images.withColumn("natural_key", c.natural_key("relative_path"))
    return rank_by_text(keyed, ["run_id"], ["natural_key", "relative_path", "image_id"], "natural_ord")


def lookup(images: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(run_id, identifier)``: first image by id, file name or path."""
    names = F.array(*[F.lower(n) for n in ("image_id", "original_filename", "relative_path")])
    named = (images.select(
        "run_id", F.explode(F.array_distinct(names)).alias("key"),
        F.struct(c.natural_key("relative_path"), F.col("relative_path"), F.col("image_id")).alias("place"))
        .groupBy("run_id", "key").agg(F.min("place").alias("first")))
    asked = wanted.withColumn("key", F.lower(c.pystrip("identifier")))
    return (asked.join(named, ["run_id", "key"])
            .select("run_id", "identifier", F.col("first.image_id").alias("image_id")))
