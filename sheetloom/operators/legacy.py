"""The older 21-column table: mapping and row rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c


def map21(df: DataFrame) -> DataFrame:
    """Rename, fill constants, keep the fixed column order; absent columns are null."""
    source = {target: name for name, target in fv.LEGACY_RENAMES.items()}

    def column(name: str) -> Column:
        if name in fv.LEGACY_CONSTANTS:
            return F.lit(fv.LEGACY_CONSTANTS[name])
        return F.col(source[name]) if source.get(name) in df.columns else F.lit(None).cast("string")

    return df.select("run_id", "row_number", *[column(n).cast("string").alias(n) for n in fv.LEGACY_COLUMNS])


def _sku() -> Column:
    return F.coalesce(c.pystrip("supplier_sku"), F.lit("nan"))


def _absent(df: DataFrame, name: str) -> Column:
    return c.is_blank(f"`{name}`") if name in df.columns else F.lit(True)


def _hits(df: DataFrame, rules: list[tuple[Column, str, str, Column]]) -> DataFrame:
    found = F.filter(F.array(*[
        F.when(w, F.struct(F.lit(f).alias("field"), F.lit(s).alias("severity"), m.alias("issue")))
        for w, f, s, m in rules]), lambda x: x.isNotNull())
    return df.select("run_id", F.col("row_number").alias("excel_row"), _sku().alias("supplier_sku"),
                     F.inline(found))


def missing_required(df: DataFrame) -> DataFrame:
    return _hits(df, [(_absent(df, f), f, "ERROR", F.lit(f"Missing required field: {f}")) for f in fv.LEGACY_REQUIRED])


def duplicate_skus(df: DataFrame) -> DataFrame:
    """Every use of a SKU after its first row in the run."""
    key = F.lower(_sku())
    used = df.where((_sku() != "") & (key != "nan")).withColumn("sku_key", key)
    first = used.groupBy("run_id", "sku_key").agg(F.min("row_number").alias("first_row"))
    again = used.join(first, ["run_id", "sku_key"]).where(F.col("row_number") > F.col("first_row"))
    return _hits(again, [(F.lit(True), "supplier_sku", "ERROR", F.lit("Duplicate SKU in batch"))])


def bad_numbers(df: DataFrame) -> DataFrame:
    def bad(name: str, extra) -> Column:
        number = c.pystrip(name).try_cast("double")
        return ~c.is_blank(name) & (number.isNull() | (~F.isnan(number) & ((number < 0) | extra(number))))

    return _hits(df, [
        (bad(f, extra), f, "ERROR", F.concat(F.lit("Invalid numeric value: "), F.col(f)))
        for f, extra in (("supplier_price", lambda n: n == 0), ("gst_percent", lambda n: n > 100))])


def pending_review(df: DataFrame) -> DataFrame:
    return _hits(df, [(_absent(df, f), f, "WARNING", F.lit(f"Pending later workflow step: {f}")) for f in fv.LEGACY_REVIEW])


def published_drafts(df: DataFrame) -> DataFrame:
    said = F.lower(c.pystrip("publish"))
    return _hits(df, [(~c.is_blank("publish") & ~said.isin("false", "0", "no"), "publish", "ERROR",
                       F.lit("Product must remain unpublished during processing"))])


def findings(df: DataFrame) -> DataFrame:
    out = missing_required(df)
    for rule in (duplicate_skus, bad_numbers, pending_review, published_drafts):
        out = out.unionByName(rule(df))
    return out


def summary(df: DataFrame) -> DataFrame:
    rows = df.groupBy("run_id").agg(F.count(F.lit(1)).alias("products_checked"))
    found = findings(df).groupBy("run_id").agg(
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"))
    return rows.join(found, "run_id", "left").na.fill(0, ["errors", "warnings"])
