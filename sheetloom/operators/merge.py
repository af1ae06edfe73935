"""Union of canonical datasets and of import tables, with conflict checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators.ranking import rank_by_number


class MergeConflict(ValueError):
    """Two datasets disagree about an identity."""


class ConsolidationError(ValueError):
    """A source table cannot be combined."""


def conflicts(rows: DataFrame) -> DataFrame:
    """Product ids with several catalogue names, variant codes with several products."""
    def several(key: str, value: str, kind: str) -> DataFrame:
        return (rows.groupBy(F.col(key).alias("id"))
                .agg(F.min(value).alias("first"), F.max(value).alias("last"))
                .where(F.col("first") != F.col("last"))
                .select(F.lit(kind).alias("kind"), "id", "first", "last"))

    return several("product_id", "catalog_name", "product_id").unionByName(
        several("variant_code", "product_id", "variant_code"))


def merge(datasets: list[DataFrame], dedupe: bool = False) -> DataFrame:
    """Bag union in the given order; ``dedupe`` keeps equal rows once."""
    parts = [d.withColumn("dataset_ord", F.lit(i)) for i, d in enumerate(datasets)]
    rows = reduce(DataFrame.unionByName, parts)
    if not dedupe:
        return rows
    own = [x for x in rows.columns if x != "dataset_ord"]
    return rows.groupBy(*own).agg(F.min("dataset_ord").alias("dataset_ord"))


def checked_merge(datasets: list[DataFrame], dedupe: bool = False) -> DataFrame:
    """The union, or an error that names the first conflict."""
    rows = merge(datasets, dedupe)
    found = conflicts(rows).orderBy("kind", "id").first()
    if found:
        raise MergeConflict(f"{found['kind']} '{found['id']}' used for '{found['first']}' and '{found['last']}'")
    return rows


def regroup_flat(rows: DataFrame) -> DataFrame:
    """Flat canonical rows to variants: product by id else catalogue name, default code and name."""
    product = F.coalesce(F.nullif("product_id", F.lit("")), "catalog_name")
    placed = rank_by_number(rows.withColumn("product_id", product), ["run_id", "product_id"], "row_number", "variant_ord")
    return placed.withColumns({
        "variant_code": F.coalesce(F.nullif("variant_code", F.lit("")), F.concat(F.lit("VAR-"), F.col("variant_ord").cast("string"))),
        "variant_name": F.coalesce(F.nullif("variant_name", F.lit("")), F.lit("Standard"))})


# --------------------------------------------------------- import tables
def _filled() -> Column:
    return F.exists("cells", lambda x: F.coalesce(c.pystrip(x) != "", F.lit(False)))


def source_checks(rows: DataFrame) -> DataFrame:
    """Per source: number of filled rows and what is wrong with it, if anything.

    ``rows(source, row_number, header array<string>, cells array<string>)``.
    """
    expected = F.array(*[F.lit(x) for x in fv.IMPORT_COLUMNS])
    per_source = rows.groupBy("source").agg(
        F.min_by("header", "row_number").alias("header"), F.count_if(_filled()).alias("rows"))
    wrong = F.filter(F.transform(F.sequence(F.lit(0), F.lit(len(fv.IMPORT_COLUMNS) - 1)), lambda i: F.when(
        ~F.get("header", i).eqNullSafe(F.get(expected, i)), F.concat(
            F.lit("Col "), (i + 1).cast("string"), F.lit(": expected '"), F.get(expected, i), F.lit("', found '"),
            F.coalesce(F.get("header", i), F.lit("")), F.lit("'")))), lambda x: x.isNotNull())
    problem = F.when(F.size(wrong) > 0, F.concat(F.lit("Schema mismatch. "), F.array_join(wrong, "; "))).when(
        F.col("rows") == 0, F.lit("0 product data rows"))
    return per_source.select("source", "rows", problem.alias("problem"))


def consolidate(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Filled rows of all sound sources under the fixed 26 columns, nothing removed twice.

    ``strict`` stops at the first faulty source instead of leaving it out.
    """
    checks = source_checks(rows)
    if strict:
        bad = checks.where(F.col("problem").isNotNull()).orderBy("source").first()
        if bad:
            raise ConsolidationError(f"[{bad['source']}] {bad['problem']}")
    sound = checks.where(F.col("problem").isNull()).select("source")
    return rows.where(_filled()).join(sound, "source", "left_semi").select(
        "source", "row_number", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(fv.IMPORT_COLUMNS)])
