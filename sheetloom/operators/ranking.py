"""Positions inside a group, without putting a whole group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sheetloom.session import written

CHUNK = 1 << 16


def rank_by_number(df: DataFrame, group: list[str], order: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """1-based position by the integer column ``order``, unique inside a group.

    The number line is cut into stretches of ``chunk``.  A stretch holds at most
    ``chunk`` rows, so each window stays small however large the group is; the
    rows before a stretch come from a count per stretch.
    """
    cut = df.withColumn("_stretch", F.floor(F.col(order) / F.lit(chunk)))
    before = Window.partitionBy(*group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(*group, "_stretch").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.sum("_n").over(before))
               .where(F.col("_before") > 0)
               .drop("_n"))
    inside = Window.partitionBy(*group, "_stretch").orderBy(order)
    return (cut.withColumn("_pos", F.row_number().over(inside))
            .join(offsets, [*group, "_stretch"], "left")
            .withColumn(out, (F.col("_pos") + F.coalesce(F.col("_before"), F.lit(0))).cast("int"))
            .drop("_stretch", "_pos", "_before"))


def rank_by_text(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """1-based position by text columns.

    The rows are range-partitioned over group and order, which splits a large
    group over many tasks, written once, and numbered slice by slice; the rows
    before a slice come from a count per slice.
    """
    ranged = written(
        df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id()), "ranged")
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.sum("_n").over(before)).drop("_n"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*group, "_slice"]])
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    numbered = ranged.withColumn("_pos", F.row_number().over(inside))
    return (numbered.alias("r").join(offsets.alias("o"), same, "left")
            .select("r.*", F.col("o._before"))
            .withColumn(out, (F.col("_pos") + F.coalesce(F.col("_before"), F.lit(0))).cast("int"))
            .drop("_slice", "_pos", "_before"))
