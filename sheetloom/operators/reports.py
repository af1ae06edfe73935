"""Per-run reports on the cleaning of one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.functions.clean import is_blank


def cleaning_report(df: DataFrame, raw: str, cleaned: Column) -> DataFrame:
    """Per run: accepted, missing and rejected cells, and the range of the accepted."""
    value = df.select("run_id", F.col(raw).alias("raw"), cleaned.alias("value"))
    present = F.col("value").isNotNull()
    return value.groupBy("run_id").agg(
        F.count_if(present).alias("accepted"),
        F.count_if(is_blank("raw")).alias("missing"),
        F.count_if(~present & ~is_blank("raw")).alias("rejected"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"))
