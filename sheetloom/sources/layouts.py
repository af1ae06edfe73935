"""Header layouts: which column of a sheet answers to which header key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def effective_keys(keys: list[str]) -> list[str]:
    """Blank out a key that a later column repeats: the last column wins."""
    return ["" if k in keys[i + 1:] else k for i, k in enumerate(keys)]


def effective_keys_column(keys: Column) -> Column:
    """The same for an array column."""
    return F.transform(
        keys,
        lambda k, i: F.when(
            F.array_contains(F.slice(keys, i + F.lit(2), F.size(keys) + F.lit(1)), k), F.lit(""),
        ).otherwise(k))
