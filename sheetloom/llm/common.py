"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CHUNK_BYTES = 4 << 20  # texts that one step holds as Python objects at a time
BATCH_BYTES = 4 << 20  # of an Arrow batch between Spark and a Python worker, one row at least


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_workers(df: DataFrame) -> DataFrame:
    """Let Python workers import this library from where the driver has it, wherever they are started.

    Batches for them are bounded by bytes: texts and vectors differ too much in size for a number of rows alone.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that nothing is learned from; a null id belongs to it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def as_bytes(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def chunks(batch: pa.RecordBatch, text: str | None) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about CHUNK_BYTES of text (one row at least)."""
    if text is None or batch.num_rows == 0:
        yield batch
        return
    data = as_bytes(batch.column(text))
    start = size = 0
    for i, n in enumerate(pa.compute.binary_length(data).to_pylist()):
        if size and size + (n or 0) > CHUNK_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    yield batch.slice(start)


def append_struct(df: DataFrame, into: str, fields: T.StructType, make: Callable[[], Callable[[pa.RecordBatch], dict[str, Any]]],
                  text: str | None = "text") -> DataFrame:
    """Append one struct column that is worked out batch by batch, without a shuffle.

    ``make`` runs once per task and returns the function from a record batch to the lists of the struct's
    fields. Every input column passes through unchanged; one already called ``into`` is replaced.
    The function may have an attribute ``forget``: a function called at the end of the task. Python workers serve
    many tasks, of other operators too, and what one of them leaves behind counts against all that follow.
    """
    rest = [f for f in df.schema if f.name.lower() != into.lower()]
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        work = make()
        try:
            for whole in batches:
                for batch in chunks(whole, text):
                    made = work(batch)
                    struct = pa.StructArray.from_arrays([pa.array(made[f.name], kind) for f, kind in zip(fields, kinds, strict=True)],
                                                        names=[f.name for f in fields])
                    yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, into])
        finally:
            getattr(work, "forget", lambda: None)()
            pa.default_memory_pool().release_unused()

    return on_workers(df).select(*[F.col(f"`{f.name}`") for f in rest]).mapInArrow(run, T.StructType([*rest, T.StructField(into, fields)]))


def rows_of(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict[str, Any]]]],
            text: str | None = "text") -> DataFrame:
    """Replace every batch by what the function made by ``make`` yields: dictionaries of columns.

    The function may have an attribute ``rest``: a function called at the end of the task for what it has kept.
    """
    kinds = {f.name: to_arrow_type(f.dataType) for f in T.StructType.fromDDL(schema)}

    def pack(made):
        return pa.RecordBatch.from_arrays([pa.array(made[c], kind) for c, kind in kinds.items()], names=list(kinds))

    def run(batches):
        work = make()
        for whole in batches:
            for batch in chunks(whole, text):
                for made in work(batch):
                    yield pack(made)
        for made in getattr(work, "rest", lambda: ())():
            yield pack(made)
        pa.default_memory_pool().release_unused()

    return on_workers(df).mapInArrow(run, schema)
