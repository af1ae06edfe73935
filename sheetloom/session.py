"""Where intermediate tables are written, how they are read back and removed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_paths: dict[str, list[str]] = {}  # written tables by application
_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session (tests, one machine) may run without the setting; it
    gets a folder that is removed when the process ends. A cluster needs a
    folder that every executor can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="sheetloom-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/sheetloom/{name}-{uuid.uuid4().hex}"
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def tables(spark: SparkSession) -> list[str]:
    """Paths of the intermediate tables of this application, in the order they were written."""
    return list(_paths.get(spark.sparkContext.applicationId, []))


def clean_up(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Remove intermediate tables of this application, all or some; call it when what reads them is not needed any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone, own = 0, _paths.setdefault(spark.sparkContext.applicationId, [])
    for path in list(own) if paths is None else paths:
        own.remove(path)
        place = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(place.getFileSystem(conf).delete(place, True))
    return gone


def broadcast_by_measure(spark: SparkSession) -> None:
    """Let joins send a side through the driver by its measured size only.

    The planner's guess for a table is its size on disk, cut down to the columns
    read: rows of a few repeated texts are 40 times that, and computed arrays
    count as one entry.  So no join is planned as a broadcast; adaptive
    execution turns it into one when its shuffled side is really that small.
    The session's threshold is kept, as that of adaptive execution.
    """
    planned, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    limit = spark.conf.get(planned)
    if limit != "-1":
        if spark.conf.get(adaptive, None) is None:
            spark.conf.set(adaptive, limit)
        spark.conf.set(planned, "-1")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several branches read the same result: the work is done once,
    and the lineage ends here (a lost executor re-reads files).
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
