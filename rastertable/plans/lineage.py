"""Cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of this process's runs, with the session that made them.
_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, else its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def run_folder(spark: SparkSession, what: str) -> str:
    """A new folder for one run. ``release_runs`` deletes it, at the latest when the process ends."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def release_runs(spark: SparkSession | None = None) -> None:
    """Delete the run folders of a session (of all by default); results that read them end with it."""
    for pair in [p for p in _made if spark is None or p[0] is spark]:
        _made.remove(pair)
        with contextlib.suppress(Exception):  # a session that has stopped can delete nothing any more
            path = pair[0]._jvm.org.apache.hadoop.fs.Path(pair[1])
            files = path.getFileSystem(pair[0].sparkContext._jsc.hadoopConfiguration())
            files.delete(path, True)
            if not files.listStatus(path.getParent()):
                files.delete(path.getParent(), False)


atexit.register(release_runs)


def through_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: the plan restarts from files that outlive any executor, and
    the optimizer sees their true size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
