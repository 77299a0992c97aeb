"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset and the master is local (tests) a folder of this machine is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quillgraph-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                _remove(spark, path)
        except Exception:  # noqa: BLE001  the session or this table is gone: the cluster's own clean-up removes its folder
            continue


def discard(*frames: DataFrame) -> None:
    """Removes tables that written() made, once nothing is read from them any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            _remove(df.sparkSession, path)
            _made.remove((df.sparkSession, path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_root(spark)}/quillgraph-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends there, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out
