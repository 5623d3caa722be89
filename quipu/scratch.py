"""Folders below the cluster's checkpoint folder, for tables that cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process made, with the session's Hadoop settings.
_MADE: dict[str, tuple] = {}


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's checkpoint folder, removed when the process ends.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a
    session on one machine (master ``local``), as in tests, gets a temporary
    folder; on a cluster, whose executors share no such folder, this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quipu-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    _MADE[folder] = spark._jvm, spark._jsc.hadoopConfiguration()
    return folder


def remove(folder: str) -> None:
    """Delete a folder of :func:`shared_dir` that nothing reads any more."""
    if folder in _MADE:
        jvm, conf = _MADE.pop(folder)
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _remove_all() -> None:
    for folder in list(_MADE):
        with contextlib.suppress(Exception):  # the store or the JVM may be gone by now
            remove(folder)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: what follows never recomputes what came before."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored` in a folder of its own."""
    return stored(df, f"{shared_dir(df.sparkSession)}/{name}")
