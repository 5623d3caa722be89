"""Writers: Parquet, strict JSON, CSV, replacement of a table that is being read, manifests."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.text import finite


def write_parquet(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    out = rows.write.mode("overwrite").option("compression", "zstd")
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)


def replace_parquet(rows: DataFrame, path: str) -> None:
    """Write ``rows``, which may read ``path``, beside it, then put it in its place.

    The old table is moved aside before the new one is moved in and deleted only
    then, so that a crash at any point leaves a whole table beside ``path``.
    """
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    mark = uuid.uuid4().hex
    target, staged, old = at(path), at(f"{path}.staged-{mark}"), at(f"{path}.old-{mark}")
    rows.write.option("compression", "zstd").parquet(staged.toString())
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(target) and not store.rename(target, old):
        raise OSError(f"could not move {path}")
    if not store.rename(staged, target):
        store.rename(old, target)
        raise OSError(f"could not move {staged.toString()}")
    store.delete(old, True)


def drop_if_empty(rows: DataFrame, path: str) -> bool:
    """Write ``rows``, or remove what an earlier run left at ``path`` if there are none; says whether it wrote."""
    if rows.isEmpty():
        target = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
        return False
    write_parquet(rows, path)
    return True


def without_nonfinite(rows: DataFrame) -> DataFrame:
    """NaN and infinities as null."""
    return rows.select(*[finite(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`") for f in rows.schema])


def write_json(rows: DataFrame, path: str) -> None:
    """Strict JSON lines."""
    without_nonfinite(rows).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True)


def manifest(facts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Rows and files per year; with ``files`` (source_file, n_bytes, sha256, delimiter), one row per year and source file with what is known of it."""
    if files is None:
        return facts.groupBy("periodo").agg(F.count("*").alias("n_rows"), F.count_distinct("source_file").alias("n_files"))
    return facts.groupBy("periodo", "source_file").agg(F.count("*").alias("n_rows")).join(files, "source_file", "left")


def file_digests(spark: SparkSession, pattern: str) -> DataFrame:
    """source_file, path, n_bytes and sha256 of the files that match; each is read as a stream, so files of any size do."""

    def digest(batches):
        from pyarrow import fs

        for pdf in batches:
            sums = []
            for path in pdf["path"]:
                store, inside = fs.FileSystem.from_uri(path)
                whole = hashlib.sha256()
                with store.open_input_stream(inside, compression=None) as stream:
                    while block := stream.read(8 << 20):
                        whole.update(block)
                sums.append(whole.hexdigest())
            yield pdf.assign(sha256=sums)

    listed = spark.read.format("binaryFile").load(pattern).select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "path", F.col("length").alias("n_bytes"))
    return listed.mapInPandas(digest, "source_file string, path string, n_bytes long, sha256 string")


def drop_files(spark: SparkSession, paths: list[str]) -> int:
    """Delete what a year's run needs no longer; how many were there."""
    gone = 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
    return gone


def check_json(spark: SparkSession, path: str) -> int:
    """Read strict JSON lines again; the number of them, or an error if one doesn't parse."""
    lines = spark.read.text(path)
    broken = lines.filter(F.try_parse_json("value").isNull() | F.col("value").rlike(r'(?<!")\b(NaN|Infinity)\b(?!")')).limit(1).collect()
    if broken:
        raise ValueError(f"no strict JSON: {broken[0][0][:200]}")
    return lines.count()
