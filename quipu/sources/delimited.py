"""Delimited, JSON and Parquet readers."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DELIMITERS = ",;|\t"


def sniff_delimiter(sample: str) -> str:
    """The delimiter of a text's first lines; a comma if none fits."""
    try:
        return csv.Sniffer().sniff(sample, delimiters=DELIMITERS).delimiter
    except csv.Error:
        return ","


def head_of(spark: SparkSession, path: str, letters: int = 65_536) -> str:
    """The first lines of a file, read through Spark, so from any store and through gzip."""
    out, size = [], 0
    for row in spark.read.text(path).limit(200).toLocalIterator():
        out.append(row[0])
        size += len(row[0]) + 1
        if size >= letters:
            break
    return "\n".join(out).lstrip("﻿")


def read_delimited(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """All columns as text, gzip or plain; a byte-order mark before the header is dropped.

    A gzip file is one partition; repartition after it if there are few files.
    """
    sep = delimiter or sniff_delimiter(head_of(spark, path))
    rows = spark.read.csv(path, header=True, sep=sep, inferSchema=False, multiLine=False, quote='"', escape='"', encoding="UTF-8")
    return rows.toDF(*[c.lstrip("﻿") for c in rows.columns])


def read_many_delimited(spark: SparkSession, paths: list[str], delimiter: str = "\t") -> DataFrame:
    """Several files as one, matched by column names, rows that don't parse dropped."""
    out: DataFrame | None = None
    for path in paths:
        rows = spark.read.csv(path, header=True, sep=delimiter, inferSchema=False, mode="DROPMALFORMED", encoding="UTF-8")
        rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no paths")
    return out


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines, bad ones dropped; no rows if there is no such file."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def read_parquet(spark: SparkSession, glob: str) -> DataFrame:
    """Parquet files matched by column names."""
    return spark.read.option("mergeSchema", "true").parquet(glob)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows of ``schema`` where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def page_links(pages: DataFrame, pattern: str = r'href="([^"]+)"', html: str = "html") -> DataFrame:
    """One row per link in a column of web pages."""
    return pages.select("*", F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("link"))


def table_rows(pages: DataFrame, html: str = "html", least: int = 3, skip: tuple[str, ...] = ()) -> DataFrame:
    """Cells of the tables in web pages: rows of at least ``least`` cells, without those that hold a header word."""
    rows = pages.select("*", F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_no", "row_html"))
    cells = F.transform(
        F.regexp_extract_all("row_html", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)),
        lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]+>", " "), r"\s+", " ")),
    )
    out = rows.withColumn("cells", cells).drop("row_html").filter(F.size("cells") >= least)
    return out.filter(~F.arrays_overlap("cells", F.array(*[F.lit(w) for w in skip]))) if skip else out


def coverage_states(found: DataFrame, wanted: list[int], spark: SparkSession) -> DataFrame:
    """Wanted years that have no source: anti-join of the years with ``found(periodo)``."""
    years = spark.range(1).select(F.explode(F.array(*[F.lit(int(y)) for y in wanted])).alias("periodo"))
    return years.join(found.select("periodo").distinct(), "periodo", "left_anti")
