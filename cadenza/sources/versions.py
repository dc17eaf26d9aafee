"""Sets of tables that are committed together, version by version.

A version's tables are written first, below ``path/<table>/version=<n>``; a manifest with the length, digest and row
count of each of their files, and the schema, is written last, below ``path/manifests/version=<n>``. A version counts only
if its manifest is there and every file is as listed, no file missing, changed or added; readers take the
newest one that counts.
"""

from __future__ import annotations

import logging
import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

log = logging.getLogger(__name__)

MANIFESTS = "manifests"


def _at(path: str, table: str, version: int) -> str:
    return f"{path.rstrip('/')}/{table}/version={version}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions with a manifest folder, newest first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFESTS}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted((int(m[1]) for n in names if (m := re.fullmatch(r"version=(\d+)", n))), reverse=True)


def _files(spark: SparkSession, path: str, table: str, version: int) -> DataFrame:
    """(table, file, length, digest) as they lie there. A file is read by one task, so files should be of usual size."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(_at(path, table, version))
    return found.select(F.lit(table).alias("table"), F.element_at(F.split("path", "/"), -1).alias("file"),
                        "length", F.sha2("content", 256).alias("digest"))


def commit(path: str, tables: dict[str, DataFrame]) -> int:
    """Write ``tables`` as the next version and return its number."""
    spark = next(iter(tables.values())).sparkSession
    version = max(versions(spark, path), default=0) + 1
    listed = None
    for table, df in tables.items():
        at = _at(path, table, version)
        # what an aborted commit may have left there was never listed
        df.write.mode("overwrite").option("compression", "zstd").parquet(at)
        rows = spark.read.schema(df.schema).parquet(at).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))
        here = _files(spark, path, table, version).join(rows, "file", "left").select(
            "table", "file", "length", "digest", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(df.schema.json()).alias("schema"))
        listed = here if listed is None else listed.unionByName(here)
    listed.coalesce(1).write.parquet(_at(path, MANIFESTS, version))
    return version


def damage(spark: SparkSession, path: str, version: int, tables) -> DataFrame:
    """(table, file, fault): files that are missing, changed or not listed."""
    listed = spark.read.parquet(_at(path, MANIFESTS, version))
    there = None
    for table in tables:
        here = _files(spark, path, table, version)
        there = here if there is None else there.unionByName(here)
    both = listed.select("table", "file", "length", "digest").join(
        there.select("table", "file", F.col("length").alias("l"), F.col("digest").alias("d")), ["table", "file"], "full")
    fault = (F.when(F.col("d").isNull(), "missing").when(F.col("digest").isNull(), "not listed")
             .when((F.col("l") != F.col("length")) | (F.col("d") != F.col("digest")), "changed"))
    return both.select("table", "file", fault.alias("fault")).filter(F.col("fault").isNotNull())


def is_whole(spark: SparkSession, path: str, version: int, tables) -> bool:
    """Whether all files of a version are as its manifest lists them."""
    try:
        listed = {r["table"] for r in spark.read.parquet(_at(path, MANIFESTS, version)).select("table").distinct().collect()}
        found = [] if set(tables) <= listed else ["tables"]
        found = found or damage(spark, path, version, tables).limit(5).collect()
    except (PySparkException, Py4JJavaError) as e:  # a folder or the manifest itself is missing or damaged
        found = [type(e).__name__]
    if found:
        log.warning("version %s of %s is not whole: %s", version, path, found)
    return not found


def read_version(spark: SparkSession, path: str, version: int, tables) -> dict[str, DataFrame]:
    schemas = dict(spark.read.parquet(_at(path, MANIFESTS, version)).select("table", "schema").distinct().collect())
    kind = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType
    return {t: spark.read.schema(kind.fromJson(schemas[t]).toDDL()).parquet(_at(path, t, version)) for t in tables}


def read_newest(spark: SparkSession, path: str, tables) -> dict[str, DataFrame]:
    """The tables of the newest whole version; ValueError if there is none."""
    for version in versions(spark, path):
        if is_whole(spark, path, version, tables):
            return read_version(spark, path, version, tables)
    raise ValueError(f"no whole version of {', '.join(tables)} at {path}")
