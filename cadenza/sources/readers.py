"""Readers. Schemas are given where they are known; inference is the caller's choice."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.operators.ingest import PAGE_SCHEMA, page_items
from cadenza.schema import nan_to_null
from cadenza.session import write_and_read
from cadenza.sources import versions


log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the price of a second scan.

    ``multi_line`` reads quoted line breaks, but then a file can no longer be split over tasks.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet by suffix, CSV otherwise."""
    if path.lower().rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path)
    return read_csv(spark, path, schema)


def read_playlist_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed playlist pages (JSON lines) to one row per entry with a usable track."""
    return page_items(spark.read.schema(PAGE_SCHEMA).json(path))


def read_checked_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed pages as by ``read_playlist_pages``, and what was put aside: (file, playlist_id, page_no, pos, reason, record).

    A line that is no JSON of the expected types is put aside whole (``damaged page``, with the line as it is), a page
    without a list as ``no items``, and an entry without a track or a usable id by itself; every other entry is read.
    """
    schema = PAGE_SCHEMA.rstrip() + ", _line STRING"
    parsed = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").json(path)
    # written, because the parser fills the line only where all columns are read
    pages = write_and_read(parsed.select("*", F.col("_metadata.file_name").alias("_file")), "pages")
    whole = pages.filter(F.col("_line").isNull())
    missing = F.lit(None)
    damaged = pages.filter(F.col("_line").isNotNull()).select(
        F.col("_file").alias("file"), missing.cast("string").alias("playlist_id"), missing.cast("int").alias("page_no"),
        missing.cast("int").alias("pos"), F.lit("damaged page").alias("reason"), F.col("_line").alias("record"))
    bare = whole.filter(F.col("items").isNull()).select(
        F.col("_file").alias("file"), "playlist_id", "page_no", missing.cast("int").alias("pos"),
        F.lit("no items").alias("reason"), missing.cast("string").alias("record"))
    entries = whole.select("_file", "playlist_id", "page_no", F.posexplode("items").alias("pos", "item"))
    track = F.col("item.track")
    reason = F.when(track.isNull(), "no track").when(track["id"].isNull() | (track["id"] == ""), "no id")
    unusable = entries.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        F.col("_file").alias("file"), "playlist_id", "page_no", "pos", "reason", F.to_json("item").alias("record"))
    return page_items(whole.drop("_line", "_file")), damaged.unionByName(bare).unionByName(unusable)


INDEX_TABLES = ("vectors", "items", "feature_stats")


def load_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the newest whole version written by ``save_index``; ValueError if there is none."""
    return versions.read_newest(spark, path, INDEX_TABLES)


def load_index_or_fallback(spark: SparkSession, learned: str, raw: str) -> tuple[dict[str, DataFrame], str]:
    """Learned vectors if a version of them is whole, every file of it, otherwise the raw-feature vectors."""
    try:
        tables = load_index(spark, learned)
        if {"id", "vec"} <= set(tables["vectors"].columns):
            return tables, "learned"
    except (ValueError, PySparkException, Py4JJavaError) as e:
        log.warning("learned vectors at %s cannot be read (%s); using %s", learned, e, raw)
    return load_index(spark, raw), "raw"


def index_items(tables: dict[str, DataFrame]) -> DataFrame:
    """Vectors with their item columns; both tables are keyed by id."""
    return tables["items"].join(tables["vectors"], "id")


