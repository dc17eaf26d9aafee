"""Committed versions of table sets: damage anywhere is found, and the last whole version is read."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cadenza.session import scratch_path
from cadenza.sources import readers, versions, writers


@pytest.fixture
def tables(spark):
    def make(add):
        vectors = spark.range(0, 400, 1, 5).select(F.col("id").cast("string").alias("id"), F.array(F.col("id") + F.lit(add)).cast("array<double>").alias("vec"))
        return vectors, vectors.select("id", F.lit("n").alias("name")), vectors.agg(F.count("*").alias("n"))
    return make


def files(path, table, version):
    return sorted(glob.glob(f"{path}/{table}/version={version}/part-*.parquet"))


def first_values(found):
    return sorted(r["vec"][0] for r in found["vectors"].collect())


def overwrite(name, content):
    os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
    with open(name, "wb") as f:
        f.write(content)


def test_third_file_damaged_falls_back(spark, tables):
    learned, raw = scratch_path(spark, "learned"), scratch_path(spark, "raw")
    writers.save_index(raw, *tables(1000))
    writers.save_index(learned, *tables(0))
    writers.save_index(learned, *tables(1))
    found, kind = readers.load_index_or_fallback(spark, learned, raw)
    assert kind == "learned" and first_values(found) == [float(i + 1) for i in range(400)]

    third = files(learned, "vectors", 2)[2]
    with open(third, "rb") as f:
        content = bytearray(f.read())
    content[len(content) // 2] ^= 1
    overwrite(third, bytes(content))
    assert [tuple(r)[::2] for r in versions.damage(spark, learned, 2, readers.INDEX_TABLES).collect()] == [("vectors", "changed")]
    found, kind = readers.load_index_or_fallback(spark, learned, raw)
    # the version before is whole
    assert kind == "learned" and first_values(found) == [float(i) for i in range(400)]

    os.remove(files(learned, "items", 1)[0])
    found, kind = readers.load_index_or_fallback(spark, learned, raw)
    assert kind == "raw" and first_values(found) == [float(i + 1000) for i in range(400)]


def test_added_files_and_unfinished_commits_do_not_count(spark, tables):
    path = scratch_path(spark, "index")
    writers.save_index(path, *tables(0))
    # a second version whose manifest was never written
    tables(9)[0].write.parquet(f"{path}/vectors/version=2")
    assert first_values(readers.load_index(spark, path))[0] == 0.0
    assert writers.save_index(path, *tables(5)) == 2
    assert first_values(readers.load_index(spark, path)) == [float(i + 5) for i in range(400)]
    tables(9)[0].limit(1).write.mode("append").parquet(f"{path}/vectors/version=2")
    assert {r["fault"] for r in versions.damage(spark, path, 2, readers.INDEX_TABLES).collect()} == {"not listed"}
    assert first_values(readers.load_index(spark, path))[0] == 0.0


def test_manifest_lists_files_rows_and_schema(spark, tables):
    path = scratch_path(spark, "index")
    writers.save_index(path, *tables(0))
    listed = spark.read.parquet(f"{path}/manifests/version=1")
    assert {r["table"]: r["n"] for r in listed.groupBy("table").agg(F.sum("rows").alias("n")).collect()} == {
        "vectors": 400, "items": 400, "feature_stats": 1}
    found = readers.load_index(spark, path)
    assert dict(found["vectors"].dtypes) == {"id": "string", "vec": "array<double>"}


def test_nothing_there(spark):
    with pytest.raises(ValueError):
        readers.load_index(spark, scratch_path(spark, "none"))
