"""Counts taken by the write of a deduplicated table, against plain counting."""

from pyspark.sql import functions as F

from cadenza.operators.ordering import keep_first, keep_first_counted
from cadenza.plans.catalog import deduplicated, preprocess

SCHEMA = "track_id string, ingest_seq bigint, name string, energy double"


def rows():
    out = [(f"t{i % 40}", i, None if i % 3 == 0 else f"n{i}", None if i % 4 == 0 else float(i)) for i in range(300)]
    return out + [(None, 500, "nameless key", 1.0), (None, 400, None, None), ("alone", None, "no order", 2.0)]


def test_counted_write_equals_keep_first(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(7)
    kept, seen = keep_first_counted(df, "track_id", missing=["name", "energy"])
    plain = keep_first(df, "track_id")
    assert kept.columns == plain.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    assert seen == {"n_before": 303, "n_after": 42, "n_removed": 261,
                    **{f"missing_{c}": plain.filter(F.col(c).isNull()).count() for c in ("name", "energy")}}


def test_nothing_to_write(spark):
    kept, seen = keep_first_counted(spark.createDataFrame([], SCHEMA), "track_id", missing=["name"])
    assert kept.count() == 0 and seen == {"n_before": 0, "n_after": 0, "n_removed": 0, "missing_name": 0}


def test_preprocess_of_a_reported_table(spark):
    df = spark.createDataFrame([r for r in rows() if r[0]], SCHEMA)
    kept, report = deduplicated(df)
    assert {r["measure"] for r in report.collect()} == {"n_before", "n_after", "n_removed", "missing_name", "missing_energy"}
    a, b = preprocess(df)[0], preprocess(kept, settle=False)[0]
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
