"""The pipeline's stages on odd tables, and beside other users of their operators."""

import pytest

import corpus_pipeline
from cadenza.llm.exact_dedup import drop_duplicates
from cadenza.session import write_and_read

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, rid bigint"
BENCH = "/root/testdata/sf0.001"
ODD = [(1, "Und die.", None, "a", 8, "x", 7), (2, None, None, None, None, None, None), (3, "", "de", "a", 0, "x", 7),
       (4, "12 + 34", None, "b", 7, "y", 8), (None, "Ohne Nummer", None, "b", 11, "y", 8),
       (5, "Und die.", None, "c", 8, "z", 9), (5, "Und die.", None, "c", 8, "z", 9)]


@pytest.mark.parametrize("rows", [[], ODD])
def test_stages_on_odd_tables(spark, rows):
    """Null and repeated ids, null and empty texts, clashing columns; without a letter no document stays."""
    docs = spark.createDataFrame(rows, SCHEMA)
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = write_and_read(stage(spark, docs, BENCH), "test")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == ([4, 2, 2, 2] if rows else [0, 0, 0, 0])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, BENCH).count() == sizes[-1]


def test_no_labelled_row(spark):
    docs = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in ODD], SCHEMA)
    kept = corpus_pipeline.identified(spark, docs, BENCH)
    assert sorted(r["text"] for r in kept.collect()) == ["Ohne Nummer", "Und die.", "Und die.", "Und die."]


def test_copies_of_others_stay(spark):
    docs = spark.createDataFrame([r for r in ODD if r[0]], SCHEMA)
    mine = drop_duplicates(docs)
    write_and_read(corpus_pipeline.distinct(spark, docs, BENCH), "test")
    corpus_pipeline.dissimilar(spark, docs, BENCH)
    assert mine.count() == 3
