"""The registered queries against their SQL at the smallest scale, and the pipeline against plain code."""

import hashlib

import pytest

import corpus_pipeline
from cadenza.llm.language import fit, predict
from cadenza.llm.queries import load_all
from cadenza.session import write_and_read
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_exact_dedup import brute as equal
from tests.llm.test_ngram_join import brute as similar
from tools.compare import connect, difference, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load_all()


def test_all_operators_and_the_pipeline():
    assert sorted(QUERIES) == sorted([n for n in QUERIES if n.startswith("op")] + ["pipeline"])
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    assert difference(spark_rows(QUERIES[name](spark, SF)), sql_rows(connect(SF), SQL[name])) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r for r in predict(docs, fit(docs)).collect()}
    alive = [(d, t) for d, t in rows if found[d]["lang_pred"] != "und"
             and found[d]["score"] >= corpus_pipeline.LEAST_LANGUAGE_SCORE]
    wanted = [alive]
    kept = equal(alive)
    alive = [(d, t) for d, t in alive if kept[d][2]]
    wanted.append(alive)
    groups = similar(alive)
    alive = [(d, t) for d, t in alive if groups[d][1] == d]
    wanted.append(alive)
    dirty = contaminated(alive, items)
    wanted.append([(d, t) for d, t in alive if not dirty[d][-1]])
    for (name, stage), expected in zip(corpus_pipeline.STAGES, wanted):
        docs = write_and_read(stage(spark, docs, SF), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == expected, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == {
        d: hashlib.sha256(t.encode()).hexdigest() for d, t in wanted[-1]}
    # hardly any document with text is rejected for its language
    assert len(wanted[0]) > 0.97 * sum(bool(t and t.strip()) for _, t in rows)
