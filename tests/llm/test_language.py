import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cadenza.llm import language
from cadenza.llm.language import Network, fit, held_out, keep_identified, pieces_of, predict, sample, train
from tests.llm.helpers import by_id

SF = "/root/testdata/sf0.001"


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    net = Network.fresh(["a", "b", "c"], 4)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    codes, labels = rng.integers(97, 103, (5, 6)), rng.integers(0, 3, 6)
    _, gradients = net.gradients(codes, labels)
    for name, weight in net.weights.items():
        spots = np.argwhere(np.abs(gradients[name]) > 1e-3)[:6]
        assert len(spots)
        for spot in map(tuple, spots):
            old, losses = weight[spot], []
            for step in (1e-2, -1e-2):
                weight[spot] = old + step
                losses.append(net.gradients(codes, labels)[0])
            weight[spot] = old
            assert abs((losses[0] - losses[1]) / 2e-2 - gradients[name][spot]) < 2e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: (r["lang"], r["held"]) for r in docs.select("*", held_out(F.col("doc_id")).alias("held")).collect()}
    found = by_id(predict(docs, fit(docs, steps=300)))
    held = [found[d]["lang_pred"] == lang for d, (lang, out) in truth.items() if out]
    assert len(held) > 20 and sum(held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_held_out_documents_are_never_sampled(spark, make_docs):
    import zlib
    rows = [(i, f"text{i}", "en") for i in range(200)] + [(500, "z" * 50_000, "en"), (501, "q", None)]
    texts = {t.decode() for _, t in sample(make_docs(rows), per_language=10**6)}
    wanted = {f"text{i}" for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert texts == wanted
    assert len(sample(make_docs(rows), per_language=7)) == 7


def tiny():
    return train([("en", b"the and of with this that which there"), ("fr", "été où ça élève près là".encode())], steps=150)


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "é"), (5, "with the"), (5, "with the"), (None, "x" * 5000 + " 1")]
    got = predict(make_docs(rows), tiny()).collect()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == 7
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[4][0] == "fr" and found[5][0] == "en" and found[None][0] in ("en", "fr")
    kept = keep_identified(make_docs(rows), tiny(), 0.0)
    assert kept.columns == make_docs(rows).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 4, 5, 5]
    assert predict(make_docs([]), tiny()).count() == 0
    assert fit(make_docs([(1, "a", None)])) is None
    assert [r["lang_pred"] for r in predict(make_docs([(1, "abc")]), None).collect()] == ["und"]


def test_every_position_counts_once():
    net = tiny()
    assert pieces_of(b"ab " + b"c" * 100) == [b"ab", b"c" * 48, b"c" * 48, b"c" * 4]
    sums = net.word_sums([b"the", b"of", b"the"])
    assert np.allclose(sums[0], sums[2]) and sums[:, -1].tolist() == [3, 2, 3]
    assert np.allclose(sums[:, :-1].sum(axis=1), sums[:, -1], atol=1e-4)
    both = net.positions(np.frombuffer(b"the", np.uint8).reshape(1, 3).T)
    assert np.allclose(both[:, 0].sum(axis=0), sums[0, :-1], atol=1e-5)
    assert language.HIDDEN > 0


def test_texts_run_as_a_whole():
    net = tiny()
    texts = [b"the", b"the and of", "là the  été\nthe".encode(), b"de la de", b""]
    sums = net.word_sums(texts)
    for text, got in zip(texts[:-1], sums):
        whole = net.positions(np.frombuffer(text, np.uint8).reshape(1, -1).T)[:, 0].sum(axis=0)
        assert np.allclose(got[:-1], whole, atol=1e-4) and got[-1] == len(text)
    assert not sums[-1].any()
    rows = language.Predictor(net).rows(pa.array([t.decode() for t in texts]))
    assert all(abs(score - got[:-1].max() / got[-1]) < 1e-6 for (_, score), got in zip(rows[:-1], sums))
    # the surroundings of a word that both languages may have count
    alone, among = (net.word_sums([t])[0] for t in (b"on", "là on là".encode()))
    parts = sum(net.word_sums([w])[0] for w in "là on là".encode().split())
    assert alone[-1] == 2 and abs(among[:-1] / among[-1] - parts[:-1] / parts[-1]).max() > 1e-3


def test_stretches_cut_between_characters_and_equal_the_whole(spark):
    text = "日本語の文章".encode() * 1500 + "é".encode() * 1000 + b"a" * 3000
    cuts = language.stretches(text)
    assert len(cuts) > 10 and cuts[0][1] == 0 and cuts[-1][2] == len(text)
    assert all(a[2] == b[1] for a, b in zip(cuts, cuts[1:]))
    for cut in cuts:
        text[cut[0]:cut[3]].decode(), text[cut[1]:cut[2]].decode()
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["lang"] and r["text"]]
    net = train([(lang, t.encode()) for lang, t in rows[:100]], steps=200)
    long_ = sorted((t.encode() for _, t in rows), key=len)[-5:]
    assert min(map(len, long_)) > 2 * language.STRETCH
    for text, got in zip(long_, net.word_sums(long_)):
        whole = net.positions(np.frombuffer(text, np.uint8).reshape(1, -1).T)[:, 0].sum(axis=0)
        assert abs(got[:-1] - whole).max() / len(text) < 1e-3


def test_sample_has_different_texts_and_parts_of_long_ones(make_docs):
    long_ = "".join(chr(0x3041 + i // 1000) * 2 for i in range(30_000))
    rows = [(i, "one copy", "en") for i in range(300)] + [(1000 + i, f"text{i}", "en") for i in range(20)]
    rows += [(2000 + i, long_, "ja") for i in range(10)]
    got = sample(make_docs(rows), per_language=12, parts=8)
    short = [t for lang, t in got if lang == "en"]
    assert len(short) == len(set(short)) == 12
    taken = [t.decode() for lang, t in got if lang == "ja"]
    assert len(taken) == 8 and all(len(t) == language.SAMPLE_CHARS // 8 and t in long_ for t in taken)
    assert any(t.startswith(long_[:100]) for t in taken) and any(t.endswith(long_[-100:]) for t in taken)
    assert fit(make_docs(rows), steps=2).languages == ["en", "ja"]
