"""Character n-gram TF-IDF: fit, transform and exact top-k.

tf = 1 + ln(count); idf = ln((1 + N) / (1 + df)) + 1; each row has length 1.
Texts are moved to their id's partition once; exploding, counting and regrouping then
need no further shuffle, which keeps the (many times larger) postings where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from cadenza.functions.text import GRAM_SIZES, token_sort, words
from cadenza.operators.blocks import TokenSort, block_top_k, compared
from cadenza.operators.grams import Vocabulary, best_texts, document_frequencies, unit_vectors
from cadenza.operators.impact import ImpactIndex, best_of_classes, impact_top_k
from cadenza.operators.joins import fits_broadcast, lookup_join, salted_join
from cadenza.operators.ordering import top_per_group
from cadenza.session import write_and_read


#: Bytes of text whose grams are counted in one task: their table of groups stays in its memory.
TASK_BYTES = 2 << 20
#: Rows and bytes of the fitted vocabulary, and of the grams of all queries, that go to every task of ``scan_top_k``.
FITTED_ROWS, FITTED_BYTES, ASKED_ROWS, ASKED_BYTES = 2_000_000, 128 << 20, 200_000, 16 << 20
#: Bytes of all texts of one repeated key that are put together in a row.
MERGED_BYTES = 16 << 20


def placed_texts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) in the partition of the key, in as many partitions as the bytes of all texts ask for."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size <= partitions * TASK_BYTES:
        return texts.select(key, text).repartition(key)
    return texts.select(key, text).repartition(-(-size // TASK_BYTES), key)


def gram_counts(texts: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """(key, gram, tf) with raw counts; a text's repeated words are cut into grams once."""
    placed = placed_texts(texts, key, text)
    by_word = (placed.select(key, F.explode(words(F.lower(text))).alias("_word"))
               .groupBy(key, "_word").agg(F.count("*").alias("_n")))
    low, high = GRAM_SIZES
    sized = by_word.select(key, "_n", F.concat(F.lit(" "), "_word", F.lit(" ")).alias("_w"),
                           F.explode(F.sequence(F.lit(low), F.lit(high))).alias("_size"))
    last = F.length("_w") - F.col("_size") + 1
    starts = sized.filter(last >= 1).select(key, "_n", "_w", "_size", F.explode(F.sequence(F.lit(1), last)).alias("_at"))
    # plain rows and substrings stay inside generated code; char_grams is the same as one expression
    return (starts.select(key, "_n", F.substring("_w", F.col("_at"), F.col("_size")).alias("gram"))
            .groupBy(key, "gram").agg(F.sum("_n").alias("tf")))


def counted_grams(texts: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """The same, written: for a table whose grams are both fitted and weighed."""
    return write_and_read(gram_counts(texts, key, text), "gram-counts")


def one_row_each(texts: DataFrame, key: str, text: str) -> DataFrame | None:
    """(key, text) with one row per key: texts of a repeated key are joined by a blank. None if a key has too many for a row."""
    texts = texts.select(key, text)
    sizes = texts.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("size"))
    most, largest = sizes.agg(F.max("n"), F.max(F.when(F.col("n") > 1, F.col("size")))).first()
    if (most or 0) <= 1:
        return texts
    if (largest or 0) > MERGED_BYTES:
        return None
    return texts.groupBy(key).agg(F.array_join(F.collect_list(F.lower(text)), " ").alias(text))


def sent_vocabulary(idf: DataFrame) -> Vocabulary | None:
    """The written vocabulary (gram, idf), if it measures small enough to go to every task."""
    if not fits_broadcast(idf, FITTED_ROWS, FITTED_BYTES):
        return None
    fitted = Vocabulary(idf.select("gram", "idf").toArrow())
    return fitted if fitted.alphabet.fits else None


def fit_idf(texts: DataFrame, key: str = "id", text: str = "text", grams: DataFrame | None = None, long: bool = False) -> DataFrame:
    """The fitted vocabulary (gram, df, idf), written once and read by every later step.

    ``long`` texts are counted in numpy where they lie, and no posting is made.
    """
    rows = one_row_each(texts, key, text) if long and grams is None else None
    n = texts.agg(F.count("*")).scalar()
    if rows is not None:
        df = document_frequencies(rows, text)
    else:
        grams = gram_counts(texts, key, text) if grams is None else grams
        df = grams.groupBy("gram").agg(F.count("*").alias("df"))
    return write_and_read(df.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1.0), "idf")


def weigh(grams: DataFrame, idf: DataFrame, key: str = "id") -> DataFrame:
    """(key, gram, raw weight); grams outside the vocabulary drop out."""
    joined = lookup_join(grams, idf.select("gram", "idf"), "gram", "inner", spread=[key], write=False)
    return joined.select(key, "gram", ((1.0 + F.log("tf")) * F.col("idf")).alias("w"))


def vectors(texts: DataFrame, idf: DataFrame, key: str = "id", text: str = "text",
            grams: DataFrame | None = None, long: bool = False) -> DataFrame:
    """(key, grams, weights): one unit-length sparse row per text that has a known gram.

    ``long`` texts are weighed in numpy where they lie, if the vocabulary, a written table, measures small.
    """
    if long and grams is None:
        rows = one_row_each(texts, key, text)
        fitted = sent_vocabulary(idf) if rows is not None else None
        if fitted is not None:
            return unit_vectors(rows, fitted, key, text)
    weighed = weigh(gram_counts(texts, key, text) if grams is None else grams, idf, key)
    # a list holds the grams of one text only
    rows = weighed.groupBy(key).agg(F.collect_list(F.struct("gram", "w")).alias("p"),
                                    F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.select(key, F.col("p.gram").alias("grams"),
                       F.transform("p", lambda p: p["w"] / F.col("norm")).alias("weights"))


def fit_index(texts: DataFrame, text: str = "text") -> tuple[ImpactIndex, DataFrame]:
    """The search index of items (id, text) and the vocabulary; a text is cut into grams once, however many items have it."""
    named = write_and_read(texts.select("id", F.sha2(F.col(text).cast("binary"), 256).alias("cls"), text), "index-texts")
    named = named.filter(F.col(text).isNotNull())
    once = write_and_read(named.groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("n"),
                                                   F.first(text).alias(text)), "index-once")
    counted = counted_grams(once, "cls", text)
    n = texts.agg(F.count("*")).scalar()
    df = counted.join(once.select("cls", "n"), "cls").groupBy("gram").agg(F.sum("n").alias("df"))
    idf = write_and_read(df.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1.0), "idf")
    rows = vectors(once, idf, "cls", grams=counted).join(once.select("cls", "least"), "cls")
    return ImpactIndex(named.select("cls", "id"), rows), idf


def postings(rows: DataFrame, key: str = "id") -> DataFrame:
    """(key, gram, weight) in long form."""
    return rows.select(key, F.explode(F.arrays_zip("grams", "weights")).alias("p")).select(
        key, F.col("p.grams").alias("gram"), F.col("p.weights").alias("weight"))


def tfidf_top_k(items: DataFrame, queries: DataFrame, idf: DataFrame, k: int, carry=(),
                index: ImpactIndex | None = None) -> DataFrame:
    """Best k items per query with a score above 0: (qid, id, score, carry..., rank).

    ``items`` holds vectors (id, grams, weights, carry...), ``queries`` is (qid, text); with the ``index`` of the
    items, which ``fit_index`` makes, only their id and the carried columns are read.
    """
    index = index or ImpactIndex.of_vectors(items)
    found = impact_top_k(index, queries, lambda texts: vectors(texts, idf, "q", "text"), k)
    if carry:
        found = found.join(items.select("id", *carry), "id")
    return found.select("qid", "id", "score", *carry, "rank")


def scan_top_k(texts: DataFrame, queries: DataFrame, k: int, text: str = "text") -> DataFrame:
    """The same from items (id, text) and queries (qid, text), for few queries and long texts: (qid, id, score, rank).

    No posting is made. Equal texts are cut once, where their class lies, for the fit and again for the scores; there
    they meet the vocabulary and the queries' grams, which travel if they measure small, and a task keeps the best k
    classes of each query. Beyond that, the items are indexed.
    """
    named = texts.filter(F.col(text).isNotNull()).select("id", F.sha2(F.col(text).cast("binary"), 256).alias("cls"), text)
    members = write_and_read(named.select("cls", "id"), "scan-members")
    once = named.groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first(text).alias(text))
    once = write_and_read(once, "scan-once")
    n = texts.agg(F.count("*")).scalar()
    df = document_frequencies(once, text, F.col("n"))
    idf = write_and_read(df.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1.0), "idf")

    queries = write_and_read(queries.select("qid", "text"), "scan-queries")
    distinct = queries.groupBy("text").agg(F.min("qid").alias("q"))
    asked = vectors(distinct, idf, "q", "text", long=True).filter(F.col("q").isNotNull())
    asked = write_and_read(asked.select("q", F.inline(F.arrays_zip(F.col("grams").alias("gram"), F.col("weights").alias("a")))), "scan-asked")
    fitted = sent_vocabulary(idf) if fits_broadcast(asked, ASKED_ROWS, ASKED_BYTES) else None
    if fitted is None:
        index, idf = fit_index(texts, text)
        return tfidf_top_k(texts, queries, idf, k, index=index)
    numbers = sorted(r["q"] for r in asked.select("q").distinct().collect())
    kind = T.StructType([T.StructField("_q", T.LongType()), T.StructField("q", asked.schema["q"].dataType)])
    numbers = texts.sparkSession.createDataFrame(list(enumerate(numbers)), kind)
    met = asked.join(F.broadcast(numbers), "q").select(F.col("_q").alias("q"), "gram", "a").toArrow()
    scored = best_texts(once, met, fitted, numbers.count(), k, ["cls", "least"], text).withColumnRenamed("q", "_q")
    best = top_per_group(scored, ["_q"], [compared("score"), F.col("least")], k).join(F.broadcast(numbers), "_q")
    classes = write_and_read(best.select("q", "cls", "score"), "scan-best")
    found = best_of_classes(classes, members, k).join(distinct, "q").drop("q")
    return lookup_join(queries, found, "text", "inner", spread=["qid"]).select("qid", "id", "score", "rank")


def query_gram_join(items: DataFrame, queries: DataFrame, idf: DataFrame) -> DataFrame:
    """(qid, id, score) of all queries and items that share a gram: postings joined on the gram.

    Items of equal vectors are joined once and follow their class at the end. Products are summed per pair, partly
    before the shuffle; grams of very many classes are salted.
    """
    index = ImpactIndex.of_vectors(items)
    asked = postings(vectors(queries, idf, "qid", "text"), "qid").withColumnRenamed("weight", "asked")
    met = salted_join(index.postings.select("gram", "cls", "w"), asked, "gram", spread=["cls"])
    pairs = met.groupBy("qid", "cls").agg(F.sum(F.col("w") * F.col("asked")).alias("score"))
    # a class may have most of the items: their rows are spread, its pairs copied
    return salted_join(index.members, write_and_read(pairs, "class-pairs"), "cls", spread=["id"]).select("qid", "id", "score")


def query_gram_stats(queries: DataFrame, idf: DataFrame) -> DataFrame:
    """Gram equi-join of queries with the fitted vocabulary: how much of a query the catalog knows.

    Postings are summed per gram before the join, so a common gram joins one row.
    """
    joined = lookup_join(gram_counts(queries, "qid", "text"), idf, "gram", "left", spread=["qid"], write=False)
    return joined.groupBy("qid").agg(
        F.count("*").alias("n_grams"), F.count("idf").alias("n_known"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("postings"),
        F.sum((1.0 + F.log("tf")) * F.col("idf")).alias("raw_weight"))


def fuzzy_top_k(items: DataFrame, queries: DataFrame, k: int, carry=(), **bounds) -> DataFrame:
    """Token-sort ratio of lower-cased queries (qid, text) against (id, text, carry...).

    Equal texts are measured once on both sides: of a text's items, k at most can be among the best k.
    """
    named = write_and_read(items.select("id", token_sort(F.col("text")).alias("sorted_text")), "fuzzy-items")
    asked = write_and_read(queries.select("qid", token_sort(F.lower("text")).alias("asked")).filter(F.col("asked").isNotNull()), "fuzzy-asked")
    texts = named.groupBy("sorted_text").agg(F.min("id").alias("id")).withColumn("text", F.col("sorted_text"))
    once = write_and_read(asked.groupBy("asked").agg(F.min("qid").alias("qid")), "fuzzy-once")
    best = block_top_k(texts, once.select("qid", F.col("asked").alias("sorted_text")), k, TokenSort(),
                       carry=("text",), **bounds)
    best = write_and_read(best.select("qid", F.col("text").alias("sorted_text"), "score").join(once, "qid").drop("qid"), "fuzzy-best")
    won = named.join(best.select("sorted_text").distinct(), "sorted_text", "left_semi")
    ids = top_per_group(won, ["sorted_text"], [F.col("id")], k)
    found = top_per_group(best.join(ids, "sorted_text"), ["asked"], [compared("score"), F.col("id")], k, rank="rank")
    found = lookup_join(asked, found.select("asked", "id", "score", "rank"), "asked", "inner", spread=["qid"])
    if carry:
        found = found.join(items.select("id", *carry), "id")
    return found.select("qid", "id", "score", *carry, "rank")
