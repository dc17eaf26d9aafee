"""Exact top-k of sparse queries over postings that lie in bands of weight.

Items with equal vectors form one class, as they score alike: a class stands in the postings once, and at most
k of its ids can be among the best k. The postings of a gram are cut into bands of weight; a small table has
the largest weight and the number of postings of each band. A query first reads the bands of its largest
possible products until they hold a few times k postings; the scores of the classes in them give its
floor. After that it leaves out its weakest grams as long as all of them together stay below the floor, and
of the others every band with which a class could not reach it. Classes met are summed up, and only those that
can still reach the floor are scored in full.

All of it are joins and sums of Spark tables; what a task holds depends neither on the number of queries nor
on that of items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from cadenza.operators.kernels import DECIMALS, SLACK
from cadenza.operators.joins import lookup_join
from cadenza.operators.ordering import top_per_group
from cadenza.session import write_and_read

#: Bands of weights between 0 and 1, and postings read for a floor, in multiples of k.
BANDS, FIRST_READ = 64, 8
#: Grams scored in one numpy block.
CELLS = 1_000_000


class ImpactIndex:
    """Fitted tables: members (cls, id) and classes (cls, least, grams, weights), which are given, postings in bands, bands."""

    def __init__(self, members: DataFrame, classes: DataFrame):
        self.members, self.classes = members, write_and_read(classes.filter(F.size("grams") > 0), "impact-classes")
        posted = self.classes.select("cls", F.inline(F.arrays_zip(F.col("grams").alias("gram"), F.col("weights").alias("w"))))
        band = F.floor(F.col("w") * BANDS).cast("int")
        # read off the written classes, which costs less than a table of its own
        self.postings = posted.select("gram", band.alias("band"), "cls", "w")
        self.bands = write_and_read(self.postings.groupBy("gram", "band").agg(
            F.max("w").alias("top"), F.count("*").alias("n")), "impact-bands")

    @classmethod
    def of_vectors(cls, rows: DataFrame) -> ImpactIndex:
        """From items (id, grams, weights); weights are told apart at 12 decimals."""
        pairs = F.array_sort(F.arrays_zip("grams", "weights"))
        key = F.sha2(F.concat_ws("\x1f", F.transform(pairs, lambda p: F.concat(
            p["grams"], F.lit("\x1e"), F.round(p["weights"], 12).cast("string")))), 256)
        keyed = write_and_read(rows.select("id", key.alias("cls"), "grams", "weights"), "impact-rows")
        return cls(keyed.select("cls", "id"), keyed.groupBy("cls").agg(
            F.min("id").alias("least"), F.first("grams").alias("grams"), F.first("weights").alias("weights")))


def _dot(batches):
    """Scores of rows (q, cls, least, grams, weights, asked, impacts), each a query and a class."""
    for batch in batches:
        size = np.add(*(batch.column(c).value_lengths().to_numpy(zero_copy_only=False) for c in ("grams", "asked")))
        ends, at = np.cumsum(size), 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, "right")))
            part = batch.slice(at, stop - at)
            sides, n = [], part.num_rows
            for grams, weights in (("grams", "weights"), ("asked", "impacts")):
                column = part.column(grams)
                row = np.repeat(np.arange(n), column.value_lengths().to_numpy(zero_copy_only=False))
                sides.append((column.flatten(), row, part.column(weights).flatten().to_numpy(zero_copy_only=False)))
            both = pa.concat_arrays([s[0] for s in sides]).dictionary_encode()
            code, words = both.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(both.dictionary)
            cells = [row * words + c for (_, row, _), c in zip(sides, np.split(code, [len(sides[0][0])]))]
            order = np.argsort(cells[0])
            place = np.searchsorted(cells[0], cells[1], sorter=order)
            place = order[np.minimum(place, len(order) - 1)] if len(order) else place[:0]
            same = cells[0][place] == cells[1] if len(order) else np.zeros(len(cells[1]), bool)
            score = np.bincount(sides[1][1][same], (sides[0][2][place] * sides[1][2])[same], n)
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("q", "cls", "least")] + [pa.array(score)],
                                             ["q", "cls", "least", "score"])
            at = stop


class ImpactSearch:
    """One search of weighed queries (q, grams, weights), written; ``top`` has the rows, ``blocks_read`` what was read."""

    def __init__(self, index: ImpactIndex, queries: DataFrame, k: int):
        self.index, self.queries, self.k = index, queries, k
        asked = queries.select("q", F.inline(F.arrays_zip(F.col("grams").alias("gram"), F.col("weights").alias("a"))))
        best = F.max("bound").over(W.partitionBy("q", "gram"))
        bounded = asked.join(index.bands, "gram").withColumn("bound", F.col("a") * F.col("top")).withColumn("u", best)
        self.bands = write_and_read(bounded, "impact-asked")
        before = W.partitionBy("q").orderBy(F.desc("bound"), "gram", "band").rowsBetween(W.unboundedPreceding, -1)
        held = F.coalesce(F.sum("n").over(before), F.lit(0))
        first = self.bands.withColumn("held", held).filter(F.col("held") < FIRST_READ * k)
        met = first.join(index.postings, ["gram", "band"]).select("q", "cls").distinct()
        self.floors = write_and_read(top_per_group(self._scored(met), ["q"], self._order(), k, rank="rank")
                                     .filter(F.col("rank") == k).select("q", F.col("score").alias("floor")), "impact-floors")
        self.reached = self._reached()

    @staticmethod
    def _order() -> list:
        return [F.round("score", DECIMALS).desc(), F.col("least")]

    def _scored(self, met: DataFrame) -> DataFrame:
        """(q, cls, least, score) of pairs (q, cls), in full."""
        asked = self.queries.select("q", F.col("grams").alias("asked"), F.col("weights").alias("impacts"))
        full = met.join(self.index.classes, "cls").join(asked, "q")
        kind = T.StructType([met.schema["q"], T.StructField("cls", T.StringType()), self.index.classes.schema["least"],
                             T.StructField("score", T.DoubleType())])
        return full.select("q", "cls", "least", "grams", "weights", "asked", "impacts").mapInArrow(_dot, kind)

    def _reached(self) -> DataFrame:
        """Bands a query has to read, with its floor and what its weak grams can add to a class."""
        floor = F.coalesce("floor", F.lit(0.0)) - SLACK
        grams = self.bands.groupBy("q", "gram").agg(F.max("bound").alias("u")).join(self.floors, "q", "left")
        up = W.partitionBy("q").orderBy("u", "gram").rowsBetween(W.unboundedPreceding, 0)
        whole = W.partitionBy("q")
        sums = grams.select("q", "gram", floor.alias("floor"), F.sum("u").over(up).alias("upto"), F.col("u").alias("own"))
        strong = F.col("upto") >= F.col("floor")
        sums = sums.withColumn("total", F.max("upto").over(whole)).withColumn(
            "weak", F.coalesce(F.max(F.when(~strong, F.col("upto"))).over(whole), F.lit(0.0))).filter(strong)
        return self.bands.join(sums, ["q", "gram"]).filter(
            F.col("total") - F.col("own") + F.col("bound") >= F.col("floor")).select("q", "gram", "band", "a", "n", "floor", "weak")

    def blocks_read(self) -> DataFrame:
        """(q, bands, bands_read, postings, postings_read) after the floor is known."""
        total = self.bands.groupBy("q").agg(F.count("*").alias("bands"), F.sum("n").alias("postings"))
        read = self.reached.groupBy("q").agg(F.count("*").alias("bands_read"), F.sum("n").alias("postings_read"))
        return total.join(read, "q", "left")

    def top(self) -> DataFrame:
        """(q, id, score, rank): the best k ids with a score above 0, ties by id."""
        met = self.reached.join(self.index.postings, ["gram", "band"]).groupBy("q", "cls").agg(
            F.sum(F.col("a") * F.col("w")).alias("seen"), F.max("weak").alias("weak"), F.max("floor").alias("floor"))
        able = met.filter(F.col("seen") + F.col("weak") + SLACK >= F.col("floor")).select("q", "cls")
        scored = self._scored(able).filter(F.col("score") > 0)
        classes = write_and_read(top_per_group(scored, ["q"], self._order(), self.k).select("q", "cls", "score"), "impact-best")
        return best_of_classes(classes, self.index.members, self.k)


def best_of_classes(classes: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(q, id, score, rank) from each query's best classes (q, cls, score), written, and their members (cls, id)."""
    # k ids of each class that won, whatever the size of the class
    won = members.join(classes.select("cls").distinct(), "cls", "left_semi")
    ids = top_per_group(won, ["cls"], [F.col("id")], k)
    return top_per_group(classes.join(ids, "cls"), ["q"], [F.round("score", DECIMALS).desc(), F.col("id")], k,
                         rank="rank").select("q", "id", "score", "rank")


def impact_top_k(index: ImpactIndex, texts: DataFrame, weighed, k: int) -> DataFrame:
    """(qid, id, score, rank) for ``texts`` (qid, text): queries of one text are searched once.

    ``weighed`` gives (q, grams, weights) of a table (q, text).
    """
    texts = write_and_read(texts.select("qid", "text"), "impact-texts")
    once = texts.groupBy("text").agg(F.min("qid").alias("q"))
    queries = write_and_read(weighed(once).filter(F.size("grams") > 0), "impact-queries")
    found = ImpactSearch(index, queries, k).top().join(once, "q").drop("q")
    return lookup_join(texts, found, "text", "inner", spread=["qid"]).select("qid", "id", "score", "rank")
