"""Exact top-k of queries against a whole catalog, without a cross join.

Each task scores its own catalog rows against all queries in blocks and keeps only the
best k per query, so what leaves a task is (queries x k) rows however large the catalog
is. The query side is sent to the tasks when its measured size is small. Many vector queries are
answered by ``pruned``, which skips the blocks of rows that a bound excludes. Beyond the size bound, both
sides of other kernels are cut into hash blocks and every pair of blocks meets in one bounded task. All
ways are exact.

Scores are kept as they are but compared at 9 decimals and then by id, so the order in
which a task happens to add floats cannot change a rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadenza.operators.kernels import DECIMALS, Dot, TokenSort, _Best  # noqa: F401
from cadenza.operators.ordering import top_per_group
from cadenza.operators.pruned import MAX_BLOCKS, PrunedSearch
from cadenza.session import write_and_read

MAX_QUERY_ROWS = 50_000
MAX_QUERY_BYTES = 64 << 20
MAX_RESULT_ROWS = 2_000_000
BLOCK_ROWS = 50_000
BLOCK_BYTES = 128 << 20
#: Scores that make a task of its own worth while.
CELLS_PER_TASK = 40_000_000
#: Scores of vector queries from which clustering the catalog first pays, though one scan would do.
PRUNE_FROM = 10_000_000_000


def compared(score: str):
    """Sort order of a score: best first, at 9 decimals."""
    return F.round(score, DECIMALS).desc()


def _given(df: DataFrame, columns) -> DataFrame:
    # plain IS NOT NULL tests: the optimizer drops them where a column cannot be NULL
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def _measure(df: DataFrame, width) -> tuple[int, int]:
    row = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(row[0]), int(row[1])


def pruned_search(items: DataFrame, queries: DataFrame, k: int, n_items: int, n_queries: int, travelling: bool = True,
                  block_rows: int | None = None, carry=()) -> PrunedSearch:
    """A search over written items (id, vec, carry...) and queries (qid, vec[, exclude_id]), in as many tasks as its scores are worth."""
    partitions = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = -(-n_items // block_rows) if block_rows else None
    tasks = max(partitions, min(MAX_BLOCKS, -(-n_items * n_queries // CELLS_PER_TASK)))
    return PrunedSearch(items.select("id", "vec", *carry), queries, k, n_items, n_queries, travelling, tasks, n_blocks, carry)


def block_top_k(items: DataFrame, queries: DataFrame, k: int, kernel, *, carry=(), positive: bool = False,
                max_query_rows: int | None = None, block_rows: int | None = None, written: bool = False) -> DataFrame:
    """Best k items per query as (qid, id, score, carry..., rank).

    ``items`` has unique ``id`` plus the kernel's columns, ``queries`` unique ``qid`` plus the
    kernel's columns and, optionally, ``exclude_id``. ``carry`` names item columns to bring along,
    which saves joining the winners back to the catalog. ``positive`` keeps scores above 0 only.
    ``written`` says that ``items`` is a written table, which need not be written again to be read twice.
    """
    bounded = bool(block_rows)
    max_query_rows, block_rows = max_query_rows or MAX_QUERY_ROWS, block_rows or BLOCK_ROWS
    spark = items.sparkSession
    extra = [c for c in ("exclude_id",) if c in queries.columns]
    items = _given(items.select("id", *kernel.item_columns, *carry), ("id", *kernel.item_columns))
    queries = _given(queries, ("qid", *kernel.query_columns))
    queries = write_and_read(queries.select("qid", *extra, *kernel.query_columns), "queries")
    n_queries, n_bytes = _measure(queries, kernel.width())
    in_one_scan = n_queries <= max_query_rows and n_bytes <= MAX_QUERY_BYTES and n_queries * k <= MAX_RESULT_ROWS
    plain = [
        T.StructField("qid", queries.schema["qid"].dataType),
        T.StructField("id", items.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ]
    carried = [items.schema[c] for c in carry]
    if not n_queries:
        return spark.createDataFrame([], T.StructType(plain + carried)).withColumn("rank", F.lit(0))
    if isinstance(kernel, Dot) and not positive:
        items = items if written else write_and_read(items, "items")
        n_items = items.count()
        if not in_one_scan or n_items * n_queries >= PRUNE_FROM:
            # from a grid of tasks rows bring their carried columns along; they are met again by their id otherwise
            brought = () if in_one_scan else tuple(carry)
            best = pruned_search(items, queries, k, n_items, n_queries, in_one_scan, block_rows if bounded else None, brought).best()
            best = top_per_group(best, ["qid"], [compared("score"), F.col("id")], k, rank="rank")
            if carry and in_one_scan:
                best = best.join(items.select("id", *carry), "id")
            return best.select("qid", "id", "score", *carry, "rank")
    out = T.StructType(plain + carried if in_one_scan else plain)
    arrow_out = to_arrow_schema(out)

    if in_one_scan:
        local = spark.sparkContext.broadcast(queries.toArrow())

        def scan(batches):
            best = _Best(kernel, local.value, k, positive, arrow_out)
            for batch in batches:
                best.add(batch)
            yield from best.table().to_batches()

        # rows are scored where they lie; only a table in too few splits for its work is dealt out first
        n_items, splits = items.select(F.spark_partition_id().alias("split")).agg(
            F.count("*"), F.count_distinct("split")).first()
        tasks = -(-n_items * n_queries // CELLS_PER_TASK)
        spread = items if splits * 2 >= tasks else items.repartition(tasks, "id")
        found = spread.mapInArrow(scan, out)
    else:
        n_items, item_bytes = _measure(items, kernel.width())
        n_i = max(1, -(-n_items // block_rows), -(-item_bytes // BLOCK_BYTES))
        n_q = max(1, -(-n_queries // block_rows), -(-n_bytes // BLOCK_BYTES), -(-n_queries * k // MAX_RESULT_ROWS))

        def meet(key, left, right):
            best = _Best(kernel, right, k, positive, arrow_out)
            best.add(left)
            return best.table()

        # block sizes follow from the counts above; hashed unique ids fill them evenly
        def numbers(n):
            return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

        def renewed(df):
            # queries are often derived from the items: fresh columns keep the two sides apart
            return [F.col(c).alias(c) for c in df.columns]

        # carried columns stay behind and meet the winners, which are few
        scored = items.select("id", *kernel.item_columns)
        left = scored.select(F.pmod(F.xxhash64("id"), F.lit(n_i)).alias("_i"), numbers(n_q).alias("_q"), *renewed(scored))
        right = queries.select(numbers(n_i).alias("_i"), F.pmod(F.xxhash64("qid"), F.lit(n_q)).alias("_q"), *renewed(queries))
        found = left.groupBy("_i", "_q").cogroup(right.groupBy("_i", "_q")).applyInArrow(meet, out)
        best = top_per_group(found, ["qid"], [compared("score"), F.col("id")], k, rank="rank")
        if not carry:
            return best
        return best.join(items.select("id", *carry), "id").select("qid", "id", "score", *carry, "rank")
    return top_per_group(found, ["qid"], [compared("score"), F.col("id")], k, rank="rank")
