"""Exact top-k against brute force, both ways of meeting queries and catalog."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators.blocks import Dot, block_top_k
from cadenza.operators.vectors import nearest_items, nearest_to_vectors, unit

N, D = 700, 6


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(N, D)), 1)
    x[100:300] = x[0]  # a large tie
    x[5] = 0.0
    df = spark.createDataFrame([(f"t{i:04d}", [float(v) for v in r], f"n{i}") for i, r in enumerate(x)],
                               "id string, vec array<double>, name string")
    return df.repartition(5), x


def brute(x, q, k, skip=None):
    ids = np.array([f"t{i:04d}" for i in range(len(x))])
    s = np.round(x @ q, 9)
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != skip][:k]
    return [ids[i] for i in order]


def lists(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r["id"])
    return out


@pytest.mark.parametrize("bounds", [{}, {"max_query_rows": 10, "block_rows": 150}])
def test_nearest_items(data, bounds):
    df, x = data
    got = lists(nearest_items(df, df.select("id"), 5, **bounds))
    assert got == {f"t{i:04d}": brute(x, x[i], 5, f"t{i:04d}") for i in range(N)}


def test_cosine_and_zero_vector(data):
    df, x = data
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)
    got = lists(nearest_items(df, df.select("id"), 4, metric="cosine"))
    assert got == {f"t{i:04d}": brute(u, u[i], 4, f"t{i:04d}") for i in range(N)}


def test_fewer_items_than_k_and_unknown_seed(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id bigint, vec array<double>")
    seeds = spark.createDataFrame([(1,), (99,)], "id bigint")
    got = nearest_items(df, seeds, 10).collect()
    assert [(r["qid"], r["id"], r["score"]) for r in got] == [(1, 2, 2.0)]


def test_missing_and_nan_vectors_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None), (3, [float("nan")]), (4, [2.0])], "id bigint, vec array<double>")
    got = nearest_items(df, df.select("id"), 1).collect()
    assert sorted((r["qid"], r["id"]) for r in got) == [(1, 4), (4, 1)]


def test_no_queries(data):
    df, _ = data
    none = df.filter("false").select(F.col("id").alias("qid"), "vec")
    assert nearest_to_vectors(df, none, 3).count() == 0


def test_carried_columns_follow_their_row(data):
    df, _ = data
    got = block_top_k(df, df.select(F.col("id").alias("qid"), "vec"), 7, Dot(), carry=("name",))
    assert got.filter(F.col("name") != F.concat(F.lit("n"), F.substring("id", 2, 4).cast("int").cast("string"))).count() == 0


def test_unit(data):
    df, x = data
    got = df.select("id", unit(F.col("vec")).alias("u")).collect()
    for r in got:
        n = np.linalg.norm(r["u"])
        assert n == pytest.approx(0.0 if r["id"] == "t0005" else 1.0)


@pytest.mark.parametrize("bounds", [{}, {"max_query_rows": 10}, {"max_query_rows": 10, "block_rows": 25}, {"block_rows": 1000}])
def test_pruned_search_with_ties(data, monkeypatch, bounds):
    from cadenza.operators import blocks, pruned
    monkeypatch.setattr(blocks, "PRUNE_FROM", 0)
    monkeypatch.setattr(pruned, "CELLS", 500)
    monkeypatch.setattr(pruned, "PENDING_ROWS", 50)
    monkeypatch.setattr(pruned, "QUERIES_PER_MEETING", 40)
    df, x = data
    got = lists(nearest_items(df, df.select("id"), 5, **bounds))
    assert got == {f"t{i:04d}": brute(x, x[i], 5, f"t{i:04d}") for i in range(N)}


def test_bounds_hold_and_exclude_blocks(spark):
    from cadenza.operators.blocks import pruned_search
    from cadenza.session import write_and_read
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(30, 8)) * 5
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 8)) * 0.3
    items = write_and_read(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>"), "t")
    queries = write_and_read(items.select(F.col("id").alias("qid"), F.col("id").alias("exclude_id"), "vec"), "t")
    search = pruned_search(items, queries, 3, 3000, 3000)
    visits = search.visits().agg(F.sum("n_visited"), F.sum("n_blocks"), F.count("*")).first()
    assert visits[2] == 3000 and visits[0] < 0.4 * visits[1]
    # no row scores above its block's bound
    known = search.bounds.value
    for r in search.clustered.limit(500).collect():
        v = np.array(r["vec"])
        assert (x[:50] @ v <= known.upper(x[:50], np.linalg.norm(x[:50], axis=1), [r["block"]])[:, 0]).all()


def test_pruned_search_of_one_repeated_vector(spark, monkeypatch):
    from cadenza.operators import blocks
    monkeypatch.setattr(blocks, "PRUNE_FROM", 0)
    df = spark.createDataFrame([(i, [1.0, 0.0] if i % 3 else [float(i), 1.0]) for i in range(400)] + [(900, [float("nan"), 1.0])],
                               "id bigint, vec array<double>")
    got = lists(nearest_items(df, df.filter("id < 30"), 4, block_rows=20))
    by_id = {i: (1.0, 0.0) if i % 3 else (float(i), 1.0) for i in range(400)}
    score = lambda a, b: sum(x * y for x, y in zip(by_id[a], by_id[b]))
    assert got == {q: sorted((i for i in by_id if i != q), key=lambda i: (-score(q, i), i))[:4] for q in range(30)}


def test_many_queries_write_no_row_per_query_and_block(spark, monkeypatch):
    from cadenza.operators import pruned
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 24))  # nothing is excluded by a bound
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>")
    seen = []

    def counted(table, name, write=pruned.write_and_read):
        out = write(table, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(pruned, "write_and_read", counted)
    monkeypatch.setattr(pruned, "SIDE_ROWS", 300)
    monkeypatch.setattr(pruned, "WINNERS", 500)
    got = lists(nearest_items(df, None, 4, max_query_rows=10))
    for i in (0, 7, 1199):
        s = x @ x[i]
        s[i] = -np.inf
        assert got[i] == np.argsort(-s)[:4].tolist()
    assert len(got) == 1200 and max(n for _, n in seen) <= 10 * 1200


def test_grid_sides_are_bounded():
    from cadenza.operators import pruned
    for n, width, k in ((102_564, 64, 101), (615_384, 64, 11), (1_200_000, 9, 10), (7_200_000, 9, 1)):
        parts, groups = pruned.grid_shape(n, n, width, k, 96)
        assert parts * groups >= 96
        assert n / parts * width * 8 <= pruned.SIDE_BYTES * 1.01 and n / groups * width * 8 <= pruned.SIDE_BYTES * 1.01
        assert n / groups * k <= pruned.WINNERS * 1.01
        assert (parts + groups) * n * (8 * width + pruned.ROW_BYTES) < 70e9


def test_grid_has_a_cell_per_core_and_writes_its_blocks_only(spark, monkeypatch):
    from cadenza.operators import blocks, pruned
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 5))
    x[700:] = x[0]  # more rows of one vector than are wanted
    df = spark.createDataFrame([(i, v.tolist(), f"n{i}") for i, v in enumerate(x)], "id bigint, vec array<double>, name string")
    written, shapes = [], []
    monkeypatch.setattr(blocks, "CELLS_PER_TASK", 100)
    monkeypatch.setattr(pruned, "write_and_read", lambda t, name, write=pruned.write_and_read: written.append(name) or write(t, name))
    monkeypatch.setattr(pruned, "_grid", lambda *given, grid=pruned._grid: shapes.append(given[4]) or grid(*given))
    asked = df.select(F.col("id").alias("qid"), F.col("id").alias("exclude_id"), "vec")
    got = block_top_k(df, asked, 6, Dot(), carry=("name",), max_query_rows=10).collect()
    s = np.round(x @ x.T, 9)
    np.fill_diagonal(s, -np.inf)
    assert {(r["qid"], r["rank"], r["id"], r["name"]) for r in got} == {
        (i, n + 1, j, f"n{j}") for i in range(900) for n, j in enumerate(np.lexsort((np.arange(900), -s[i]))[:6].tolist())}
    assert written == ["blocks"]
    assert np.prod(shapes[0]) < 2 * spark.sparkContext.defaultParallelism


def test_bound_by_distance():
    from cadenza.operators.pruned import Bounds
    rng = np.random.default_rng(6)
    unit = lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    rows = unit(rng.normal(size=(1, 6)) + 0.2 * rng.normal(size=(50, 6)))
    centre = rows.mean(axis=0)
    known = Bounds(centre[None], np.array([np.linalg.norm(rows - centre, axis=1).max()]), np.array([1.0]), np.array([50]))
    queries = unit(rng.normal(size=(300, 6)))
    upper = known.upper(queries, np.ones(300))[:, 0]
    assert (upper >= (queries @ rows.T).max(axis=1)).all()
    plain = np.minimum(queries @ centre + known.radius[0], 1.0)
    assert (upper <= plain + 1e-9).all() and (upper < plain - 0.02).mean() > 0.05
