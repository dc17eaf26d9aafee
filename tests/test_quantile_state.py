"""Mergeable quantile state against a full fit, and boxes whose fences fall outside their brackets."""

import numpy as np
import pytest

from cadenza.operators import profile, quantiles
from cadenza.operators.quantiles import exact_boxes, exact_quantiles, merge_states, quantile_state, updated
from cadenza.session import write_and_read

COLUMNS = ["v", "w", "none"]


def table(seed, n):
    rng = np.random.default_rng(seed)
    return [(int(k), float(v) + 1e6, None if i % 5 == 0 else float(w), None)
            for i, (k, v, w) in enumerate(zip(rng.integers(0, 3, n), rng.standard_cauchy(n), rng.integers(0, 9, n)))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v double, w double, none double")


def test_updated_state_equals_a_full_fit(spark):
    days = [table(s, 700) for s in range(3)]
    state = quantile_state(frame(spark, days[0]), COLUMNS, "k")
    for day in days[1:]:
        state = write_and_read(updated(write_and_read(state, "state"), frame(spark, day), COLUMNS, "k"), "state")
    rows = [r for day in days for r in day]
    df = frame(spark, rows)
    full = {(r["k"], r["feature"]): r for r in quantile_state(df, COLUMNS, "k").collect()}
    got = {(r["k"], r["feature"]): r for r in state.collect()}
    assert set(got) == set(full) and len(got) == 9
    for key, r in got.items():
        assert r["n"] == full[key]["n"]
        for part in ("mean", "square", "min", "max"):
            assert (r[part] is None) == (r["n"] == 0)
            assert r[part] is None or r[part] == pytest.approx(full[key][part], rel=1e-9)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for r in exact_quantiles(df, COLUMNS, probs, "k", state=state).collect():
        mine = [x[1 + COLUMNS.index(r["feature"])] for x in rows if x[0] == r["k"]]
        mine = [x for x in mine if x is not None]
        assert r["n"] == len(mine) and np.allclose([r[f"q{i}"] for i in range(5)], np.quantile(mine, probs), rtol=1e-12)


def test_groups_merge_to_the_whole(spark):
    rows = table(9, 900) + [(None, 5.0, 1.0, None)]
    df = frame(spark, rows)
    whole = write_and_read(merge_states(quantile_state(df, COLUMNS, "k")), "state")
    plain, given = profile.describe(df, COLUMNS), profile.describe(df, COLUMNS, whole)
    assert plain.columns == given.columns
    a, b = plain.orderBy("feature").collect(), given.orderBy("feature").collect()
    assert [r["feature"] for r in a] == ["v", "w"] == [r["feature"] for r in b]
    assert np.allclose([r[1:] for r in a], [r[1:] for r in b], rtol=1e-9)
    assert a[0]["std"] == pytest.approx(np.std([r[1] for r in rows], ddof=1))
    counted = [profile.histogram(df, ["v"], 7, s).orderBy("bin").select("n").collect() for s in (None, whole)]
    assert counted[0] == counted[1]


@pytest.mark.parametrize("sketch,slack", [(16384, 6.0), (8, 0.0), (8, 0.3)])
def test_boxes_whatever_the_brackets(spark, monkeypatch, sketch, slack):
    monkeypatch.setattr(quantiles, "SKETCH", sketch)
    monkeypatch.setattr(quantiles, "SLACK", slack)
    rows = table(4, 2500)
    got = {(r["k"], r["feature"]): r for r in exact_boxes(frame(spark, rows), COLUMNS, "k").collect()}
    assert set(got) == {(k, c) for k in range(3) for c in ("v", "w")}
    for (k, c), r in got.items():
        x = np.array([y[1 + COLUMNS.index(c)] for y in rows if y[0] == k and y[1 + COLUMNS.index(c)] is not None])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        near = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert np.allclose([r[p] for p in ("q1", "median", "q3", "whisker_low", "whisker_high")],
                           [q1, q2, q3, near.min(), near.max()], rtol=1e-12)
        assert (r["n"], r["n_outliers"]) == (len(x), len(x) - len(near))


def test_no_rows(spark):
    df = frame(spark, [])
    assert quantile_state(df, COLUMNS, "k").count() == 0
    assert [r["n"] for r in merge_states(quantile_state(df, COLUMNS)).collect()] == [0, 0, 0]
    assert exact_quantiles(df, COLUMNS, [0.5]).count() == 0
    assert exact_boxes(df, COLUMNS, "k").count() == 0
    assert profile.describe(df, COLUMNS).count() == 0
