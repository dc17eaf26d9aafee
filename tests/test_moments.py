"""Mergeable moments and co-moments against a full fit in numpy."""

import numpy as np
import pytest

from cadenza.operators.moments import co_moments, correlations_of, moments_of, updated
from cadenza.session import write_and_read

COLUMNS = ["a", "b", "c", "flat", "none"]


def rows(seed, n):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n) + 1e7  # sums of squares would cancel
    b = 0.5 * (a - 1e7) + rng.normal(size=n)
    table = [[float(x), float(y), float(z), 3.0, None] for x, y, z in zip(a, b, rng.random(n))]
    for i, r in enumerate(table):
        if i % 7 == 0:
            r[i % 3] = None
        if i % 31 == 0:
            r[1] = float("nan")
    return table


def wanted(table):
    x = np.array([[np.nan if v is None else v for v in r] for r in table], float)
    out = {}
    for i, a in enumerate(COLUMNS):
        for j, b in enumerate(COLUMNS[:i]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            varies = both.sum() > 1 and np.ptp(x[both, i]) > 0 and np.ptp(x[both, j]) > 0
            out[a, b] = np.corrcoef(x[both, i], x[both, j])[0, 1] if varies else None
    return x, out


def check(state, table):
    x, pairs = wanted(table)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlations_of(state).collect()}
    assert got.keys() == pairs.keys()
    for pair, r in pairs.items():
        assert got[pair] == (None if r is None else pytest.approx(r, abs=1e-9))
    for r, column in zip(moments_of(state).collect(), x.T):
        have = column[~np.isnan(column)]
        assert r["n"] == len(have)
        if len(have):
            assert r["mean"] == pytest.approx(have.mean()) and r["std"] == pytest.approx(have.std(ddof=1), abs=1e-9)


@pytest.mark.parametrize("partitions", [1, 3, 29])
def test_against_numpy(spark, partitions):
    table = rows(1, 500)
    check(co_moments(spark.createDataFrame(table, ", ".join(f"{c} double" for c in COLUMNS)).repartition(partitions), COLUMNS), table)


def test_updated_state_equals_a_full_fit(spark):
    schema = ", ".join(f"{c} double" for c in COLUMNS)
    old, new = rows(2, 300), rows(3, 40)
    state = write_and_read(co_moments(spark.createDataFrame(old, schema), COLUMNS), "state")
    check(updated(state, spark.createDataFrame(new, schema)), old + new)


def test_no_rows(spark):
    empty = spark.createDataFrame([], ", ".join(f"{c} double" for c in COLUMNS))
    assert correlations_of(co_moments(empty, COLUMNS)).count() == 0
