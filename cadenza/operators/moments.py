"""Counts, means and co-moments of columns as a state that merges: one row per partition, then one in all.

For every pair of columns the state has the rows in which both are present, both means over them, both sums
of squared deviations and the sum of products of deviations. States are merged by the pairwise formula, which
stays accurate where sums of squares would cancel; a stored state takes new rows in without a scan of the old.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCHEMA = "columns array<string>, n array<double>, mean array<double>, square array<double>, product array<double>"
PARTS = ("n", "mean", "square", "product")


def _of(x: np.ndarray) -> list[np.ndarray]:
    """State of rows: entry (i, j) is about column i over the rows where j is present too."""
    here = ~np.isnan(x)
    # deviations from a value near all of them, so that sums stay small
    with np.errstate(invalid="ignore"):
        shift = np.where(here.any(axis=0), np.where(here, x, 0.0).sum(axis=0) / np.maximum(here.sum(axis=0), 1), 0.0)
    d, m = np.where(here, x - shift, 0.0), here.astype(float)
    n = m.T @ m
    off = np.divide(d.T @ m, n, out=np.zeros_like(n), where=n > 0)
    return [n, np.where(n > 0, off + shift[:, None], 0.0), (d * d).T @ m - n * off * off, d.T @ d - n * off * off.T]


def merge(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    n = a[0] + b[0]
    gap = b[1] - a[1]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    mean = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + gap * share))
    weight = a[0] * share
    return [n, mean, a[2] + b[2] + gap * gap * weight, a[3] + b[3] + gap * gap.T * weight]


def _row(columns, state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([columns], pa.list_(pa.string()))] + [
        pa.array([part.ravel().tolist()], pa.list_(pa.float64())) for part in state], ["columns", *PARTS])


def _merged(batches):
    columns = total = None
    for batch in batches:
        for row in batch.to_pylist():
            columns, p = row["columns"], len(row["columns"])
            state = [np.array(row[part]).reshape(p, p) for part in PARTS]
            total = state if total is None else merge(total, state)
    if columns is not None:
        yield _row(columns, total)


def merge_states(states: DataFrame) -> DataFrame:
    """One state of all, merged as it streams by: first in as many tasks as a shuffle has, then in one."""
    tasks = int(states.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return states.repartition(tasks).mapInArrow(_merged, SCHEMA).repartition(1).mapInArrow(_merged, SCHEMA)


def co_moments(df: DataFrame, columns) -> DataFrame:
    """The state of ``df``, from one scan; null and NaN are missing. No row if the table has none."""
    columns = list(columns)

    def fit(batches):
        total = None
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            total = _of(x) if total is None else merge(total, _of(x))
        if total is not None:
            yield _row(columns, total)

    return merge_states(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(fit, SCHEMA))


def updated(state: DataFrame, new_rows: DataFrame) -> DataFrame:
    """A stored state with ``new_rows`` taken in; the rows before are not read again."""
    columns = state.first()["columns"]
    return merge_states(state.unionByName(co_moments(new_rows, columns)))


def correlations_of(state: DataFrame) -> DataFrame:
    """(feature_a, feature_b, r): the lower triangle; null where a column does not vary or fewer than two rows have both."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = len(row["columns"])
                n, _, square, product = (np.array(row[part]).reshape(p, p) for part in PARTS)
                pairs = [(i, j) for i in range(p) for j in range(i)]
                r = [float(np.clip(product[i, j] / np.sqrt(square[i, j] * square[j, i]), -1, 1))
                     if n[i, j] > 1 and square[i, j] > 0 and square[j, i] > 0 else None for i, j in pairs]
                yield pa.RecordBatch.from_arrays([pa.array([row["columns"][i] for i, _ in pairs], pa.string()),
                                                  pa.array([row["columns"][j] for _, j in pairs], pa.string()),
                                                  pa.array(r, pa.float64())], ["feature_a", "feature_b", "r"])

    return state.mapInArrow(read, "feature_a string, feature_b string, r double")


def moments_of(state: DataFrame) -> DataFrame:
    """(feature, n, mean, std): ``std`` is the sample deviation, null below two values."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = len(row["columns"])
                n, mean, square, _ = (np.diag(np.array(row[part]).reshape(p, p)) for part in PARTS)
                std = [float(np.sqrt(max(s, 0.0) / (k - 1))) if k > 1 else None for s, k in zip(square, n)]
                yield pa.RecordBatch.from_arrays([pa.array(row["columns"]), pa.array(n.astype(np.int64)),
                                                  pa.array([float(m) if k else None for m, k in zip(mean, n)], pa.float64()),
                                                  pa.array(std, pa.float64())], ["feature", "n", "mean", "std"])

    return state.mapInArrow(read, "feature string, n bigint, mean double, std double")
