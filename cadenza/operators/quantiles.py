"""Exact quantiles (linear interpolation) without holding a column's values in one task.

A state of one row per feature and group, with counts, moments, ends and a mergeable sketch, comes from one scan
and takes new rows in without a scan of the old. Its sketch brackets each wanted rank; in one more scan, values
outside the brackets collapse to counts before the shuffle, and only the distinct values inside a bracket are
ordered, as running sums over any number of tasks. A rank that fell outside its bracket lies in one of the
collapsed cells, whose values are ordered in a pass of their own: the sketch decides the work, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.operators.joins import lookup_join
from cadenza.operators.ordering import running
from cadenza.session import write_and_read

# size of a sketch, some 400 kB at most; its ranks are off by about 2.3 / SKETCH ** 0.9 of the rows
SKETCH = 16_384
SLACK = 6.0


def long_form(df: DataFrame, columns, by: str | None = None) -> DataFrame:
    """(by, feature, value) with missing values left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in columns])
    keep = [by] if by else []
    return (df.select(*keep, F.explode(pairs).alias("p"))
            .select(*keep, "p.feature", "p.value").filter(F.col("value").isNotNull()))


def quantile_state(df: DataFrame, columns, by: str | None = None) -> DataFrame:
    """(by, feature, n, mean, square, min, max, sketch) of every group, from one scan with map-side aggregation.

    ``square`` is the sum of squared deviations. Missing values count nowhere; a group without a value has
    n = 0, a null ``by`` is a group too. Store the state to merge it later.
    """
    columns = list(columns)
    aggregates = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        aggregates += [F.count(v).alias(f"_n{i}"), F.avg(v).alias(f"_mean{i}"), F.var_pop(v).alias(f"_var{i}"),
                       F.min(v).alias(f"_min{i}"), F.max(v).alias(f"_max{i}"),
                       F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias(f"_sketch{i}")]
    wide = (df.groupBy(by) if by else df).agg(*aggregates)
    rows = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"_n{i}").alias("n"), F.col(f"_mean{i}").alias("mean"),
        (F.col(f"_var{i}") * F.col(f"_n{i}")).alias("square"), F.col(f"_min{i}").alias("min"),
        F.col(f"_max{i}").alias("max"), F.col(f"_sketch{i}").alias("sketch")) for i, c in enumerate(columns)])
    return wide.select(*([by] if by else []), F.inline(rows))


def merge_states(states: DataFrame, by: str | None = None) -> DataFrame:
    """One state of many rows of states, such as those of days, per ``by`` and feature; without ``by`` over all groups."""
    parts = F.collect_list(F.when(F.col("n") > 0, F.struct(F.col("n").cast("double").alias("n"), "mean", "square")))

    def add(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"),
                        (a["square"] + b["square"] + gap * gap * a["n"] * b["n"] / n).alias("square"))

    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("square"))
    keys = ([by] if by else []) + ["feature"]
    merged = states.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.aggregate(parts, none, add).alias("_m"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("sketch"))
    return merged.select(*keys, "n", F.when(F.col("n") > 0, F.col("_m.mean")).alias("mean"),
                         F.when(F.col("n") > 0, F.col("_m.square")).alias("square"), "min", "max", "sketch")


def updated(state: DataFrame, new_rows: DataFrame, columns, by: str | None = None) -> DataFrame:
    """A stored state with ``new_rows`` taken in; the rows before are not read again."""
    return merge_states(state.unionByName(quantile_state(new_rows, columns, by)), by)


def _listed(df: DataFrame, by: str | None, groups) -> DataFrame:
    if not by:
        return df
    return df.filter(F.col(by).isin(*groups) if groups else F.col(by).isNotNull())


def _solve(df: DataFrame, columns, probs, by, groups, state: DataFrame | None,
           more=lambda low, high: []) -> tuple[DataFrame, DataFrame]:
    """The quantiles, and the ordered cells (keys, _rows, _cell, _min, _max, _n) they were read from.

    ``more`` gives further intervals, from the low and high ends of the brackets, in which every value is a cell of its own.
    """
    keys = ([by] if by else []) + ["feature"]
    state = write_and_read(quantile_state(_listed(df, by, groups), columns, by), "quantile-state") if state is None else state
    long = long_form(_listed(df, by, groups), columns, by)
    margin, m = SLACK / SKETCH ** 0.9, len(probs)
    marks = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(x)) for x in marks]))
    # sketches of empty groups cannot be asked
    brackets = _listed(state, by, groups).filter(F.col("feature").isin(*columns) & (F.col("n") > 0)).select(
        *keys, F.col("n").alias("_rows"), F.when(F.col("n") > 0, found).alias("_b"))
    brackets = write_and_read(brackets, "brackets")
    low, high = [F.col("_b")[i] for i in range(m)], [F.col("_b")[m + i] for i in range(m)]
    v, inside, cell = F.col("value"), F.lit(False), F.lit(0)
    for lo, hi in [*zip(low, high), *more(low, high)]:
        inside = inside | v.between(lo, hi)
        cell = cell + (v >= lo).cast("int") + (v > hi).cast("int")
    cells = (lookup_join(long, brackets, keys, "inner", write=False)
             .groupBy(*keys, "_rows", cell.alias("_cell"), F.when(inside, v).alias("_v"))
             .agg(F.count("*").alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max")).drop("_v"))
    cells = write_and_read(cells, "cells")
    summed = running(cells, [*keys, "_rows"], [F.col("_cell"), F.col("_min")], {"_to": "_n"}, rank="_nth")
    summed = summed.withColumn("_from", F.col("_to") - F.col("_n"))

    # the ranks below and above each quantile: two per probability
    ats = [F.lit(float(p)) * (F.col("_rows") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[side(at).cast("bigint") for at in ats for side in (F.floor, F.ceil)]))
    held = F.filter(ranks, lambda r: (r >= F.col("_from")) & (r < F.col("_to")))
    value = (F.when((F.col("_min") == F.col("_max")) | (F.col("_rank") == F.col("_from")), F.col("_min"))
             .when(F.col("_rank") == F.col("_to") - 1, F.col("_max")))
    hits = summed.select(*keys, "_rows", "_min", "_max", "_from", "_to", F.explode(held).alias("_rank")).withColumn("value", value)
    hits = write_and_read(hits, "rank-cells")
    missed = hits.filter("value IS NULL")
    known = hits.select(*keys, "_rows", "_rank", "value")
    if not missed.isEmpty():
        again = _inside_cells(long, missed, [*keys, "_rows"])
        known = known.filter("value IS NOT NULL").unionByName(again)
    picks = []
    for i, at in enumerate(ats):
        lower = F.max(F.when(F.col("_rank") == F.floor(at), F.col("value")))
        upper = F.max(F.when(F.col("_rank") == F.ceil(at), F.col("value")))
        picks.append((lower + (upper - lower) * (at - F.floor(at))).alias(f"q{i}"))
    return known.groupBy(*keys, "_rows").agg(*picks).withColumnRenamed("_rows", "n"), cells


def exact_quantiles(df: DataFrame, columns, probs, by: str | None = None, groups=None,
                    state: DataFrame | None = None) -> DataFrame:
    """(by, feature, n, q0, q1, ...) for each feature and each group of ``by``, or each of the listed ``groups``.

    ``state`` is the written ``quantile_state`` of these very rows, if there is one: it saves the first of two scans.
    """
    return _solve(df, columns, probs, by, groups, state)[0]


def exact_boxes(df: DataFrame, columns, by: str, groups=None, state: DataFrame | None = None, reach: float = 1.5) -> DataFrame:
    """(by, feature, n, q1, median, q3, whisker_low, whisker_high, n_outliers), whiskers at the last value within ``reach`` IQR.

    The cells keep the values apart where a fence may lie, too, so that whiskers and outliers come from the same
    scan as the quartiles; a fence inside a collapsed cell has that cell's values read again.
    """
    def fences(low, high):
        return [(low[0] - reach * (high[2] - low[0]), high[0] - reach * (low[2] - high[0])),
                (low[2] + reach * (low[2] - high[0]), high[2] + reach * (high[2] - low[0]))]

    keys = [by, "feature"]
    q, cells = _solve(df, columns, [0.25, 0.5, 0.75], by, groups, state, fences)
    q = q.select(*keys, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    span = reach * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - span, F.col("q3") + span
    near = (F.col("_min") >= low) & (F.col("_max") <= high)
    far = (F.col("_max") < low) | (F.col("_min") > high)
    box = [*keys, "_rows", "q1", "median", "q3"]
    # the cells of a key lie in order, so that at most two of them hold a fence between their ends
    judged = write_and_read(lookup_join(cells, q, keys, "inner").groupBy(*box).agg(
        F.min(F.when(near, F.col("_min"))).alias("whisker_low"), F.max(F.when(near, F.col("_max"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(far, F.col("_n"))), F.lit(0)).alias("n_outliers"),
        F.collect_list(F.when(~near & ~far, F.struct("_min", "_max"))).alias("_open")), "boxes")
    still = judged.filter(F.size("_open") > 0)
    if still.isEmpty():
        return judged.drop("_open").withColumnRenamed("_rows", "n")
    v = F.col("value")
    near = v.between(low, high)
    spots = still.select(*box, F.inline("_open"))
    rest = (lookup_join(long_form(_listed(df, by, groups), columns, by), spots, keys, "inner")
            .filter("value BETWEEN _min AND _max").groupBy(*box)
            .agg(F.min(F.when(near, v)).alias("whisker_low"), F.max(F.when(near, v)).alias("whisker_high"),
                 F.count_if(~near).alias("n_outliers")))
    return judged.drop("_open").unionByName(rest).groupBy(*box).agg(
        F.min("whisker_low").alias("whisker_low"), F.max("whisker_high").alias("whisker_high"),
        F.sum("n_outliers").alias("n_outliers")).withColumnRenamed("_rows", "n")


def _inside_cells(long: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _rank, value) of ranks somewhere inside a collapsed cell: its values are counted and summed up."""
    on = [k for k in keys if k in long.columns]
    spots = cells.select(*keys, "_rank", "_from", "_min", "_max")
    counted = (lookup_join(long, spots, on, "inner").filter("value BETWEEN _min AND _max")
               .groupBy(*keys, "_rank", "_from", "value").agg(F.count("*").alias("_n")))
    summed = running(write_and_read(counted, "cell-values"), [*keys, "_rank"], [F.col("value")], {"_to": "_n"}, rank="_nth")
    at = F.col("_rank") - F.col("_from")
    return summed.filter((at < F.col("_to")) & (at >= F.col("_to") - F.col("_n"))).select(*keys, "_rank", "value")


def medians(df: DataFrame, columns) -> DataFrame:
    """One row, one column per feature; an all-missing column stays NULL."""
    found = exact_quantiles(df, columns, [0.5])
    return found.agg(*[F.max(F.when(F.col("feature") == c, F.col("q0"))).alias(c) for c in columns])
