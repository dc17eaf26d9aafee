"""V01-V05: scaling and imputation."""

from pyspark.sql import functions as F

from cadenza.operators import clean
from cadenza.operators.vectors import normalized_vector
from cadenza.queries.aggregates import each
from cadenza.queries.base import FEATURES, R, TRACKS, query, rounded, table, tracks

SCALED = [c for c in FEATURES if c != "popularity"]


@query("v01_standard_scale", "WITH " + TRACKS + f""", s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in SCALED)} FROM tracks)
SELECT id, {', '.join(f"{R(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END')} AS {c}" for c in SCALED)}, {R('popularity')} AS popularity FROM tracks, s""")
def v01(spark, sf):
    scaled, _ = clean.scale(tracks(spark, sf).select("id", *FEATURES))
    return rounded(scaled)


@query("v01_scale_params", "WITH " + TRACKS + each(
    f"SELECT '{{c}}' AS feature, {R('avg({c})')} AS shift, {R('stddev_pop({c})')} AS scale FROM tracks", SCALED))
def v01_params(spark, sf):
    _, params = clean.scale(tracks(spark, sf).select("id", *FEATURES))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"shift_{c}").alias("shift"),
                              F.col(f"scale_{c}").alias("scale")) for c in SCALED])
    return rounded(params.select(F.explode(rows).alias("r")).select("r.*"))


@query("v02_minmax_scale", "WITH " + TRACKS + f""", s AS (SELECT {', '.join(f'min({c}) AS m_{c}, max({c}) - min({c}) AS s_{c}' for c in SCALED)} FROM tracks)
SELECT id, {', '.join(f"{R(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END')} AS {c}" for c in SCALED)}, {R('popularity')} AS popularity FROM tracks, s""")
def v02(spark, sf):
    scaled, _ = clean.scale(tracks(spark, sf).select("id", *FEATURES), "minmax")
    return rounded(scaled)


@query("v03_zscore_sample", "WITH " + TRACKS + f""", s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) + 1e-8 AS s_{c}' for c in FEATURES)} FROM tracks)
SELECT id, {', '.join(f"{R(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in FEATURES)} FROM tracks, s""")
def v03(spark, sf):
    return rounded(clean.zscore(tracks(spark, sf).select("id", *FEATURES), FEATURES, "sample"))


@query("v04_impute_median", "WITH " + TRACKS + f"""
SELECT id, name, {', '.join(f"{R(f'coalesce({c}, (SELECT median({c}) FROM tracks))')} AS {c}" for c in ('energy', 'valence', 'tempo'))} FROM tracks""")
def v04(spark, sf):
    return rounded(clean.impute(tracks(spark, sf).select("id", "name", "energy", "valence", "tempo"), "median"))


@query("v04_impute_most_frequent", "WITH " + TRACKS + """
SELECT id, """ + ", ".join(R(f"coalesce({c}, (SELECT {c} FROM tracks WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1))") + f" AS {c}" for c in ("energy", "valence")) + " FROM tracks")
def v04_frequent(spark, sf):
    return rounded(clean.impute(tracks(spark, sf).select("id", "energy", "valence"), "most_frequent"))


@query("v04_impute_constant", "WITH " + TRACKS + f"SELECT id, {R('coalesce(energy, 0)')} AS energy, {R('coalesce(valence, 0)')} AS valence FROM tracks")
def v04_constant(spark, sf):
    return rounded(clean.impute(tracks(spark, sf).select("id", "energy", "valence"), "constant"))


@query("v05_normalize_queries", f"""WITH s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) + 1e-8 AS s1, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) + 1e-8 AS s2 FROM lineitem)
SELECT p_partkey, {R('(p_size - m1) / s1')} AS z1, {R('(p_retailprice - m2) / s2')} AS z2 FROM part, s""")
def v05(spark, sf):
    stats = clean.column_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    asked = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").alias("l_quantity"), F.col("p_retailprice").alias("l_extendedprice"))
    z = clean.attach_row(asked, stats).select(
        "p_partkey", normalized_vector(["l_quantity", "l_extendedprice"], F.col("_stats")).alias("v"))
    return rounded(z.select("p_partkey", F.col("v")[0].alias("z1"), F.col("v")[1].alias("z2")))
