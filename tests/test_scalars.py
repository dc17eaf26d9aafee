"""Row-level expressions on boundary values."""

import pytest
from pyspark.sql import functions as F

from cadenza.functions import scalars as x
from cadenza.schema import MOODS, nan_to_null

COLUMNS = ["energy", "danceability", "tempo", "valence", "acousticness", "release_date", "all_genres"]
SCHEMA = ", ".join(f"{c} {'string' if c in ('release_date', 'all_genres') else 'double'}" for c in COLUMNS)
NAN = float("nan")

MOOD_CASES = [
    ((0.71, 0.71, 110.1, 0.1, 0.9, "2020", ""), "party"),
    ((0.70, 0.71, 110.1, 0.9, 0.1, "2020", ""), "neutral"),
    ((0.71, 0.70, 110.1, 0.9, 0.1, "2020", ""), "neutral"),
    ((0.71, 0.71, 110.0, 0.9, 0.1, "2020", ""), "neutral"),
    ((0.60, 0.60, 130.0, 0.349, 0.501, "2020", ""), "sad"),
    ((0.60, 0.60, 130.0, 0.35, 0.501, "2020", ""), "neutral"),
    ((0.60, 0.60, 130.0, 0.349, 0.5, "2020", ""), "neutral"),
    ((0.60, 0.60, 99.9, 0.4, 0.41, "2020", ""), "romantic"),
    ((0.60, 0.60, 99.9, 0.7, 0.41, "2020", ""), "romantic"),
    ((0.60, 0.60, 99.9, 0.701, 0.41, "2020", ""), "neutral"),
    ((0.60, 0.60, 99.9, 0.399, 0.41, "2020", ""), "neutral"),
    ((0.60, 0.60, 100.0, 0.5, 0.41, "2020", ""), "neutral"),
    ((0.60, 0.60, 99.9, 0.5, 0.4, "2020", ""), "neutral"),
    ((0.49, 0.59, 119.9, 0.51, 0.1, "2020", ""), "chill"),
    ((0.50, 0.59, 119.9, 0.51, 0.1, "2020", ""), "neutral"),
    ((0.49, 0.60, 119.9, 0.51, 0.1, "2020", ""), "neutral"),
    ((0.49, 0.59, 120.0, 0.51, 0.1, "2020", ""), "neutral"),
    ((0.49, 0.59, 119.9, 0.50, 0.1, "2020", ""), "neutral"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "1994-12-31", ""), "old_melody"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "1995", ""), "neutral"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "0", ""), "neutral"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "soon", ""), "neutral"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, None, "Rock; Golden OLDIES"), "old_melody"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "2020", "classic rock"), "old_melody"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "2020", "vintage jazz"), "old_melody"),
    ((0.60, 0.60, 130.0, 0.9, 0.1, "2020", "retrowave"), "old_melody"),
    ((NAN, 0.9, 130.0, 0.9, 0.1, "2020", None), "neutral"),
    ((0.9, NAN, 130.0, 0.9, 0.1, "2020", None), "neutral"),
    ((0.9, 0.9, NAN, 0.9, 0.1, "2020", None), "neutral"),
    ((None, 0.9, 130.0, 0.9, 0.1, "2020", None), "neutral"),
    ((0.6, 0.6, 130.0, None, 0.9, "2020", None), "neutral"),
    ((0.6, 0.6, 130.0, 0.1, NAN, "2020", None), "neutral"),
]


def test_mood_thresholds(spark):
    rows = [(i, *case) for i, (case, _) in enumerate(MOOD_CASES)]
    df = nan_to_null(spark.createDataFrame(rows, "i int, " + SCHEMA))
    got = {r["i"]: r["m"] for r in df.select("i", x.mood_rule(df.columns).alias("m")).collect()}
    assert [got[i] for i in range(len(rows))] == [want for _, want in MOOD_CASES]


def test_mood_defaults_for_absent_columns(spark):
    df = spark.createDataFrame([(0.9, 0.9), (0.1, 0.1)], "energy double, danceability double")
    # tempo defaults to 100, so the party rule cannot fire; valence and acousticness to 0.5
    assert {r[0] for r in df.select(x.mood_rule(df.columns)).collect()} == {"neutral"}


@pytest.mark.parametrize("value, want", [
    (1.5, "high"), (-1.5, "low"), (0.3, "mid"), (0.64, "mid"), (0.65, "high"), (-0.64, "mid"), (-0.65, "low")])
def test_feature_label(spark, value, want):
    assert spark.range(1).select(x.feature_label(F.lit(value), "high", "low", "mid")).first()[0] == want


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_release_year(spark):
    years = {"1999-01-02": 1999, "1999": 1999, "abc": None, "": None, " 2001 -x": 2001, "20x1": None}
    for text, want in years.items():
        assert one(spark, x.release_year(F.lit(text))) == want
    assert one(spark, x.bounded_release_year(F.lit("1899"))) is None
    assert one(spark, x.bounded_release_year(F.lit("1900"))) == 1900
    assert one(spark, x.bounded_release_year(F.lit("2025"))) == 2025
    assert one(spark, x.bounded_release_year(F.lit("2026"))) is None


@pytest.mark.parametrize("text", ["chill night drive", "lo-fi", "don't stop", "ABC def", "(x) y1z", "élan vital"])
def test_title_case_is_pythons(spark, text):
    assert one(spark, x.title_case(F.lit(text))) == text.title()


def test_percent(spark):
    def pct(z, mode="truncate"):
        return one(spark, x.percent_of_z(F.lit(z), mode))
    assert [pct(z) for z in (-9.0, -2.0, 0.0, 0.03, 1.9, 9.0)] == [5, 5, 50, 50, 95, 95]
    assert pct(0.03, "round") == 51
    with pytest.raises(ValueError):
        pct(0.0, "other")


def test_theme(spark):
    themes = {"": "chill", "GYM time": "energetic", "rainy day": "moody", "sweet talk": "romantic",
              "sad party": "energetic", "quiet": "chill"}
    for text, want in themes.items():
        assert one(spark, x.query_theme(F.lit(text))) == want


def test_standard_mood(spark):
    for mood, want in {"SAD": "sad", "Old_Melody": "old_melody", "focus": "neutral", None: "neutral"}.items():
        assert one(spark, x.standard_mood(F.lit(mood).cast("string"), MOODS)) == want


def test_finite_or_zero(spark):
    for v, want in ((1.5, 1.5), (float("inf"), 0.0), (float("-inf"), 0.0), (NAN, 0.0), (None, 0.0)):
        assert one(spark, x.finite_or_zero(F.lit(v).cast("double"))) == want


def test_explanation_order_and_cut(spark):
    df = spark.createDataFrame(
        [(0.91234, 0.5, 0.75, 0.5, 1.0, 0.0, -1.0)],
        "final_score double, similarity_score double, pop_score double, diversity_bonus double, "
        "energy double, valence double, danceability double")
    got = df.select(x.explanation(df.columns, F.lit("hybrid"), F.lit("two-tower hybrid"))).first()[0]
    assert got == ["ranked highly by the two-tower hybrid scorer (0.912)",
                   "strong vector similarity to the seed track (0.500)",
                   "popularity signal contributed 0.75", "artist diversity bonus 0.50"]
    vibe = df.select(F.col("final_score").alias("_search_score"), "energy", "valence", "danceability")
    got = vibe.select(x.explanation(vibe.columns, F.lit("vibe"), F.lit("any"))).first()[0]
    assert got == ["ranked highly by the any scorer (0.912)", "matches the requested vibe profile",
                   "high energy", "balanced mood"]
