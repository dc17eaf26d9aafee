"""Mood-phrase queries: keyword detection and search by target feature profile."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from cadenza.functions.text import TextBlock, strip, token_sort
from cadenza.operators.blocks import Dot, block_top_k, compared
from cadenza.operators.clean import EPSILON
from cadenza.operators.ordering import top_per_group
from cadenza.schema import FEATURES9

# Trigger keywords per profile, in match order.
VIBE_KEYWORDS = {
    "gym": ["gym", "workout", "running", "hype", "pump", "beast", "intense",
            "aggressive", "power", "training", "cardio", "crossfit"],
    "party": ["party", "club", "dance", "turn up", "disco", "rave", "edm",
              "nightclub", "festival", "banger"],
    "chill": ["chill", "chillout", "relax", "night drive", "lofi", "lo-fi",
              "mellow", "laid back", "evening", "calm", "smooth", "vibes",
              "late night", "drive", "cruise", "sunday"],
    "focus": ["focus", "study", "coding", "concentrate", "work", "productivity",
              "reading", "deep work", "ambient", "background"],
    "sad": ["sad", "sadness", "heartbreak", "crying", "depressed", "breakup",
            "lonely", "melancholy", "emotional", "hurt", "miss", "missing",
            "tearful", "grief"],
    "romantic": ["romantic", "romance", "love", "date", "date night", "dinner",
                 "anniversary", "slow dance", "intimate", "couples"],
    "happy": ["happy", "feel good", "upbeat", "joy", "joyful", "good vibes",
              "positive", "sunshine", "bright", "cheerful", "fun"],
    "acoustic": ["acoustic", "unplugged", "guitar", "folk", "singer songwriter",
                 "indie folk", "campfire", "raw", "stripped"],
    "motivation": ["motivation", "motivational", "inspiring", "inspirational",
                   "hustle", "grind", "success", "boss", "confidence"],
    "sleep": ["sleep", "sleeping", "meditation", "meditate", "relax deep",
              "spa", "peace", "peaceful", "tranquil", "zen", "breathe"],
}
# Target z-scores per profile, in the order of FEATURES9.
VIBE_TARGETS = {
    "gym": [1.0, 2.0, 0.5, 1.5, 0.5, -1.5, -1.0, 0.3, 0.5],
    "party": [2.0, 1.5, 1.5, 1.0, 0.3, -1.5, -1.0, 0.5, 0.8],
    "chill": [0.0, -1.2, 0.3, -1.0, -0.5, 1.0, 0.5, -0.5, 0.3],
    "focus": [-0.8, -1.5, 0.0, -1.2, -1.0, 1.2, 2.0, -0.8, 0.0],
    "sad": [-0.8, -1.5, -2.0, -1.2, -0.3, 1.2, -0.3, -0.5, 0.3],
    "romantic": [0.0, -0.8, 0.5, -1.0, -0.5, 0.8, -0.3, -0.5, 0.5],
    "happy": [1.0, 0.8, 2.0, 0.5, 0.0, -0.5, -0.5, 0.3, 0.8],
    "acoustic": [-0.3, -1.2, 0.3, -0.8, -0.5, 2.0, 0.3, 0.0, 0.0],
    "motivation": [0.8, 1.5, 0.8, 1.0, 0.8, -1.2, -0.8, 0.5, 0.5],
    "sleep": [-1.5, -2.0, 0.0, -1.5, -1.0, 1.5, 2.0, -1.0, -0.5],
}
FUZZY_CUTOFF = 80.0
POOL_FACTOR = 20
SIMILARITY_WEIGHT, POPULARITY_WEIGHT = 0.80, 0.20

KEYWORDS = [(word, vibe) for vibe, words in VIBE_KEYWORDS.items() for word in words]


def keyword_table(spark) -> DataFrame:
    """The keywords as a table (pos, keyword, profile), in list order; callers may bring another."""
    return spark.createDataFrame([(i, word, vibe) for i, (word, vibe) in enumerate(KEYWORDS)],
                                 "pos bigint, keyword string, profile string")


def exact_vibe(text: Column) -> Column:
    """Profile of the first keyword, in list order, that the text contains; NULL if none."""
    chain = F
    for word, vibe in KEYWORDS:
        chain = chain.when(text.contains(word), F.lit(vibe))
    return chain


@F.pandas_udf(T.StringType())
def _closest_keyword(texts: pd.Series) -> pd.Series:
    block = TextBlock([" ".join(sorted(w.split())) for w, _ in KEYWORDS])

    def best(text):
        scores = block.ratio(text)
        at = int(scores.argmax())
        return KEYWORDS[at][1] if scores[at] >= FUZZY_CUTOFF else None

    known = {t: best(t) for t in texts.dropna().unique()}
    return texts.map(known).astype(object).where(texts.notna(), None)


def detect_vibe(queries: DataFrame, text: str = "text") -> DataFrame:
    """``vibe`` per query: contained keyword first, else the closest keyword at 80 % or more."""
    q = F.lower(strip(F.col(text)))
    found = queries.withColumn("_exact", exact_vibe(q))
    ordered = token_sort(q)
    # a ratio needs as many common characters: much longer texts cannot reach the cutoff
    longest = max(len(word) for word, _ in KEYWORDS) * (200 - FUZZY_CUTOFF) / FUZZY_CUTOFF
    rest = F.when(F.col("_exact").isNull() & (q != "") & (F.length(ordered) <= longest), ordered)
    return found.withColumn("vibe", F.coalesce("_exact", _closest_keyword(rest))).drop("_exact")


def profile_vectors(spark: SparkSession, features, stats: DataFrame) -> DataFrame:
    """The ten targets normalized like the catalog: (qid = vibe, vec). Absent features are left out."""
    targets = spark.createDataFrame(
        [(v, *[dict(zip(FEATURES9, t)).get(f, 0.0) for f in features]) for v, t in VIBE_TARGETS.items()],
        "qid string, " + ", ".join(f"`{f}` double" for f in features))
    s = stats.select(F.struct(*stats.columns)).scalar()
    return targets.withColumn("_s", s).select("qid", F.array(*[
        (F.col(f) - F.col("_s")[f"mean_{f}"]) / (F.col("_s")[f"std_{f}"] + EPSILON) for f in features]).alias("vec"))


def rescaled(x: Column, window) -> Column:
    """Min-max within the window, 1 where all values are equal."""
    lo, hi = F.min(x).over(window), F.max(x).over(window)
    return F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(1.0))


def vibe_results(items: DataFrame, profiles: DataFrame, k: int, carry=("popularity",)) -> DataFrame:
    """Top k per profile from the 20k nearest: 80 % rescaled similarity, 20 % rescaled popularity.

    All queries of one profile share its result, so at most ten searches run however many
    queries there are.
    """
    pool = block_top_k(items, profiles, POOL_FACTOR * k, Dot(), carry=carry)
    w = W.partitionBy("qid")
    score = (rescaled(F.col("score"), w) * SIMILARITY_WEIGHT
             + rescaled(F.col("popularity").cast("double"), w) * POPULARITY_WEIGHT)
    scored = pool.drop("rank").withColumn("_search_score", score)
    return (top_per_group(scored, ["qid"], [compared("_search_score"), F.col("id")], k, rank="rank")
            .withColumnRenamed("qid", "vibe"))
