"""Row-level expressions. All are Catalyst columns; none needs Python at run time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cadenza.functions.text import strip

# Mood thresholds, keyword lists and display texts.
VINTAGE_WORDS = ["oldies", "classic", "vintage", "retro"]
THEME_WORDS = {
    "energetic": ["gym", "workout", "run", "hype", "pump", "beast", "intense", "power",
                  "cardio", "party", "club", "dance", "disco", "rave", "edm", "banger",
                  "happy", "hustle"],
    "moody": ["sad", "heartbreak", "moody", "dark", "melancholy", "depressed", "lonely",
              "ambient", "rainy", "cry", "pain"],
    "romantic": ["romantic", "love", "dinner", "date", "sweet", "passion", "hug"],
}
LABEL_BOUND = 0.65
YEAR_RANGE = (1900, 2025)
REASON_LIMIT = 4
RANKED = ("ranked highly by the ", " scorer (", ")")
SIMILAR = ("strong vector similarity to the seed track (", ")")
PROFILED = "matches the requested vibe profile"
POPULAR, POPULARITY, DIVERSE = "popularity signal contributed ", "popularity is ", "artist diversity bonus "
TRAITS = {
    "energy": ("high energy", "low energy", "balanced energy"),
    "valence": ("brighter mood", "more melancholic mood", "balanced mood"),
    "danceability": ("dance-forward feel", "less dance-focused feel", "moderate danceability"),
}


def _any_word(text: Column, words) -> Column:
    hit = text.contains(words[0])
    for w in words[1:]:
        hit = hit | text.contains(w)
    return hit


def release_year(date: Column) -> Column:
    """Digits before the first dash; NULL when they are not a number."""
    return strip(F.split(date, "-").getItem(0)).try_cast("int")


def bounded_release_year(date: Column) -> Column:
    y = release_year(date)
    return F.when(y.between(*YEAR_RANGE), y)


def has_vintage_genre(genres: Column) -> Column:
    return F.coalesce(_any_word(F.lower(genres), VINTAGE_WORDS), F.lit(False))


def mood_rule(columns, genres: str | None = "all_genres") -> Column:
    """Mood from audio features. An absent column takes its default, a NULL value matches no rule."""
    defaults = {"valence": 0.5, "energy": 0.5, "danceability": 0.5, "tempo": 100.0, "acousticness": 0.5}
    v, e, d, t, a = [F.col(c) if c in columns else F.lit(x) for c, x in defaults.items()]
    rules = [
        ("party", (e > 0.7) & (d > 0.7) & (t > 110)),
        ("sad", (v < 0.35) & (a > 0.5)),
        ("romantic", v.between(0.4, 0.7) & (a > 0.4) & (t < 100)),
        ("chill", (e < 0.5) & (v > 0.5) & (d < 0.6) & (t < 120)),
    ]
    if "release_date" in columns:
        year = release_year(F.col("release_date"))
        rules.append(("old_melody", (year != 0) & (year < 1995)))
    if genres and genres in columns:
        rules.append(("old_melody", has_vintage_genre(F.col(genres))))
    chain = F
    for label, test in rules:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit("neutral"))


def fill_mood(label: Column, rule: Column) -> Column:
    return F.when(label.isNull() | (label == ""), rule).otherwise(label)


def standard_mood(label: Column, moods) -> Column:
    low = F.lower(label)
    return F.when(low.isin(*moods), low).otherwise(F.lit("neutral"))


def search_text(name: Column, artists: Column | None) -> Column:
    parts = [F.coalesce(name, F.lit(""))]
    if artists is not None:
        parts.append(F.coalesce(artists, F.lit("")))
    return F.lower(F.concat_ws(" ", *parts))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def finite_or_zero(x: Column) -> Column:
    x = x.cast("double")
    bad = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(F.when(~bad, x), F.lit(0.0))


def feature_label(value: Column, high: str, low: str, neutral: str) -> Column:
    return (F.when(value >= LABEL_BOUND, F.lit(high))
            .when(value <= -LABEL_BOUND, F.lit(low)).otherwise(F.lit(neutral)))


def percent_of_z(z: Column, mode: str = "truncate") -> Column:
    """A z-score shown as 5..95 percent; ``truncate`` or ``round`` (half up)."""
    pct = (z + 2.0) / 4.0 * 100
    if mode == "round":
        pct = F.floor(pct + 0.5)
    elif mode != "truncate":
        raise ValueError("mode must be 'truncate' or 'round'")
    return F.least(F.lit(95), F.greatest(F.lit(5), pct.cast("int")))


def query_theme(query: Column) -> Column:
    q = F.lower(strip(F.coalesce(query, F.lit(""))))
    chain = F
    for theme, words in THEME_WORDS.items():
        chain = chain.when(_any_word(q, words), F.lit(theme))
    return chain.otherwise(F.lit("chill"))


def title_case(text: Column) -> Column:
    """Every run of letters gets a capital, also after a dash or an apostrophe."""
    runs = F.split(text, r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(runs, lambda s: F.initcap(s)), "")


def vibe_label(query: Column) -> Column:
    return F.concat(F.lit("Vibe: *"), title_case(strip(query)), F.lit("*"))


def track_label(name: Column, artists: Column | None) -> Column:
    """A missing name or artist is shown as nothing; the label itself is never missing."""
    label = F.concat(F.lit("**"), F.coalesce(name, F.lit("")), F.lit("**"))
    return label if artists is None else F.concat(label, F.lit(" by "), F.coalesce(artists, F.lit("")))


def _optional(columns, *names) -> Column:
    """First given value among the named columns that the table has; NULL when it has none."""
    return F.coalesce(*[F.col(n).cast("double") for n in names if n in columns], F.lit(None).cast("double"))


def decimals(x: Column, n: int) -> Column:
    """Fixed-point text, rounded from the exact value of the double."""
    return F.call_function("format_number", x, F.lit("0." + "0" * n))


def explanation(columns, mode: Column, engine: Column) -> Column:
    """Up to four reasons, taken in a fixed order from whatever scores the row carries."""
    score = _optional(columns, "final_score", "_search_score")
    sim = _optional(columns, "similarity_score", "sim_score")
    searched = _optional(columns, "_search_score")
    pop_score, pop = _optional(columns, "pop_score"), _optional(columns, "popularity")
    bonus = _optional(columns, "diversity_bonus")

    def said(value, n, before, after=""):
        return F.when(value.isNotNull(), F.concat(*before, decimals(value, n), F.lit(after)))

    def trait(name):
        value = _optional(columns, name)
        return F.when(value.isNotNull(), feature_label(value, *TRAITS[name]))

    reasons = F.array(
        said(score, 3, [F.lit(RANKED[0]), engine, F.lit(RANKED[1])], RANKED[2]),
        said(sim, 3, [F.lit(SIMILAR[0])], SIMILAR[1]),
        F.when(searched.isNotNull() & (mode == "vibe"), F.lit(PROFILED)),
        F.coalesce(said(pop_score, 2, [F.lit(POPULAR)]), said(pop, 1, [F.lit(POPULARITY)])),
        said(bonus, 2, [F.lit(DIVERSE)]),
        *[trait(name) for name in TRAITS],
    )
    return F.slice(F.array_compact(reasons), 1, REASON_LIMIT)


def output_similarity(columns) -> Column:
    """The score shown for a result: first non-missing of the known score columns, else 0."""
    names = [c for c in ("similarity_score", "sim_score", "final_score", "_search_score") if c in columns]
    return F.coalesce(*[F.col(c).cast("double") for c in names], F.lit(0.0))
