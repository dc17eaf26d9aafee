"""End-to-end jobs that build, clean and describe a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadenza.functions.scalars import standard_mood
from cadenza.operators import clean, genres, ingest, learning, profile
from cadenza.operators.ordering import keep_first, keep_first_counted
from cadenza.operators.quantiles import merge_states, quantile_state
from cadenza.operators.vectors import feature_table
from cadenza.schema import (
    AUDIO9_EDA, CLUSTER_FEATURES, FEATURES9, MOOD_FEATURES, MOOD_PLOT_ORDER, MOODS, choose_profile_column,
    keep_listed, normalize_schema, present, rename_columns, training_features,
)
from cadenza.session import write_and_read
from cadenza.sources.writers import save_index


def collect_catalog(items: DataFrame, audio: DataFrame, artists: DataFrame, moods: dict[str, str],
                    use_playlist_labels: bool = True) -> DataFrame:
    """Playlist entries to labelled tracks.

    ``items`` is (playlist_id, page_no, pos, track). Playlists are taken in the order of
    ``moods`` and the first appearance of a track wins. Tracks are placed by track id once;
    deduplication, the audio join and the artist regrouping all reuse that placement.
    """
    order = F.array_position(F.array(*[F.lit(p) for p in moods]), F.col("playlist_id"))
    listed = items.filter(F.col("playlist_id").isin(*moods)).withColumn(
        "ingest_seq", F.struct(order.alias("playlist"), "page_no", "pos"))
    tracks = ingest.flatten_tracks(listed, keep=("playlist_id", "ingest_seq"))
    if use_playlist_labels:
        tracks = ingest.label_by_playlist(tracks, moods)
    tracks = keep_first(tracks, "track_id").drop("ingest_seq", "playlist_id")
    return ingest.apply_mood_rules(ingest.join_artists(ingest.join_audio(tracks, audio, unique=True), artists))


def deduplicated(df: DataFrame, key: str = "track_id", order: str = "ingest_seq") -> tuple[DataFrame, DataFrame]:
    """The first row of each key, written, and the report of that write: (measure, n), one row per measure.

    Measures are the rows before, after and removed, and the missing values of each column that is left.
    """
    columns = [c for c in df.columns if c not in (key, order)]
    kept, seen = keep_first_counted(df, key, order, missing=columns)
    report = df.sparkSession.createDataFrame([(k, int(n)) for k, n in seen.items()], "measure string, n bigint")
    return kept.drop(order), report


def preprocess(df: DataFrame, method: str = "standard", encode_genres: bool = True, key: str = "track_id",
               order: str = "ingest_seq", settle: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Deduplicate, date, impute, standardize moods, encode genres, scale.

    ``settle`` is False for a table that ``deduplicated`` has written.

    The deduplicated table and the fitted values are written, so that the passes of the fitted steps
    read back only the columns they need. Years and numbers get their medians from the same two scans.
    """
    if settle:
        df = write_and_read(keep_first(df, key, order).drop(order), "deduplicated")
    df = clean.impute(clean.add_release_year(df, fill=False), "median", exclude=(key, "artist_id"), settle=True)
    mood = F.col("mood_label") if "mood_label" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("mood_label", standard_mood(mood, MOODS))
    if encode_genres:
        df = genres.multi_hot(df)
    return clean.scale(df, method)


def preprocess_large(df: DataFrame, order: str = "ingest_seq", carry=()) -> DataFrame:
    """Rename, prune, drop rows without id or name, deduplicate, z-score by sample deviation."""
    named = rename_columns(df)
    kept = keep_listed(named).columns
    rows = clean.drop_missing(named.select(*kept, *carry, order), ["id", "name"])
    rows = write_and_read(keep_first(rows, "id", order).drop(order), "deduplicated")
    return clean.zscore(rows, present(named, FEATURES9), "sample")


def profile_report(df: DataFrame, mood: str = "mood_label") -> dict[str, DataFrame]:
    """All descriptive tables of a catalog. Their shared input is written once, with its few columns."""
    wanted = dict.fromkeys([mood, "id", *MOOD_FEATURES, *AUDIO9_EDA, *CLUSTER_FEATURES])
    df = write_and_read(df.select(*[c for c in wanted if c in df.columns]), "profile-input")
    out = {}
    if mood in df.columns:
        out["moods"] = profile.value_counts(df, mood)
    mood_features = present(df, MOOD_FEATURES)
    by_mood = whole = None
    if mood_features:
        # one scan for the counts, moments, ends and brackets of the tables below
        by_mood = write_and_read(quantile_state(df, mood_features, mood if mood in df.columns else None), "quantile-state")
        whole = write_and_read(merge_states(by_mood), "quantile-state")
        out["describe"] = profile.describe(df, mood_features, whole)
    if "valence" in df.columns:
        out["valence_histogram"] = profile.histogram(df, ["valence"], 50, whole)
    if len(present(df, AUDIO9_EDA)) >= 2:
        out["correlations"] = profile.correlations(df, present(df, AUDIO9_EDA))
    if mood in df.columns and len(mood_features) >= 2:
        out["boxes"] = profile.box_summary(df, mood_features, mood, state=by_mood)
    if "id" in df.columns and len(present(df, CLUSTER_FEATURES)) >= 2:
        out["components"], _ = profile.principal_components(df, present(df, CLUSTER_FEATURES), 2, mood)
    return out


def build_vector_tables(df: DataFrame, path: str | None = None,
                        features=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors, items and feature statistics of a catalog; written when a path is given."""
    features = features or present(df, FEATURES9)
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    stats = clean.column_stats(filled, features)
    vectors = feature_table(df, features, stats)
    if path:
        save_index(path, vectors, df, stats)
    return vectors, df, stats


def build_learned_tables(df: DataFrame, layers: list[dict], path: str | None = None,
                         features=None) -> DataFrame:
    """(id, vec) with the network's embedding of each row's features."""
    features = features or present(df, FEATURES9)
    raw = df.select("id", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]).alias("vec"))
    vectors = learning.embed_items(raw, layers).withColumnRenamed("embedding", "vec")
    if path:
        save_index(path, vectors, df, clean.column_stats(df, features))
    return vectors


def build_profile_examples(df: DataFrame, profile_column: str | None = None):
    """Training examples, scaling parameters and a summary row."""
    df = normalize_schema(df)
    profile_column = profile_column or choose_profile_column(df)
    features = training_features(df)
    examples, params = learning.profile_examples(df, profile_column, features)
    summary = learning.training_summary(examples, features).withColumn("profile_column", F.lit(profile_column))
    return examples, params, summary
