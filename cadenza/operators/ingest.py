"""From nested source records to one flat row per track."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.functions.scalars import fill_mood, mood_rule
from cadenza.operators.joins import lookup_join

PAGE_SCHEMA = """
    playlist_id STRING, page_no INT,
    items ARRAY<STRUCT<track: STRUCT<
        id: STRING, name: STRING, popularity: INT,
        artists: ARRAY<STRUCT<id: STRING, name: STRING>>,
        album: STRUCT<name: STRING, release_date: STRING>>>>
"""


def _given(x: Column) -> Column:
    return x.isNotNull() & (x != "")


def page_items(pages: DataFrame) -> DataFrame:
    """One row per playlist entry that has a track with an id."""
    keep = [c for c in pages.columns if c != "items"]
    rows = pages.select(*keep, F.posexplode("items").alias("pos", "item"))
    return rows.select(*keep, "pos", "item.track").filter(_given(F.col("track.id")))


def has_id(df: DataFrame, column: str = "id") -> DataFrame:
    return df.filter(_given(F.col(column)))


def flatten_tracks(df: DataFrame, keep=()) -> DataFrame:
    """Nested ``track`` to columns; lists keep only given values, absent parts become '' or 0."""
    def parts(field):
        present = F.filter(F.col("track.artists"), lambda a: _given(a[field]))
        return F.coalesce(F.transform(present, lambda a: a[field]), F.array().cast("array<string>"))

    return df.filter(_given(F.col("track.id"))).select(
        *keep, F.col("track.id").alias("track_id"),
        F.coalesce("track.name", F.lit("")).alias("name"),
        parts("id").alias("artist_ids"), parts("name").alias("artist_names"),
        F.coalesce("track.popularity", F.lit(0)).alias("popularity"),
        F.coalesce("track.album.name", F.lit("")).alias("album"),
        F.coalesce("track.album.release_date", F.lit("")).alias("release_date"))


def label_by_playlist(df: DataFrame, moods: dict[str, str], column: str = "playlist_id") -> DataFrame:
    """``mood_label`` from a small playlist-to-mood map; other playlists stay unlabelled."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(moods.items())])
    return df.withColumn("mood_label", F.try_element_at(table, F.col(column)))


def union_tables(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def artist_columns(artists: DataFrame) -> DataFrame:
    popularity = F.coalesce("popularity", F.lit(0)) if "popularity" in artists.columns else F.lit(0)
    return artists.select(
        F.col("id").alias("artist_id"),
        F.coalesce(F.get("genres", F.lit(0)), F.lit("")).alias("primary_genre"),
        F.coalesce(F.array_join("genres", "; "), F.lit("")).alias("all_genres"),
        F.coalesce("followers.total", F.lit(0)).alias("artist_followers"),
        popularity.alias("artist_popularity"))


def join_audio(tracks: DataFrame, audio: DataFrame, unique: bool = False) -> DataFrame:
    """Left join on the track id after feature entries without an id are dropped.

    ``unique`` says the tracks are already one row per id, so a plain join cannot be skewed.
    """
    features = audio.filter(_given(F.col("id"))).withColumnRenamed("id", "track_id")
    if unique:
        return tracks.join(features, "track_id", "left")
    return lookup_join(tracks, features, "track_id", "left")


def distinct_artists(tracks: DataFrame) -> DataFrame:
    ids = tracks.select(F.explode("artist_ids").alias("artist_id"))
    return ids.filter(_given(F.col("artist_id"))).distinct()


def explode_artists(tracks: DataFrame) -> DataFrame:
    """One row per track and artist id with its position; a track without artists keeps one row."""
    return tracks.select("*", F.posexplode_outer("artist_ids").alias("artist_pos", "artist_id")).drop("artist_ids")


def regroup_tracks(rows: DataFrame) -> DataFrame:
    """Back to one row per track: first genre, distinct genre texts in order, maxima, first of the rest.

    Rows are first combined per (track, genre text), so what is listed per track is only its
    distinct texts, which the result holds anyway.
    """
    pos = F.coalesce("artist_pos", F.lit(0))
    others = [c for c in rows.columns
              if c not in ("track_id", "artist_pos", "artist_id", "all_genres", "artist_followers", "artist_popularity")]
    by_text = rows.groupBy("track_id", "all_genres").agg(
        F.min(pos).alias("_pos"), F.max("artist_followers").alias("artist_followers"),
        F.max("artist_popularity").alias("artist_popularity"),
        *[F.min(F.when(F.col(c).isNotNull(), F.struct(pos.alias("p"), F.col(c).alias("v")))).alias(c) for c in others])
    texts = F.sort_array(F.collect_list(F.when(F.col("all_genres").isNotNull(), F.struct("_pos", "all_genres"))))
    first = {c: F.min(c)["v"] for c in others}
    if "primary_genre" in first:
        first["primary_genre"] = F.coalesce(first["primary_genre"], F.lit(""))
    return by_text.groupBy("track_id").agg(
        *[v.alias(c) for c, v in first.items()],
        F.array_join(F.transform(texts, lambda t: t["all_genres"]), "; ").alias("all_genres"),
        F.max("artist_followers").alias("artist_followers"),
        F.max("artist_popularity").alias("artist_popularity"))


def join_artists(tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Artist data per track. An artist on very many tracks is broadcast or salted, never one task."""
    rows = lookup_join(explode_artists(tracks), artist_columns(artists), "artist_id", "left",
                       spread=["track_id"])
    return regroup_tracks(rows)


def apply_mood_rules(df: DataFrame) -> DataFrame:
    """Rule-based mood where no label is given."""
    label = F.col("mood_label") if "mood_label" in df.columns else F.lit(None).cast("string")
    return df.withColumn("mood_label", fill_mood(label, mood_rule(df.columns)))
