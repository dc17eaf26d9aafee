"""Command line for the end-to-end jobs, for spark-submit or ``python -m cadenza.jobs``.

Every command reads tables, runs one job and writes tables. A table without an order column
is taken in the order of its files' names, and of the rows in each.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadenza.operators import evaluate as ev, genres, learning, profile, recommend
from cadenza.operators.ordering import listing, running
from cadenza.plans import catalog, search as plan
from cadenza.schema import feature_vector, normalize_schema, similarity_features
from cadenza.session import remove_scratch
from cadenza.sources import readers, writers

AUDIO_SCHEMA = "id string, " + ", ".join(f"{c} double" for c in (
    "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "duration_ms"))
# Fixed value: results one search may ask for.
TOP_K_RANGE = (1, 50)
ARTIST_SCHEMA = "id string, genres array<string>, followers struct<total: bigint>, popularity int"


def in_file_order(df: DataFrame, name: str = "ingest_seq") -> DataFrame:
    if name in df.columns:
        return df
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_row"), F.lit(0).alias("_all"))
    order = [F.col("_file"), F.col("_block"), F.col("_row")]
    return running(placed, ["_all"], order, rank=name).drop("_file", "_block", "_row", "_all")


def _write(df: DataFrame, path: str) -> None:
    (writers.write_parquet if path.rstrip("/").endswith(".parquet") else writers.write_csv)(df, path)


def collect(spark, a):
    moods = dict(pair.split("=", 1)[::-1] for pair in a.playlist)
    got = catalog.collect_catalog(
        readers.read_playlist_pages(spark, a.pages), spark.read.schema(AUDIO_SCHEMA).json(a.audio),
        spark.read.schema(ARTIST_SCHEMA).json(a.artists), moods, not a.rules_only)
    _write(got, a.output)


def preprocess(spark, a):
    df, counts = catalog.deduplicated(in_file_order(readers.read_table(spark, a.input)))
    if a.counts:
        _write(counts, a.counts)
    _write(catalog.preprocess(df, a.method, not a.no_genres, settle=False)[0], a.output)


def preprocess_large(spark, a):
    _write(catalog.preprocess_large(in_file_order(readers.read_table(spark, a.input)), carry=a.carry), a.output)


def report(spark, a):
    df = readers.read_table(spark, a.input)
    df = normalize_schema(in_file_order(df)) if "id" not in df.columns else df
    for name, table in catalog.profile_report(df, a.mood_column).items():
        _write(table, f"{a.output}/{name}")


def build_index(spark, a):
    catalog.build_vector_tables(normalize_schema(in_file_order(readers.read_table(spark, a.input))), a.output)


def build_learned(spark, a):
    df = normalize_schema(in_file_order(readers.read_table(spark, a.input)))
    catalog.build_learned_tables(df, learning.read_layers(spark.read.parquet(a.weights)), a.output)


def examples(spark, a):
    df = in_file_order(readers.read_table(spark, a.input))
    for name, table in zip(("examples", "parameters", "summary"), catalog.build_profile_examples(df, a.profile_column)):
        writers.write_parquet(table, f"{a.output}/{name}")


def evaluate(spark, a):
    got = ev.evaluate(readers.read_table(spark, a.data), a.top_k, a.sample_size, a.seed, a.label_column)
    if a.output:
        writers.write_metrics(got, a.top_k, a.output)
    else:
        writers.metrics_with_k(got, a.top_k).show(truncate=False)


def recommend_by_mood(spark, a):
    df = in_file_order(readers.read_table(spark, a.data))
    _write(recommend.top_of_label(df, a.mood, n=a.n), a.output)


def recommend_similar(spark, a):
    df = normalize_schema(in_file_order(readers.read_table(spark, a.data)))
    hot = df if any("genre_" in c for c in df.columns) else genres.multi_hot(df)
    items = hot.select("id", "name", feature_vector(similarity_features(hot)).alias("vec"))
    names = spark.createDataFrame([(a.name,)], "name string")
    _write(recommend.similar_by_name(items, df, names, a.n), a.output)


def stats(spark, a):
    _write(profile.mood_statistics(readers.read_table(spark, a.data)), a.output)


def browse(spark, a):
    df = normalize_schema(in_file_order(readers.read_table(spark, a.data)))
    if a.name:
        df = recommend.name_contains(df, a.name)
    _write(listing(df, ["name", "artists", "mood_label", "popularity"]), a.output)


def search(spark, a):
    if not TOP_K_RANGE[0] <= a.top_k <= TOP_K_RANGE[1]:
        raise ValueError(f"--top-k must be within {TOP_K_RANGE}")
    df = normalize_schema(in_file_order(readers.read_table(spark, a.data)))
    queries = readers.read_table(spark, a.queries, "qid string, text string")
    index = plan.build_search_index(df)
    learned = None
    if a.learned:
        learned = readers.index_items(readers.load_index(spark, a.learned))
    _write(plan.search_service(index, queries, a.top_k, learned, alpha=a.alpha, beta=a.beta, gamma=a.gamma), a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cadenza", description=__doc__)
    commands = p.add_subparsers(required=True)

    def command(name, run, *required, output=True):
        c = commands.add_parser(name)
        for r in required:
            c.add_argument(f"--{r}", required=True)
        c.add_argument("--output", required=output)
        c.set_defaults(run=run)
        return c

    c = command("collect", collect, "pages", "audio", "artists")
    c.add_argument("--playlist", action="append", required=True, help="mood=playlist id, in order of preference")
    c.add_argument("--rules-only", action="store_true")
    c = command("preprocess", preprocess, "input")
    c.add_argument("--method", default="standard", choices=["standard", "minmax"])
    c.add_argument("--no-genres", action="store_true")
    c.add_argument("--counts", help="where to write removed rows and missing values, as seen by the deduplication")
    c = command("preprocess-large", preprocess_large, "input")
    c.add_argument("--carry", nargs="*", default=[])
    command("report", report, "input").add_argument("--mood-column", default="mood_label")
    command("build-index", build_index, "input")
    command("build-learned", build_learned, "input", "weights")
    command("examples", examples, "input").add_argument("--profile-column")
    c = command("evaluate", evaluate, "data", output=False)
    c.add_argument("--top-k", type=int, default=10)
    c.add_argument("--sample-size", type=int, default=200)
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--label-column", default="mood_label")
    command("mood", recommend_by_mood, "data", "mood").add_argument("-n", type=int, default=10)
    command("similar", recommend_similar, "data", "name").add_argument("-n", type=int, default=10)
    command("stats", stats, "data")
    command("browse", browse, "data").add_argument("--name")
    c = command("search", search, "data", "queries")
    c.add_argument("--learned")
    c.add_argument("--top-k", type=int, default=8)
    for name, value in (("alpha", 0.70), ("beta", 0.20), ("gamma", 0.10)):
        c.add_argument(f"--{name}", type=float, default=value)
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    shared = SparkSession.getActiveSession() is not None
    spark = SparkSession.builder.appName("cadenza").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        if not shared:
            remove_scratch(spark)


if __name__ == "__main__":
    main()
