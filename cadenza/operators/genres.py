"""List-valued genre text: token counts and indicator columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def genre_tokens(df: DataFrame, column: str = "all_genres") -> DataFrame:
    """One row per list entry; rows without a list are skipped."""
    usable = df.filter(F.col(column).isNotNull() & ~F.col(column).isin("", "Unknown"))
    return usable.select(F.explode(F.split(column, ";")).alias("t")).select(F.trim("t").alias("genre"))


def token_counts(df: DataFrame, column: str = "all_genres") -> DataFrame:
    return genre_tokens(df, column).groupBy("genre").agg(F.count("*").alias("n"))


def top_genres(df: DataFrame, column: str = "all_genres", n: int = 20) -> DataFrame:
    return token_counts(df, column).orderBy(F.col("n").desc(), "genre").limit(n)


def genre_column(genre: str) -> str:
    return "genre_" + genre.lower().replace(" ", "_")


def multi_hot(df: DataFrame, column: str = "all_genres", n: int = 20, match: str = "substring",
              genres: list[str] | None = None) -> DataFrame:
    """A 0/1 column per top genre. The list of at most ``n`` names decides the schema, so it is read first.

    ``substring`` lets 'pop' match 'k-pop'; ``token`` compares whole list entries.
    """
    if column not in df.columns:
        return df
    if genres is None:
        genres = [r["genre"] for r in top_genres(df, column, n).collect()]
    low = F.lower(F.col(column))
    if match == "token":
        entries = F.transform(F.split(low, ";"), lambda s: F.trim(s))
        hits = {g: F.array_contains(entries, g.lower()) for g in genres}
    elif match == "substring":
        hits = {g: low.contains(g.lower()) for g in genres}
    else:
        raise ValueError("match must be 'substring' or 'token'")
    return df.withColumns({genre_column(g): F.coalesce(h.cast("int"), F.lit(0)) for g, h in hits.items()})
