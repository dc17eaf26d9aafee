"""Writers. Every job writes its partitions in parallel; nothing is gathered first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from cadenza.sources import versions


def lists_to_text(df: DataFrame, separator: str = "; ") -> DataFrame:
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(c, separator) for c in lists})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; list columns become joined text."""
    lists_to_text(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def save_index(path: str, vectors: DataFrame, items: DataFrame, feature_stats: DataFrame) -> int:
    """Vector table (id, vec), item table (id, ...) and one-row feature statistics, committed as the path's next version."""
    return versions.commit(path, {"vectors": vectors, "items": items, "feature_stats": feature_stats})


def metrics_with_k(report: DataFrame, k: int) -> DataFrame:
    """Metric names carry the cut-off."""
    return report.withColumnsRenamed({
        "n_rows": "rows", "precision_at_k": f"precision@{k}", "recall_at_k": f"recall@{k}",
        "map_at_k": f"map@{k}", "ndcg_at_k": f"ndcg@{k}"})


def write_metrics(report: DataFrame, k: int, path: str) -> None:
    metrics_with_k(report, k).write.mode("overwrite").json(path)
