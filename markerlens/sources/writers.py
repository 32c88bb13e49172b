"""Sinks (SNK-1 … SNK-6). Paths are folders (Spark writes one file per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from markerlens.operators.ordering import contiguous_index


def write_csv_quoted(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """SNK-1 CSV, header, every field quoted, no index. ``errorifexists`` refuses to overwrite
    a finished build (SRC-4)."""
    df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_csv_indexed(df: DataFrame, path: str, order: str, mode: str = "errorifexists") -> None:
    """SNK-2 CSV with a leading contiguous index column (DED-5) in ``order``."""
    indexed = contiguous_index(df, order, "id")
    cols = ["id"] + [c for c in df.columns]
    write_csv_quoted(indexed.select(*cols), path, mode)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-3 JSON records, one per line."""
    df.write.mode(mode).json(path)


def write_splits(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """SNK-4 one folder per split value (partition pruning on read: ``split = 'train'``)."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-5 derived training sets."""
    df.write.mode(mode).parquet(path)


def safe_key(key: str) -> str:
    """File-safe form of a model key (characters outside [A-Za-z0-9._-] become ``_``)."""
    return "".join(ch if ch.isalnum() or ch in "._-" else "_" for ch in key)


def save_model_and_predictions(model, predictions: DataFrame, root: str, key: str) -> str:
    """SNK-6 fitted model under a file-safe key, predictions partitioned by model and task."""
    target = f"{root.rstrip('/')}/models/{safe_key(key)}"
    model.write().overwrite().save(target)
    # a rerun replaces the partitions that it writes and no others
    predictions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "task").parquet(f"{root.rstrip('/')}/predictions")
    return target
