"""Sinks: corpus export as JSON lines (S4), tab-separated statistics (S6), the annotated
corpus as Parquet (S7). Output folders are joined properly (not prefix-concatenated)."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame


def out_path(base: str, name: str) -> str:
    return posixpath.join(base.rstrip("/"), name)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, readable back with the article schema."""
    df.write.mode(mode).json(path)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text, no header, one file set per table."""
    df.write.mode(mode).option("sep", "\t").option("header", "false").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S7 (and every other table when a columnar sink is preferred)."""
    df.write.mode(mode).parquet(path)
