"""Writers of cleaned tables, features, clusters and evaluation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_clean(tables: Mapping[str, DataFrame], base: str, csv=False) -> None:
    """Cleaned tables as parquet under ``base/clean``, optionally as CSV under ``base/clean_csv`` too."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/clean/{name}")
        if csv:
            df.write.mode("overwrite").option("header", True).csv(f"{base}/clean_csv/{name}")


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_clusters(df: DataFrame, path: str, label="cluster") -> None:
    """Labelled tickets, one folder per cluster."""
    df.write.mode("overwrite").partitionBy(label).parquet(path)


def write_eval_report(df: DataFrame, path: str) -> None:
    """Metric rows as JSON lines."""
    df.write.mode("overwrite").json(path)
