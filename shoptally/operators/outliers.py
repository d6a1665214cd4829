"""Tukey fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.operators.ranks import melt, quantiles

# Labels of the two volume segments.
RETAIL_SEGMENT = "Estándar Minorista"
WHOLESALE_SEGMENT = "Mayorista / Compra Atípica"


def _fences(df: DataFrame, cols: Sequence[str], k: float) -> DataFrame:
    cuts = quantiles(df, cols, (0.25, 0.75)).select(
        "column", "n", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("q3")
    )
    iqr = F.col("q3") - F.col("q1")
    return cuts.withColumns({"iqr": iqr, "lower": F.col("q1") - k * iqr, "upper": F.col("q3") + k * iqr})


def tukey_fences(df: DataFrame, cols: Sequence[str], k=1.5, floor0=True) -> DataFrame:
    """Quartiles, fences and the number and percent of values above the upper fence, one row per column."""
    fences = _fences(df, cols, k)
    if floor0:
        fences = fences.withColumn("lower", F.greatest("lower", F.lit(0.0)))
    above = melt(df, cols).join(F.broadcast(fences), "column").groupBy("column").agg(
        F.count_if(F.col("value") > F.col("upper")).alias("n_outliers")
    )
    return fences.join(F.broadcast(above), "column").withColumn(
        "outlier_pct", F.col("n_outliers") * 100.0 / F.col("n")
    )


def upper_fences(df: DataFrame, cols: Sequence[str], k=1.5) -> dict[str, float]:
    """Upper fence per column. Fits the fences: runs a job that returns one row per column."""
    return {row["column"]: row["upper"] for row in _fences(df, cols, k).select("column", "upper").collect()}


def tukey_split(df: DataFrame, cols: Sequence[str], k=1.5) -> tuple[DataFrame, DataFrame]:
    """Rows within all upper fences, and the others (a null counts as beyond)."""
    upper = upper_fences(df, cols, k)
    inside = F.lit(True)
    for c in cols:
        inside = inside & (F.col(c) <= F.lit(upper.get(c)))
    inside = F.coalesce(inside, F.lit(False))
    return df.filter(inside), df.filter(~inside)


def volume_segment(df: DataFrame, col: str, k=1.5) -> DataFrame:
    """Outlier flag and segment label by the upper fence of one column."""
    upper = upper_fences(df, [col], k).get(col)
    return df.withColumn("is_outlier", F.col(col) > F.lit(upper)).withColumn(
        "segment", F.when(F.col("is_outlier"), WHOLESALE_SEGMENT).otherwise(RETAIL_SEGMENT)
    )


def top_outlier_tickets(df: DataFrame, n=5, amount="total", key="id", k=1.5) -> DataFrame:
    """Largest amounts above the upper fence."""
    return volume_segment(df, amount, k).filter("is_outlier").orderBy(F.desc(amount), key).limit(n)
