"""Data-quality audit: completeness, null counts, frequency tables, stock checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def preview(df: DataFrame, n=5, order=None) -> DataFrame:
    """First ``n`` rows, by ``order`` when given."""
    return (df.orderBy(order) if order else df).limit(n)


def completeness(df: DataFrame) -> DataFrame:
    """Rows, rows without nulls, null cells and the share of complete rows (100 for an empty table)."""
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    counted = df.select(nulls.alias("_nulls")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("_nulls") == 0, 1)).alias("n_complete"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("n_null_cells"),
    )
    share = F.when(F.col("n_rows") > 0, F.try_divide(F.col("n_complete") * 100.0, F.col("n_rows"))).otherwise(100.0)
    return counted.withColumn("coverage_pct", share)


def null_audit(df: DataFrame) -> DataFrame:
    """Null count and share of filled cells per column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}") for c in df.columns]
    )
    long = counts.unpivot(["n_rows"], list(df.columns), "column", "n_null")
    share = F.when(F.col("n_rows") > 0, 100.0 * (1 - F.try_divide("n_null", "n_rows"))).otherwise(100.0)
    return long.select("column", "n_rows", "n_null", share.alias("complete_pct"))


def compare_quality(before: DataFrame, after: DataFrame) -> DataFrame:
    """Completeness before and after cleaning."""
    return (
        completeness(before)
        .withColumn("stage", F.lit("before"))
        .unionByName(completeness(after).withColumn("stage", F.lit("after")))
    )


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """Count and percent of all rows per value; the rows with null count in the denominator only."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)))
    return counts.filter(F.col(col).isNotNull()).withColumn("pct", F.col("n") * 100.0 / total.scalar())


def crosstab(df: DataFrame, a: str, b: str, null_label="SIN DATO") -> DataFrame:
    """Counts per pair with a bucket for nulls and ``All`` margins, in long form."""
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null_label)).alias(c) for c in (a, b)])
    cube = filled.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("_a"), F.grouping(b).alias("_b"))
    return cube.select(
        F.when(F.col("_a") == 1, "All").otherwise(F.col(a)).alias(a),
        F.when(F.col("_b") == 1, "All").otherwise(F.col(b)).alias(b),
        "n",
    )


def entry_time_profile(df: DataFrame, date: str, unit="weekday") -> DataFrame:
    """Records per weekday (Monday 0) or per hour."""
    parts = {"weekday": F.weekday(date), "hour": F.hour(F.col(date).cast("timestamp"))}
    return df.groupBy(parts[unit].alias(unit)).agg(F.count(F.lit(1)).alias("n"))


def batch_entry_share(df: DataFrame, date: str) -> DataFrame:
    """Records whose raw date carries a clock time, and their share."""
    timed = F.coalesce(F.col(date).contains(":"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(timed).alias("n_timed"),
        (F.avg(timed.cast("double")) * 100).alias("timed_pct"),
    )


def reorder_point_profile(inventory: DataFrame) -> DataFrame:
    """Observed reorder points by department."""
    return (
        inventory.filter(F.col("min_stock").isNotNull())
        .groupBy("dept", "min_stock")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def negative_stock(inventory: DataFrame, n=10) -> DataFrame:
    """Items with negative stock, worst first."""
    return (
        inventory.filter(F.col("stock") < 0)
        .select("id", "description", "dept", "stock")
        .orderBy("stock", "id")
        .limit(n)
    )


def stack_results(*dfs: DataFrame) -> DataFrame:
    """Rows of several result tables with the same columns."""
    stacked = dfs[0]
    for df in dfs[1:]:
        stacked = stacked.unionByName(df)
    return stacked
