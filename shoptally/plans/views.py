"""Point-of-sale reading of the supplied tables: the only module that knows their column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptally.operators.joins import join_dimension

ROLES = ("STANDARD", "PROMO")
LABELS = ("EFECTIVO", "YAPE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("total"),
        F.when(urgent, "YAPE").otherwise("EFECTIVO").alias("pay"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("dept"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") - 20).alias("stock"),
        F.when(F.col("p_partkey") % 4 == 0, F.col("p_size")).alias("min_stock"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").alias("shipped"),
    )
    dim = inventory(spark, sf_dir).select(F.col("id").alias("product"), "dept", "description", "category")
    return join_dimension(sold, dim, "product", "inner")


def ledger_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log keyed by user: sign-ups and views insert, clicks and purchases update, errors delete."""
    op = (
        F.when(F.col("event_type").isin("signup", "view"), "insert")
        .when(F.col("event_type") == "error", "delete")
        .otherwise("update")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
        F.col("value").alias("total"),
        F.when(F.col("value") > 10, "YAPE").otherwise("EFECTIVO").alias("pay"),
    )
