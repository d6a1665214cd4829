"""Ticket-level features and the joins between header, lines and inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.functions.numbers import dominant_role, encode_target, ratio_or_null, safe_ratio, spend_by_role
from shoptally.operators.joins import join_dimension

FEATURES = (
    "total",
    "units",
    "n_products",
    "unit_ticket",
    "diversity",
    "n_depts",
    "max_subtotal",
    "std_subtotal",
)
PAYMENT_FEATURES = (
    "total",
    "units",
    "n_products",
    "main_dept_code",
    "dept_share",
    "weekday",
    "is_weekend",
)


def n_distinct(col) -> Column:
    """Number of distinct values that are not null, as a set inside the aggregate; for columns with a bounded catalogue."""
    return F.size(F.collect_set(col)).cast("long")


def attach_header(features: DataFrame, sales: DataFrame, how="inner") -> DataFrame:
    """Ticket aggregates with the columns of their sales header; one row per ticket on both sides."""
    return features.join(sales, "id", how)


def enrich_lines(lines: DataFrame, inventory: DataFrame, cols, product="product") -> DataFrame:
    """Lines with inventory attributes; lines of unknown products stay."""
    dim = dedupe_first(inventory, "id", list(cols)).select(F.col("id").alias(product), *cols)
    return join_dimension(lines, dim, product, "left")


def dedupe_first(df: DataFrame, key: str, order) -> DataFrame:
    """One row per key: the first by ``order``, nulls last. An aggregate, so a hot key is reduced before the shuffle."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c != key]
    nulls_last = [x for c in order for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    first = F.min(F.struct(*nulls_last, *[F.col(c) for c in rest if c not in order]))
    return df.groupBy(key).agg(first.alias("_first")).select(*[key if c == key else f"_first.{c}" for c in df.columns])


def ticket_features(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Eight features per ticket for segmentation, with the payment label. Zero units give null ratios.

    Lines are read and shuffled once: distinct values are sets of the same aggregate, merged before the shuffle, so no line is
    copied per distinct count. A set holds at most the catalogue.
    """
    per_ticket = lines.groupBy("id").agg(
        F.sum("qty").alias("units"),
        n_distinct("product").alias("n_products"),
        n_distinct("dept").alias("n_depts"),
        F.max("subtotal").alias("max_subtotal"),
        F.coalesce(F.stddev_samp("subtotal"), F.lit(0.0)).alias("std_subtotal"),
    )
    joined = attach_header(per_ticket, sales.select("id", "pay", "total"))
    return joined.select(
        "id",
        "pay",
        "total",
        "units",
        "n_products",
        ratio_or_null("total", "units").alias("unit_ticket"),
        ratio_or_null("n_products", "units").alias("diversity"),
        "n_depts",
        "max_subtotal",
        "std_subtotal",
    )


def ticket_spend_profile(lines: DataFrame, roles=("UTILES", "FOTOCOPIADORA"), digits: int | None = 4) -> DataFrame:
    """Units, variety and spend per ticket, split by two named departments, with guarded ratios."""
    return (
        spend_by_role(lines, roles=roles)
        .groupBy("id")
        .agg(
            F.sum("qty").alias("units"),
            F.countDistinct("product").alias("variety"),
            F.sum("subtotal").alias("subtotal"),
            F.sum("spend_1").alias("spend_1"),
            F.sum("spend_2").alias("spend_2"),
            F.sum("spend_other").alias("spend_other"),
        )
        .withColumns(
            {
                "unit_price": safe_ratio("subtotal", "units", digits),
                "share_1": safe_ratio("spend_1", "subtotal", digits),
                "dominant": dominant_role("spend_1", "spend_2", roles),
            }
        )
    )


def ticket_first_hour(lines: DataFrame, order="line_no", at="at") -> DataFrame:
    """Units per ticket and the hour of its first line."""
    return lines.groupBy("id").agg(
        F.sum("qty").alias("units"),
        F.min(F.struct(F.col(order), F.hour(F.col(at)).alias("hour"))).getField("hour").alias("first_hour"),
    )


def payment_features(sales: DataFrame, lines: DataFrame, share_dept="FOTOCOPIADORA", labels=None) -> DataFrame:
    """Features of the payment classifier. Lines are counted per (ticket, department) before the ticket level, in one pass."""
    per_dept = lines.groupBy("id", "dept").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("units"), F.collect_set("product").alias("products")
    )
    per_ticket = per_dept.groupBy("id").agg(
        F.sum("units").alias("units"),
        F.min(F.when(F.col("dept").isNotNull(), F.struct(-F.col("n"), F.col("dept")))).getField("dept").alias("main_dept"),
        (F.sum(F.when(F.col("dept") == share_dept, F.col("n")).otherwise(0)) / F.sum("n")).alias("dept_share"),
        F.size(F.array_distinct(F.flatten(F.collect_list("products")))).cast("long").alias("n_products"),
    )
    header = sales.select(
        "id",
        "total",
        F.weekday("day").alias("weekday"),
        F.weekday("day").isin(5, 6).cast("int").alias("is_weekend"),
        encode_target("pay", labels).alias("target"),
    )
    return header.join(per_ticket, "id").select(
        "id", "total", "units", "n_products", "main_dept", "dept_share", "weekday", "is_weekend", "target"
    )


def ticket_sizes(lines: DataFrame) -> DataFrame:
    """Lines and distinct products per ticket."""
    return lines.groupBy("id").agg(
        F.count("product").alias("n_lines"), F.countDistinct("product").alias("n_products")
    )


def sales_kpis(sales: DataFrame) -> DataFrame:
    """Number of tickets, revenue and mean ticket."""
    return sales.agg(
        F.count(F.lit(1)).alias("n_tickets"), F.sum("total").alias("revenue"), F.avg("total").alias("mean_ticket")
    )


def ranked_totals(df: DataFrame, key: str, value: str, n=5) -> DataFrame:
    """Top ``n`` keys by summed value, ties by key."""
    return df.groupBy(key).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), key).limit(n)


def extreme_tickets(sales: DataFrame) -> DataFrame:
    """Largest and smallest ticket, the lowest id among ties."""
    picked = sales.filter(F.col("total").isNotNull()).agg(
        F.min(F.struct(-F.col("total"), F.col("id"))).getField("id").alias("max_id"),
        F.max("total").alias("max_total"),
        F.min(F.struct(F.col("total"), F.col("id"))).getField("id").alias("min_id"),
        F.min("total").alias("min_total"),
    )
    return picked.select(
        F.explode(
            F.array(
                F.struct(F.lit("max").alias("which"), F.col("max_id").alias("id"), F.col("max_total").alias("total")),
                F.struct(F.lit("min").alias("which"), F.col("min_id").alias("id"), F.col("min_total").alias("total")),
            )
        ).alias("r")
    ).select("r.*")


def extreme_ticket_lines(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of the largest and the smallest ticket (two keys, broadcast)."""
    keys = extreme_tickets(sales).select("which", "id")
    return lines.join(F.broadcast(keys), "id")


def orphans(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """Ticket ids present on one side only. Both sides meet in one aggregate, which is reduced before the shuffle and can spill."""
    seen = sales.select("id", F.lit(1).alias("_header"), F.lit(0).alias("_line")).unionByName(
        lines.select("id", F.lit(0).alias("_header"), F.lit(1).alias("_line"))
    )
    sides = seen.groupBy("id").agg(F.max("_header").alias("_header"), F.max("_line").alias("_line"))
    unknown = F.col("id").isNull()  # meets nothing on the other side
    problems = F.array(
        F.when((F.col("_line") == 1) & ((F.col("_header") == 0) | unknown), "no_header"),
        F.when((F.col("_header") == 1) & ((F.col("_line") == 0) | unknown), "no_lines"),
    )
    return sides.select("id", F.explode(F.array_compact(problems)).alias("problem"))


def top_products(lines: DataFrame, n=20) -> DataFrame:
    """Most frequent descriptions by line count."""
    return (
        lines.groupBy("description")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .orderBy(F.desc("n_lines"), "description")
        .limit(n)
    )
