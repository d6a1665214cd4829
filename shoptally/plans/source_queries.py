"""Readers and writers on exports that Spark derives from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally import sources
from shoptally.functions import to_number
from shoptally.operators import cleaning
from shoptally.plans import views
from shoptally.plans.registry import query
from shoptally.session import scratch_path

SALES_HEADER = "ID;Fecha;Metodo_Pago;ID_Cliente;Total"
LINES_HEADER = ";ID_Venta;ID_Producto;Departamento;Descripcion;Cantidad;Subtotal;"
INVENTORY_HEADER = "ID,Descripcion,Categoria,Departamento,Precio_Venta,Stock_Minimo,Stock_Actual"


def _export(spark, rows, preamble, name):
    """Text files that each start with the preamble lines, as spreadsheet exports do."""
    path = scratch_path(spark, name)
    head = spark.range(1).select(F.explode(F.array(*[F.lit(p) for p in preamble])).alias("value"))
    head.coalesce(1).write.text(path)
    rows.write.mode("append").text(path)
    return path


def _sales_text(spark, sf):
    s = views.sales(spark, sf)
    line = F.concat_ws(";", "id", "day", F.lower("pay"), "customer", F.format_string("%.2f", "total"))
    return s.select(F.when(F.col("id") % 100 == 0, ";;;;").otherwise(line).alias("value"))


def sales_export(spark, sf):
    return _export(spark, _sales_text(spark, sf), ["﻿" + SALES_HEADER], "ventas.csv")


@query(
    "read_sales",
    """SELECT CAST(id AS VARCHAR) AS id, CAST(day AS VARCHAR) AS date, upper(left(pay, 1)) || lower(substr(pay, 2)) AS pay,
  CAST(customer AS VARCHAR) AS customer, CAST(CAST(total AS DECIMAL(18, 2)) AS VARCHAR) AS total FROM sales WHERE id % 100 <> 0""",
)
def read_sales(spark, sf):
    return sources.read_sales(spark, sales_export(spark, sf))


@query(
    "read_lines",
    """SELECT CAST(id AS VARCHAR) AS id, CAST(product AS VARCHAR) AS product, dept, description, 1000 + qty AS qty,
  round(subtotal, 2) AS subtotal FROM lines WHERE id % 100 <> 0""",
)
def read_lines(spark, sf):
    sold = views.lines(spark, sf)
    quantity = F.concat(F.lit('"1,'), F.lpad(F.col("qty").cast("long").cast("string"), 3, "0"), F.lit('"'))
    ticket = F.when(F.col("id") % 100 == 0, "").otherwise(F.concat(F.lit(" "), F.col("id").cast("string")))
    line = F.concat_ws(
        ";", F.lit(""), ticket, "product", "dept", "description", quantity, F.format_string("%.2f", "subtotal"), F.lit("")
    )
    path = _export(spark, sold.select(line.alias("value")), [";;;;;;;", LINES_HEADER], "detalle_ventas.csv")
    raw = sources.read_lines(spark, path).filter(F.col("id") != "")
    return raw.select("id", "product", "dept", "description", to_number("qty").alias("qty"), to_number("subtotal").alias("subtotal"))


@query(
    "read_inventory",
    """SELECT CAST(id AS VARCHAR) AS id, description, dept, round(price, 2) AS price,
  coalesce(min_stock, CASE WHEN dept = 'STANDARD' THEN 5 ELSE 2 END) AS min_stock, greatest(stock, 0) AS stock, stock < 0 AS negative_stock FROM inventory""",
)
def read_inventory(spark, sf):
    """Delimiter found, then cleaned."""
    line = F.concat_ws(
        ",",
        "id",
        "description",
        "category",
        "dept",
        F.format_string("%.2f", "price"),
        F.coalesce(F.col("min_stock").cast("string"), F.lit("")),
        "stock",
    )
    items = views.inventory(spark, sf).select(line.alias("value"))
    path = _export(spark, items, [",,,,,,", INVENTORY_HEADER], "inventario.csv")
    clean = cleaning.clean_inventory(sources.read_inventory(spark, path), {"STANDARD": 5})
    return clean.select("id", "description", "dept", "price", "min_stock", "stock", "negative_stock")


@query(
    "write_and_load_clean",
    """SELECT CAST(id AS VARCHAR) AS id, CAST(day AS VARCHAR) AS date, pay, CAST(customer AS VARCHAR) AS customer,
  round(total, 2) AS total FROM sales WHERE id % 100 <> 0""",
)
def write_and_load_clean(spark, sf):
    """Clean table written, then preferred over the raw export."""
    base = scratch_path(spark, "store")
    raw = sources.read_sales(spark, sales_export(spark, sf))
    sources.write_clean({"sales": cleaning.clean_sales(raw)}, base)
    return sources.load_table(spark, base, "sales")


@query(
    "write_features",
    "SELECT pay, count(*) AS n FROM sales GROUP BY pay",
)
def write_features(spark, sf):
    """Partitioned feature table, read back by partition."""
    path = scratch_path(spark, "features")
    sources.write_features(views.sales(spark, sf), path, ["pay"])
    return spark.read.parquet(path).groupBy("pay").agg(F.count(F.lit(1)).alias("n"))


@query(
    "write_eval_report",
    "SELECT pay, round(avg(total), 4) AS mean FROM sales GROUP BY pay",
)
def write_eval_report(spark, sf):
    """Metric rows as JSON, read back."""
    path = scratch_path(spark, "report")
    rows = views.sales(spark, sf).groupBy("pay").agg(F.round(F.avg("total"), 4).alias("mean"))
    sources.write_eval_report(rows, path)
    return spark.read.schema("pay string, mean double").json(path)
