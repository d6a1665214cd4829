"""Query registry: each query is a function of (spark, sf_dir), with its SQL oracle where the result is exact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The point-of-sale reading of the supplied tables, as SQL; ``views.py`` states the same for Spark.
CTES = """
WITH RECURSIVE sales AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_custkey AS customer, o_totalprice AS total,
         CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'YAPE' ELSE 'EFECTIVO' END AS pay
  FROM orders),
inventory AS (
  SELECT p_partkey AS id, p_name AS description, p_brand AS category, p_type AS dept, p_retailprice AS price,
         p_size - 20 AS stock, CASE WHEN p_partkey % 4 = 0 THEN p_size END AS min_stock
  FROM part),
lines AS (
  SELECT l_orderkey AS id, l_partkey AS product, p_type AS dept, p_name AS description, p_brand AS category,
         l_quantity AS qty, l_extendedprice AS subtotal, l_linenumber AS line_no, l_shipdate AS shipped
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""

FEATURES_CTE = """
, agg AS (
  SELECT id, sum(qty) AS units, count(DISTINCT product) AS n_products, count(DISTINCT dept) AS n_depts,
         max(subtotal) AS max_subtotal, coalesce(stddev_samp(subtotal), 0) AS std_subtotal
  FROM lines GROUP BY id),
features AS (
  SELECT s.id, s.pay, s.total, a.units, a.n_products, s.total / nullif(a.units, 0) AS unit_ticket,
         a.n_products / nullif(a.units, 0) AS diversity, a.n_depts, a.max_subtotal, a.std_subtotal
  FROM sales s JOIN agg a USING (id))
"""


def query(name: str, sql: str | None = None, ctes=True):
    """Register a query; ``sql`` continues the common table expressions unless ``ctes`` is false."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = (CTES + sql) if ctes else sql
        return function

    return register


def rounded(df: DataFrame, shift=0.0, **digits: int) -> DataFrame:
    """Round the named columns, so that two engines' summation orders give equal values.

    A small ``shift``, also stated in the SQL, moves exact ties (cents over an even count) to one side in both engines.
    """
    return df.withColumns({c: F.round(F.col(c) + shift, d) for c, d in digits.items()})
