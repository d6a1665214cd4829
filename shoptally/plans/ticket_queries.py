"""Ticket features, joins, totals and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally.operators import outliers, tickets
from shoptally.plans import views
from shoptally.plans.registry import FEATURES_CTE, query, rounded


def _features(spark, sf):
    return tickets.ticket_features(views.sales(spark, sf), views.lines(spark, sf))


_ROUND_FEATURES = {"unit_ticket": 4, "diversity": 6, "std_subtotal": 4}
_SQL_ROUND = """total, units, n_products, round(unit_ticket + 1e-9, 4) AS unit_ticket, round(diversity + 1e-9, 6) AS diversity,
 n_depts, max_subtotal, round(std_subtotal + 1e-9, 4) AS std_subtotal"""


@query("ticket_features", FEATURES_CTE + f"SELECT id, pay, {_SQL_ROUND} FROM features")
def ticket_features(spark, sf):
    return rounded(_features(spark, sf), 1e-9, **_ROUND_FEATURES)


@query(
    "ticket_spend_profile",
    """, p AS (
  SELECT id, sum(qty) AS units, count(DISTINCT product) AS variety, sum(subtotal) AS subtotal,
    sum(CASE WHEN upper(trim(dept)) = 'STANDARD' THEN subtotal ELSE 0 END) AS spend_1,
    sum(CASE WHEN upper(trim(dept)) = 'PROMO' THEN subtotal ELSE 0 END) AS spend_2,
    sum(CASE WHEN upper(trim(dept)) IN ('STANDARD','PROMO') THEN 0 ELSE subtotal END) AS spend_other
  FROM lines GROUP BY id)
SELECT id, units, variety, round(subtotal + 1e-9, 2) AS subtotal, round(spend_1 + 1e-9, 2) AS spend_1, round(spend_2 + 1e-9, 2) AS spend_2,
  round(spend_other + 1e-9, 2) AS spend_other,
  CASE WHEN units > 0 THEN round(subtotal / units + 1e-9, 4) ELSE 0.0 END AS unit_price,
  CASE WHEN subtotal > 0 THEN round(spend_1 / subtotal + 1e-9, 4) ELSE 0 END AS share_1,
  CASE WHEN spend_1 >= spend_2 THEN 'STANDARD' ELSE 'PROMO' END AS dominant
FROM p""",
)
def ticket_spend_profile(spark, sf):
    profile = tickets.ticket_spend_profile(views.lines(spark, sf), views.ROLES, digits=None)
    return rounded(profile, 1e-9, subtotal=2, spend_1=2, spend_2=2, spend_other=2, unit_price=4, share_1=4)


@query(
    "ticket_first_hour",
    """SELECT id, sum(qty) AS units, arg_min(h, line_no * 100 + h) AS first_hour
FROM (SELECT id, qty, line_no, hour(CAST(shipped AS TIMESTAMP) + to_hours(CAST(product % 24 AS INTEGER))) AS h FROM lines)
GROUP BY id""",
)
def ticket_first_hour(spark, sf):
    stamped = views.lines(spark, sf).withColumn(
        "at", F.col("shipped").cast("timestamp") + F.make_dt_interval(hours=(F.col("product") % 24).cast("int"))
    )
    return tickets.ticket_first_hour(stamped).withColumn("first_hour", F.col("first_hour").cast("long"))


PAYMENT_CTE = """
, dept_counts AS (SELECT id, dept, count(*) AS n FROM lines GROUP BY id, dept),
main AS (SELECT id, dept AS main_dept FROM (
  SELECT id, dept, row_number() OVER (PARTITION BY id ORDER BY n DESC, dept) AS rn FROM dept_counts) WHERE rn = 1),
per AS (SELECT id, sum(qty) AS units, count(DISTINCT product) AS n_products,
  avg(CASE WHEN dept = 'PROMO' THEN 1.0 ELSE 0.0 END) AS dept_share FROM lines GROUP BY id),
payment AS (
  SELECT s.id, s.total, p.units, p.n_products, m.main_dept, round(p.dept_share, 6) AS dept_share,
    CAST(isodow(s.day) - 1 AS INTEGER) AS weekday, CAST(CASE WHEN isodow(s.day) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST(CASE WHEN s.pay = 'YAPE' THEN 1 ELSE 0 END AS INTEGER) AS target
  FROM sales s JOIN per p USING (id) JOIN main m USING (id))
"""


@query("payment_features", PAYMENT_CTE + "SELECT * FROM payment")
def payment_features(spark, sf):
    return rounded(tickets.payment_features(views.sales(spark, sf), views.lines(spark, sf), "PROMO"), dept_share=6)


@query("ticket_sizes", "SELECT id, count(product) AS n_lines, count(DISTINCT product) AS n_products FROM lines GROUP BY id")
def ticket_sizes(spark, sf):
    return tickets.ticket_sizes(views.lines(spark, sf))


@query(
    "attach_header",
    """, a AS (SELECT id, sum(qty) AS units FROM lines GROUP BY id)
SELECT s.id, a.units, s.day, s.customer, s.total, s.pay FROM a JOIN sales s USING (id)""",
)
def attach_header(spark, sf):
    per_ticket = views.lines(spark, sf).groupBy("id").agg(F.sum("qty").alias("units"))
    return tickets.attach_header(per_ticket, views.sales(spark, sf))


@query(
    "enrich_lines",
    """SELECT l.l_orderkey AS id, l.l_linenumber AS line_no, l.l_partkey AS product, i.category, i.price
FROM lineitem l LEFT JOIN inventory i ON i.id = l.l_partkey""",
)
def enrich_lines(spark, sf):
    sold = views.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("product")
    )
    return tickets.enrich_lines(sold, views.inventory(spark, sf), ["category", "price"])


@query(
    "extreme_tickets",
    """SELECT * FROM (SELECT 'max' AS which, id, total FROM sales ORDER BY total DESC, id LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'min' AS which, id, total FROM sales ORDER BY total, id LIMIT 1)""",
)
def extreme_tickets(spark, sf):
    return tickets.extreme_tickets(views.sales(spark, sf))


@query(
    "extreme_ticket_lines",
    """, k AS (SELECT * FROM (SELECT 'max' AS which, id FROM sales ORDER BY total DESC, id LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'min' AS which, id FROM sales ORDER BY total, id LIMIT 1))
SELECT k.which, l.id, l.product, l.qty, l.subtotal FROM lines l JOIN k USING (id)""",
)
def extreme_ticket_lines(spark, sf):
    picked = tickets.extreme_ticket_lines(views.sales(spark, sf), views.lines(spark, sf))
    return picked.select("which", "id", "product", "qty", "subtotal")


@query(
    "orphans",
    """SELECT DISTINCT l_orderkey AS id, 'no_header' AS problem FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT o_orderkey, 'no_lines' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    ctes=False,
)
def orphans(spark, sf):
    sold = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return tickets.orphans(views.sales(spark, sf), sold)


@query(
    "sales_kpis",
    "SELECT count(*) AS n_tickets, round(sum(total), 2) AS revenue, round(avg(total), 4) AS mean_ticket FROM sales",
)
def sales_kpis(spark, sf):
    return rounded(tickets.sales_kpis(views.sales(spark, sf)), revenue=2, mean_ticket=4)


@query(
    "ranked_totals",
    """SELECT * FROM (SELECT 'revenue' AS measure, dept AS key, round(sum(subtotal), 2) AS total FROM lines GROUP BY dept ORDER BY sum(subtotal) DESC, dept LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'units', category, round(sum(qty), 2) FROM lines GROUP BY category ORDER BY sum(qty) DESC, category LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'product_units', description, round(sum(qty), 2) FROM lines GROUP BY description ORDER BY sum(qty) DESC, description LIMIT 5)""",
)
def ranked_totals(spark, sf):
    sold = views.lines(spark, sf)
    parts = [
        tickets.ranked_totals(sold, key, value).select(
            F.lit(measure).alias("measure"), F.col(key).alias("key"), F.round("total", 2).alias("total")
        )
        for measure, key, value in (
            ("revenue", "dept", "subtotal"),
            ("units", "category", "qty"),
            ("product_units", "description", "qty"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "top_products",
    "SELECT description, count(*) AS n_lines FROM lines GROUP BY description ORDER BY n_lines DESC, description LIMIT 20",
)
def top_products(spark, sf):
    return tickets.top_products(views.lines(spark, sf))


@query(
    "dedupe_first",
    """SELECT product, id, line_no, qty FROM (SELECT l_partkey AS product, l_orderkey AS id, l_linenumber AS line_no, l_quantity AS qty,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem) WHERE rn = 1""",
    ctes=False,
)
def dedupe_first(spark, sf):
    sold = views.lines(spark, sf).select("product", "id", "line_no", "qty")
    return tickets.dedupe_first(sold, "product", ["id", "line_no", "qty"])


_TUKEY = """, q AS (SELECT quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.75) AS q3,
  quantile_cont(units, 0.25) AS u1, quantile_cont(units, 0.75) AS u3 FROM features),
f AS (SELECT *, q3 + 0.5 * (q3 - q1) AS upper_total, u3 + 0.5 * (u3 - u1) AS upper_units FROM q)
"""


@query(
    "tukey_fences",
    FEATURES_CTE
    + """, c AS (SELECT 'units' AS measure, CAST(units AS DOUBLE) AS v FROM features UNION ALL SELECT 'total', total FROM features
  UNION ALL SELECT 'std_subtotal', std_subtotal FROM features),
q AS (SELECT measure, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM c GROUP BY measure),
f AS (SELECT *, q3 - q1 AS iqr, greatest(q1 - 1.5 * (q3 - q1), 0) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT f.measure, f.n, round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr, round(lower, 4) AS lower, round(upper, 4) AS upper,
  count(*) FILTER (WHERE c.v > f.upper) AS n_outliers, round(100.0 * count(*) FILTER (WHERE c.v > f.upper) / f.n, 4) AS outlier_pct
FROM f JOIN c ON c.measure = f.measure GROUP BY f.measure, f.n, q1, q3, iqr, lower, upper""",
)
def tukey_fences(spark, sf):
    fences = outliers.tukey_fences(_features(spark, sf), ["units", "total", "std_subtotal"])
    fences = fences.withColumnRenamed("column", "measure")
    return rounded(fences, q1=4, q3=4, iqr=4, lower=4, upper=4, outlier_pct=4)


@query(
    "tukey_split",
    FEATURES_CTE
    + _TUKEY
    + """SELECT id, total, units, CASE WHEN total <= upper_total AND units <= upper_units THEN 'normal' ELSE 'isolated' END AS part
FROM features, f""",
)
def tukey_split(spark, sf):
    normal, isolated = outliers.tukey_split(_features(spark, sf).select("id", "total", "units"), ["total", "units"], 0.5)
    return normal.withColumn("part", F.lit("normal")).unionByName(isolated.withColumn("part", F.lit("isolated")))


@query(
    "volume_segment",
    FEATURES_CTE
    + _TUKEY
    + """SELECT id, units, units > upper_units AS is_outlier,
  CASE WHEN units > upper_units THEN 'Mayorista / Compra Atípica' ELSE 'Estándar Minorista' END AS segment FROM features, f""",
)
def volume_segment(spark, sf):
    return outliers.volume_segment(_features(spark, sf).select("id", "units"), "units", 0.5)


@query(
    "top_outlier_tickets",
    FEATURES_CTE
    + _TUKEY
    + "SELECT id, units, total FROM features, f WHERE units > upper_units ORDER BY units DESC, id LIMIT 8",
)
def top_outlier_tickets(spark, sf):
    features = _features(spark, sf).select("id", "units", "total")
    return outliers.top_outlier_tickets(features, 8, "units", k=0.5).select("id", "units", "total")
