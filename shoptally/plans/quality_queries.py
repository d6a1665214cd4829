"""Cleaning, scalar functions and data-quality audit. Dirty input is made from clean columns on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally import functions as fn
from shoptally.operators import cleaning, quality
from shoptally.plans import views
from shoptally.plans.registry import query, rounded

DIRTY_SALES = """, raw AS (
  SELECT CASE WHEN id % 50 = 7 THEN NULL ELSE '  ' || id END AS id,
    CASE WHEN id % 11 = 0 THEN 'no date' WHEN id % 3 = 0 THEN strftime(day, '%Y-%m-%d 10:30:00')
         WHEN id % 3 = 1 THEN strftime(day, '%Y/%m/%d') ELSE strftime(day, '%Y-%m-%d') END AS date,
    '  ' || lower(pay) || ' ' AS pay, customer,
    CASE WHEN id % 13 = 5 THEN NULL WHEN id % 17 = 3 THEN 'x' ELSE '1,' || CAST(CAST(floor(total) AS BIGINT) AS VARCHAR) END AS total
  FROM sales)
"""


def dirty_sales(spark, sf):
    s = views.sales(spark, sf)
    k = F.col("id")
    day = F.col("day").cast("timestamp")
    return s.select(
        F.when(k % 50 == 7, None).otherwise(F.concat(F.lit("  "), k.cast("string"))).alias("id"),
        F.when(k % 11 == 0, "no date")
        .when(k % 3 == 0, F.date_format(day, "yyyy-MM-dd '10:30:00'"))
        .when(k % 3 == 1, F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("date"),
        F.concat(F.lit("  "), F.lower("pay"), F.lit(" ")).alias("pay"),
        "customer",
        F.when(k % 13 == 5, None)
        .when(k % 17 == 3, "x")
        .otherwise(F.concat(F.lit("1,"), F.floor("total").cast("long").cast("string")))
        .alias("total"),
    )


@query(
    "clean_sales",
    DIRTY_SALES
    + """SELECT id, CASE WHEN date = 'no date' THEN NULL ELSE replace(left(date, 10), '/', '-') END AS date,
  upper(trim(pay)) AS pay, customer, coalesce(TRY_CAST(replace(total, ',', '') AS DOUBLE), 0) AS total
FROM raw WHERE id IS NOT NULL AND total IS NOT NULL""",
)
def clean_sales(spark, sf):
    return cleaning.clean_sales(dirty_sales(spark, sf))


@query(
    "clean_lines",
    """, raw AS (SELECT CASE WHEN id % 40 = 1 THEN NULL ELSE ' ' || id || ' ' END AS id,
  CASE WHEN product % 9 = 0 THEN NULL ELSE '  ' || description || ' ' END AS description,
  CASE WHEN product % 7 = 0 THEN 'bad' WHEN product % 7 = 1 THEN '-' || CAST(CAST(qty AS BIGINT) AS VARCHAR)
       ELSE CAST(CAST(qty AS BIGINT) AS VARCHAR) END AS qty,
  strftime(shipped, '%Y-%m-%d') AS date FROM lines)
SELECT trim(id) AS id, trim(coalesce(description, 'SIN DESCRIPCION')) AS description,
  greatest(coalesce(TRY_CAST(qty AS DOUBLE), 0), 0) AS qty, date FROM raw WHERE id IS NOT NULL""",
)
def clean_lines(spark, sf):
    k, p, q = F.col("id"), F.col("product"), F.col("qty").cast("long").cast("string")
    raw = views.lines(spark, sf).select(
        F.when(k % 40 == 1, None).otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit(" "))).alias("id"),
        F.when(p % 9 == 0, None).otherwise(F.concat(F.lit("  "), "description", F.lit(" "))).alias("description"),
        F.when(p % 7 == 0, "bad").when(p % 7 == 1, F.concat(F.lit("-"), q)).otherwise(q).alias("qty"),
        F.date_format(F.col("shipped").cast("timestamp"), "yyyy-MM-dd").alias("date"),
    )
    return cleaning.clean_lines(raw)


DIRTY_INVENTORY = """, raw AS (SELECT id, description, CASE WHEN id % 5 = 0 THEN lower(dept) || ' ' ELSE dept END AS dept,
  CASE WHEN id % 6 = 0 THEN 'n/a' ELSE '1,' || CAST(CAST(floor(price) AS BIGINT) AS VARCHAR) END AS price,
  CAST(min_stock AS VARCHAR) AS min_stock, CASE WHEN id % 8 = 0 THEN NULL ELSE CAST(stock AS VARCHAR) || '.0' END AS stock
  FROM inventory)
"""


def dirty_inventory(spark, sf):
    k = F.col("id")
    return views.inventory(spark, sf).select(
        "id",
        "description",
        F.when(k % 5 == 0, F.concat(F.lower("dept"), F.lit(" "))).otherwise(F.col("dept")).alias("dept"),
        F.when(k % 6 == 0, "n/a")
        .otherwise(F.concat(F.lit("1,"), F.floor("price").cast("long").cast("string")))
        .alias("price"),
        F.col("min_stock").cast("string").alias("min_stock"),
        F.when(k % 8 == 0, None).otherwise(F.concat(F.col("stock").cast("string"), F.lit(".0"))).alias("stock"),
    )


@query(
    "clean_inventory",
    DIRTY_INVENTORY
    + """SELECT id, description, dept, coalesce(TRY_CAST(replace(price, ',', '') AS DOUBLE), 0) AS price,
  coalesce(CAST(min_stock AS INTEGER), CASE WHEN upper(trim(dept)) = 'STANDARD' THEN 5 ELSE 2 END) AS min_stock,
  greatest(coalesce(CAST(CAST(stock AS DOUBLE) AS INTEGER), 0), 0) AS stock,
  coalesce(CAST(stock AS DOUBLE) < 0, false) AS negative_stock FROM raw""",
)
def clean_inventory(spark, sf):
    return cleaning.clean_inventory(dirty_inventory(spark, sf), {"STANDARD": 5})


@query("drop_ghost_columns", "SELECT id, dept FROM inventory")
def drop_ghost_columns(spark, sf):
    raw = views.inventory(spark, sf).select("id", "dept", F.lit(None).cast("string").alias("Unnamed: 0"))
    return cleaning.drop_ghost_columns(raw)


@query(
    "to_number",
    """SELECT id, CASE WHEN id % 6 = 0 THEN 0 ELSE CAST(floor(total) + 1000000000 AS DOUBLE) END AS amount,
  CASE WHEN id % 6 = 0 THEN NULL ELSE CAST(id % 1000 AS INTEGER) END AS whole FROM sales""",
)
def to_number(spark, sf):
    k = F.col("id")
    text = F.concat(F.lit(" 1,"), F.lpad(F.floor("total").cast("long").cast("string"), 9, "0"), F.lit(" "))
    raw = views.sales(spark, sf).select(
        "id",
        F.when(k % 6 == 0, "12a").otherwise(text).alias("a"),
        F.when(k % 6 == 0, "").otherwise(F.concat((k % 1000).cast("string"), F.lit(".0"))).alias("w"),
    )
    return raw.select("id", fn.to_number("a", 0.0).alias("amount"), fn.to_number("w", kind="int").alias("whole"))


@query(
    "parse_date",
    "SELECT id, CASE WHEN id % 7 = 0 THEN NULL ELSE day END AS day FROM sales",
)
def parse_date(spark, sf):
    k, day = F.col("id"), F.col("day").cast("timestamp")
    raw = views.sales(spark, sf).select(
        "id",
        F.when(k % 7 == 0, "31/31/1999")
        .when(k % 7 == 1, F.date_format(day, "M/d/yyyy"))
        .when(k % 7 == 2, F.date_format(day, "M/d/yyyy HH:mm"))
        .when(k % 7 == 3, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("t"),
    )
    return raw.select("id", fn.parse_date("t").cast("date").alias("day"))


_FIX_RAW = """, raw AS (SELECT customer, id,
  CASE WHEN id % 19 = 0 THEN NULL WHEN id % 23 = 0 THEN 'soon' WHEN id % 2 = 0 THEN strftime(day, '%-d/%-m/%Y') ELSE strftime(day, '%-m/%-d/%Y') END AS text,
  make_date(CAST(year(day) AS INTEGER), CAST(month(day) AS INTEGER), CAST(day(day) AS INTEGER)) AS d1,
  CASE WHEN day(day) <= 12 THEN make_date(CAST(year(day) AS INTEGER), CAST(day(day) AS INTEGER), CAST(month(day) AS INTEGER)) ELSE day END AS d2
  FROM sales)
"""


@query(
    "disambiguate_dates",
    _FIX_RAW
    + """, ok AS (SELECT customer, id, least(d1, d2) AS a, greatest(d1, d2) AS b,
  row_number() OVER (PARTITION BY customer ORDER BY id) AS rn FROM raw WHERE text IS NOT NULL AND text <> 'soon'),
walk AS (
  SELECT customer, id, rn, a AS fixed FROM ok WHERE rn = 1
  UNION ALL
  SELECT o.customer, o.id, o.rn, CASE WHEN o.a >= w.fixed THEN o.a WHEN o.b >= w.fixed THEN o.b ELSE o.a END
  FROM walk w JOIN ok o ON o.customer = w.customer AND o.rn = w.rn + 1)
SELECT r.customer, r.id, r.text, w.fixed AS date_fixed FROM raw r LEFT JOIN walk w ON w.id = r.id""",
)
def disambiguate_dates(spark, sf):
    k, day = F.col("id"), F.col("day").cast("timestamp")
    raw = views.sales(spark, sf).select(
        "customer",
        "id",
        F.when(k % 19 == 0, None)
        .when(k % 23 == 0, "soon")
        .when(k % 2 == 0, F.date_format(day, "d/M/yyyy"))
        .otherwise(F.date_format(day, "M/d/yyyy"))
        .alias("text"),
    )
    return cleaning.disambiguate_dates(raw, "id", "text", ["customer"])


@query(
    "normalize_text",
    r"""SELECT doc_id, md5(upper(trim(regexp_replace(strip_accents(replace(text, 'ß', 'SS')), '\s+', ' ', 'g')))) AS digest,
  CAST(length(upper(trim(regexp_replace(strip_accents(replace(text, 'ß', 'SS')), '\s+', ' ', 'g')))) AS INTEGER) AS n FROM documents""",
    ctes=False,
)
def normalize_text(spark, sf):
    text = fn.normalize_text("text")
    return views.table(spark, sf, "documents").select("doc_id", F.md5(text).alias("digest"), F.length(text).alias("n"))


@query("normalize_id", "SELECT id AS n, 'P' || id AS key FROM inventory")
def normalize_id(spark, sf):
    raw = views.inventory(spark, sf).select(
        F.col("id").alias("n"), F.concat(F.lit("  p"), F.col("id").cast("string"), F.lit(".0 ")).alias("raw")
    )
    return raw.select("n", fn.normalize_id("raw").alias("key"))


@query("payment_label", "SELECT id, pay AS clean, upper(left(pay, 1)) || lower(substr(pay, 2)) AS raw FROM sales")
def payment_label(spark, sf):
    dirty = F.concat(F.lit(" "), F.lower("pay"), F.lit(" "))
    return views.sales(spark, sf).select(
        "id", fn.payment_label(dirty).alias("clean"), fn.payment_label(dirty, "capital").alias("raw")
    )


@query(
    "calendar_parts",
    """SELECT event_id, dayname(ts) AS day_name, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
  CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, CAST(weekofyear(ts) AS INTEGER) AS iso_week FROM events""",
    ctes=False,
)
def calendar_parts(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", "ts")
    return fn.calendar_parts(events, "ts").drop("ts")


@query("has_time", "SELECT id, id % 3 = 0 AS timed FROM sales")
def has_time(spark, sf):
    day = F.col("day").cast("timestamp")
    raw = views.sales(spark, sf).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.date_format(day, "yyyy-MM-dd HH:mm"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("t"),
    )
    return raw.select("id", fn.has_time("t").alias("timed"))


@query(
    "spend_by_role",
    """SELECT id, line_no, product, CASE WHEN dept = 'STANDARD' THEN subtotal ELSE 0 END AS spend_1,
  CASE WHEN dept = 'PROMO' THEN subtotal ELSE 0 END AS spend_2,
  CASE WHEN dept IN ('STANDARD', 'PROMO') THEN 0 ELSE subtotal END AS spend_other FROM lines""",
)
def spend_by_role(spark, sf):
    split = fn.spend_by_role(views.lines(spark, sf), roles=views.ROLES)
    return split.select("id", "line_no", "product", "spend_1", "spend_2", "spend_other")


@query(
    "ratios",
    """SELECT id, CASE WHEN stock > 0 THEN round(price / stock + 1e-9, 4) ELSE 0 END AS guarded,
  round(price / nullif(stock, 0) + 1e-9, 4) AS unguarded,
  CASE WHEN price >= stock * 100 THEN 'STANDARD' ELSE 'PROMO' END AS dominant FROM inventory""",
)
def ratios(spark, sf):
    """Guarded ratio, unguarded ratio and dominant role."""
    table = views.inventory(spark, sf).select(
        "id",
        fn.safe_ratio("price", "stock", None).alias("guarded"),
        fn.ratio_or_null("price", "stock").alias("unguarded"),
        fn.dominant_role(F.col("price"), F.col("stock") * 100, views.ROLES).alias("dominant"),
    )
    return rounded(table, 1e-9, guarded=4, unguarded=4)


@query(
    "encode_target",
    """SELECT o_orderpriority AS priority, count(*) AS n,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 0 END AS INTEGER) AS target FROM orders GROUP BY 1""",
    ctes=False,
)
def encode_target(spark, sf):
    coded = fn.encode_target("o_orderpriority", {"1-URGENT": 1, "5-LOW": 0})
    return (
        views.table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("priority"), coded.alias("target"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "split_tax",
    "SELECT id, total, round(total / 1.18, 4) AS net, round(total - total / 1.18, 4) AS tax FROM sales",
)
def split_tax(spark, sf):
    return fn.split_tax(views.sales(spark, sf).select("id", "total")).withColumns(
        {"net": F.round("net", 4), "tax": F.round("tax", 4)}
    )


@query(
    "log_scale",
    "SELECT id, round(ln(1 + total), 6) AS logged, round(total, 4) AS back FROM sales",
)
def log_scale(spark, sf):
    logged = views.sales(spark, sf).select("id", fn.log_scale("total").alias("logged"))
    return logged.select(
        "id", F.round("logged", 6).alias("logged"), F.round(fn.unlog_scale("logged"), 4).alias("back")
    )


@query("as_of", "SELECT id, day FROM sales WHERE day <= DATE '1998-06-30'")
def as_of(spark, sf):
    return fn.as_of(views.sales(spark, sf).select("id", "day"), "day", "1998-06-30")


@query(
    "rule_payment",
    """SELECT event_id, CASE WHEN event_type = 'error' OR value < 8 THEN 'EFECTIVO' ELSE 'YAPE' END AS pay_rule,
  CASE WHEN event_type = 'error' OR value < 8 THEN 0.73 WHEN value > 30 OR hour(ts) >= 18 THEN 0.84 ELSE 0.68 END::DOUBLE AS confidence
FROM events""",
    ctes=False,
)
def rule_payment(spark, sf):
    events = views.table(spark, sf, "events").select(
        "event_id", F.hour(F.col("ts").cast("timestamp")).alias("hour"), "value", "event_type"
    )
    ruled = fn.rule_payment(events, "value", "hour", "event_type", "error")
    return ruled.select("event_id", "pay_rule", "confidence")


@query("dataset_shape", "SELECT count(*) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM inventory")
def dataset_shape(spark, sf):
    return quality.dataset_shape(views.inventory(spark, sf))


@query("preview", "SELECT id, description, stock FROM inventory ORDER BY id LIMIT 5")
def preview(spark, sf):
    return quality.preview(views.inventory(spark, sf).select("id", "description", "stock"), 5, "id")


_NULLS = """, n AS (SELECT *, (CASE WHEN date IS NULL THEN 1 ELSE 0 END) + (CASE WHEN id IS NULL THEN 1 ELSE 0 END)
  + (CASE WHEN total IS NULL THEN 1 ELSE 0 END) AS k FROM raw)
"""


@query(
    "completeness",
    DIRTY_SALES
    + _NULLS
    + """SELECT count(*) AS n_rows, count(*) FILTER (WHERE k = 0) AS n_complete, CAST(sum(k) AS BIGINT) AS n_null_cells,
  round(count(*) FILTER (WHERE k = 0) * 100.0 / count(*), 4) AS coverage_pct FROM n""",
)
def completeness(spark, sf):
    return rounded(quality.completeness(dirty_sales(spark, sf)), coverage_pct=4)


@query(
    "null_audit",
    DIRTY_SALES
    + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
  round(100.0 * count({c}) / count(*), 4) AS complete_pct FROM raw"""
        for c in ("id", "date", "pay", "customer", "total")
    ),
)
def null_audit(spark, sf):
    return rounded(quality.null_audit(dirty_sales(spark, sf)), complete_pct=4)


@query(
    "compare_quality",
    DIRTY_SALES
    + _NULLS
    + """, c AS (SELECT *, CASE WHEN date = 'no date' THEN 1 ELSE 0 END AS bad FROM raw WHERE id IS NOT NULL AND total IS NOT NULL)
SELECT 'before' AS stage, count(*) AS n_rows, count(*) FILTER (WHERE k = 0) AS n_complete, CAST(sum(k) AS BIGINT) AS n_null_cells,
  round(count(*) FILTER (WHERE k = 0) * 100.0 / count(*), 4) AS coverage_pct FROM n
UNION ALL SELECT 'after', count(*), count(*) FILTER (WHERE bad = 0), CAST(sum(bad) AS BIGINT),
  round(count(*) FILTER (WHERE bad = 0) * 100.0 / count(*), 4) FROM c""",
)
def compare_quality(spark, sf):
    raw = dirty_sales(spark, sf)
    return rounded(quality.compare_quality(raw, cleaning.clean_sales(raw)), coverage_pct=4)


@query(
    "frequency_table",
    DIRTY_SALES
    + """SELECT pay, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM raw), 4) AS pct
FROM (SELECT CASE WHEN date IS NULL THEN NULL ELSE upper(trim(pay)) END AS pay FROM raw) WHERE pay IS NOT NULL GROUP BY pay""",
)
def frequency_table(spark, sf):
    labels = dirty_sales(spark, sf).select(F.when(F.col("date").isNotNull(), fn.payment_label("pay")).alias("pay"))
    return rounded(quality.frequency_table(labels, "pay"), pct=4)


@query(
    "crosstab",
    """, f AS (SELECT dept, coalesce(CAST(min_stock AS VARCHAR), 'SIN DATO') AS min_stock FROM inventory)
SELECT CASE WHEN grouping(dept) = 1 THEN 'All' ELSE dept END AS dept,
  CASE WHEN grouping(min_stock) = 1 THEN 'All' ELSE min_stock END AS min_stock, count(*) AS n FROM f GROUP BY CUBE (dept, min_stock)""",
)
def crosstab(spark, sf):
    return quality.crosstab(views.inventory(spark, sf), "dept", "min_stock")


@query(
    "entry_time_profile",
    """SELECT 'weekday' AS unit, CAST(isodow(ts) - 1 AS INTEGER) AS slot, count(*) AS n FROM events GROUP BY 2
UNION ALL SELECT 'hour', CAST(hour(ts) AS INTEGER), count(*) FROM events GROUP BY 2""",
    ctes=False,
)
def entry_time_profile(spark, sf):
    events = views.table(spark, sf, "events")
    parts = [
        quality.entry_time_profile(events, "ts", u).select(F.lit(u).alias("unit"), F.col(u).alias("slot"), "n")
        for u in ("weekday", "hour")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "batch_entry_share",
    DIRTY_SALES
    + """SELECT count(*) AS n_rows, count(*) FILTER (WHERE contains(date, ':')) AS n_timed,
  round(100.0 * count(*) FILTER (WHERE contains(date, ':')) / count(*), 4) AS timed_pct FROM raw""",
)
def batch_entry_share(spark, sf):
    return rounded(quality.batch_entry_share(dirty_sales(spark, sf), "date"), timed_pct=4)


@query(
    "reorder_point_profile",
    "SELECT dept, min_stock, count(*) AS n FROM inventory WHERE min_stock IS NOT NULL GROUP BY ALL",
)
def reorder_point_profile(spark, sf):
    return quality.reorder_point_profile(views.inventory(spark, sf))


@query("negative_stock", "SELECT id, description, dept, stock FROM inventory WHERE stock < 0 ORDER BY stock, id LIMIT 10")
def negative_stock(spark, sf):
    return quality.negative_stock(views.inventory(spark, sf))


@query(
    "stack_results",
    """SELECT pay, round(sum(total), 2) AS total FROM sales GROUP BY pay
UNION ALL SELECT 'ALL', round(sum(total), 2) FROM sales""",
)
def stack_results(spark, sf):
    s = views.sales(spark, sf)
    stacked = quality.stack_results(
        s.groupBy("pay").agg(F.sum("total").alias("total")),
        s.agg(F.sum("total").alias("total")).withColumn("pay", F.lit("ALL")),
    )
    return rounded(stacked, total=2)
