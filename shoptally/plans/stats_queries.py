"""Descriptive and bivariate statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally.operators import stats, tickets
from shoptally.operators.joins import join_dimension
from shoptally.plans import views
from shoptally.plans.registry import FEATURES_CTE, query, rounded

_COLS = ("total", "units", "n_products", "std_subtotal")
_LONG = FEATURES_CTE + ", l AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, pay, CAST({c} AS DOUBLE) AS v FROM features" for c in _COLS
) + ")\n"


def _features(spark, sf):
    return tickets.ticket_features(views.sales(spark, sf), views.lines(spark, sf))


@query(
    "univariate_stats",
    _LONG
    + """, m AS (SELECT c, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM l GROUP BY c),
p AS (SELECT l.c, avg(power(v - mean, 2)) AS m2, avg(power(v - mean, 3)) AS m3, avg(power(v - mean, 4)) AS m4 FROM l JOIN m USING (c) GROUP BY l.c),
o AS (SELECT c, v AS mode FROM (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, v) AS rn FROM l GROUP BY c, v) WHERE rn = 1)
SELECT c AS "column", n, round(mean, 4) AS mean, round(median, 4) AS median, round(mode, 4) AS mode, round(std, 4) AS std, round(iqr, 4) AS iqr,
  round(std / mean * 100, 4) AS cv_pct, round(m3 / power(m2, 1.5), 6) AS skew, round(m4 / (m2 * m2) - 3, 6) AS kurtosis
FROM m JOIN p USING (c) JOIN o USING (c)""",
)
def univariate_stats(spark, sf):
    table = stats.univariate_stats(_features(spark, sf), _COLS)
    return rounded(table, mean=4, median=4, mode=4, std=4, iqr=4, cv_pct=4, skew=6, kurtosis=6)


@query(
    "describe_numeric",
    _LONG
    + """SELECT c AS "column", count(*) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min,
  round(quantile_cont(v, 0.25), 4) AS q1, round(quantile_cont(v, 0.5), 4) AS median, round(quantile_cont(v, 0.75), 4) AS q3, round(max(v), 4) AS max
FROM l GROUP BY c""",
)
def describe_numeric(spark, sf):
    table = stats.describe_numeric(_features(spark, sf), _COLS)
    return rounded(table, mean=4, std=4, min=4, q1=4, median=4, q3=4, max=4)


@query(
    "grouped_summary",
    """SELECT dept, c AS "column", round(avg(v), 2) AS mean, round(quantile_cont(v, 0.5), 2) AS median, round(stddev_samp(v), 2) AS std
FROM (SELECT dept, 'qty' AS c, qty AS v FROM lines UNION ALL SELECT dept, 'subtotal', subtotal FROM lines) GROUP BY dept, c""",
)
def grouped_summary(spark, sf):
    return stats.grouped_summary(views.lines(spark, sf), "dept", ["qty", "subtotal"])


@query(
    "class_mix",
    """SELECT dept, pay, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY dept), 6) AS share
FROM lines JOIN sales USING (id) GROUP BY dept, pay""",
)
def class_mix(spark, sf):
    joined = join_dimension(views.lines(spark, sf), views.sales(spark, sf).select("id", "pay"), "id", "inner")
    return rounded(stats.class_mix(joined, "dept", "pay"), share=6)


_DAILY = """, daily AS (SELECT day, sum(CASE WHEN pay = 'EFECTIVO' THEN total ELSE 0 END) AS EFECTIVO,
  sum(CASE WHEN pay = 'YAPE' THEN total ELSE 0 END) AS YAPE FROM sales GROUP BY day)
"""


@query("daily_by_payment", _DAILY + 'SELECT day, round(EFECTIVO, 2) AS "EFECTIVO", round(YAPE, 2) AS "YAPE" FROM daily')
def daily_by_payment(spark, sf):
    return rounded(stats.daily_by_payment(views.sales(spark, sf), views.LABELS), EFECTIVO=2, YAPE=2)


_WEEKDAY = """SELECT CAST(isodow(day) - 1 AS INTEGER) AS weekday, round(avg(EFECTIVO), 2) AS efectivo_estimate,
  round(avg(YAPE), 2) AS yape_estimate, count(*) AS n_days FROM daily GROUP BY 1"""


@query("weekday_estimate", _DAILY + _WEEKDAY)
def weekday_estimate(spark, sf):
    return stats.weekday_estimate(stats.daily_by_payment(views.sales(spark, sf), views.LABELS), views.LABELS)


@query(
    "estimate_for",
    _DAILY
    + f""", e AS ({_WEEKDAY})
SELECT asked, e.*, round(efectivo_estimate + yape_estimate, 2) AS total_estimate
FROM (SELECT 'Sábado' AS asked, 5 AS w UNION ALL SELECT '2026-08-05', 2) JOIN e ON e.weekday = w""",
)
def estimate_for(spark, sf):
    estimates = weekday_estimate(spark, sf)
    parts = [stats.estimate_for(estimates, d).select(F.lit(d).alias("asked"), "*") for d in ("Sábado", "2026-08-05")]
    return rounded(parts[0].unionByName(parts[1]), total_estimate=2)


@query(
    "histogram",
    """, e AS (SELECT min(total) AS low, (max(total) - min(total)) / 20 AS width FROM sales),
c AS (SELECT least(CAST(floor((total - low) / width) AS BIGINT), 19) AS bin, count(*) AS n FROM sales, e GROUP BY 1)
SELECT b.bin, round(low + b.bin * width, 4) AS lower, round(low + (b.bin + 1) * width, 4) AS upper, coalesce(n, 0) AS n
FROM (SELECT unnest(range(0, 20)) AS bin) b CROSS JOIN e LEFT JOIN c ON c.bin = b.bin""",
)
def histogram(spark, sf):
    return rounded(stats.histogram(views.sales(spark, sf), "total", 20), lower=4, upper=4)


@query(
    "histogram_integer",
    """, s AS (SELECT id, count(*) AS k FROM lines GROUP BY id), c AS (SELECT k AS bin, count(*) AS n FROM s GROUP BY k)
SELECT b.bin, CAST(b.bin AS DOUBLE) AS lower, CAST(b.bin + 1 AS DOUBLE) AS upper, coalesce(n, 0) AS n
FROM (SELECT unnest(range((SELECT min(k) FROM s), (SELECT max(k) FROM s) + 1)) AS bin) b LEFT JOIN c ON c.bin = b.bin""",
)
def histogram_integer(spark, sf):
    return stats.histogram(tickets.ticket_sizes(views.lines(spark, sf)), "n_lines", integer=True)


@query(
    "kde",
    """, f AS (SELECT count(*) AS n, stddev_samp(qty) * power(count(*), -0.2) AS bw, min(qty) AS low, max(qty) AS high FROM lines),
g AS (SELECT CAST(i AS INTEGER) AS point, low - 3 * bw + i * (high - low + 6 * bw) / 199 AS x, n, bw FROM f, (SELECT unnest(range(0, 200)) AS i)),
v AS (SELECT qty AS v, count(*) AS k FROM lines GROUP BY qty)
SELECT point, round(x, 4) AS x, round(sum(k * exp(-0.5 * power((x - v) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 6) AS density
FROM g, v GROUP BY point, x""",
)
def kde(spark, sf):
    return rounded(stats.kde(views.lines(spark, sf), "qty"), x=4, density=6)


@query(
    "boxplot_stats",
    """, q AS (SELECT dept, quantile_cont(subtotal, 0.25) AS q1, quantile_cont(subtotal, 0.5) AS median, quantile_cont(subtotal, 0.75) AS q3,
  count(*) AS n, avg(subtotal) AS mean FROM lines GROUP BY dept),
w AS (SELECT *, subtotal BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1) AS inside FROM lines JOIN q USING (dept))
SELECT dept, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, n,
  min(subtotal) FILTER (WHERE inside) AS whisker_low, max(subtotal) FILTER (WHERE inside) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS n_fliers, round(mean, 4) AS mean FROM w GROUP BY dept, q1, median, q3, n, mean""",
)
def boxplot_stats(spark, sf):
    table = stats.boxplot_stats(views.lines(spark, sf), "subtotal", "dept", k=0.5)
    return rounded(table, q1=4, median=4, q3=4, mean=4)


@query(
    "trend_line",
    FEATURES_CTE
    + """SELECT round(regr_slope(total, units), 6) AS slope, round(regr_intercept(total, units), 4) AS intercept,
  round(regr_r2(total, units), 7) AS r2, CAST(regr_count(total, units) AS BIGINT) AS n FROM features""",
)
def trend_line(spark, sf):
    return rounded(stats.trend_line(_features(spark, sf), "units", "total"), slope=6, intercept=4, r2=7)


_PAIRS = [(a, b) for i, a in enumerate(_COLS) for b in _COLS[i:]]


def _pair_sql(source, name):
    picks = []
    for a, b in _PAIRS:
        value = f"round(corr({name.format(a)}, {name.format(b)}), 6)"
        picks.append(f"SELECT '{a}' AS a, '{b}' AS b, {value} AS r FROM {source}")
        if a != b:
            picks.append(f"SELECT '{b}', '{a}', {value} FROM {source}")
    return " UNION ALL ".join(picks)


@query("pearson_matrix", FEATURES_CTE + _pair_sql("features", "{}"))
def pearson_matrix(spark, sf):
    return rounded(stats.pearson_matrix(_features(spark, sf), _COLS), r=6)


@query(
    "spearman_matrix",
    FEATURES_CTE
    + ", r AS (SELECT "
    + ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in _COLS
    )
    + " FROM features)\n"
    + _pair_sql("r", "r_{}"),
)
def spearman_matrix(spark, sf):
    return rounded(stats.spearman_matrix(_features(spark, sf), _COLS), r=6)


@query(
    "cluster_profile",
    FEATURES_CTE
    + """SELECT n_depts AS label, round(avg(total), 4) AS mean_total, round(avg(units), 4) AS mean_units, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM features), 4) AS pct FROM features GROUP BY n_depts""",
)
def cluster_profile(spark, sf):
    labelled = _features(spark, sf).withColumnRenamed("n_depts", "label")
    return rounded(stats.cluster_profile(labelled, "label", ["total", "units"]), mean_total=4, mean_units=4, pct=4)
