"""Baskets, itemsets and rules. Items are brands (25) or product types (6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally.operators import baskets as bk
from shoptally.plans import views
from shoptally.plans.registry import query, rounded
from shoptally.session import checkpointed

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MIN_SUPPORT = 0.02
TYPE_SUPPORT = 0.05
PENDING_ITEM = "Brand#13"


def brand_baskets(spark, sf):
    return bk.baskets(views.lines(spark, sf), "id", "category", exclude=None)


def type_baskets(spark, sf):
    return bk.baskets(views.lines(spark, sf), "id", "dept", exclude=None)


def type_itemsets(spark, sf):
    return bk.frequent_itemsets(type_baskets(spark, sf), TYPE_SUPPORT)


def type_rules(spark, sf, min_lift=None):
    return bk.association_rules(type_itemsets(spark, sf), min_lift)


def _itemsets_cte(item, support):
    """All itemsets at a minimum support, as ``sets(items, freq, support, n)``: every non-empty subset of every ticket is counted."""
    return f"""
, pairs AS (SELECT DISTINCT id, {item} AS item FROM lines),
size AS (SELECT count(DISTINCT id) AS n FROM pairs),
held AS (SELECT id, list_sort(list(item)) AS items FROM pairs GROUP BY id),
subsets AS (SELECT items AS whole, unnest(generate_series(1, CAST(power(2, len(items)) AS BIGINT) - 1)) AS mask FROM held),
found AS (
  SELECT list_filter(whole, lambda x, i: (mask >> CAST(i - 1 AS INTEGER)) & 1 = 1) AS items, count(*) AS freq
  FROM subsets GROUP BY 1),
sets AS (SELECT items, freq, freq / n AS support, n FROM found, size WHERE freq >= ceil({support} * n))
"""


_RULES = """, masks AS (SELECT items, support, unnest(generate_series(1, CAST(power(2, len(items)) AS BIGINT) - 2)) AS mask FROM sets WHERE len(items) >= 2),
sided AS (SELECT support, mask,
  list_filter(items, lambda x, i: (mask >> CAST(i - 1 AS INTEGER)) & 1 = 1) AS antecedent,
  list_filter(items, lambda x, i: (mask >> CAST(i - 1 AS INTEGER)) & 1 = 0) AS consequent FROM masks),
rules AS (SELECT s.antecedent, s.consequent, s.support, a.support AS antecedent_support, c.support AS consequent_support,
  s.support / a.support AS confidence, s.support / a.support / c.support AS lift,
  s.support - a.support * c.support AS leverage,
  CASE WHEN s.support = a.support THEN CAST('inf' AS DOUBLE) ELSE (1 - c.support) / (1 - s.support / a.support) END AS conviction,
  array_to_string(s.antecedent, ', ') || ' -> ' || array_to_string(s.consequent, ', ') AS rule
  FROM sided s JOIN sets a ON a.items = s.antecedent JOIN sets c ON c.items = s.consequent)
"""
BRANDS = _itemsets_cte("category", MIN_SUPPORT)
TYPE_SETS = _itemsets_cte("dept", TYPE_SUPPORT)
TYPE_RULES = TYPE_SETS + _RULES
_MEASURES = {"support": 6, "confidence": 6, "lift": 6}
_SQL_MEASURES = "round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"


@query(
    "baskets",
    """SELECT id AS ticket, array_to_string(list_sort(list(DISTINCT category)), '|') AS items
FROM lines WHERE category <> 'Brand#13' GROUP BY id""",
)
def baskets(spark, sf):
    made = bk.baskets(views.lines(spark, sf), "id", "category", exclude=PENDING_ITEM)
    return made.select("ticket", F.array_join("items", "|").alias("items"))


@query(
    "basket_density",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS level, count(DISTINCT id) AS n_baskets, count(DISTINCT {c}) AS n_items,
  round(1 - count(DISTINCT (id, {c})) * 1.0 / (count(DISTINCT id) * count(DISTINCT {c})), 6) AS sparsity FROM lines)"""
        for c in ("description", "category", "dept")
    ),
)
def basket_density(spark, sf):
    table = bk.basket_density(views.lines(spark, sf), "id", ["description", "category", "dept"])
    return rounded(table, sparsity=6)


@query(
    "drop_rare_items",
    """, p AS (SELECT DISTINCT id, description FROM lines), n AS (SELECT count(DISTINCT id) AS n FROM p),
keep AS (SELECT description FROM p, n GROUP BY description, n HAVING count(*) >= CAST(floor(n * 0.06) AS BIGINT))
SELECT p.id AS ticket, coalesce(array_to_string(list_sort(list(k.description) FILTER (WHERE k.description IS NOT NULL)), '|'), '') AS items
FROM p LEFT JOIN keep k USING (description) GROUP BY p.id""",
)
def drop_rare_items(spark, sf):
    made = bk.baskets(views.lines(spark, sf), "id", "description", exclude=None)
    return bk.drop_rare_items(made, 0.06).select("ticket", F.array_join("items", "|").alias("items"))


@query(
    "frequent_itemsets",
    BRANDS + "SELECT array_to_string(items, '|') AS items, freq, round(support, 6) AS support, n FROM sets",
)
def frequent_itemsets(spark, sf):
    found = bk.frequent_itemsets(brand_baskets(spark, sf), MIN_SUPPORT)
    return rounded(found.withColumn("items", F.array_join("items", "|")), support=6)


@query(
    "association_rules",
    TYPE_RULES
    + """SELECT array_to_string(antecedent, '|') AS antecedent, array_to_string(consequent, '|') AS consequent, round(support, 6) AS support,
  round(antecedent_support, 6) AS antecedent_support, round(consequent_support, 6) AS consequent_support, round(confidence, 6) AS confidence,
  round(lift, 6) AS lift, round(leverage, 6) AS leverage, round(conviction, 6) AS conviction FROM rules""",
)
def association_rules(spark, sf):
    rules = type_rules(spark, sf).withColumns(
        {c: F.array_join(c, "|") for c in ("antecedent", "consequent")}
    )
    return rounded(
        rules,
        **_MEASURES,
        antecedent_support=6,
        consequent_support=6,
        leverage=6,
        conviction=6,
    )


@query(
    "filter_rules",
    TYPE_RULES
    + f"SELECT rule, {_SQL_MEASURES} FROM rules WHERE support >= 0.1 AND confidence >= 0.4 AND lift >= 0.9",
)
def filter_rules(spark, sf):
    kept = bk.filter_rules(type_rules(spark, sf), 0.1, 0.4, 0.9)
    return rounded(kept.select(bk.rule_name().alias("rule"), *_MEASURES), **_MEASURES)


@query(
    "actionable_rules",
    TYPE_RULES + f"SELECT rule, {_SQL_MEASURES} FROM rules WHERE lift > 0.85 AND confidence > 0.15",
)
def actionable_rules(spark, sf):
    kept = bk.actionable_rules(type_rules(spark, sf), 0.85, 0.15)
    return rounded(kept.select(bk.rule_name().alias("rule"), *_MEASURES), **_MEASURES)


@query(
    "top_rules",
    TYPE_RULES
    + f"""SELECT * FROM (SELECT 'lift' AS by_measure, rule, {_SQL_MEASURES} FROM rules r ORDER BY round(r.lift, 9) DESC, rule LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'confidence', rule, {_SQL_MEASURES} FROM rules r ORDER BY round(r.confidence, 9) DESC, rule LIMIT 10)""",
)
def top_rules(spark, sf):
    rules = type_rules(spark, sf)
    parts = [
        bk.top_rules(rules, by, 10).select(F.lit(by).alias("by_measure"), "rule", *_MEASURES)
        for by in ("lift", "confidence")
    ]
    return rounded(parts[0].unionByName(parts[1]), **_MEASURES)


SWEEP = (0.01, 0.02, 0.03, 0.05, 0.1, 0.3)


@query(
    "support_sweep",
    _itemsets_cte("category", min(SWEEP))
    + ", t AS (SELECT unnest(["
    + ", ".join(f"CAST({s} AS DOUBLE)" for s in SWEEP)
    + """]) AS min_support)
SELECT min_support, count(s.freq) AS n_itemsets FROM t LEFT JOIN sets s ON s.freq >= ceil(min_support * s.n) GROUP BY min_support""",
)
def support_sweep(spark, sf):
    return bk.support_sweep(brand_baskets(spark, sf), SWEEP)


def _level_sql(name, item, support):
    return f"""SELECT * FROM ({_itemsets_cte(item, support).replace(', pairs', 'WITH pairs', 1)} {_RULES}
SELECT '{name}' AS level, (SELECT count(*) FROM sets) AS n_itemsets, count(*) AS n_rules, round(coalesce(max(support), 0), 6) AS max_support,
  round(coalesce(max(confidence), 0), 6) AS max_confidence, round(coalesce(max(lift), 0), 6) AS max_lift FROM rules WHERE lift >= 1)"""


@query(
    "granularity_table",
    _level_sql("brand", "category", 0.01) + " UNION ALL " + _level_sql("type", "dept", 0.01),
)
def granularity_table(spark, sf):
    levels = {"brand": brand_baskets(spark, sf), "type": type_baskets(spark, sf)}
    table = bk.granularity_table(levels, 0.01)
    return rounded(table, max_support=6, max_confidence=6, max_lift=6)


@query(
    "inverse_rules",
    TYPE_RULES
    + """SELECT a.rule, round(a.confidence, 6) AS confidence, round(b.confidence, 6) AS inverse_confidence
FROM rules a JOIN rules b ON a.antecedent = b.consequent AND a.consequent = b.antecedent""",
)
def inverse_rules(spark, sf):
    pairs = bk.inverse_rules(type_rules(spark, sf)).select(
        bk.rule_name().alias("rule"), "confidence", "inverse_confidence"
    )
    return rounded(pairs, confidence=6, inverse_confidence=6)


@query(
    "lift_matrix",
    TYPE_RULES
    + "SELECT array_to_string(antecedent, ', ') AS antecedent, "
    + ", ".join(
        f"round(max(lift) FILTER (WHERE array_to_string(consequent, ', ') = '{t}'), 6) AS \"{t}\"" for t in TYPES
    )
    + " FROM rules GROUP BY 1",
)
def lift_matrix(spark, sf):
    return rounded(bk.lift_matrix(type_rules(spark, sf), TYPES), **{t: 6 for t in TYPES})


_TOP20 = ", top AS (SELECT * FROM rules ORDER BY round(lift, 9) DESC, rule LIMIT 20)\n"


@query(
    "rule_graph_edges",
    TYPE_RULES
    + _TOP20
    + """, e AS (SELECT source, unnest(consequent) AS target, lift, confidence, rule FROM (SELECT unnest(antecedent) AS source, consequent, lift, confidence, rule FROM top))
SELECT source, target, round(weight, 6) AS weight, round(confidence, 6) AS confidence FROM (
  SELECT source, target, lift AS weight, confidence, row_number() OVER (PARTITION BY source, target ORDER BY round(lift, 9), rule) AS rn FROM e) WHERE rn = 1""",
)
def rule_graph_edges(spark, sf):
    sets = type_itemsets(spark, sf)
    edges, _ = bk.rule_graph(bk.association_rules(sets, None), sets, 20, "item")
    return rounded(edges, weight=6, confidence=6)


@query(
    "rule_graph_nodes",
    TYPE_RULES
    + _TOP20.replace("20", "15")
    + """, names AS (SELECT array_to_string(antecedent, ', ') AS node FROM top UNION SELECT array_to_string(consequent, ', ') FROM top)
SELECT node, round(s.support, 6) AS support FROM names LEFT JOIN sets s ON array_to_string(s.items, ', ') = node""",
)
def rule_graph_nodes(spark, sf):
    sets = type_itemsets(spark, sf)
    _, nodes = bk.rule_graph(bk.association_rules(sets, None), sets, 15, "side")
    return rounded(nodes, support=6)


@query(
    "normalize_rule_metrics",
    TYPE_RULES
    + """, top AS (SELECT * FROM rules ORDER BY round(lift, 9) DESC, rule LIMIT 5),
m AS (SELECT min(support) AS s0, max(support) AS s1, min(confidence) AS c0, max(confidence) AS c1, min(lift) AS l0, max(lift) AS l1,
  min(conviction) AS v0, max(conviction) AS v1 FROM top)
SELECT rule, round(coalesce((support - s0) / nullif(s1 - s0, 0), 0), 6) AS support_scaled, round(coalesce((confidence - c0) / nullif(c1 - c0, 0), 0), 6) AS confidence_scaled,
  round(coalesce((lift - l0) / nullif(l1 - l0, 0), 0), 6) AS lift_scaled, round(coalesce((conviction - v0) / nullif(v1 - v0, 0), 0), 6) AS conviction_scaled FROM top, m""",
)
def normalize_rule_metrics(spark, sf):
    scaled = bk.normalize_rule_metrics(type_rules(spark, sf), 5)
    return rounded(scaled, support_scaled=6, confidence_scaled=6, lift_scaled=6, conviction_scaled=6)


@query(
    "suggest_addons",
    TYPE_RULES
    + """, b AS (SELECT id AS ticket, list(item) AS items FROM pairs GROUP BY id),
fit AS (SELECT b.ticket, array_to_string(r.antecedent, ', ') AS because, array_to_string(r.consequent, ', ') AS suggestion, r.confidence, r.lift
  FROM b JOIN rules r ON list_has_all(b.items, r.antecedent) AND NOT list_has_any(b.items, r.consequent))
SELECT ticket, CAST(rank AS INTEGER) AS rank, because, suggestion, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM (
  SELECT *, row_number() OVER (PARTITION BY ticket ORDER BY round(lift, 9) DESC, because, suggestion) AS rank FROM fit) WHERE rank <= 2""",
)
def suggest_addons(spark, sf):
    made = checkpointed(type_baskets(spark, sf))  # mined, solved and given their add-ons
    sets = bk.frequent_itemsets(made, TYPE_SUPPORT)
    addons = bk.suggest_addons(made, bk.association_rules(sets, None), 2)
    return rounded(addons, confidence=6, lift=6)
