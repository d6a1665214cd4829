"""Product -> category mapping. Test rules name the words of the product texts; their order matters."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptally.operators import categories as cat
from shoptally.operators.category_rules import KEYWORD_RULES
from shoptally.plans import views
from shoptally.plans.registry import query, rounded

RULES = (
    ("RED WIDGET", "SPECIAL"),
    ("WIDGET", "GADGET"),
    ("HOT", "HEATED"),
    ("BOLT", "FASTENER"),
    ("GEAR", "DRIVE"),
    ("ROD", "DRIVE"),
)
ALIASES = {"BRAND#1": "HOUSE", "BRAND#2": "HOUSE", "BRAND#3": "PREMIUM", "BRAND#17": "PREMIUM"}
INVALID = ("", "-", "BRAND#4")

_CASE = "CASE " + " ".join(f"WHEN contains(key, '{k}') THEN '{c}'" for k, c in RULES) + " END"
_ALIAS = "CASE bkey " + " ".join(f"WHEN '{k}' THEN '{c}'" for k, c in ALIASES.items()) + " END"
_SOLD = f""", sold AS (SELECT l.*, {_CASE} AS found, {_ALIAS} AS alias
  FROM (SELECT *, upper(trim(description)) AS key, upper(category) AS bkey FROM lines) l),
tagged AS (SELECT *, coalesce(found, alias, 'PENDIENTE_REVISION') AS analytic_category,
  CASE WHEN found IS NOT NULL THEN 'DESCRIPCION' WHEN alias IS NOT NULL THEN 'INVENTARIO' ELSE 'PENDIENTE_REVISION' END AS category_source
  FROM sold)
"""


def tagged_lines(spark, sf):
    sold = views.lines(spark, sf).drop("category")
    return cat.categorize_sales(sold, views.inventory(spark, sf), RULES, ALIASES)


@query(
    "classify_by_keywords",
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN contains(key, '{k}') THEN '{c}'" for k, c in KEYWORD_RULES)
    + r" END AS category_found FROM (SELECT doc_id, upper(trim(regexp_replace(strip_accents(text), '\s+', ' ', 'g'))) AS key FROM documents)",
    ctes=False,
)
def classify_by_keywords(spark, sf):
    found = cat.classify_by_keywords(views.table(spark, sf, "documents").select("doc_id", "text"), "text")
    return found.drop("text")


@query(
    "contains_join",
    ", rules AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{k}', '{c}')" for i, (k, c) in enumerate(RULES))
    + """) AS r(priority, keyword, category_found))
SELECT i.id, r.priority, r.keyword, r.category_found FROM inventory i JOIN rules r ON contains(upper(i.description), r.keyword)""",
)
def contains_join(spark, sf):
    hits = cat.contains_join(views.inventory(spark, sf).select("id", "description"), "description", RULES)
    return hits.drop("description")


@query(
    "alias_category",
    f"SELECT id, coalesce({_ALIAS}, 'PENDIENTE_REVISION') AS category_alias FROM (SELECT id, upper(category) AS bkey FROM inventory)",
)
def alias_category(spark, sf):
    return cat.alias_category(views.inventory(spark, sf).select("id", "category"), "category", ALIASES).drop("category")


@query(
    "categorize_sales",
    _SOLD + "SELECT id, product, line_no, category AS inventory_category, analytic_category, category_source FROM tagged",
)
def categorize_sales(spark, sf):
    columns = ["id", "product", "line_no", "inventory_category", "analytic_category", "category_source"]
    return tagged_lines(spark, sf).select(*columns)


@query(
    "audit_categories",
    f"""SELECT category AS original, bkey AS normalized,
  CASE WHEN bkey IN ('', '-', 'BRAND#4') THEN 'PENDIENTE_REVISION' ELSE coalesce({_ALIAS}, 'PENDIENTE_REVISION') END AS canonical,
  CASE WHEN bkey IN ('', '-', 'BRAND#4') THEN 'REVISAR' ELSE 'NORMALIZADA' END AS action, count(*) AS n_products
FROM (SELECT coalesce(category, '<NULO>') AS category, upper(coalesce(category, '<NULO>')) AS bkey
  FROM (SELECT CASE WHEN id % 30 = 0 THEN NULL ELSE category END AS category FROM inventory)) GROUP BY 1, 2, 3, 4""",
)
def audit_categories(spark, sf):
    gaps = F.when(F.col("id") % 30 == 0, None).otherwise(F.col("category")).alias("category")
    return cat.audit_categories(views.inventory(spark, sf).select(gaps), ALIASES, INVALID)


@query(
    "category_coverage",
    _SOLD
    + """SELECT count(*) AS n_lines, count(*) FILTER (WHERE analytic_category = 'PENDIENTE_REVISION') AS n_pending,
  round(avg(CASE WHEN analytic_category <> 'PENDIENTE_REVISION' THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM tagged""",
)
def category_coverage(spark, sf):
    return rounded(cat.category_coverage(tagged_lines(spark, sf)), coverage=6)


@query(
    "pending_products",
    _SOLD
    + "SELECT DISTINCT product, description, category AS inventory_category FROM tagged WHERE analytic_category = 'PENDIENTE_REVISION'",
)
def pending_products(spark, sf):
    return cat.pending_products(tagged_lines(spark, sf))


@query(
    "dictionary_coverage",
    f"SELECT description, count(*) AS n FROM (SELECT *, upper(description) AS key FROM lines) WHERE ({_CASE}) IS NULL GROUP BY description",
)
def dictionary_coverage(spark, sf):
    return cat.dictionary_coverage(views.lines(spark, sf), "description", RULES)


@query(
    "generalize_products",
    f"""SELECT coalesce({_CASE}, split_part(key, ' ', 1)) AS general_product, count(*) AS n
FROM (SELECT upper(description) AS key FROM lines) GROUP BY 1""",
)
def generalize_products(spark, sf):
    return cat.generalize_products(views.lines(spark, sf), "description", RULES)
