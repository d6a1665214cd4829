"""Product -> category mapping by ordered keyword rules, with inventory aliases as fallback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.functions.text import normalize_id, normalize_text
from shoptally.operators.category_rules import (
    BY_DESCRIPTION,
    BY_INVENTORY,
    CATEGORY_ALIASES,
    INVALID_CATEGORIES,
    KEYWORD_RULES,
    PENDING,
    UNMAPPED,
)
from shoptally.operators.cleaning import NO_DESCRIPTION
from shoptally.operators.joins import join_dimension
from shoptally.operators.tickets import dedupe_first

Rules = Sequence[tuple[str, str]]


def keyword_category(text: Column, rules: Rules = KEYWORD_RULES) -> Column:
    """Category of the first keyword contained in a normalised text, else null. One expression, no shuffle."""
    category = None
    for keyword, name in rules:
        found = text.contains(keyword)
        category = F.when(found, name) if category is None else category.when(found, name)
    return F.lit(None).cast("string") if category is None else category


def classify_by_keywords(df: DataFrame, text: str, rules: Rules = KEYWORD_RULES) -> DataFrame:
    """Add ``category_found`` by the keyword rules; placeholder descriptions get none."""
    key = normalize_text(text)
    found = F.when((key != "") & (key != NO_DESCRIPTION), keyword_category(key, rules))
    return df.withColumn("category_found", found)


def contains_join(df: DataFrame, text: str, rules: Rules = KEYWORD_RULES) -> DataFrame:
    """Every rule whose keyword the text contains, one row each, with the rule's ``priority``.

    The rules are part of the expression, so a row only meets its own matches and nothing is shuffled.
    """
    table = F.array(
        *[
            F.struct(F.lit(i).alias("priority"), F.lit(k).alias("keyword"), F.lit(c).alias("category_found"))
            for i, (k, c) in enumerate(rules)
        ]
    )
    hits = F.filter(table, lambda r: F.contains(F.col("_key"), r["keyword"]))
    return (
        df.withColumn("_key", normalize_text(text))
        .withColumn("_hit", F.explode(hits))
        .select(*df.columns, "_hit.priority", "_hit.keyword", "_hit.category_found")
    )


def alias_of(category: str, aliases: Mapping[str, str] = CATEGORY_ALIASES) -> Column:
    """Category that an inventory category stands for, null when unknown."""
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), normalize_text(category))


def alias_category(df: DataFrame, category: str, aliases: Mapping[str, str] = CATEGORY_ALIASES) -> DataFrame:
    """Add ``category_alias``: the alias target, or the pending label."""
    return df.withColumn("category_alias", F.coalesce(alias_of(category, aliases), F.lit(PENDING)))


def categorize_sales(
    lines: DataFrame,
    inventory: DataFrame,
    rules: Rules = KEYWORD_RULES,
    aliases: Mapping[str, str] = CATEGORY_ALIASES,
) -> DataFrame:
    """Lines with inventory category, analytic category and where it came from."""
    catalogue = inventory.select(normalize_id(F.col("id").cast("string")).alias("_product"), "category")
    catalogue = dedupe_first(catalogue, "_product", "category").withColumnRenamed("category", "inventory_category")
    keyed = lines.withColumn("_product", normalize_id(F.col("product").cast("string")))
    joined = classify_by_keywords(join_dimension(keyed, catalogue, "_product", "left"), "description", rules)
    alias = alias_of("inventory_category", aliases)
    return joined.select(
        *lines.columns,
        "inventory_category",
        F.coalesce("category_found", alias, F.lit(PENDING)).alias("analytic_category"),
        F.when(F.col("category_found").isNotNull(), BY_DESCRIPTION)
        .when(alias.isNotNull(), BY_INVENTORY)
        .otherwise(PENDING)
        .alias("category_source"),
    )


def audit_categories(
    inventory: DataFrame,
    aliases: Mapping[str, str] = CATEGORY_ALIASES,
    invalid: Sequence[str] = INVALID_CATEGORIES,
) -> DataFrame:
    """Products per original, normalised and canonical inventory category, and the action it needs."""
    original = F.coalesce("category", F.lit("<NULO>"))
    audited = inventory.select(original.alias("original")).withColumn("normalized", normalize_text("original"))
    bad = F.col("normalized").isin(*invalid)
    audited = audited.withColumns(
        {
            "canonical": F.when(bad, PENDING).otherwise(
                F.coalesce(alias_of("normalized", aliases), F.lit(PENDING))
            ),
            "action": F.when(bad, "REVISAR").otherwise("NORMALIZADA"),
        }
    )
    counts = audited.groupBy("original", "normalized", "canonical", "action").agg(
        F.count(F.lit(1)).alias("n_products")
    )
    return counts.orderBy("action", F.desc("n_products"), "original")


def category_coverage(df: DataFrame) -> DataFrame:
    """Share of lines with a category, and the pending lines."""
    pending = F.col("analytic_category") == PENDING
    return df.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(pending).alias("n_pending"),
        F.avg((~pending).cast("double")).alias("coverage"),
    )


def pending_products(df: DataFrame) -> DataFrame:
    """Distinct products that still need a category."""
    return (
        df.filter(F.col("analytic_category") == PENDING)
        .select("product", "description", "inventory_category")
        .distinct()
    )


def dictionary_coverage(df: DataFrame, text: str, rules: Rules = KEYWORD_RULES) -> DataFrame:
    """Descriptions that no keyword covers, with their row counts."""
    counts = df.groupBy(text).agg(F.count(F.lit(1)).alias("n"))
    mapped = F.coalesce(keyword_category(normalize_text(text), rules), F.lit(UNMAPPED))
    return counts.filter(mapped == UNMAPPED)


def general_product(text, rules: Rules = KEYWORD_RULES) -> Column:
    """Keyword category, or the first word of the text."""
    key = normalize_text(text)
    return F.coalesce(keyword_category(key, rules), F.split_part(key, F.lit(" "), F.lit(1)))


def generalize_products(df: DataFrame, text: str, rules: Rules = KEYWORD_RULES) -> DataFrame:
    """Row counts per general product. Texts are counted first, so each distinct one is classified once."""
    counts = df.groupBy(text).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(general_product(text, rules).alias("general_product")).agg(F.sum("_n").alias("n"))
