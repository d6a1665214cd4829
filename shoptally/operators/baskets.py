"""Market baskets, frequent itemsets and association rules with several items on either side."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.operators.category_rules import PENDING
from shoptally.operators.joins import join_dimension
from shoptally.session import checkpointed


def baskets(lines: DataFrame, ticket="id", item="analytic_category", exclude: str | None = PENDING) -> DataFrame:
    """Sorted distinct items per ticket. Lines of the excluded item do not count, nor do tickets with no others.

    An array holds at most the distinct items of the catalogue level, however many lines a ticket has.
    """
    usable = lines.filter(F.col(item).isNotNull())
    if exclude is not None:
        usable = usable.filter(F.col(item) != exclude)
    return usable.groupBy(F.col(ticket).alias("ticket")).agg(F.array_sort(F.collect_set(item)).alias("items"))


def basket_density(lines: DataFrame, ticket: str, items: Sequence[str]) -> DataFrame:
    """Tickets, distinct items and sparsity of the ticket x item matrix, one row per item column.

    One reading of the lines gives the distinct cells of all levels; tickets and items are both counted from these cells.
    """
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.col(i).cast("string").alias("item")) for i in items])
    cells = lines.select(F.col(ticket).alias("ticket"), F.explode(levels).alias("l")).select("l.level", "ticket", "l.item")
    cells = cells.filter(F.col("item").isNotNull()).distinct()
    by_item = cells.groupBy("level", "item").agg(F.count(F.lit(1)).alias("n"))
    item_sums = by_item.groupBy("level").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n").alias("n_cells"))
    by_ticket = cells.groupBy("level", "ticket").agg(F.count(F.lit(1)).alias("n"))
    ticket_sums = by_ticket.groupBy("level").agg(F.count("ticket").alias("n_baskets"))
    frame = lines.sparkSession.range(1).select(F.explode(F.array(*[F.lit(i) for i in items])).alias("level"))
    return (
        frame.join(ticket_sums, "level", "left")
        .join(item_sums, "level", "left")
        .select(
            "level",
            F.coalesce("n_baskets", F.lit(0)).alias("n_baskets"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            (1 - F.col("n_cells") / (F.col("n_baskets") * F.col("n_items"))).alias("sparsity"),
        )
    )


def drop_rare_items(df: DataFrame, share=0.01) -> DataFrame:
    """Baskets without the items that occur in less than ``int(share * baskets)`` of them.

    Emptied baskets stay, so supports keep their denominator. At most (mean basket size / share) items are kept,
    which bounds the list that is fetched.
    """
    least = int(df.count() * share)
    if least <= 1:
        return df
    counts = df.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    kept = [r["item"] for r in counts.filter(F.col("n") >= least).select("item").collect()]
    kept_items = F.array(*[F.lit(i) for i in kept]) if kept else F.array().cast("array<string>")
    return df.withColumn("items", F.array_sort(F.array_intersect("items", kept_items)))


def _counted(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Written table ``(items, w)`` of different baskets, sorted inside, with their number; the baskets, and those that are not null."""
    known = F.col("items").isNotNull()
    counted = checkpointed(df.groupBy(F.array_sort("items").alias("items")).agg(F.count(F.lit(1)).alias("w")))
    repeats = F.max(F.size("items") - F.size(F.array_distinct("items")))
    totals = counted.agg(F.sum("w").alias("n"), F.sum(F.when(known, F.col("w"))).alias("known"), repeats.alias("repeats")).first()
    if (totals["repeats"] or 0) > 0:
        raise ValueError("items of a basket must be unique")
    return counted.filter(known), totals["n"] or 0, totals["known"] or 0


def frequent_itemsets(df: DataFrame, min_support: float, max_len: int | None = None) -> DataFrame:
    """Itemsets with ``freq``, ``support`` and the number of baskets ``n``.

    Baskets are read once, to count equal ones. Itemsets then grow item by item: for each frequent prefix there are the counted
    remainders of its baskets, which name its extensions; equal remainders are counted together before the shuffle. At most
    (mean basket size / support) single items are frequent, which bounds the list that is fetched. Each length is written once.
    """
    counted, n, known = _counted(df)
    least = math.ceil(min_support * known)
    singles = counted.select(F.explode("items").alias("item"), "w").groupBy("item").agg(F.sum("w").alias("freq"))
    kept = [r["item"] for r in singles.filter(F.col("freq") >= least).select("item").collect()]

    def frequent(item: Column) -> Column:
        listed = item.isin([i for i in kept if i is not None])
        return item.isNull() | F.coalesce(listed, F.lit(False)) if None in kept else listed

    none = F.slice("items", 1, 0).alias("items")
    rows = counted.select(none, F.filter("items", frequent).alias("rest"), "w")
    found, length = None, 0
    while length < (max_len or math.inf):
        place = F.posexplode("rest").alias("at", "item")
        grown = rows.select("items", "rest", "w", place).select(
            F.concat("items", F.array("item")).alias("items"), F.expr("slice(rest, at + 2, size(rest))").alias("rest"), "w"
        )
        grown = checkpointed(grown.groupBy("items", "rest").agg(F.sum("w").alias("w")))
        level = checkpointed(grown.groupBy("items").agg(F.sum("w").alias("freq")).filter(F.col("freq") >= least))
        found, length = level if found is None else found.unionByName(level), length + 1
        if level.isEmpty():
            break
        rows = grown.filter(F.size("rest") > 0).join(level.select("items"), "items", "left_semi")
    return checkpointed(
        found.withColumns({"support": F.col("freq") / F.lit(float(n)), "n": F.lit(n).cast("long")})
    )


def _by_mask(items: Column, mask: Column, chosen: bool) -> Column:
    wanted = F.lit(1 if chosen else 0)
    return F.filter(items, lambda _, i: F.getbit(mask, i) == wanted)


def association_rules(itemsets: DataFrame, min_lift: float | None = 1.0) -> DataFrame:
    """All splits of each itemset into antecedent and consequent, with the five rule measures."""
    splits = itemsets.filter(F.size("items") >= 2).select(
        "items",
        "support",
        F.explode(F.expr("sequence(1L, shiftleft(1L, size(items)) - 2)")).alias("mask"),
    )
    sided = splits.select(
        _by_mask(F.col("items"), F.col("mask"), True).alias("antecedent"),
        _by_mask(F.col("items"), F.col("mask"), False).alias("consequent"),
        "support",
    )
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("antecedent_support"))
    right = itemsets.select(F.col("items").alias("consequent"), F.col("support").alias("consequent_support"))
    rules = sided.join(left, "antecedent").join(right, "consequent")
    s, sa, sb = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    confidence = s / sa
    rules = rules.select(
        "antecedent",
        "consequent",
        "support",
        "antecedent_support",
        "consequent_support",
        confidence.alias("confidence"),
        (confidence / sb).alias("lift"),
        (s - sa * sb).alias("leverage"),
        F.coalesce(F.try_divide(1 - sb, 1 - confidence), F.lit(float("inf"))).alias("conviction"),
    )
    return rules if min_lift is None else rules.filter(F.col("lift") >= min_lift)


def rule_name(antecedent="antecedent", consequent="consequent") -> Column:
    return F.concat(F.array_join(antecedent, ", "), F.lit(" -> "), F.array_join(consequent, ", "))


def filter_rules(rules: DataFrame, support=0.0, confidence=0.0, lift=1.0) -> DataFrame:
    """Rules at or above the three thresholds."""
    return rules.filter(
        (F.col("support") >= support) & (F.col("confidence") >= confidence) & (F.col("lift") >= lift)
    )


def actionable_rules(rules: DataFrame, lift=1.2, confidence=0.15) -> DataFrame:
    """Rules strictly above a lift and a confidence."""
    return rules.filter((F.col("lift") > lift) & (F.col("confidence") > confidence))


def top_rules(rules: DataFrame, by="lift", n=10, digits=9) -> DataFrame:
    """Best ``n`` rules by one measure, ties by rule name; measures equal to ``digits`` places tie."""
    named = rules.withColumn("rule", rule_name())
    return named.orderBy(F.desc(F.round(by, digits)), "rule").limit(n)


def support_sweep(df: DataFrame, supports: Sequence[float]) -> DataFrame:
    """Number of itemsets at each minimum support, from one mining run at the lowest."""
    found = frequent_itemsets(df, min(supports))
    levels = F.array(*[F.lit(float(s)) for s in supports])
    hits = found.select(F.explode(F.filter(levels, lambda s: F.col("freq") >= F.ceil(s * F.col("n")))).alias("min_support"))
    counts = hits.groupBy("min_support").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1).select(F.explode(levels).alias("min_support"))
    return frame.join(counts, "min_support", "left").select("min_support", F.coalesce("n", F.lit(0)).alias("n_itemsets"))


def granularity_table(levels: Mapping[str, DataFrame], min_support: float, max_len: int | None = None) -> DataFrame:
    """Itemsets, rules and best measures per basket granularity."""
    tables = []
    for name, level in levels.items():
        found = frequent_itemsets(level, min_support, max_len)
        best = association_rules(found).agg(
            F.count(F.lit(1)).alias("n_rules"),
            *[F.coalesce(F.max(m), F.lit(0.0)).alias(f"max_{m}") for m in ("support", "confidence", "lift")],
        )
        size = found.agg(F.count(F.lit(1)).alias("n_itemsets"))
        tables.append(
            best.withColumn("n_itemsets", size.scalar()).select(F.lit(name).alias("level"), "n_itemsets", *best.columns)
        )
    stacked = tables[0]
    for t in tables[1:]:
        stacked = stacked.unionByName(t)
    return stacked


def inverse_rules(rules: DataFrame) -> DataFrame:
    """Rules whose inverse is a rule too, with both confidences."""
    inverse = rules.select(
        F.col("antecedent").alias("consequent"),
        F.col("consequent").alias("antecedent"),
        F.col("confidence").alias("inverse_confidence"),
    )
    return rules.join(inverse, ["antecedent", "consequent"])


def lift_matrix(rules: DataFrame, consequents: Sequence[str]) -> DataFrame:
    """Lift per antecedent with one column per named consequent."""
    named = rules.select(
        F.array_join("antecedent", ", ").alias("antecedent"),
        F.array_join("consequent", ", ").alias("consequent"),
        "lift",
    )
    return named.groupBy("antecedent").pivot("consequent", list(consequents)).agg(F.first("lift"))


def rule_graph(rules: DataFrame, itemsets: DataFrame, n=20, grain="item") -> tuple[DataFrame, DataFrame]:
    """Edges (source, target, weight, confidence) of the top rules, and nodes with their support.

    ``side`` links whole rule sides, ``item`` links single items. An edge that several rules give keeps the values
    of the one with the lowest lift.
    """
    top = top_rules(rules, "lift", n)
    if grain == "side":
        sided = top.select(
            F.array_join("antecedent", ", ").alias("source"), F.array_join("consequent", ", ").alias("target"), "lift", "confidence", "rule"
        )
        supports = itemsets.select(F.array_join("items", ", ").alias("node"), "support")
    elif grain == "item":
        sided = top.select(F.explode("antecedent").alias("source"), "consequent", "lift", "confidence", "rule").select(
            "source", F.explode("consequent").alias("target"), "lift", "confidence", "rule"
        )
        supports = itemsets.filter(F.size("items") == 1).select(F.get("items", F.lit(0)).alias("node"), "support")
    else:
        raise ValueError("grain must be 'item' or 'side'")
    last = F.min_by(F.struct("lift", "confidence"), F.struct(F.round("lift", 9), F.col("rule")))
    edges = sided.groupBy("source", "target").agg(last.alias("m")).select(
        "source", "target", F.col("m.lift").alias("weight"), F.col("m.confidence").alias("confidence")
    )
    names = edges.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    return edges, names.join(supports, "node", "left")


def normalize_rule_metrics(rules: DataFrame, n=5) -> DataFrame:
    """Min-max scaled measures of the top rules; an infinite conviction counts as 1.5 x the largest finite one."""
    top = top_rules(rules, "lift", n)
    everything = W.partitionBy(F.lit(0))  # at most n rows
    finite = F.when(F.col("conviction") != float("inf"), F.col("conviction"))
    top = top.withColumn("conviction", F.coalesce(finite, F.max(finite).over(everything) * 1.5, F.lit(1.0)))
    scaled = {}
    for m in ("support", "confidence", "lift", "conviction"):
        low, high = F.min(m).over(everything), F.max(m).over(everything)
        scaled[f"{m}_scaled"] = F.coalesce(F.try_divide(F.col(m) - low, high - low), F.lit(0.0))
    return top.withColumns(scaled).select("rule", *scaled)


def suggest_addons(df: DataFrame, rules: DataFrame, n=1) -> DataFrame:
    """Best rules per basket whose antecedent is in the basket and whose consequent is not.

    Equal baskets are solved once. Basket items meet only the rules that start with them. The solved baskets are written and go
    back to the tickets as a dimension: broadcast when small, else a basket that many tickets share is kept out of the shuffle.
    """
    tickets = df.select("ticket", F.to_json("items").alias("_basket"))
    sets = df.select("items").distinct()
    keyed = rules.select(
        F.get("antecedent", F.lit(0)).alias("_first"),
        "antecedent",
        "consequent",
        F.array_join("antecedent", ", ").alias("because"),
        F.array_join("consequent", ", ").alias("suggestion"),
        "confidence",
        "lift",
    )
    met = sets.select("items", F.explode("items").alias("_first")).join(keyed, "_first")
    fits = (F.size(F.array_except("antecedent", "items")) == 0) & ~F.arrays_overlap("consequent", "items")
    order = W.partitionBy("items").orderBy(F.desc(F.round("lift", 9)), "because", "suggestion")
    best = met.filter(fits).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    addon = F.struct("rank", "because", "suggestion", "confidence", "lift")
    solved = best.groupBy(F.to_json("items").alias("_basket")).agg(F.collect_list(addon).alias("_addons"))  # at most n each
    found = join_dimension(tickets, checkpointed(solved), "_basket", "inner")
    return found.select("ticket", F.explode("_addons").alias("a")).select("ticket", "a.*")
