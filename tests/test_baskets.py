"""Categories, itemsets and rules."""

import itertools
import math

import numpy as np
import pytest

from shoptally.operators import baskets as bk
from shoptally.operators import categories as cat


def test_classification_by_definition(spark):
    lines = spark.createDataFrame(
        [
            (1, "1.0", "Témpera roja"),
            (2, "2", "HOJA DE COLORES A4"),
            (3, "3", "HOJA DE COLOR ROJO"),
            (4, "4", "PALIGLOBO"),
            (5, "5", "SIN DESCRIPCION"),
            (6, "6", "XYZ"),
            (7, "99", None),
        ],
        "id int, product string, description string",
    )
    inventory = spark.createDataFrame([("1", "x"), ("5", "Gomas"), ("5", "Zzz"), ("6", "TAILOY")], "id string, category string")
    got = {r.id: (r.analytic_category, r.category_source) for r in cat.categorize_sales(lines, inventory).collect()}
    assert got == {
        1: ("TEMPERA", "DESCRIPCION"),
        2: ("COLORES", "DESCRIPCION"),
        3: ("HOJAS DE COLORES", "DESCRIPCION"),
        4: ("GLOBOS Y ACCESORIOS", "DESCRIPCION"),
        5: ("GOMA", "INVENTARIO"),
        6: ("PENDIENTE_REVISION", "PENDIENTE_REVISION"),
        7: ("PENDIENTE_REVISION", "PENDIENTE_REVISION"),
    }


def _twenty():
    rows = [list("ABC")] * 5 + [list("AB")] * 3 + [["A", "C"]] + [["B", "C"]] * 2 + [["A"]] + [["B"]] * 2 + [["C"]] + [[]] * 5
    return [(i, r) for i, r in enumerate(rows)]


def test_rules_by_definition(spark):
    df = spark.createDataFrame(_twenty(), "ticket int, items array<string>")
    found = bk.frequent_itemsets(df, 0.05)
    freq = {"".join(r["items"]): r["freq"] for r in found.collect()}
    assert freq == {"A": 10, "B": 12, "C": 9, "AB": 8, "AC": 6, "BC": 7, "ABC": 5}
    rules = {("".join(r.antecedent), "".join(r.consequent)): r for r in bk.association_rules(found, None).collect()}
    assert len(rules) == 12
    for key, support, confidence, lift in (("A B", 0.4, 0.8, 4 / 3), ("AB C", 0.25, 0.625, 0.625 / 0.45), ("A BC", 0.25, 0.5, 0.5 / 0.35)):
        r = rules[tuple(key.split())]
        assert (r.support, r.confidence, r.lift) == pytest.approx((support, confidence, lift))
    for (a, c), r in rules.items():
        assert r.lift == pytest.approx(rules[(c, a)].lift)
        assert r.leverage == pytest.approx(r.support - r.antecedent_support * r.consequent_support)


def test_itemsets_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, sorted({int(v) for v in rng.geometric(0.3, rng.integers(1, 6))})) for i in range(400)]
    rows = [(i, [f"p{v}" for v in items]) for i, items in rows]
    counts = {}
    for _, items in rows:
        for k in range(1, len(items) + 1):
            for s in itertools.combinations(sorted(items), k):
                counts[s] = counts.get(s, 0) + 1
    want = {s: c for s, c in counts.items() if c >= math.ceil(0.03 * 400)}
    df = spark.createDataFrame(rows, "ticket int, items array<string>")
    assert {tuple(r["items"]): r["freq"] for r in bk.frequent_itemsets(df, 0.03).collect()} == want


def test_certain_rule_has_infinite_conviction(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, ["b"])], "ticket int, items array<string>")
    rules = bk.association_rules(bk.frequent_itemsets(df, 0.1), None)
    by_name = {r.rule: r.conviction for r in rules.withColumn("rule", bk.rule_name()).collect()}
    assert by_name["a -> b"] == math.inf
    scaled = bk.normalize_rule_metrics(rules, 5).collect()
    assert all(0 <= r[f"{m}_scaled"] <= 1 for r in scaled for m in ("support", "confidence", "lift", "conviction"))


def test_pending_only_tickets_leave(spark):
    lines = spark.createDataFrame(
        [(1, "A"), (1, "PENDIENTE_REVISION"), (2, "PENDIENTE_REVISION"), (3, "B"), (3, "B")], "id int, analytic_category string"
    )
    assert {r.ticket: r["items"] for r in bk.baskets(lines).collect()} == {1: ["A"], 3: ["B"]}


def test_rare_items_leave_empty_baskets(spark):
    df = spark.createDataFrame([(i, ["a"] if i else ["z"]) for i in range(200)], "ticket int, items array<string>")
    kept = bk.drop_rare_items(df, 0.01)
    assert kept.count() == 200
    assert kept.filter("ticket = 0").first()["items"] == []


def test_addons_never_repeat_the_basket(spark):
    df = spark.createDataFrame(_twenty(), "ticket int, items array<string>")
    rules = bk.association_rules(bk.frequent_itemsets(df, 0.05), None)
    baskets = dict(_twenty())
    for r in bk.suggest_addons(df, rules, 3).collect():
        assert set(r.because.split(", ")) <= set(baskets[r.ticket])
        assert not set(r.suggestion.split(", ")) & set(baskets[r.ticket])


def test_support_falls_with_size(spark):
    df = spark.createDataFrame(_twenty(), "ticket int, items array<string>")
    freq = {frozenset(r["items"]): r["freq"] for r in bk.frequent_itemsets(df, 0.05).collect()}
    for s, f in freq.items():
        assert all(freq[s - {i}] >= f for i in s if len(s) > 1)


def _counting(spark, rows):
    """Baskets, and the number of times that a row of them has been computed."""
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    return spark.createDataFrame(rows, "ticket int, items array<string>").mapInPandas(counted, "ticket int, items array<string>"), seen


def test_mining_reads_the_baskets_once(spark):
    df, seen = _counting(spark, _twenty())
    assert bk.frequent_itemsets(df, 0.05).count() == 7
    assert seen.value == 20


def test_mining_counts_all_shapes_of_baskets(spark):
    rows = [(1, ["b", "a"]), (2, ["a", "b"]), (3, ["a", None]), (4, None), (5, []), (6, ["c"])]
    df = spark.createDataFrame(rows, "ticket int, items array<string>")
    found = {tuple(r["items"]): (r.freq, r.n) for r in bk.frequent_itemsets(df, 0.4).collect()}  # of five baskets
    assert found == {("a",): (3, 6), ("b",): (2, 6), ("a", "b"): (2, 6)}
    found = {tuple(r["items"]) for r in bk.frequent_itemsets(df, 0.2, 1).collect()}
    assert found == {("a",), ("b",), ("c",), (None,)}
    assert ("a", None) in {tuple(r["items"]) for r in bk.frequent_itemsets(df, 0.2).collect()}
    assert bk.frequent_itemsets(df, 0.9).isEmpty() and bk.frequent_itemsets(df.limit(0), 0.1).isEmpty()
    with pytest.raises(ValueError, match="unique"):
        bk.frequent_itemsets(spark.createDataFrame([(1, ["a", "a"])], df.schema), 0.5)


def test_solved_baskets_are_broadcast(spark):
    df = spark.createDataFrame(_twenty(), "ticket int, items array<string>")
    rules = bk.association_rules(bk.frequent_itemsets(df, 0.05), None)
    plan = bk.suggest_addons(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # the tickets meet written answers
    assert bk.suggest_addons(df, rules).count() == 10
