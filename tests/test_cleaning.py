"""Cleaning rules and the date repair, on literal rows and against a sequential loop."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoptally import functions as fn
from shoptally.operators import cleaning, quality


def test_date_repair_by_definition(spark):
    texts = ["4/5/2026", "22/4/2026", "5/6/2026", None, "6/5/2026", "7/6/2026", "1/2/2026"]
    want = ["2026-04-05", "2026-04-22", "2026-05-06", None, "2026-05-06", "2026-06-07", "2026-01-02"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq int, text string")
    got = [r.date_fixed for r in cleaning.disambiguate_dates(df, "seq", "text").orderBy("seq").collect()]
    assert [d and d.isoformat() for d in got] == want


def _loop(texts):
    previous, out = dt.date.min, []
    for text in texts:
        if text is None or text == "?":
            out.append(None)
            continue
        a, b, year = (int(p) for p in text.split("/"))
        readings = []
        for day, month in ((a, b), (b, a)):
            if month <= 12:
                readings.append(dt.date(year, month, day))
        d1, d2 = readings[0], readings[-1]
        if d1 == d2:
            chosen = d1
        elif (d1 >= previous) != (d2 >= previous):
            chosen = d1 if d1 >= previous else d2
        else:
            chosen = d1 if (d1 - previous) < (d2 - previous) else d2
        out.append(chosen)
        previous = chosen
    return out


def test_date_repair_equals_loop_over_slices(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for series, n in (("hot", 6000), ("b", 40), ("c", 1)):  # the hot series is cut into many slices
        texts = []
        for _ in range(n):
            d, m = int(rng.integers(1, 28 if rng.random() < 0.2 else 12)), int(rng.integers(1, 12))
            texts.append("?" if rng.random() < 0.02 else None if rng.random() < 0.02 else f"{d}/{m}/2026")
        want[series] = _loop(texts)
        rows += [(series, i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "s string, i int, text string").repartition(7)
    got = cleaning.disambiguate_dates(df, "i", "text", ["s"]).toPandas()
    for series, expected in want.items():
        part = got[got.s == series].sort_values("i")["date_fixed"]
        assert [None if pd.isna(d) else d for d in part] == expected


def test_iso_dates_are_not_ambiguous(spark):
    df = spark.createDataFrame([(1, "2026-03-04"), (2, "2026-03-05 10:00:00")], "i int, t string")
    got = [r.date_fixed.isoformat() for r in cleaning.disambiguate_dates(df, "i", "t").orderBy("i").collect()]
    assert got == ["2026-03-04", "2026-03-05"]


def test_text_and_ids(spark):
    df = spark.createDataFrame([("  Lápiz   2b ", "15.0"), (None, None), ("ñandú\t é", " a.0 ")], "t string, i string")
    got = [tuple(r) for r in df.select(fn.normalize_text("t"), fn.normalize_id("i")).collect()]
    assert got == [("LAPIZ 2B", "15"), ("", ""), ("NANDU E", "A")]


def test_decomposed_accents(spark):
    df = spark.createDataFrame([("LÁPIZ",), ("Ångström",)], "t string")
    assert df.select(fn.normalize_text("t")).collect()[0][0] == "LAPIZ"


def test_numbers(spark):
    df = spark.createDataFrame([("1,200",), (" 3.5 ",), ("x",), (None,), ("12.0",), ("NaN",)], "t string")
    got = [tuple(r) for r in df.select(fn.to_number("t"), fn.to_number("t", 0.0), fn.to_number("t", kind="int")).collect()]
    assert got == [(1200.0, 1200.0, 1200), (3.5, 3.5, 3), (None, 0.0, None), (None, 0.0, None), (12.0, 12.0, 12), (None, 0.0, None)]


def test_clean_inventory_rules(spark):
    df = spark.createDataFrame(
        [("1", "Utiles ", None, "-3", "1,5"), ("2", "X", None, None, "bad"), ("3", "X", "7.0", "4", "2"), (None, "X", "1", "1", "1")],
        "id string, dept string, min_stock string, stock string, price string",
    )
    got = {r.id: (r.min_stock, r.stock, r.negative_stock, r.price) for r in cleaning.clean_inventory(df).collect()}
    assert got == {"1": (5, 0, True, 15.0), "2": (2, 0, False, 0.0), "3": (7, 4, False, 2.0)}


def test_clean_lines_rules(spark):
    df = spark.createDataFrame(
        [(" A ", None, "-2", "bad", "3"), (None, "x", "1", "1", "1")],
        "id string, description string, qty string, unit_price string, subtotal string",
    )
    row = cleaning.clean_lines(df).first()
    assert (row.id, row.description, row.qty, row.unit_price, row.subtotal) == ("A", "SIN DESCRIPCION", 0.0, 0.0, 3.0)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns: total"):
        cleaning.clean_sales(spark.createDataFrame([("1", "d", "p")], "id string, date string, pay string"))


def test_empty_table_is_complete(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert quality.completeness(empty).first()["coverage_pct"] == 100.0


def test_week_labels(spark):
    days = ["2026-03-01", "2026-03-02", "2026-03-09"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(fn.week_end(F.col("d").cast("date")).alias("w"))
    assert [r.w.isoformat() for r in df.collect()] == ["2026-03-01", "2026-03-08", "2026-03-15"]


def test_scalar_rules(spark):
    df = spark.createDataFrame([(11.8, 20, "UTILES", 0.0, 0.0)], "total double, hour int, dept string, a double, b double")
    row = fn.rule_payment(fn.split_tax(df), "total", "hour", "dept").withColumn("dom", fn.dominant_role("a", "b")).first()
    assert round(row.net, 2) == 10.0 and round(row.tax, 2) == 1.8
    assert (row.pay_rule, row.confidence, row.dom) == ("YAPE", 0.84, "UTILES")


def test_dedupe_first_puts_nulls_last(spark):
    from shoptally.operators.tickets import dedupe_first

    df = spark.createDataFrame([(1, None, "x"), (1, "LAPICEROS", "y"), (2, None, "z")], "id int, category string, note string")
    assert {tuple(r) for r in dedupe_first(df, "id", "category").collect()} == {(1, "LAPICEROS", "y"), (2, None, "z")}
