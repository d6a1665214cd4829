"""Operators that read their rows once: same results as plain versions, and the plans that they promise."""

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoptally import streaming
from shoptally.operators import baskets as bk
from shoptally.operators import payment, stats, tickets


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark):
    rng = np.random.default_rng(5)
    n = 2000
    ticket = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 60, n))  # one ticket holds two fifths of the lines
    pdf = pd.DataFrame(
        {"id": ticket, "product": rng.integers(0, 40, n), "dept": rng.choice(["A", "B", "C"], n), "qty": rng.integers(1, 5, n) * 1.0, "subtotal": rng.random(n)}
    )
    lines = spark.createDataFrame(pdf).withColumn("dept", F.when(F.col("product") != 7, F.col("dept")))
    return pdf, lines.withColumn("product", F.when(F.col("product") != 3, F.col("product")))


def test_ticket_features_without_copies_of_lines(spark):
    pdf, lines = _lines(spark)
    sales = spark.createDataFrame([(int(i), "YAPE", 10.0) for i in pdf.id.unique()], "id long, pay string, total double")
    made = tickets.ticket_features(sales, lines)
    assert "Expand" not in _plan(made)
    known = pdf.assign(product=pdf["product"].where(pdf["product"] != 3), dept=pdf.dept.where(pdf["product"] != 7))
    want = known.groupby("id").agg(p=("product", "nunique"), d=("dept", "nunique"))
    assert {r.id: (r.n_products, r.n_depts) for r in made.collect()} == {i: (r.p, r.d) for i, r in want.iterrows()}


def test_payment_features_scan_the_lines_once(spark, sf):
    from shoptally.plans import views

    sales, lines = views.sales(spark, sf), views.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("product"), F.col("l_returnflag").alias("dept"), F.col("l_quantity").alias("qty")
    )
    made = tickets.payment_features(sales, lines)
    assert _plan(made).count("FileScan") <= 3
    want = {r.id: r.n for r in lines.groupBy("id").agg(F.countDistinct("product").alias("n")).collect()}
    assert {r.id: r.n_products for r in made.collect()} == want


def test_basket_density_scans_the_lines_at_most_twice(spark, sf):
    from shoptally.plans import views

    lines = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), "l_returnflag", "l_partkey")
    made = bk.basket_density(lines, "id", ["l_returnflag", "l_partkey"])
    rows = {r.level: r for r in made.collect()}
    pdf = lines.toPandas()
    for c in ("l_returnflag", "l_partkey"):
        cells, n, m = len(pdf[["id", c]].drop_duplicates()), pdf.id.nunique(), pdf[c].nunique()
        assert (rows[c].n_baskets, rows[c].n_items) == (n, m) and rows[c].sparsity == pytest.approx(1 - cells / (n * m))
    final = made._jdf.queryExecution().executedPlan().toString()
    assert final.split("Initial Plan")[0].count("FileScan") <= 2


def test_basket_density_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, a string")
    assert [tuple(r) for r in bk.basket_density(empty, "id", ["a"]).collect()] == [("a", 0, 0, None)]


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_spearman_with_hot_values(spark, limit):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": np.where(rng.random(3000) < 0.5, 1.0, rng.normal(size=3000)), "b": rng.integers(0, 4, 3000) * 1.0, "c": rng.normal(size=3000)})
    pdf.loc[::50, "c"] = -0.0
    pdf["d"] = 2.0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = {(r.a, r.b): r.r for r in stats.spearman_matrix(spark.createDataFrame(pdf), list("abcd")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = pdf[["a", "b", "c"]].corr(method="spearman")
    for x in "abc":
        for y in "abc":
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9)
    assert got["a", "d"] is None  # a constant has no correlation


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_addons_when_nine_tenths_of_the_baskets_are_equal(spark, limit):
    rows = [(i, ["a"] if i % 10 else ["a", "b"]) for i in range(400)] + [(400, []), (401, ['x"', "y,z"])]
    df = spark.createDataFrame(rows, "ticket int, items array<string>")
    rules = spark.createDataFrame(
        [(["a"], ["b"], 0.1, 2.0), (["a"], ["c"], 0.2, 3.0), (['x"'], ["q"], 0.3, 1.0)],
        "antecedent array<string>, consequent array<string>, confidence double, lift double",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = sorted((r.ticket, r.rank, r.suggestion) for r in bk.suggest_addons(df, rules, 2).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(i, 1, "c") for i in range(400)] + [(i, 2, "b") for i in range(400) if i % 10] + [(401, 1, "q")]
    assert got == sorted(want)


def test_permutation_importance_equals_a_loop_over_moved_columns(spark):
    rows = [(i, float(i % 11), "A" if i % 3 else "B", int(i % 11 > 5)) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, total double, main_dept string, target int")
    cols = ("total", "main_dept_code")
    model = payment.fit_forest(df, cols, trees=5)
    got = {r.feature: r.loss for r in payment.permutation_importance(model, df, cols, "accuracy").collect()}
    order = df.withColumn("k", F.concat(F.md5(F.concat_ws("|", F.lit(42), F.col("id").cast("string"))), F.col("id").cast("string"))).orderBy("k").drop("k").toPandas()

    def accuracy(pdf):
        scored = payment.score_tickets(spark.createDataFrame(pdf), model).toPandas()
        return (scored.prediction == scored.target).mean()

    base = accuracy(order)
    for i, (feature, col) in enumerate(zip(cols, ("total", "main_dept"), strict=True)):
        moved = order.assign(**{col: np.roll(order[col].to_numpy(), -(i + 1))})
        assert got[feature] == pytest.approx(base - accuracy(moved))


def test_closed_weeks_are_written_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    for day, total in (("2026-03-02", 1.0), ("2026-03-08", 1.5), ("2026-06-01", 2.0), ("2026-06-08", 3.0), ("2026-03-03", 5.0)):
        time.sleep(1.1)
        spark.createDataFrame([(dt.datetime.fromisoformat(day), total)], "at timestamp, total double").coalesce(1).write.mode("append").parquet(folder)
    stream = streaming.table_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1)
    weekly = streaming.weekly_revenue_stream(stream, delay="7 days")
    out, late = streaming.run_closed(weekly, str(tmp_path / "o"), str(tmp_path / "c"))
    assert [(r.ds.isoformat(), r.y) for r in out.collect()] == [("2026-03-08", 2.5)]
    assert late == 1
