"""Series, forecasts, payment models, ledger, streaming and files."""

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoptally import sources, streaming
from shoptally.operators import baskets as bk
from shoptally.operators import cleaning, forecast, ledger, payment
from shoptally.operators import series as sr


def _weeks(n=60, seed=1):
    rng = np.random.default_rng(seed)
    ds = [dt.date(2024, 1, 7) + dt.timedelta(days=7 * i) for i in range(n)]
    flag = (np.arange(n) % 9 == 0).astype(int)
    school = (np.arange(n) % 13 < 3).astype(int)
    y = np.exp(5 + 0.01 * np.arange(n) + 0.4 * flag - 0.2 * school + rng.normal(0, 0.05, n))
    return pd.DataFrame({"ds": ds, "y": y, "is_nat": flag, "is_school": school})


def test_trend_with_regressors_equals_least_squares(spark):
    pdf = _weeks()
    pdf2 = pdf.assign(s="b", y=pdf.y * 3)
    df = spark.createDataFrame(pd.concat([pdf.assign(s="a"), pdf2]))
    got = forecast.trend_forecast(df, 4, ["is_nat", "is_school"], changepoints=["2024-06-02"], holdout=4, series=["s"])
    got = got.filter("s = 'a' and not is_future").orderBy("ds").toPandas()
    t = np.arange(60.0)
    hinge = np.maximum((pd.to_datetime(pdf.ds) - pd.Timestamp("2024-06-02")).dt.days / 7.0, 0)
    x = np.column_stack([np.ones(60), t, hinge, pdf.is_nat, pdf.is_school])
    coef, *_ = np.linalg.lstsq(x[:56], np.log1p(pdf.y[:56]), rcond=None)
    np.testing.assert_allclose(got.yhat, np.expm1(x @ coef), rtol=1e-8)
    assert (got.yhat_lower <= got.yhat).all() and (got.yhat <= got.yhat_upper).all()


def test_forecast_is_never_negative(spark):
    df = spark.createDataFrame(_weeks(20).assign(y=np.linspace(5, 0, 20))[["ds", "y"]])
    got = forecast.trend_forecast_base(df, 30).toPandas()
    assert (got.yhat >= 0).all() and (got.yhat_lower >= 0).all() and got.is_future.sum() == 30


def test_percent_error_with_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 2.0), (10.0, 8.0)], "y double, yhat double")
    row = sr.forecast_errors(df).first()
    assert row.mape == pytest.approx(110.0) and row.rmse == pytest.approx(2.0)


def test_missing_days_are_zero(spark):
    df = spark.createDataFrame([("2026-01-01", 5.0), ("2026-01-04", 1.0)], "day string, total double").withColumn(
        "day", F.col("day").cast("date")
    )
    assert [r.y for r in sr.daily_revenue(df).orderBy("day").collect()] == [5.0, 0.0, 0.0, 1.0]


def test_tree_forecasts(spark):
    df = sr.add_lags(spark.createDataFrame(_weeks()), 3)
    train, test = sr.holdout_last(df, 4)
    for model in (forecast.forest_forecast(train, test, trees=10), forecast.boosted_forecast(train, test, rounds=5)):
        got = model.toPandas()
        assert len(got) == 4 and (got.yhat > 0).all()


def _tickets(spark, n=600):
    rng = np.random.default_rng(6)
    target = rng.integers(0, 2, n)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "total": rng.gamma(2, 10, n) + 15 * target,
            "units": rng.integers(1, 9, n).astype(float),
            "n_products": rng.integers(1, 5, n),
            "main_dept": rng.choice(["A", "B", "C"], n),
            "dept_share": rng.random(n),
            "weekday": rng.integers(0, 7, n),
            "is_weekend": rng.integers(0, 2, n),
            "target": target,
        }
    )
    return spark.createDataFrame(pdf)


def test_split_is_stratified_and_stable(spark):
    df = _tickets(spark)
    a = {r.id: r.part for r in payment.stratified_split(df).collect()}
    b = {r.id: r.part for r in payment.stratified_split(df.repartition(13)).collect()}
    assert a == b
    counts = payment.stratified_split(df).groupBy("target").agg(F.avg((F.col("part") == "train").cast("int")).alias("p"))
    assert all(abs(r.p - 0.8) < 0.01 for r in counts.collect())


def test_models_score_save_and_load(spark, tmp_path):
    split = payment.stratified_split(_tickets(spark)).cache()
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    model = payment.fit_boosted(train, rounds=10)
    unseen = test.withColumn("main_dept", F.lit("NEW"))
    scored = payment.score_tickets(test.unionByName(unseen), model).toPandas()
    assert len(scored) == 2 * test.count()
    assert scored.confidence.between(0.5, 1.0).all()
    assert ((scored.p_yape > 0.5) == (scored.prediction == 1)).all()
    payment.save_model(model, str(tmp_path / "m"))
    again = payment.score_tickets(test, payment.load_model(str(tmp_path / "m"))).orderBy("id").toPandas()
    want = payment.score_tickets(test, model).orderBy("id").toPandas()
    np.testing.assert_allclose(again.p_yape, want.p_yape)
    with pytest.raises(ValueError):
        payment.load_model(str(tmp_path / "m"), ["total"])
    forest = payment.fit_forest(train, trees=10)
    ranked = payment.importances(forest)
    assert ranked[0][0] == "total" and sum(v for _, v in ranked) == pytest.approx(1.0)
    loss = {r.feature: r.loss for r in payment.permutation_importance(forest, test, metric="accuracy").collect()}
    assert max(loss, key=loss.get) == "total"


def test_shuffle_moves_values_and_keeps_them(spark):
    df = _tickets(spark).select("id", "total", "units")
    moved = payment.shuffled(df, "total").toPandas().sort_values("id")
    before = df.toPandas().sort_values("id")
    assert sorted(moved.total) == pytest.approx(sorted(before.total))
    assert (moved.total.to_numpy() != before.total.to_numpy()).mean() > 0.9
    assert (moved.units.to_numpy() == before.units.to_numpy()).all()


def test_label_leak_is_refused(spark):
    with pytest.raises(ValueError, match="repeat the label"):
        payment.fit_forest(_tickets(spark).withColumn("pay_copy", F.lit(1)), ["total", "pay_copy"])


def test_tie_goes_to_boosted(spark):
    table = spark.createDataFrame([("forest", 0.4), ("boosted", 0.4)], "model string, f1 double")
    assert payment.pick_classifier(table).first().model == "boosted"


def _ledger_loop(base, log):
    rows = {k: dict(v) for k, v in base.items()}
    for key, _, op, total, pay in sorted(log, key=lambda r: r[1]):
        if op == "insert":
            rows.setdefault(key, {"total": total, "pay": pay})
        elif op == "delete":
            rows.pop(key, None)
        elif key in rows:
            rows[key] = {"total": rows[key]["total"] if total is None else total, "pay": rows[key]["pay"] if pay is None else pay}
    return rows


@pytest.mark.parametrize("limit", ["10485760", "100"])
def test_change_log_equals_loop(spark, limit):
    rng = np.random.default_rng(11)
    base = {k: {"total": float(k), "pay": "B"} for k in range(5)}
    log = []
    for seq in range(2000):
        key = 0 if rng.random() < 0.4 else int(rng.integers(0, 40))  # a hot key
        op = rng.choice(["insert", "update", "update", "delete"], p=[0.4, 0.25, 0.25, 0.1])
        log.append((key, seq, str(op), None if rng.random() < 0.2 else float(seq), None if rng.random() < 0.2 else f"p{seq % 3}"))
    schema = "key int, seq long, op string, total double, pay string"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        base_df = spark.createDataFrame([(k, v["total"], v["pay"]) for k, v in base.items()], "key int, total double, pay string")
        got = ledger.apply_changes(base_df, spark.createDataFrame(log, schema)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.key: {"total": r.total, "pay": r.pay} for r in got} == _ledger_loop(base, log)


def _sales_folder(spark, tmp_path):
    start = dt.datetime(2026, 3, 2, 9)
    rows = [(f"S{i % 80}", start + dt.timedelta(hours=6 * (i % 80)), float(i % 80)) for i in range(120)]
    df = spark.createDataFrame(rows, "id_sale string, at timestamp, total double").orderBy("at")
    folder = str(tmp_path / "in")
    for i in range(3):
        df.filter(F.pmod(F.hash("at", "id_sale"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(folder)
    return df, folder


def test_streams_equal_batch(spark, tmp_path):
    df, folder = _sales_folder(spark, tmp_path)
    stream = streaming.table_stream(spark, folder, df.schema, files_per_batch=1)
    unique = streaming.dedupe_stream(stream, "id_sale", "at", "60 days")
    written = streaming.run_available(unique, str(tmp_path / "u"), str(tmp_path / "uc"))
    assert sorted(r.id_sale for r in written.select("id_sale").collect()) == sorted({f"S{i}" for i in range(80)})

    weekly = streaming.weekly_revenue_stream(stream, delay="60 days")
    out = streaming.latest_per_key(streaming.run_available(weekly, str(tmp_path / "w"), str(tmp_path / "wc"), "update"), "ds")
    batch = sr.weekly_revenue(sr.daily_revenue(df, "at", "total"))
    assert {r.ds: r.y for r in out.collect()} == {r.ds: r.y for r in batch.collect()}


def test_late_sales_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "at timestamp, total double"
    # A batch filters by the watermark of the batch before, so the late row comes two batches after the jump.
    for day, total in (("2026-03-02", 1.0), ("2026-06-01", 2.0), ("2026-06-08", 3.0), ("2026-03-03", 5.0)):
        time.sleep(1.1)
        spark.createDataFrame([(dt.datetime.fromisoformat(day), total)], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = streaming.table_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1)
    weekly = streaming.weekly_revenue_stream(stream, delay="7 days")
    out = streaming.run_available(weekly, str(tmp_path / "o"), str(tmp_path / "c"), "append")
    assert {r.ds.isoformat(): r.y for r in out.collect()}.get("2026-03-08") == 1.0


def test_scored_stream_equals_batch(spark, tmp_path):
    items = F.when(F.col("main_dept") == "A", F.array(F.lit("x"), F.lit("y"))).otherwise(F.array(F.lit("x")))
    df = _tickets(spark).withColumn("items", items)
    folder = str(tmp_path / "in")
    df.repartition(3).write.parquet(folder)
    model = payment.fit_forest(df, trees=5)
    rules = bk.association_rules(bk.frequent_itemsets(df.select("items"), 0.1), None)
    stream = streaming.table_stream(spark, folder, df.schema, files_per_batch=1)
    streaming.score_stream(stream, model, rules, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch").toPandas().sort_values("id").reset_index(drop=True)
    want = streaming.score_batch(df, model, rules).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)
    assert set(got.suggestion.dropna()) == {"y"}


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8-sig"))
    return str(path)


def test_read_sales_file(spark, tmp_path):
    path = _write(tmp_path / "raw/ventas.csv", "ID;Fecha;Metodo_Pago;ID_Cliente;Total\nV1;2/3/2026 10:15;  yape ;1;12.5\n;;;;\n")
    rows = sources.read_sales(spark, path).collect()
    assert [tuple(r) for r in rows] == [("V1", "2/3/2026 10:15", "Yape", "1", "12.5")]


def test_read_lines_file(spark, tmp_path):
    path = _write(
        tmp_path / "raw/detalle-ventas.csv",
        "REPORTE;;;;\n;ID_Venta;ID_Producto;Cantidad;Descripcion\n; V1 ;7.0;1,200;Lápiz\n;V2;8;x;\n;;9;1;b\n",
    )
    clean = cleaning.clean_lines(sources.read_lines(spark, path)).orderBy("id").collect()
    assert [(r.id, r.product, r.qty, r.description) for r in clean] == [
        ("V1", "7.0", 1200.0, "Lápiz"),
        ("V2", "8", 0.0, "SIN DESCRIPCION"),
    ]


def test_inventory_delimiter_is_found(spark, tmp_path):
    header = ["ID", "Descripcion", "Departamento", "Costo_Unitario", "Stock_Minimo", "Stock_Actual"]
    for sep in (";", ","):
        lines = [sep * 5, sep.join(header), sep.join(["1", "x", "UTILES", "2", "", "-4"]), sep.join(["2", "y", "OTRO", "3", "", "6"])]
        path = _write(tmp_path / f"inv{ord(sep)}.csv", "\n".join(lines))
        assert sources.sniff_delimiter(spark, path) == sep
        got = {r.id: (r.min_stock, r.stock, r.negative_stock) for r in cleaning.clean_inventory(sources.read_inventory(spark, path)).collect()}
        assert got == {"1": (5, 0, True), "2": (2, 6, False)}


def test_clean_table_is_preferred(spark, tmp_path):
    base = str(tmp_path)
    _write(tmp_path / "raw/ventas.csv", "ID;Fecha;Metodo_Pago;ID_Cliente;Total\nV1;2026-03-02;yape;1;x\n")
    raw = sources.load_table(spark, base, "sales")
    assert raw.first().total == "x"
    sources.write_clean({"sales": cleaning.clean_sales(raw)}, base, csv=True)
    assert sources.load_table(spark, base, "sales").first().total == 0.0
    assert sources.load_table(spark, base, "sales", prefer_clean=False).first().total == "x"
    with pytest.raises(FileNotFoundError):
        sources.load_table(spark, base, "lines")


def test_missing_header(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        sources.read_sales(spark, _write(tmp_path / "x.csv", "a;b\n1;2\n"))


def test_clusters_are_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, cluster int")
    sources.write_clusters(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).filter("cluster = 1").count() == 2


def test_payment_models_take_many_departments(spark):
    from shoptally.operators import payment

    rows = [(i, i % 2, f"dept{i % 60}", float(i % 7), float(i % 5), float(i % 3)) for i in range(300)]
    names = "id long, target int, {} string, a double, b double, c double".format(next(iter(payment.CATEGORICAL.values())))
    cols = [next(iter(payment.CATEGORICAL))]
    train = spark.createDataFrame(rows, names)
    for fitted in (payment.fit_forest(train, cols, trees=2, depth=2), payment.fit_boosted(train, cols, rounds=2, depth=2)):
        assert fitted.transform(train).count() == 300


def test_readers_find_the_header_by_position(spark, tmp_path):
    top = ["4;2026-05-04;Cash;7;1.0", *[f"9{i};2026-05-04;Cash;7;1.0" for i in range(29)]]
    body = ["ID;Fecha;Metodo_Pago;ID_Cliente;Total", "4;2026-05-04;Cash;7;1.0", '5;2026-05-04;"Ca\nsh";7;2.0', "ID;Fecha;Metodo_Pago;ID_Cliente;Total", "6;2026-05-04;Cash;7;3.0"]
    sales = _write(tmp_path / "deep.csv", "\n".join([*top, *body]) + "\n")
    assert sorted((r.id, r.total) for r in sources.read_sales(spark, sales).collect()) == [("4", "1.0"), ("5", "2.0"), ("6", "3.0")]
    lines = _write(tmp_path / "lines.csv", "\n".join(["4;x;y", *["note"] * 25, "ID_Venta;ID_Producto;Departamento;Descripcion", '4;x;y;"a\nb; c"', "4;x;y"]) + "\n")
    assert sorted((r.id, r.description or "") for r in sources.read_lines(spark, lines).collect()) == [("4", ""), ("4", "a\nb; c")]
    stock = _write(tmp_path / "stock.csv", "\n".join(["a;b;c"] * 30 + ["ID,Descripcion,Categoria", "1,x;y,z"]) + "\n")
    assert sources.sniff_delimiter(spark, stock) == ","
    assert [(r.id, r.description, r.category) for r in sources.read_inventory(spark, stock).collect()] == [("1", "x;y", "z")]
