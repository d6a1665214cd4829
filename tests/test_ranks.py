"""Distributed ranks and quantiles against numpy, with hot values, hot groups, ties and few rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoptally.operators import ranks, stats


def _hot(n=20_000, seed=3):
    rng = np.random.default_rng(seed)
    value = np.round(rng.gamma(2.0, 50.0, n), 2)
    value[: n // 3] = 42.5  # one value holds a third of the rows
    group = rng.integers(0, 6, n)
    group[: n // 2] = 0  # one group holds half of them
    return pd.DataFrame({"g": group, "v": value})


@pytest.mark.parametrize("n", [3, 50, 20_000])
def test_quantiles_match_numpy(spark, n):
    pdf = _hot(max(n, 6)).head(n)
    got = ranks.quantiles(spark.createDataFrame(pdf), ["v"], (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)).first()
    np.testing.assert_allclose(got["q"], np.quantile(pdf["v"], [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]), rtol=1e-12)
    assert got["n"] == n


def test_quantiles_by_hot_group(spark):
    pdf = _hot()
    rows = ranks.quantiles(spark.createDataFrame(pdf), ["v"], (0.25, 0.5, 0.75), ["g"]).collect()
    assert len(rows) == pdf["g"].nunique()
    for r in rows:
        np.testing.assert_allclose(r["q"], np.quantile(pdf.loc[pdf.g == r["g"], "v"], [0.25, 0.5, 0.75]), rtol=1e-12)


def test_quantiles_ignore_nulls_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert ranks.quantiles(df, ["v"], (0.5,)).first()["q"] == [2.0]
    assert ranks.quantiles(df.filter("v > 9"), ["v"], (0.5,)).count() == 0


def test_ordered_totals_null_group(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.permutation(6000), "g": np.where(np.arange(6000) % 2 == 0, None, "a")})
    df = spark.createDataFrame(pdf, "k long, g string")
    placed = ranks.positions(df, "k", ["g"]).toPandas()
    for _, part in placed.groupby("g", dropna=False):
        part = part.sort_values("k")
        assert list(part["position"]) == list(range(3000))
        assert set(part["size"]) == {3000}


def test_average_ranks_and_spearman(spark):
    pdf = _hot(5000)
    pdf["w"] = pdf["v"] * 2 + pdf["g"]
    got = {(r.a, r.b): r.r for r in stats.spearman_matrix(spark.createDataFrame(pdf), ["v", "w", "g"]).collect()}
    want = pdf[["v", "w", "g"]].rank().corr()
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_buckets_split_a_hot_table(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    points = ranks.split_points(df, "v")
    sizes = [r["count"] for r in ranks.with_bucket(df, "v", points).groupBy("bucket").count().collect()]
    assert len(sizes) == ranks.BUCKETS
    assert max(sizes) < 6 * 50_000 / ranks.BUCKETS


def test_mode_is_lowest_among_ties(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (1.0,), (9.0,)], "v double")
    assert ranks.modes(df, ["v"]).first()["mode"] == 1.0


def test_auc_matches_pairs(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + 0.2 * y, 2)
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    df = spark.createDataFrame(pd.DataFrame({"target": y, "p": s}))
    assert stats.auc_by_rank(df, "target", "p").first()[0] == pytest.approx(want)


def test_only_buckets_with_wanted_places_are_ranked(spark):
    pdf = _hot()
    counts = ranks.counted_values(spark.createDataFrame(pdf), "v")
    some, whole = ranks.ordered_totals(counts, "v", buckets=64, probs=(0.5,)).toPandas(), ranks.ordered_totals(counts, "v", buckets=64).toPandas()
    assert 0 < len(some) < len(whole) / 5
    both = some.merge(whole, on="v", suffixes=("", "_all"))
    assert len(both) == len(some) and (both.n_before == both.n_before_all).all() and (both.n_total == len(pdf)).all()


def test_buckets_grow_with_the_values():
    sizes = [ranks.bucket_number(n) for n in (0, 10**6, 10**8, 10**9, 10**13)]
    assert sizes == [256, 256, 1024, 16_384, 16_384]
