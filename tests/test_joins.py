"""The dimension join beyond the broadcast limit: hot keys, null keys, unknown keys."""

import pytest
from pyspark.sql import functions as F

from shoptally.operators import joins


@pytest.fixture
def small_limit(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _tables(spark):
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 900)
    facts = spark.range(6000).select(F.col("id").alias("row"), key.alias("k"))
    dim = spark.range(800).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return facts, dim


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_dimension(spark, small_limit, how):
    facts, dim = _tables(spark)
    assert not joins.fits_broadcast(dim)
    got = joins.join_dimension(facts, dim, "k", how)
    want = facts.join(dim, "k", how)
    assert sorted(map(str, got.select("row", "k", "v").collect())) == sorted(map(str, want.select("row", "k", "v").collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_dimension_of_two_columns(spark, small_limit, how):
    facts, dim = _tables(spark)
    facts, dim = (t.withColumns({"a": F.col("k") / 2, "b": -F.col("k") % 7}).drop("k") for t in (facts, dim))
    got = joins.join_dimension(facts, dim, ["a", "b"], how, heavy=[(0.5, -1)])
    want = facts.join(dim, ["a", "b"], how)
    assert sorted(map(str, got.select("row", "a", "b", "v").collect())) == sorted(map(str, want.select("row", "a", "b", "v").collect()))
    with pytest.raises(ValueError):
        joins.join_dimension(facts, dim, ["a", "b"], how)


def test_heavy_keys_are_bounded(spark):
    facts, _ = _tables(spark)
    assert joins.heavy_keys(facts, "k", 0.01) == [1]


def test_bad_join_type(spark):
    facts, dim = _tables(spark)
    with pytest.raises(ValueError):
        joins.join_dimension(facts, dim, "k", "full")
