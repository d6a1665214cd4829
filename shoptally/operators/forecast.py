"""Trend and tree forecasts of weekly revenue.

The trend model is least squares on log revenue with a linear trend, optional change points and calendar
regressors. Each regressor is made orthogonal to the earlier ones by window sums over its series, which gives the
multiple-regression fit for any number of series in one shuffle. It takes the place of a Bayesian curve-fitting
library: same inputs and outputs, not the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.numbers import log_scale, unlog_scale
from shoptally.operators.series import future_weeks

Z80 = 1.2815515655446004  # standard normal quantile of an 80 % interval
LAG_FEATURES = ("is_nat", "is_school", "week", "lag_1", "lag_2", "lag_3")
TINY = 1e-9

FIT_PARTITIONS = 16


def trend_forecast(
    df: DataFrame,
    horizon=4,
    regressors: Sequence[str] = (),
    future: DataFrame | None = None,
    changepoints: Sequence[str] = (),
    holdout=0,
    series: Sequence[str] = (),
    z=Z80,
) -> DataFrame:
    """Fitted and future rows: ``ds``, ``y`` (null ahead), ``yhat``, ``yhat_lower``, ``yhat_upper``, ``is_future``.

    ``df`` has ``ds``, ``y`` and the regressors. ``future`` gives the regressors of the coming weeks (default: all 0).
    ``holdout`` weeks at the end are predicted but not fitted. ``changepoints`` are dates where the slope may change.
    """
    keys = list(series)
    ahead = future_weeks(df, horizon, keys).drop("step")
    if future is not None:
        ahead = ahead.join(future.select(*keys, "ds", *regressors), [*keys, "ds"], "left")
    else:
        ahead = ahead.withColumns({r: F.lit(0) for r in regressors}) if regressors else ahead
    known = df.select(*keys, "ds", "y", *regressors).withColumn("is_future", F.lit(False))
    rows = known.unionByName(ahead.withColumn("is_future", F.lit(True)), allowMissingColumns=True)
    rows = rows.fillna(0, subset=list(regressors)) if regressors else rows

    part = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    back = F.row_number().over(part.orderBy(F.col("is_future"), F.desc("ds")))
    rows = rows.withColumn("_fit", ~F.col("is_future") & (back > holdout))
    rows = rows.withColumn("_t", F.datediff("ds", F.min("ds").over(part)) / 7.0)

    def total(expression):
        return F.sum(F.when(F.col("_fit"), expression)).over(part)

    columns = {"_x0": F.col("_t")}
    for i, day in enumerate(changepoints):
        after = F.datediff(F.col("ds"), F.lit(day).cast("date")) / 7.0
        columns[f"_h{i}"] = F.greatest(after, F.lit(0.0))
    for i, name in enumerate(regressors):
        columns[f"_r{i}"] = F.col(name).cast("double")
    rows = rows.withColumns({**columns, "_target": log_scale("y")})
    rows = rows.withColumn("_n", total(F.lit(1.0)))
    rows = rows.withColumn("_fitted", total(F.col("_target")) / F.col("_n"))

    done: list[str] = []
    for x in columns:
        rows = rows.withColumn(x, F.col(x) - total(F.col(x)) / F.col("_n"))
        for earlier in done:
            slope = total(F.col(x) * F.col(earlier)) / F.col(f"{earlier}_ss")
            rows = rows.withColumn(x, F.col(x) - F.when(F.col(f"{earlier}_ss") > TINY, slope).otherwise(0.0) * F.col(earlier))
        rows = rows.withColumn(f"{x}_ss", total(F.col(x) * F.col(x)))
        gain = F.try_divide(total(F.col(x) * F.col("_target")), F.col(f"{x}_ss"))
        rows = rows.withColumn(f"{x}_b", F.when(F.col(f"{x}_ss") > TINY, gain).otherwise(0.0))
        rows = rows.withColumn("_fitted", F.col("_fitted") + F.col(f"{x}_b") * F.col(x))
        done.append(x)

    freedom = F.greatest(F.col("_n") - (1 + len(done)), F.lit(1.0))
    spread = F.sqrt(total(F.pow(F.col("_target") - F.col("_fitted"), 2)) / freedom)
    rows = rows.withColumn("_spread", spread)
    return rows.select(
        *keys,
        "ds",
        "y",
        unlog_scale("_fitted").alias("yhat"),
        unlog_scale(F.col("_fitted") - z * F.col("_spread")).alias("yhat_lower"),
        unlog_scale(F.col("_fitted") + z * F.col("_spread")).alias("yhat_upper"),
        "is_future",
    )


def trend_forecast_base(df: DataFrame, horizon=4, holdout=0, series: Sequence[str] = ()) -> DataFrame:
    """Trend only, to measure what the regressors add."""
    return trend_forecast(df, horizon, holdout=holdout, series=series)


def _tree_forecast(model, train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    prepared = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_features"), model])
    # Dealt by day over a fixed number of partitions, so the seed fixes the result on every cluster and at every size.
    fitted = prepared.fit(train.repartition(FIT_PARTITIONS, "ds").sortWithinPartitions("ds"))
    return fitted.transform(test).drop("_features")


def forest_forecast(train: DataFrame, test: DataFrame, cols: Sequence[str] = LAG_FEATURES, trees=100, seed=42) -> DataFrame:
    """Random-forest regression on lags and calendar; adds ``yhat`` to ``test``."""
    model = RandomForestRegressor(
        featuresCol="_features", labelCol="y", predictionCol="yhat", numTrees=trees, seed=seed
    )
    return _tree_forecast(model, train, test, cols)


def boosted_forecast(
    train: DataFrame, test: DataFrame, cols: Sequence[str] = LAG_FEATURES, rounds=100, rate=0.1, seed=42
) -> DataFrame:
    """Boosted-tree regression on lags and calendar; adds ``yhat`` to ``test``."""
    model = GBTRegressor(
        featuresCol="_features", labelCol="y", predictionCol="yhat", maxIter=rounds, stepSize=rate, seed=seed
    )
    return _tree_forecast(model, train, test, cols)
