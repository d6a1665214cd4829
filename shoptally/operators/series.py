"""Daily and weekly revenue series, calendar regressors, lags, moving means and error measures.

Every function works per ``series`` (column names, possibly none), so many shops run in one job. Windows run
over aggregated rows: at most one per series and day or week.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.dates import week_end

Names = Sequence[str]

# Start (month, day) and length in days of the yearly school periods.
SCHOOL_PERIODS = ((3, 1, 30), (7, 20, 15))


def _part(series: Names):
    return W.partitionBy(*series) if series else W.partitionBy(F.lit(0))


def daily_revenue(df: DataFrame, date="day", amount="total", series: Names = ()) -> DataFrame:
    """Revenue per day from the first to the last sale of the series, 0 on days without sales."""
    keys = list(series)
    sums = df.filter(F.col(date).isNotNull()).groupBy(*keys, F.to_date(date).alias("day")).agg(F.sum(amount).alias("y"))
    spans = sums.groupBy(*keys).agg(F.min("day").alias("_from"), F.max("day").alias("_to"))
    days = spans.filter(F.col("_from").isNotNull()).select(*keys, F.explode(F.sequence("_from", "_to")).alias("day"))
    return days.join(sums, [*keys, "day"], "left").fillna(0.0, subset=["y"])


def weekly_revenue(daily: DataFrame, end="SUN", series: Names = ()) -> DataFrame:
    """Revenue per week, labelled by its last day."""
    return daily.groupBy(*series, week_end("day", end).alias("ds")).agg(F.sum("y").alias("y"))


def school_days(weeks: DataFrame, years_after=2) -> DataFrame:
    """Days of the school periods for the years of a series and the following ones."""
    span = weeks.agg(F.year(F.min("ds")).alias("a"), (F.year(F.max("ds")) + years_after).alias("b"))
    years = span.select(F.explode(F.sequence("a", "b")).alias("year"))
    periods = F.array(
        *[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("n")) for m, d, n in SCHOOL_PERIODS]
    )
    starts = years.select(F.explode(periods).alias("p"), "year").select(
        F.make_date("year", F.col("p.m"), F.col("p.d")).alias("start"), "p.n"
    )
    return starts.select(F.explode(F.sequence("start", F.date_add("start", F.col("n") - 1))).alias("day"))


def yearly_days(weeks: DataFrame, month_days: Sequence[tuple[int, int]], years_after=2) -> DataFrame:
    """Fixed-date holidays (month, day) for the years of a series and the following ones."""
    span = weeks.agg(F.year(F.min("ds")).alias("a"), (F.year(F.max("ds")) + years_after).alias("b"))
    pairs = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d")) for m, d in month_days])
    years = span.select(F.explode(F.sequence("a", "b")).alias("year"))
    return years.select("year", F.explode(pairs).alias("p")).select(
        F.make_date("year", F.col("p.m"), F.col("p.d")).alias("day")
    )


def attach_calendar(weeks: DataFrame, regressors: DataFrame) -> DataFrame:
    """Weeks with calendar flags; weeks the calendar does not name get 0. The calendar has one row per week."""
    flags = [c for c in regressors.columns if c != "ds"]
    return weeks.join(regressors, "ds", "left").fillna(0, subset=flags)


def calendar_regressors(weeks: DataFrame, holidays: DataFrame, windows: DataFrame, end="SUN") -> DataFrame:
    """Add ``is_nat`` and ``is_school``: whether any day of the week is a holiday / in a school period."""
    marked = weeks
    for name, days in (("is_nat", holidays), ("is_school", windows)):
        hits = days.select(week_end("day", end).alias("ds")).distinct().withColumn(name, F.lit(1))
        marked = attach_calendar(marked, hits)
    return marked


def add_lags(df: DataFrame, n=3, value="y", series: Names = ()) -> DataFrame:
    """Lags 1..n and the ISO week; rows with an incomplete history are left out."""
    order = _part(series).orderBy("ds")
    lagged = df.withColumns({f"lag_{i}": F.lag(value, i).over(order) for i in range(1, n + 1)})
    return lagged.withColumn("week", F.weekofyear("ds")).dropna(subset=[f"lag_{i}" for i in range(1, n + 1)])


def lagged_mean(df: DataFrame, k=3, fill: Column | float | None = None, value="y", series: Names = ()) -> DataFrame:
    """Mean of the ``k`` rows before each; the first row gets ``fill``."""
    mean = F.avg(value).over(_part(series).orderBy("ds").rowsBetween(-k, -1))
    fill = F.lit(fill).cast("double") if not isinstance(fill, Column) else fill
    return df.withColumn("ma_pred", F.coalesce(mean, fill))


def rolling_mean(df: DataFrame, k=3, value="y", series: Names = ()) -> DataFrame:
    """Mean of each row and the ``k - 1`` before it."""
    return df.withColumn("rolling", F.avg(value).over(_part(series).orderBy("ds").rowsBetween(-k + 1, 0)))


def expanding_mean(df: DataFrame, value="y", series: Names = ()) -> DataFrame:
    """Mean of all rows up to each."""
    frame = _part(series).orderBy("ds").rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("expanding", F.avg(value).over(frame))


def _from_end(df: DataFrame, series: Names) -> DataFrame:
    return df.withColumn("_back", F.row_number().over(_part(series).orderBy(F.desc("ds"))))


def holdout_last(df: DataFrame, n=4, series: Names = ()) -> tuple[DataFrame, DataFrame]:
    """Training rows, and the last ``n`` rows per series."""
    placed = _from_end(df, series)
    return placed.filter(F.col("_back") > n).drop("_back"), placed.filter(F.col("_back") <= n).drop("_back")


def future_weeks(df: DataFrame, horizon=4, series: Names = ()) -> DataFrame:
    """The ``horizon`` weeks after the last one of each series."""
    last = df.groupBy(*series).agg(F.max("ds").alias("_last"))
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    return last.select(*series, "_last", step).select(*series, "step", F.date_add("_last", F.col("step") * 7).alias("ds"))


def flat_forecast(df: DataFrame, k=3, horizon=4, value="y", series: Names = ()) -> DataFrame:
    """Future weeks, each at the mean of the last ``k`` rows."""
    level = _from_end(df, series).filter(F.col("_back") <= k).groupBy(*series).agg(
        F.avg(value).alias("ma_pred"), F.max("ds").alias("_last")
    )
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    return level.select(*series, "_last", "ma_pred", step).select(
        *series, F.date_add("_last", F.col("step") * 7).alias("ds"), "ma_pred"
    )


def _relative_error(actual: str, pred: str) -> Column:
    divisor = F.when(F.col(actual) == 0, 1.0).otherwise(F.col(actual))
    return F.abs((F.col(actual) - F.col(pred)) / divisor) * 100


def forecast_errors(df: DataFrame, actual="y", pred="yhat", series: Names = ()) -> DataFrame:
    """Root mean squared error and mean absolute percent error (a zero actual divides by 1)."""
    return df.groupBy(*series).agg(
        F.sqrt(F.avg(F.pow(F.col(actual) - F.col(pred), 2))).alias("rmse"),
        F.avg(_relative_error(actual, pred)).alias("mape"),
    )


def align_forecasts(actual: DataFrame, *models: DataFrame, series: Names = ()) -> DataFrame:
    """Actual weeks with the predictions of each model."""
    aligned = actual
    for model in models:
        aligned = aligned.join(model, [*series, "ds"], "left")
    return aligned


def backtest_frame(df: DataFrame, preds: Names, n=4, series: Names = ()) -> DataFrame:
    """Absolute and percent error of each prediction over the last ``n`` weeks, labelled ``Sem 1..n``."""
    recent = _from_end(df, series).filter(F.col("_back") <= n)
    label = F.concat(F.lit("Sem "), F.row_number().over(_part(series).orderBy("ds")).cast("string"))
    errors = {}
    for p in preds:
        errors[f"{p}_mape"] = _relative_error("y", p)
        errors[f"{p}_rmse"] = F.abs(F.col("y") - F.col(p))
    return recent.withColumns({**errors, "week_label": label}).drop("_back")


def pick_winner(errors: DataFrame, a: str, b: str, names: tuple[str, str], tie="Empate") -> DataFrame:
    """Name of the model with the lower percent error; ``a`` and ``b`` are its columns."""
    return errors.withColumn(
        "winner", F.when(F.col(a) < F.col(b), names[0]).when(F.col(b) < F.col(a), names[1]).otherwise(tie)
    )


def model_table(**errors: DataFrame) -> DataFrame:
    """Error tables of several models on top of each other."""
    stacked = None
    for name, table in errors.items():
        named = table.select(F.lit(name).alias("model"), "*")
        stacked = named if stacked is None else stacked.unionByName(named)
    return stacked


def revenue_summary(weeks: DataFrame, future: DataFrame, pred="ma_pred", series: Names = ()) -> DataFrame:
    """Total, mean week, last week and the next forecast per series."""
    past = weeks.groupBy(*series).agg(
        F.sum("y").alias("total"), F.avg("y").alias("mean_week"), F.max_by("y", "ds").alias("last_week")
    )
    ahead = future.groupBy(*series).agg(F.min_by(pred, "ds").alias("next_week"))
    if series:
        return past.join(ahead, list(series))
    return past.withColumn("next_week", ahead.scalar())
