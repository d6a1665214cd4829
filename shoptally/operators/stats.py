"""Descriptive and bivariate statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.operators.joins import join_dimension
from shoptally.operators.ranks import average_ranks, counted_values, melt, modes, ordered_totals, quantiles
from shoptally.session import checkpointed

MAX_GRID = 512


def univariate_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, median, lowest mode, sample std, IQR, CV %, population skew and excess kurtosis per column."""
    long = melt(df, cols)
    moments = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.skewness("value").alias("skew"),
        F.kurtosis("value").alias("kurtosis"),
    )
    cuts = quantiles(df, cols, (0.25, 0.5, 0.75)).drop("n")
    return (
        moments.join(F.broadcast(cuts), "column")
        .join(F.broadcast(modes(df, cols)), "column")
        .select(
            "column",
            "n",
            "mean",
            F.get("q", F.lit(1)).alias("median"),
            "mode",
            "std",
            (F.get("q", F.lit(2)) - F.get("q", F.lit(0))).alias("iqr"),
            F.when(F.col("mean") != 0, F.try_divide("std", "mean") * 100).alias("cv_pct"),
            "skew",
            "kurtosis",
        )
    )


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, minimum, exact quartiles and maximum per column."""
    moments = melt(df, cols).groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    cuts = quantiles(df, cols, (0.25, 0.5, 0.75)).drop("n")
    return moments.join(F.broadcast(cuts), "column").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("q1", "median", "q3"))],
        "max",
    )


def grouped_summary(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Mean, median and sample std per group and column, rounded to 2 digits."""
    moments = melt(df, cols, [key]).groupBy(key, "column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    middle = quantiles(df, cols, (0.5,), [key])
    return moments.join(middle, [key, "column"]).select(
        key,
        "column",
        F.round("mean", 2).alias("mean"),
        F.round(F.get("q", F.lit(0)), 2).alias("median"),
        F.round("std", 2).alias("std"),
    )


def class_mix(df: DataFrame, group: str, label: str) -> DataFrame:
    """Count per (group, class) and the share of the class within the group."""
    counts = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(group)))


def daily_by_payment(sales: DataFrame, labels=("EFECTIVO", "YAPE")) -> DataFrame:
    """Revenue per day with one column per payment label, 0 when absent."""
    pivoted = sales.groupBy("day").pivot("pay", list(labels)).agg(F.sum("total"))
    return pivoted.fillna(0.0, subset=list(labels))


def weekday_estimate(daily: DataFrame, labels=("EFECTIVO", "YAPE")) -> DataFrame:
    """Mean daily revenue per weekday (Monday 0) and payment label, with the number of observed days."""
    return daily.groupBy(F.weekday("day").alias("weekday")).agg(
        *[F.round(F.avg(p), 2).alias(f"{p.lower()}_estimate") for p in labels], F.count(F.lit(1)).alias("n_days")
    )


def estimate_for(estimates: DataFrame, day: str, labels=("EFECTIVO", "YAPE")) -> DataFrame:
    """Estimate for a weekday name (English or Spanish) or a date, with the total over the labels."""
    # Weekday names, Monday first.
    names = (
        ("monday", "lunes"),
        ("tuesday", "martes"),
        ("wednesday", "miércoles"),
        ("thursday", "jueves"),
        ("friday", "viernes"),
        ("saturday", "sábado"),
        ("sunday", "domingo"),
    )
    by_name = [i for i, forms in enumerate(names) if day.strip().lower() in forms]
    wanted = F.lit(by_name[0]) if by_name else F.weekday(F.lit(day).cast("date"))
    total = sum((F.col(f"{p.lower()}_estimate") for p in labels), F.lit(0.0))
    return estimates.filter(F.col("weekday") == wanted).withColumn("total_estimate", total)


def histogram(df: DataFrame, col: str, bins=10, integer=False) -> DataFrame:
    """Equal-width bins (the last one closed) or one bin per integer, empty bins included."""
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    if integer:
        ends = values.agg(F.struct(F.floor(F.min("v")).alias("low"), F.floor(F.max("v")).alias("high")).alias("e"))
        frame = ends.select(F.explode(F.sequence("e.low", "e.high")).alias("bin"))
        counts = values.groupBy(F.floor("v").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        return frame.join(counts, "bin", "left").select(
            "bin",
            F.col("bin").cast("double").alias("lower"),
            (F.col("bin") + 1).cast("double").alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    ends = values.agg(
        F.struct(F.min("v").alias("low"), ((F.max("v") - F.min("v")) / F.lit(bins)).alias("width")).alias("e")
    )
    slot = F.floor(F.try_divide(F.col("v") - F.col("e.low"), F.col("e.width"))).cast("long")
    placed = values.withColumn("e", ends.scalar()).select(
        F.least(F.coalesce(slot, F.lit(0)), F.lit(bins - 1)).cast("long").alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = ends.select("e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("e.low") + F.col("bin") * F.col("e.width")).alias("lower"),
        (F.col("e.low") + (F.col("bin") + 1) * F.col("e.width")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def kde(df: DataFrame, col: str, points=200, bandwidth: float | None = None, cut=3.0) -> DataFrame:
    """Gaussian density estimate on an even grid that reaches ``cut`` bandwidths past the data.

    Copies of a value are counted first; each distinct value then adds to every grid point inside the task,
    so only the grid sums are shuffled.
    """
    if points > MAX_GRID:
        raise ValueError(f"points must be at most {MAX_GRID}")
    counts = counted_values(df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull()), "v")
    facts = df.agg(
        F.count(col).alias("n"),
        F.stddev_samp(col).alias("std"),
        F.min(col).cast("double").alias("low"),
        F.max(col).cast("double").alias("high"),
    )
    width = F.lit(float(bandwidth)) if bandwidth else F.col("std") * F.pow(F.col("n"), F.lit(-0.2))
    facts = facts.select(
        F.struct("n", width.alias("bw"), (F.col("low") - cut * width).alias("start"),
                 ((F.col("high") - F.col("low") + 2 * cut * width) / (points - 1)).alias("step")).alias("f")
    )
    spread = counts.withColumn("f", facts.scalar()).select(
        "v", "n", "f", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    x = F.col("f.start") + F.col("point") * F.col("f.step")
    weight = F.col("n") * F.exp(-0.5 * F.pow((x - F.col("v")) / F.col("f.bw"), 2))
    sums = spread.groupBy("point", "f").agg(F.sum(weight).alias("s"))
    scale = F.col("f.n") * F.col("f.bw") * F.lit((2 * 3.141592653589793) ** 0.5)
    return sums.select("point", x.alias("x"), (F.col("s") / scale).alias("density"))


def boxplot_stats(df: DataFrame, col: str, by: str | None = None, k=1.5) -> DataFrame:
    """Quartiles, whiskers, number of fliers and mean, overall or per group."""
    group = by or "_all"
    source = df if by else df.withColumn(group, F.lit("all"))
    source = source.filter(F.col(group).isNotNull())
    cuts = quantiles(source, [col], (0.25, 0.5, 0.75), [group]).select(
        group, *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    )
    reach = (F.col("q3") - F.col("q1")) * k
    cuts = cuts.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    counts = counted_values(melt(source, [col], [group]), "value", [group])
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    result = (
        join_dimension(counts, cuts, group, "inner")
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_fliers"),
            (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        )
    )
    return result if by else result.drop(group)


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def _pairs_to_long(corr: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("r")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"_{i}").alias("r")))
    return corr.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations in long form, all pairs from one pass."""
    pairs = list(combinations_with_replacement(cols, 2))
    return _pairs_to_long(df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]), pairs)


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman correlations (average ranks for ties) in long form, over rows without nulls in ``cols``.

    Equal rows are counted first. Their values go into long form, meet their ranks in one join for all columns, and come back
    to one row per distinct row. Mean ranks are known, so weighted sums of centred ranks are all that is left.
    """
    numbers = df.select(*[(F.col(c).cast("double") + 0.0).alias(c) for c in cols]).dropna()
    distinct = checkpointed(numbers.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")))  # read for the ranks, the sums and the count
    ranks = average_ranks(distinct, cols, "_n").select(_value_key("column", "value"), "average_rank")
    places = F.array(*[F.struct(F.lit(i).alias("i"), _value_key(F.lit(c), c)) for i, c in enumerate(cols)])
    long = distinct.select(*cols, "_n", F.explode(places).alias("p")).select(*cols, "_n", "p.i", "p._key")
    ranked = join_dimension(long, checkpointed(ranks), "_key", "inner")
    wide = ranked.groupBy(*cols, "_n").agg(*[F.max(F.when(F.col("i") == i, F.col("average_rank"))).alias(f"_r{i}") for i in range(len(cols))])
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    middle = (distinct.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar() + 1) / F.lit(2.0)
    centred = wide.select("_n", *[(F.col(f"_r{i}") - middle).alias(f"_r{i}") for i in range(len(cols))])
    sums = centred.agg(*[F.sum(F.col("_n") * F.col(f"_r{a}") * F.col(f"_r{b}")).alias(f"_s{a}_{b}") for a, b in pairs])
    corr = [
        F.try_divide(F.col(f"_s{a}_{b}"), F.sqrt(F.col(f"_s{a}_{a}")) * F.sqrt(F.col(f"_s{b}_{b}"))).alias(f"_{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    return _pairs_to_long(sums.select(*corr), [(cols[a], cols[b]) for a, b in pairs])


def _value_key(column, value):
    """Text that names a value of a column; the decimal form of a double is exact."""
    return F.concat_ws(":", F.col(value).cast("string"), column).alias("_key")


def cluster_profile(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each feature, size and percent of all rows per cluster."""
    total = df.agg(F.count(F.lit(1)))
    return df.groupBy(label).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols],
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) * 100.0 / total.scalar()).alias("pct"),
    )


def auc_by_rank(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve from counts per distinct score (ties count half)."""
    positive = (F.col(label) == 1).cast("long")
    counts = counted_values(df, score, weights={"pos": positive, "neg": 1 - positive})
    placed = ordered_totals(counts, score, ("pos", "neg"))
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return placed.agg((wins / (F.max("pos_total") * F.max("neg_total"))).alias("auc"))
