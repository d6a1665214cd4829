"""Ordered totals, ranks and exact quantiles without a global sort in one task.

Everything here starts from *counted values* (one row per distinct value), so copies of one value
cost one row however often it occurs. The counted values are cut into ordered buckets at split
points, running totals are taken inside each bucket, and the totals of the lower buckets are added.
The split points come from the values with the smallest hashes: a balanced sample of distinct
values that does not depend on how the data is partitioned, so a re-run task sees the same buckets.
They are fetched when the query is built (one row of at most ``MOST_BUCKETS`` values) and enter the plan as constants. Where
only some places are wanted, as for quantiles, only the buckets that hold them are sorted.
The counted values are checkpointed once, so what they are counted from is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.session import checkpointed

BUCKETS, MOST_BUCKETS = 256, 16_384  # powers of two
VALUES_PER_BUCKET = 100_000
SAMPLES_PER_BUCKET = 8


def bucket_number(rows: int) -> int:
    """Buckets for so many counted values, so that tasks grow in number with the data and not in size.

    At most ``MOST_BUCKETS``, whose split points are a constant of some 300 KB in the plan; 1.6 billion different values
    reach that.
    """
    buckets = BUCKETS
    while buckets * VALUES_PER_BUCKET < rows and buckets < MOST_BUCKETS:
        buckets *= 2
    return buckets


def counted_values(df: DataFrame, value, by: Sequence[str] = (), weights: dict[str, Column] | None = None) -> DataFrame:
    """One row per (``by``, ``value``) with its count ``n``, or with the given summed weights."""
    sums = [F.sum(w).alias(name) for name, w in weights.items()] if weights else [F.count(F.lit(1)).alias("n")]
    return df.groupBy(*by, value).agg(*sums)


def split_points(counts: DataFrame, value: str, buckets=BUCKETS) -> list:
    """Up to ``buckets - 1`` ordered split points, none when the whole table is no larger than the sample.

    Runs a job and returns one bounded row.
    """
    limit = buckets * SAMPLES_PER_BUCKET
    sample = (
        counts.filter(F.col(value).isNotNull())
        .select(F.col(value).alias("v"), F.xxhash64(value).alias("h"))
        .orderBy("h", "v")
        .limit(limit)
        .agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set("v")).alias("sorted"))
    )
    chosen = F.transform(
        F.sequence(F.lit(1), F.lit(buckets - 1)),
        lambda i: F.get("sorted", (i * F.size("sorted") / F.lit(buckets)).cast("int")),
    )
    picked = sample.select("rows", F.array_distinct(F.filter(chosen, lambda v: v.isNotNull())).alias("points")).first()
    return picked["points"] if picked["rows"] == limit else []


def with_bucket(counts: DataFrame, value: str, points: list, buckets=BUCKETS) -> DataFrame:
    """Add ``bucket``: the number of split points at or below the value."""
    if not points:
        return counts.withColumn("bucket", F.lit(0))
    kind = counts.schema[value].dataType.simpleString()
    splits = F.split(F.lit("\u0001".join(str(p) for p in points)), "\u0001").cast(f"array<{kind}>")
    steps = F.array(*[F.lit(buckets >> k) for k in range(1, buckets.bit_length())])
    position = F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: low + F.when(F.get(splits, low + step - 1) <= F.col(value), step).otherwise(0),
    )
    return counts.withColumn("bucket", position)


def ordered_totals(
    counts: DataFrame, value: str, weights: Sequence[str] = ("n",), by: Sequence[str] = (), buckets: int | None = None, probs: Sequence[float] = ()
) -> DataFrame:
    """Add ``<w>_before`` (weight of all lower values of the group) and ``<w>_total`` for each weight.

    ``counts`` must hold one row per (``by``, ``value``). A group of any size is spread over the buckets;
    the only frames without a spread hold at most one row per bucket of a group. With ``probs`` only the buckets come back that
    hold one of the places ``prob * (total - 1)``, rounded down or up, of the first weight.
    """
    counts = checkpointed(counts)  # read for the split points, the bucket sums and the result
    buckets = buckets or bucket_number(counts.count())
    points = split_points(counts, value, buckets)
    placed = with_bucket(counts, value, points, buckets)
    group = list(by)
    if not points:
        before = W.partitionBy(*group, "bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
        return placed.select(
            *counts.columns,
            *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{w}_before") for w in weights],
            *[F.sum(w).over(W.partitionBy(*group, "bucket")).alias(f"{w}_total") for w in weights],
        )
    sums = placed.groupBy(*group, "bucket").agg(*[F.sum(w).alias(f"_{w}") for w in weights])
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    lower = whole.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("bucket").alias("_bucket"),
        F.col(f"_{weights[0]}").alias("_here"),
        *[F.coalesce(F.sum(f"_{w}").over(lower), F.lit(0)).alias(f"_{w}_carried") for w in weights],
        *[F.sum(f"_{w}").over(whole).alias(f"{w}_total") for w in weights],
    )
    if probs:
        first = F.col(f"_{weights[0]}_carried")
        wanted = F.lit(False)
        for p in probs:
            place = (F.col(f"{weights[0]}_total") - 1) * F.lit(float(p))
            for at in (F.floor(place), F.ceil(place)):
                wanted = wanted | ((at >= first) & (at < first + F.col("_here")))
        carried = carried.filter(wanted)
    same = F.col("bucket") == F.col("_bucket")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    inside = W.partitionBy(*group, "bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    kept = placed.join(carried, same)
    local = kept.withColumns({f"_{w}_inside": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
    return local.select(
        *counts.columns,
        *[(F.col(f"_{w}_carried") + F.col(f"_{w}_inside")).alias(f"{w}_before") for w in weights],
        *[f"{w}_total" for w in weights],
    )


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), approx: int | None = None
) -> DataFrame:
    """Linear-interpolated quantiles, one row per (``by``, ``column``) with the array ``q`` in the order of ``probs``.

    Exact by default. ``approx`` gives the accuracy of Spark's bounded-memory sketch instead.
    """
    long = melt(df, cols, by)
    if approx:
        return long.groupBy(*by, "column").agg(
            F.percentile_approx("value", list(probs), approx).alias("q"), F.count("value").alias("n")
        )
    keys = [*by, "column"]
    placed = ordered_totals(counted_values(long, "value", keys), "value", by=keys, probs=probs)
    picks = []
    for i, p in enumerate(probs):
        place = (F.col("n_total") - 1) * F.lit(float(p))
        picks.append(F.max(F.when(F.col("n_before") <= F.floor(place), F.col("value"))).alias(f"_low{i}"))
        picks.append(F.max(F.when(F.col("n_before") <= F.ceil(place), F.col("value"))).alias(f"_high{i}"))
    picked = placed.groupBy(*keys).agg(F.max("n_total").alias("n"), *picks)
    parts = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        parts.append(low + (high - low) * (place - F.floor(place)))
    return picked.select(*keys, "n", F.array(*parts).alias("q"))


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per (``by``, ``column``), the lowest among ties."""
    keys = [*by, "column"]
    counts = counted_values(melt(df, cols, by), "value", keys)
    return counts.groupBy(*keys).agg(F.min(F.struct(-F.col("n"), F.col("value"))).getField("value").alias("mode"))


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (``by``, ``column``, ``value``) of numeric columns, nulls left out."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "column", "value").filter(F.col("value").isNotNull())


def average_ranks(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Distinct ``value`` of each ``column`` with its 1-based ``average_rank``; a row counts ``weight`` times."""
    times = {"n": F.col(weight)} if weight else None
    counts = counted_values(melt(df, cols, [weight] if weight else []), "value", ["column"], times)
    placed = ordered_totals(counts, "value", by=["column"])
    return placed.select("column", "value", (F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)).alias("average_rank"))


def positions(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows with unique ``key`` per group, plus their 0-based ``position`` by key and the group size ``size``."""
    counts = df.withColumn("n", F.lit(1).cast("long"))
    placed = ordered_totals(counts, key, by=by)
    return placed.withColumnsRenamed({"n_before": "position", "n_total": "size"}).drop("n")
