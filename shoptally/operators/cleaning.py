"""Cleaning of the three raw tables and the repair of ambiguous dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.dates import parse_date, two_readings
from shoptally.functions.numbers import to_number
from shoptally.functions.text import payment_label
from shoptally.operators.ranks import split_points, with_bucket
from shoptally.schemas import require
from shoptally.session import checkpointed

NO_DESCRIPTION = "SIN DESCRIPCION"


def drop_ghost_columns(df: DataFrame, prefix="Unnamed") -> DataFrame:
    """Without the nameless columns that spreadsheet exports add."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix)])


def _iso(date) -> Column:
    return F.date_format(parse_date(date), "yyyy-MM-dd")


def clean_sales(df: DataFrame) -> DataFrame:
    """Sales header: rows need an id and a total; ISO dates, upper-case payment, numeric total."""
    require(df, "id", "date", "pay", "total")
    return drop_ghost_columns(df).dropna(subset=["id", "total"]).withColumns(
        {"date": _iso("date"), "pay": payment_label("pay"), "total": to_number("total", 0.0)}
    )


def clean_lines(df: DataFrame) -> DataFrame:
    """Sale lines: rows need a ticket id; trimmed texts, ISO dates, non-negative numbers."""
    require(df, "id", "description")
    numeric = [c for c in ("qty", "unit_price", "subtotal") if c in df.columns]
    cleaned = drop_ghost_columns(df).dropna(subset=["id"]).withColumns(
        {
            "id": F.trim("id"),
            "description": F.trim(F.coalesce("description", F.lit(NO_DESCRIPTION))),
            **{c: F.greatest(to_number(c, 0.0), F.lit(0.0)) for c in numeric},
        }
    )
    return cleaned.withColumn("date", _iso("date")) if "date" in df.columns else cleaned


def clean_inventory(df: DataFrame, dept_defaults: dict[str, int] | None = None, default=2) -> DataFrame:
    """Inventory: numeric prices, missing reorder points by department, negative stock flagged and set to 0."""
    require(df, "id", "dept", "min_stock", "stock")
    dept_defaults = {"UTILES": 5} if dept_defaults is None else dept_defaults
    missing = F.lit(default)
    for dept, value in dept_defaults.items():
        missing = F.when(F.upper(F.trim("dept")) == dept, F.lit(value)).otherwise(missing)
    stock = to_number("stock", kind="int")
    prices = [c for c in ("cost", "price") if c in df.columns]
    return drop_ghost_columns(df).dropna(subset=["id"]).withColumns(
        {
            **{c: to_number(c, 0.0) for c in prices},
            "min_stock": F.coalesce(to_number("min_stock", kind="int"), missing),
            "stock": F.greatest(F.coalesce(stock, F.lit(0)), F.lit(0)),
            "negative_stock": F.coalesce(stock < 0, F.lit(False)),
        }
    )


def disambiguate_dates(df: DataFrame, order: str, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Add ``date_fixed``: the reading of each date text that keeps the series in time order.

    With readings a <= b and the previous choice p, the later reading b is taken when a < p <= b, otherwise a.
    So a row either decides alone (both outcomes of the row before lead to the same choice), repeats the choice
    before it, or flips it, and the chain resolves to *last self-decided row, flipped once per flipping row
    since*: running windows over slices of the series instead of a row-by-row loop. ``order`` must be unique
    within a series. Rows without a readable date stay null and do not move the chain.
    """
    keys = list(series)
    d1, d2 = two_readings(date)
    read = df.withColumns({"_a": F.least(d1, d2), "_b": F.greatest(d1, d2)})
    rows = checkpointed(read.select(*keys, order, "_a", "_b").filter(F.col("_a").isNotNull()))
    rows = with_bucket(rows, order, split_points(rows, order))

    part = W.partitionBy(*keys, "bucket").orderBy(order)
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    # Readings of the last row of the slice before, one row per slice.
    ends = rows.groupBy(*keys, "bucket").agg(F.max_by(F.struct("_a", "_b"), order).alias("_end"))
    ends = ends.select(*keys, "bucket", F.lag("_end").over(group.orderBy("bucket")).alias("_slice_before"))
    linked = _join_slices(rows, ends, keys)
    before = F.coalesce(F.lag(F.struct("_a", "_b")).over(part), F.col("_slice_before"))
    linked = linked.withColumn("_before", before)

    def later(previous: Column) -> Column:
        return (F.col("_a") < previous) & (previous <= F.col("_b"))

    if_a, if_b = later(F.col("_before._a")), later(F.col("_before._b"))
    linked = linked.withColumns(
        {
            "_own": F.when(F.col("_before").isNull(), False).when(if_a == if_b, if_a),
            "_flip": F.when(F.col("_before").isNotNull() & if_a & ~if_b, 1).otherwise(0),
        }
    )
    # State after each row: the last own decision and the number of flips so far, first inside the slice.
    so_far = part.rowsBetween(W.unboundedPreceding, 0)
    marked = linked.withColumn("_flips", F.sum("_flip").over(so_far))
    state = F.when(F.col("_own").isNotNull(), F.struct(F.col("_own"), F.col("_flips")))
    marked = marked.withColumn("_state", F.last(state, ignorenulls=True).over(so_far))

    slices = marked.groupBy(*keys, "bucket").agg(
        F.max("_flips").alias("_slice_flips"), F.max_by("_state", order).alias("_slice_state")
    )
    lower = group.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.withColumn("_flips_before", F.coalesce(F.sum("_slice_flips").over(lower), F.lit(0)))
    absolute = F.when(
        F.col("_slice_state").isNotNull(),
        F.struct(
            F.col("_slice_state._own").alias("_own"),
            (F.col("_slice_state._flips") + F.col("_flips_before")).alias("_flips"),
        ),
    )
    slices = slices.withColumn("_absolute", absolute).select(
        *keys, "bucket", "_flips_before", F.last("_absolute", ignorenulls=True).over(lower).alias("_carried")
    )
    solved = _join_slices(marked, slices, keys)
    own = F.coalesce(F.col("_state._own"), F.col("_carried._own"))
    start = F.coalesce(F.col("_state._flips") + F.col("_flips_before"), F.col("_carried._flips"))
    flips = F.col("_flips") + F.col("_flips_before") - start
    choose_later = own != (flips % 2 == 1)
    solved = solved.select(*keys, order, F.when(choose_later, F.col("_b")).otherwise(F.col("_a")).alias("date_fixed"))

    on = F.col(f"l.{order}") == F.col(f"r.{order}")
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return (
        df.alias("l")
        .join(solved.alias("r"), on, "left")
        .select(*[F.col(f"l.{c}") for c in df.columns], F.col("r.date_fixed"))
    )


def _join_slices(rows: DataFrame, slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their slice; the slice side has one row per (series, bucket)."""
    renamed = slices.withColumnsRenamed({k: f"_s_{k}" for k in [*keys, "bucket"]})
    on = F.col("bucket") == F.col("_s_bucket")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return rows.join(renamed, on).drop(*[f"_s_{k}" for k in [*keys, "bucket"]])
