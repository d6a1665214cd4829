"""Records of delimited text whose quoted fields may hold line breaks, while a file is read by many tasks.

A line maps the state before it (inside a quoted field or not) to the state after it. These maps are composed along the
lines of a split, then along the splits of a file (one row per split), so every line learns its state without reading the
file in one task. Splits in which no line leaves a quote open need no order of lines: their lines are records as they are.
Only the other splits, those entered inside a quoted field, and those that hold a header are shuffled, by split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.operators.joins import fits_broadcast
from shoptally.session import checkpointed

UNQUOTED, INSIDE, CLOSED = 0, 1, 2
SPLIT = ["_file", "_block"]


def _open_after(value: Column, sep: str, start: int) -> Column:
    """Whether a quoted field is open behind a line that starts in the state ``start``.

    A quote opens a field only at its start; elsewhere in an unquoted field it is text. A doubled quote is text, too.
    """

    def at_quote(state: Column, before: Column) -> Column:
        opens = before.endswith(sep) | ((state == CLOSED) & (before == ""))
        return F.when(state == INSIDE, CLOSED).when(opens, INSIDE).otherwise(UNQUOTED)

    parts = F.split(value, '"')
    state = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), F.lit(start), at_quote)
    return F.when(value.contains('"'), state == INSIDE).otherwise(start == INSIDE)


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Lines with their split, their order in it, and the state after them for both states before (``_f0``, ``_f1``)."""
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        F.regexp_replace("value", "^﻿", "").alias("value"),
    )
    value = F.col("value")
    return text.withColumns({"_f0": _open_after(value, sep, CLOSED).cast("int"), "_f1": _open_after(value, sep, INSIDE).cast("int")})


def with_entry(df: DataFrame, by, order: str) -> DataFrame:
    """Add ``_s0`` and ``_s1``: the state before each row when its group is entered in state 0 or 1.

    The last row before with a fixed outcome sets the state; rows since that swap it are counted.
    """
    so_far = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    above = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    swap = ((F.col("_f0") == 1) & (F.col("_f1") == 0)).cast("int")
    counted = df.withColumn("_swaps", F.sum(swap).over(so_far))
    fixed = F.when(F.col("_f0") == F.col("_f1"), F.struct(F.col("_f0").alias("v"), F.col("_swaps").alias("s")))
    placed = counted.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(above))
    since = F.col("_swaps") - swap - F.coalesce(F.col("_fixed.s"), F.lit(0))
    states = {f"_s{s}": F.pmod(F.coalesce(F.col("_fixed.v"), F.lit(s)) + since, F.lit(2)) for s in (0, 1)}
    return placed.withColumns(states).drop("_swaps", "_fixed")


def _after(state: Column) -> Column:
    return F.when(state == 1, F.col("_f1")).otherwise(F.col("_f0"))


def _only(lines: DataFrame, splits: DataFrame, how: str) -> DataFrame:
    splits = splits.select(*SPLIT)
    return lines.join(F.broadcast(splits) if fits_broadcast(splits) else splits, SPLIT, how)


class Records:
    """Records of the files under a path.

    ``ordered`` are those of the splits whose line order is known: ``(_file, _block, _row, record)``; all records that match
    ``is_head`` (an expression over ``value``) are among them. ``plain(first)`` are the records of all other splits.
    A line break inside a quoted field comes back as ``\\n``. A quoted field that is never closed up to the end of its file
    does not swallow the file: its lines are records of their own.
    """

    def __init__(self, spark: SparkSession, path: str, sep: str, is_head: Column):
        self._lines = _lines(spark, path, sep)
        splits = checkpointed(
            self._lines.groupBy(*SPLIT).agg(
                F.max("_f0").alias("_opens"), F.min("_f1").alias("_f1"), F.max(is_head.cast("int")).alias("_head")
            )
        )
        noisy = checkpointed(with_entry(_only(self._lines, splits.filter("_opens = 1 OR _head = 1"), "left_semi"), SPLIT, "_row"))
        ends = noisy.groupBy(*SPLIT).agg(
            F.max_by(_after(F.col("_s0")), "_row").alias("_e0"), F.max_by(_after(F.col("_s1")), "_row").alias("_e1")
        )
        chain = splits.join(ends, SPLIT, "left").select(
            *SPLIT,
            F.col("_e0").isNotNull().alias("_known"),
            F.coalesce("_e0", F.lit(0)).alias("_f0"),
            F.coalesce("_e1", "_f1").alias("_f1"),
        )
        self._splits = checkpointed(
            with_entry(chain, ["_file"], "_block").select(*SPLIT, "_known", F.col("_s0").alias("_entry"), _after(F.col("_s0")).alias("_exit"))
        )
        entered = self._splits.filter("NOT _known AND _entry = 1")
        if not entered.isEmpty():  # splits that begin inside a quoted field and open none themselves
            noisy = noisy.unionByName(with_entry(_only(self._lines, entered, "left_semi"), SPLIT, "_row"))
        self.ordered = checkpointed(self._joined(noisy))

    def _joined(self, noisy: DataFrame) -> DataFrame:
        """One row per record of ``noisy`` lines; only records of several lines are shuffled."""
        inclusive = W.partitionBy(*SPLIT).orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
        state = F.when(F.col("_entry") == 1, F.col("_s1")).otherwise(F.col("_s0"))
        here = F.struct(F.col("_block").alias("block"), F.col("_row").alias("row"))
        lines = checkpointed(
            noisy.join(self._splits.select(*SPLIT, "_entry"), SPLIT)
            .withColumn("_state", state)
            .withColumn("_first", F.last(F.when(F.col("_state") == 0, here), ignorenulls=True).over(inclusive))
        )
        whole = (F.col("_state") == 0) & (F.col("_f0") == 0)
        single = lines.filter(whole).select(*SPLIT, "_row", F.col("value").alias("record"))
        # The record that is open at the end of a split, and so at the start of the next one: one row per split.
        last = lines.groupBy(*SPLIT).agg(F.max("_first").alias("_last"))
        upto = W.partitionBy("_file").orderBy("_block")
        carried = self._splits.join(last, SPLIT, "left").select(
            *SPLIT,
            "_exit",
            F.last("_last", ignorenulls=True).over(upto.rowsBetween(W.unboundedPreceding, -1)).alias("_carried"),
            F.last("_last", ignorenulls=True).over(upto.rowsBetween(W.unboundedPreceding, 0)).alias("_last"),
        )
        unclosed = carried.groupBy("_file").agg(F.max_by(F.struct("_exit", "_last"), "_block").alias("end")).filter("end._exit = 1")
        unclosed = unclosed.select("_file", F.col("end._last").alias("_first"), F.lit(True).alias("_unclosed"))
        parts = lines.filter(~whole).join(carried.select(*SPLIT, "_carried"), SPLIT)
        parts = parts.withColumn("_first", F.coalesce("_first", "_carried")).join(unclosed, ["_file", "_first"], "left")
        alone = parts.filter(F.col("_unclosed")).select(*SPLIT, "_row", F.col("value").alias("record"))
        line = F.struct("_block", "_row", "value")
        pieces = parts.filter(F.col("_unclosed").isNull()).groupBy("_file", "_first").agg(F.array_sort(F.collect_list(line)).alias("l"))
        several = pieces.select(
            "_file",
            F.col("_first.block").alias("_block"),
            F.col("_first.row").alias("_row"),
            F.array_join("l.value", "\n").alias("record"),
        )
        return single.unionByName(several).unionByName(alone)

    def plain(self, tops: DataFrame) -> DataFrame:
        """``(record)`` of the other splits, without those that lie above the ``_top`` split of their file in ``tops (_file, _top)``."""
        left_out = self._splits.join(tops, "_file", "left").filter("_known OR _entry = 1 OR _block < _top")
        return _only(self._lines.select(*SPLIT, "value"), left_out, "left_anti").select(F.col("value").alias("record"))
