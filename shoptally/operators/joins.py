"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.01


def plan_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of a plan; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    return 0 <= plan_bytes(df) <= broadcast_limit(df)


def heavy_keys(df: DataFrame, key: str, share=HEAVY_SHARE) -> list:
    """Keys holding more than ``share`` of the rows. Runs a job; at most ``1/share`` keys come back."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    heavy = counts.filter(F.col(key).isNotNull() & (F.col("_n") > F.lit(total * share)))
    return [row[0] for row in heavy.select(key).collect()]


def join_dimension(facts: DataFrame, dim: DataFrame, key: str | Sequence[str], how="left", share=HEAVY_SHARE, heavy: Sequence | None = None) -> DataFrame:
    """Join facts with a dimension that has one row per ``key`` (a column or several).

    A dimension under the session's broadcast threshold is broadcast. Beyond it the few heavy keys (at most
    ``1/share``) are joined with a broadcast of just their dimension rows, the other rows by a shuffle, and
    rows without a key skip the join. Heavy keys that the caller knows (with several columns: a row of values for each) need no
    job to find them; with several columns they must be given.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) > 1 and heavy is None:
        raise ValueError("heavy keys of several columns must be given")
    if fits_broadcast(dim):
        return facts.join(F.broadcast(dim), keys, how)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = facts.filter(whole)
    if heavy is None:
        heavy = heavy_keys(keyed, keys[0], share)
    if len(keys) == 1:
        hot = F.col(keys[0]).isin(list(heavy))
    else:
        same = [reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(keys, values, strict=True)]) for values in heavy]
        hot = reduce(lambda a, b: a | b, same, F.lit(False))
    joined = keyed.filter(~hot).join(dim, keys, how)
    if heavy:
        joined = keyed.filter(hot).join(F.broadcast(dim.filter(hot)), keys, how).unionByName(joined)
    if how == "left":
        added = {f.name: F.lit(None).cast(f.dataType) for f in dim.schema.fields if f.name not in keys}
        joined = joined.unionByName(facts.filter(~whole).withColumns(added))
    return joined
