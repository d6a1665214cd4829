"""Transaction ledger as a change log: unique inserts, last-wins updates, deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.operators.joins import join_dimension


def apply_changes(base: DataFrame | None, log: DataFrame, key="key", seq="seq", op="op") -> DataFrame:
    """Current rows after a change log, with ``inserted_at`` (seq of the insert).

    Per key: the last delete clears everything before it, the first insert after it holds (later ones are refused),
    and each value is that of the last update after the insert that does not leave it null. An update without a row does
    nothing. Rows of ``base`` count as inserts before the log. Each step is one aggregate per key, so a key
    with a large share of the log is reduced before any shuffle.
    """
    values = [c for c in log.columns if c not in (key, seq, op)]
    changes = log
    if base is not None:
        start = F.lit(-(2**63)).cast("long")
        changes = log.unionByName(base.select(key, *values, start.alias(seq), F.lit("insert").alias(op)))

    deletes = changes.filter(F.col(op) == "delete").groupBy(key).agg(F.max(seq).alias("_deleted"))
    alive = join_dimension(changes.filter(F.col(op) != "delete"), deletes, key, "left")
    alive = alive.filter(F.col("_deleted").isNull() | (F.col(seq) > F.col("_deleted"))).drop("_deleted")

    first = F.min(F.struct(F.col(seq).alias("_at"), *[F.col(v).alias(f"_i_{v}") for v in values])).alias("_insert")
    inserts = alive.filter(F.col(op) == "insert").groupBy(key).agg(first).select(key, "_insert.*")
    updates = join_dimension(alive.filter(F.col(op) == "update"), inserts.select(key, "_at"), key, "inner")
    updates = updates.filter(F.col(seq) > F.col("_at"))
    last = [
        F.max(F.when(F.col(v).isNotNull(), F.struct(F.col(seq), F.col(v)))).getField(v).alias(f"_u_{v}") for v in values
    ]
    updates = updates.groupBy(key).agg(*last)
    return inserts.join(updates, key, "left").select(
        key, F.col("_at").alias("inserted_at"), *[F.coalesce(f"_u_{v}", f"_i_{v}").alias(v) for v in values]
    )


def ledger_latest(df: DataFrame, n: int | None = None, order="inserted_at") -> DataFrame:
    """Rows newest first, all or the first ``n``."""
    listed = df.orderBy(F.desc(order))
    return listed if n is None else listed.limit(n)


def ledger_kpis(df: DataFrame, total="total", pay="pay", label="YAPE") -> DataFrame:
    """Rows, revenue, mean and percent paid with ``label``."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(total).alias("revenue"),
        F.avg(total).alias("mean"),
        (F.avg(F.coalesce((F.col(pay) == label).cast("double"), F.lit(0.0))) * 100).alias("label_pct"),
    )
