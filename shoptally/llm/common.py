"""Shared by the operators of this folder: words, tables, column guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"

# Stands for a missing document id in comparisons: it orders after every real one.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` parts at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_array(text: Column) -> Column:
    """The words of a text as an array column; empty for null and blank texts."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS + "+")
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def keyed(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """Columns ``doc_id`` and ``text`` alone, so that no further column of the input can clash."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def part_count(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
