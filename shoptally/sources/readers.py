"""Readers of delimited exports with preamble lines, ghost columns and a byte-order mark.

All columns arrive as text under our names; the clean operators give them types.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptally.functions.text import payment_label
from shoptally.operators.joins import join_dimension
from shoptally.schemas import INVENTORY_COLUMNS, LINES_COLUMNS, SALES_COLUMNS
from shoptally.session import checkpointed
from shoptally.sources.records import Records


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _fields(line, sep: str):
    """Fields of a header line: without quotes, blanks and byte-order mark."""
    return F.transform(F.split(F.regexp_replace(line, "^\ufeff", ""), re.escape(sep)), lambda f: F.trim(F.regexp_replace(f, '"', "")))


def _mentions(fields: Sequence[str]):
    """Whether a line, without its quotes, holds all these texts: what a header must, before it is split into fields."""
    bare = F.translate("value", '"', "")
    held = F.lit(True)
    for field in fields:
        held = held & bare.contains(field)
    return held


def _header(spark: SparkSession, path: str, names: dict[str, str], sep: str) -> list[str] | None:
    """Fields of the first line, anywhere in the file, that holds the first two of ``names``."""
    first, second = list(names)[:2]
    lines = spark.read.text(path).filter(_mentions([first, second])).select(_fields("value", sep).alias("f"))
    found = lines.filter(F.array_contains("f", first) & F.array_contains("f", second)).limit(1).collect()
    return list(found[0].f) if found else None


def sniff_delimiter(spark: SparkSession, path: str, candidates: Sequence[str] = (";", ","), names: dict[str, str] = INVENTORY_COLUMNS) -> str:
    """First candidate that splits a line into the header; without a header, the first that splits any line."""
    for sep in candidates:
        if _header(spark, path, names, sep):
            return sep
    for sep in candidates:
        filled = F.size(F.filter(_fields("value", sep), lambda f: f != ""))
        if spark.read.text(path).filter(filled > 1).limit(1).collect():
            return sep
    return candidates[0]


def _read(spark: SparkSession, path: str, names: dict[str, str], sep: str) -> DataFrame:
    """Rows below the header as text columns; lines above it, repeated headers and ghost columns are left out.

    The header is found by its place in each file, however far down. Quoted fields may hold line breaks, and a file is still
    read by many tasks (``records``). A file of the path without a header keeps all its rows; blank lines are no rows.
    """
    first, second = list(names)[:2]
    header = _header(spark, path, names, sep)
    if header is None:
        raise ValueError(f"no header with the columns {first} and {second} in {path}")
    columns = [names.get(h, f"Unnamed: {i}" if not h else h) for i, h in enumerate(header)]
    wanted = list(dict.fromkeys(c for c in columns if not c.startswith("Unnamed")))
    schema = ", ".join(f"`c{i}` string" for i in range(len(columns)))
    options = {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "multiLine": "true"}
    found = Records(spark, path, sep, _mentions([second]) & (_fields("value", sep) == F.array(*[F.lit(h) for h in header])))
    is_header = F.lit(True)
    for i, h in sorted(enumerate(header), key=lambda field: -len(field[1])):  # an empty name decides little
        is_header = is_header & (F.trim(F.coalesce(F.regexp_replace(F.col(f"r.c{i}"), '"', ""), F.lit(""))) == h)

    def parsed(rows: DataFrame) -> DataFrame:
        filled = rows.filter(F.trim("record") != "")
        return filled.withColumn("r", F.from_csv("record", schema, options)).withColumn("_is_header", is_header)

    ordered = parsed(found.ordered)
    heads = ordered.filter("_is_header").groupBy("_file").agg(F.min(F.struct("_block", "_row")).alias("_at"))
    heads = checkpointed(heads.select("_file", F.col("_at._block").alias("_top"), F.col("_at._row").alias("_top_row")))
    if heads.isEmpty():
        raise ValueError(f"the header of {path} lies inside a quoted field")
    above = (F.col("_block") < F.col("_top")) | ((F.col("_block") == F.col("_top")) & (F.col("_row") < F.col("_top_row")))
    below = join_dimension(ordered, heads, "_file").filter(~F.coalesce(above, F.lit(False)))
    rows = below.select("r", "_is_header").unionByName(parsed(found.plain(heads.select("_file", "_top"))).select("r", "_is_header"))
    return rows.filter(~F.col("_is_header")).select(*[F.col(f"r.c{columns.index(c)}").alias(c) for c in wanted])


def read_sales(spark: SparkSession, path: str, sep=";") -> DataFrame:
    """Sales header; rows without an id (all-delimiter lines) are dropped, the payment label is capitalised."""
    raw = _read(spark, path, SALES_COLUMNS, sep).filter(F.col("id").isNotNull())
    return raw.withColumn("pay", payment_label("pay", "capital"))


def read_lines(spark: SparkSession, path: str, sep=";") -> DataFrame:
    """Sale lines with a ticket id."""
    return _read(spark, path, LINES_COLUMNS, sep).filter(F.col("id").isNotNull()).withColumn("id", F.trim("id"))


def read_inventory(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Inventory; the delimiter is found when not given."""
    return _read(spark, path, INVENTORY_COLUMNS, sep or sniff_delimiter(spark, path)).filter(F.col("id").isNotNull())


# File names of the raw exports, in the order they are tried.
RAW_FILES = {
    "sales": ("ventas.csv",),
    "lines": ("detalle_ventas.csv", "detalle-ventas.csv"),
    "inventory": ("inventario.csv", "Inventario.csv"),
}
_READERS = {"sales": read_sales, "lines": read_lines, "inventory": read_inventory}


def load_table(spark: SparkSession, base: str, name: str, prefer_clean=True) -> DataFrame:
    """A cleaned table under ``base/clean`` when there is one, else the raw export under ``base/raw``."""
    if name not in RAW_FILES:
        raise ValueError(f"unknown table {name}")
    clean = f"{base}/clean/{name}"
    if prefer_clean and path_exists(spark, clean):
        return spark.read.parquet(clean)
    for file in RAW_FILES[name]:
        if path_exists(spark, f"{base}/raw/{file}"):
            return _READERS[name](spark, f"{base}/raw/{file}")
    raise FileNotFoundError(f"no {name} under {base}")
