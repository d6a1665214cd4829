"""Removal of lines that many documents share.

Texts are exploded into normalised lines, a line is known by two 64-bit hashes of its key, and each hash is counted once
for each document that holds it. Positions of lines whose hash reaches the threshold go back to their document, where the
other lines are put together again in order. The shuffles carry hashes and positions; a text moves once, to meet the
positions it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import SPACES, keyed, table
from shoptally.session import checkpointed

MIN_CHARS = 1
MIN_DOCS = 10

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z alone lower-cased. Plain ``lower`` does that for strings of one byte a character, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def line_keys(lines: Column) -> Column:
    """Each line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. One step at a time, so that none is done twice."""
    return F.transform(F.transform(lines, lambda line: F.trim(line, F.lit(SPACES))), lower_ascii)


def split_lines(text: Column) -> Column:
    """Lines between ``\\n``; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashes(text: Column, min_chars: int) -> Column:
    """One struct of two hashes for each line, null for keys that are too short."""

    def hashed(key):
        both = F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g"))
        return F.when(F.length(key) >= min_chars, both)

    return F.transform(line_keys(split_lines(text)), hashed)


def _row_key() -> list[Column]:
    """Rows with one id and one text lose the same lines, so they may share a key; it is never null."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(F.lit(0), "doc_id", text).alias("k"), F.xxhash64(F.lit(1), "doc_id", text).alias("k2")]


def frequent_lines(docs: DataFrame, min_docs=MIN_DOCS, min_chars=MIN_CHARS) -> DataFrame:
    """Written table ``(h, g)`` of the line hashes that at least ``min_docs`` documents hold.

    A document counts once for a line, however often it repeats it. A first count takes rows of ``docs`` for documents; it is
    summed before the shuffle and is never too low. Rows that repeat a doc_id would be counted twice, so the lines it lets
    through are counted again by distinct doc_id where an id repeats. Rows without an id are one document.
    """
    held = F.explode(F.array_distinct(F.filter(_hashes(F.col("text"), min_chars), lambda x: x.isNotNull()))).alias("line")
    rows = keyed(docs).select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), held)
    often = checkpointed(rows.groupBy("line.h", "line.g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("h", "g"))
    ids = keyed(docs).select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"))
    if ids.groupBy("doc_id", "no_id").count().filter("count > 1").isEmpty():
        return often
    candidates = rows.select("doc_id", "no_id", "line.h", "line.g").join(often, ["h", "g"], "left_semi")
    distinct = candidates.distinct().groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"))
    return checkpointed(distinct.filter(F.col("n") >= min_docs).select("h", "g"))


def without_frequent_lines(docs: DataFrame, min_docs=MIN_DOCS, min_chars=MIN_CHARS, text_column="text") -> DataFrame:
    """Rows of ``docs (doc_id, text, ...)`` with ``text`` without frequent lines, plus ``n_lines`` (before) and ``n_dropped``.

    All columns pass through, also ones named like those used inside, except that ``n_lines`` and ``n_dropped`` of the input
    are replaced. A null or empty text is one empty line and comes back empty; lines whose key has under ``min_chars`` code
    points always stay. Rows that share an id are one document in the count and each keep their own lines; rows without an
    id count as one document together. An empty table gives an empty result. A text of any length is one row of the result,
    as it is one of the input; no other group is gathered.
    """
    texts = docs.select("doc_id", F.col(text_column).alias("text"))
    frequent = frequent_lines(texts, min_docs, min_chars)
    at = F.posexplode(_hashes(F.col("text"), min_chars)).alias("position", "line")
    lines = keyed(texts).select(*_row_key(), at).filter(F.col("line").isNotNull())
    dropped = lines.select("k", "k2", "position", "line.h", "line.g").join(frequent, ["h", "g"], "left_semi")
    gone = dropped.groupBy("k", "k2").agg(F.collect_set("position").alias("gone"))

    passing = [c for c in docs.columns if c not in (text_column, "n_lines", "n_dropped")]
    whole = F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(passing)]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), whole)
    met = rows.select(*_row_key(), "row", F.coalesce("text", F.lit("")).alias("text")).join(gone, ["k", "k2"], "left")
    parts = met.select("row", "gone", "text", split_lines(F.col("text")).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    )
    places = {c: f"row.c{i}" for i, c in enumerate(passing)}
    columns = [(text if c == text_column else F.col(places[c])).alias(c) for c in docs.columns if c in (text_column, *passing)]
    n_dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    return parts.select(*columns, F.size("lines").cast("long").alias("n_lines"), n_dropped.alias("n_dropped"))


def op11_lines(spark, sf_dir: str) -> DataFrame:
    kept = without_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_KEY_SQL = f"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}')"

ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
  FROM documents),
k AS (SELECT doc_id, position, line, {_KEY_SQL} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id"""

QUERIES = {"op11_lines": op11_lines}
ORACLES = {"op11_lines": ORACLE}
