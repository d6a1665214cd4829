"""Packing of documents into fixed windows by minimum bin slack.

A document's ids are cut into full windows and one remainder. Only the number of pieces of each length matters for the
plan, so the plan is made from a histogram of at most ``capacity`` rows, whatever the corpus: the largest length left opens
a window, a bitset subset-sum over the other lengths (bounded by their counts) finds the fill closest to the capacity, the
counts are backtracked, and the pattern is repeated as often as the counts allow. A pattern exhausts a length or at least
halves what is left of it below ``capacity / length`` pieces, so at most ``sum(log2(capacity / length) + 2)`` patterns arise,
about 14 thousand for 4096, each of at most 90 different lengths.
Pieces find their place by their rank among the pieces of their length, computed in buckets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shoptally.llm.common import table
from shoptally.llm.word_tokens import document_ids, known_words
from shoptally.session import checkpointed

CAPACITY = 4096
END_ID = 2


@dataclass
class Pattern:
    """``times`` windows starting at number ``first``, each holding ``counts[length]`` pieces of each length."""

    first: int
    times: int
    counts: dict[int, int] = field(default_factory=dict)


def best_fill(target: int, left: dict[int, int]) -> dict[int, int]:
    """Counts of a multiset from ``left`` (length -> pieces) whose sum is the closest to ``target`` from below."""
    reach, levels = 1, []
    full = (1 << (target + 1)) - 1
    for length in sorted(left, reverse=True):
        most = min(left[length], target // length)
        if not most:
            continue
        levels.append((length, most, reach))
        step = 1
        while most:
            take = min(step, most)
            reach |= (reach << (take * length)) & full
            most -= take
            step *= 2
        if reach >> target & 1:
            break
    at, counts = reach.bit_length() - 1, {}
    for length, most, before in reversed(levels):
        used = next(k for k in range(most + 1) if at >= k * length and before >> (at - k * length) & 1)
        if used:
            counts[length] = used
            at -= used * length
    return counts


def plan_windows(histogram: dict[int, int], capacity=CAPACITY) -> list[Pattern]:
    """Patterns that place every piece of a length histogram."""
    left, patterns, windows = {k: v for k, v in histogram.items() if v}, [], 0
    while left:
        largest = max(left)
        others = dict(left)
        others[largest] -= 1
        counts = best_fill(capacity - largest, {k: v for k, v in others.items() if v})
        counts[largest] = counts.get(largest, 0) + 1
        times = min(left[k] // n for k, n in counts.items())
        patterns.append(Pattern(windows, times, counts))
        windows += times
        for k, n in counts.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return patterns


def pieces(docs: DataFrame, vocabulary: str, capacity=CAPACITY, end_id=END_ID, with_ids=False) -> DataFrame:
    """``(doc_id, tag, start, length, ids_crc32, doc_tokens[, ids])``: the cuts of every row of ``docs (doc_id, text)``.

    ``tag`` tells apart rows that share an id. ``ids`` are little-endian unsigned 32-bit integers.
    """

    def cuts(text, known):
        ids = document_ids(text, known, end_id)
        data = memoryview(ids).cast("B")
        for start in range(0, len(ids), capacity):
            stop = min(start + capacity, len(ids))
            part = data[4 * start : 4 * stop]
            yield {"start": start, "length": stop - start, "ids_crc32": zlib.crc32(part), "doc_tokens": len(ids), "ids": bytes(part) if with_ids else None}

    fields = "start long, length long, ids_crc32 long, doc_tokens long, ids binary"

    @F.pandas_udf(f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with known_words(vocabulary) as known:
            for texts in batches:
                yield pd.Series([list(cuts(text, known)) for text in texts], dtype=object)

    found = docs.select("doc_id", F.hash("text").alias("tag"), F.explode(cut("text")).alias("p")).select("doc_id", "tag", "p.*")
    return found if with_ids else found.drop("ids")


def ranked(made: DataFrame, total: int) -> DataFrame:
    """Add ``rank``, from 0 among the pieces of a length: running numbers in hash buckets after the totals of lower buckets.

    The number of buckets follows from the number of pieces alone, so a frequent length is dealt over many tasks and the
    result is the same on every cluster.
    """
    buckets = max(16, int(total**0.5 / 4))
    dealt = made.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "tag", "start"), F.lit(buckets)).cast("int"))
    lower = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before"))
    within = W.partitionBy("length", "_bucket").orderBy("doc_id", "tag", "start", "ids_crc32")
    numbered = dealt.withColumn("_row", F.row_number().over(within))
    return numbered.join(before, ["length", "_bucket"]).withColumn("rank", F.col("_before") + F.col("_row") - 1).drop("_bucket", "_before", "_row")


def placed(made: DataFrame, capacity=CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces. The driver sees the length histogram only."""
    histogram = {row["length"]: row["count"] for row in made.groupBy("length").count().collect()}
    spots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    for p in plan_windows(histogram, capacity):
        offset = 0
        for length in sorted(p.counts, reverse=True):
            n = p.counts[length]
            spots.setdefault(length, []).append((used.get(length, 0), n, p.first, offset))
            used[length] = used.get(length, 0) + n * p.times
            offset += n * length
    plan = {length: np.array(rows, dtype=np.int64).T for length, rows in spots.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.empty((2, len(length)), dtype=np.int64)
        sizes, ranks = length.to_numpy(), rank.to_numpy()
        for size in np.unique(sizes):
            here = np.flatnonzero(sizes == size)
            since, n, first, offset = plan[size]
            at = np.searchsorted(since, ranks[here], side="right") - 1
            place_in = ranks[here] - since[at]
            out[0, here] = first[at] + place_in // n[at]
            out[1, here] = offset[at] + place_in % n[at] * size
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    numbered = ranked(made, sum(histogram.values()))
    return numbered.withColumn("_place", place("length", "rank")).select("*", "_place.*").drop("_place", "rank")


def pack(docs: DataFrame, vocabulary: str, capacity=CAPACITY, end_id=END_ID, with_ids=False) -> DataFrame:
    """One row per piece of every row of ``docs (doc_id, text)`` with its window ``sequence_id`` and ``offset`` there.

    A null or empty text is its end id alone. Rows that repeat an id, or have none, are packed like others. An empty table
    gives an empty result; further columns are ignored.
    """
    return placed(checkpointed(pieces(docs.select("doc_id", "text"), vocabulary, capacity, end_id, with_ids)), capacity)


def vocabulary_path(name="word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, vocabulary_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {"op7_packing": op7_packing}
