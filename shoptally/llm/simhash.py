"""SimHash near-duplicates by pivot distance tables.

A fingerprint's row in the table holds its Hamming distances to ``PIVOTS`` fixed reference fingerprints, once for each of
``SEGMENTS`` parts of the 64 bits. By the triangle inequality two fingerprints that differ in d bits of a segment differ
by at most d in each coordinate of that segment. So two fingerprints within ``DISTANCE`` bits agree in all coordinates of
at least ``SEGMENTS - DISTANCE`` segments: those coordinates are the join key of the candidate search. Candidates whose
whole distances to any pivot differ by more than ``DISTANCE`` are discarded; the exact distance decides on the survivors.
No link is missed, however many fingerprints share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import NO_ID, keyed, part_count, table, words_of
from shoptally.llm.components import components
from shoptally.operators.joins import join_dimension
from shoptally.session import checkpointed

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 6
PIVOTS = 12
TILE = 2000

_EDGES = np.linspace(0, 64, SEGMENTS + 1).round().astype(int)
_MASKS = np.array([((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(_EDGES, _EDGES[1:], strict=False)], dtype=np.uint64)
_PIVOTS = np.array([xxhash.xxh64_intdigest(f"pivot {i}") for i in range(PIVOTS)], dtype=np.uint64)
_AGREE = list(combinations(range(SEGMENTS), SEGMENTS - DISTANCE))


def fingerprint(text: str | None, n=SHINGLE) -> int:
    """SimHash of the word ``n``-shingles of a text, as an unsigned integer; zero without words."""
    words = words_of(text)
    if not words:
        return 0
    lowered = b" ".join(words).translate(_LOWER).split(b" ")
    count = max(1, len(lowered) - n + 1)
    ones = np.zeros(64, dtype=np.int64)
    step = 1 << 16
    for at in range(0, count, step):
        stop = min(count, at + step)
        shingles = map(b" ".join, zip(*(lowered[at + k : stop + k] for k in range(n)), strict=True)) if len(lowered) >= n else [b" ".join(lowered)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8", count=stop - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text hash, fp)`` of every row; ``fp`` is the fingerprint as a signed long. Columns: ``doc_id, text``."""

    @F.pandas_udf("long")
    def prints(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in text], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), prints("text").alias("fp"))


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances (fingerprint, segment, pivot) as bytes."""
    return np.bitwise_count((fps[:, None] ^ _PIVOTS)[:, None, :] & _MASKS[:, None]).astype(np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def candidate_keys(distinct: DataFrame) -> DataFrame:
    """``(key, fp)``: one row for each set of segments that must agree."""

    def run(batches):
        for batch in batches:
            fps = batch.fp.to_numpy().view(np.uint64)
            packed = (pivot_table(fps).astype(np.uint64) << (np.uint64(4) * np.arange(PIVOTS, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)
            for number, chosen in enumerate(_AGREE):
                key = np.full(len(fps), number, dtype=np.uint64)
                for segment in chosen:
                    key = _mix(key ^ packed[:, segment]) + np.uint64(segment + 1)
                yield pd.DataFrame({"key": key.view(np.int64), "fp": batch.fp})

    return distinct.mapInPandas(run, "key long, fp long")


def tiled(keys: DataFrame, tile=TILE) -> DataFrame:
    """Add ``cell``: keys with over ``tile`` fingerprints are dealt into blocks, and each pair of blocks is one cell."""
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    blocks = F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(F.col("own"), other) * F.col("blocks") + F.greatest(F.col("own"), other),
    )
    dealt = keys.join(crowded, "key", "left").select("key", "fp", blocks.alias("blocks")).withColumn("own", own)
    # A block of its own meets itself in every cell it is part of, so its cell with itself is needed only when it is alone.
    cells = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(pair)
    return dealt.select("key", "fp", F.explode(cells).alias("cell"))


def spanning_links(fps: np.ndarray, distance=DISTANCE) -> list[tuple[int, int]]:
    """Links that connect ``fps`` as all pairs within ``distance`` would: a breadth-first forest, at most one per member."""
    coordinates = pivot_table(fps).sum(axis=1, dtype=np.int16)
    left = np.arange(len(fps))
    links = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = (np.abs(coordinates[left] - coordinates[at]) <= distance).all(axis=1)
            near[near] = np.bitwise_count(fps[left[near]] ^ fps[at]) <= distance
            found, left = left[near], left[~near]
            queue.extend(found)
            links.extend((fps[at], fps[x]) for x in found)
    return links


def links(distinct: DataFrame) -> DataFrame:
    """``(a, b)`` links between different fingerprints that connect all pairs within ``DISTANCE`` bits."""
    spark = distinct.sparkSession
    parts = part_count(spark)
    cells = tiled(candidate_keys(distinct)).repartition(parts, "key", "cell").sortWithinPartitions("key", "cell", "fp")

    def run(batches):
        rest = None
        for batch in batches:
            held = batch if rest is None or not len(rest) else pd.concat([rest, batch], ignore_index=True)
            cut = _last_group(held)
            rest = held.iloc[cut:]
            yield _links_of(held.iloc[:cut])
        if rest is not None:
            yield _links_of(rest)

    return cells.mapInPandas(run, "a long, b long").distinct()


def _last_group(held: pd.DataFrame) -> int:
    key, cell = held.key.to_numpy(), held.cell.to_numpy()
    same = (key == key[-1]) & (cell == cell[-1]) if len(held) else np.zeros(0, bool)
    return int(np.argmax(same)) if len(held) else 0


def _links_of(rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(rows):
        key, cell, fps = rows.key.to_numpy(), rows.cell.to_numpy(), rows.fp.to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
        sizes = np.diff(np.r_[starts, len(rows)])
        pairs = starts[sizes == 2]
        if len(pairs):
            a, b = fps[pairs], fps[pairs + 1]
            near = (np.abs(pivot_table(a).sum(axis=1, dtype=np.int16) - pivot_table(b).sum(axis=1, dtype=np.int16)) <= DISTANCE).all(axis=1)
            near &= np.bitwise_count(a ^ b) <= DISTANCE
            out.append(np.stack([a[near], b[near]], axis=1))
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            found = spanning_links(fps[at : at + size])
            if found:
                out.append(np.array(found, dtype=np.uint64))
    both = (np.concatenate(out) if out else np.zeros((0, 2), np.uint64)).astype(np.uint64).view(np.int64)
    return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id, root)`` of every row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest id in the group of linked rows, null if all its ids are null; ``root`` tells
    the groups apart even where ids repeat. Null, empty and blank
    texts have fingerprint zero and are linked like any other; equal texts always share a component; rows that repeat an
    id stay rows. An empty table gives an empty result. One row per document comes back, never the pairs of a group.
    """
    prints = checkpointed(fingerprints(docs))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    spread = distinct.select("fp").repartition(part_count(docs.sparkSession), "fp")
    roots = checkpointed(components(links(spread)))
    rooted = distinct.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    by_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = checkpointed(rooted.join(by_root, "root").select("fp", "component_id", "root"))
    return join_dimension(prints, named, "fp", "inner")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, with the columns of ``docs``: the smallest id, then the smallest text hash; a repeated row stays once.

    A row without an id counts as the largest id.
    """
    found = near_duplicates(keyed(docs))
    order = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("text_hash").alias("hash"))
    chosen = found.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.id").alias("_id"), F.col("first.hash").alias("_hash"))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_hash")
    )
    return rows.join(checkpointed(chosen), ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select("row.*")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(keyed(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op1_simhash": op1_simhash}
