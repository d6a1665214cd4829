"""Spelling variants: words one edit apart, grouped under their most frequent form.

Two different words are one edit apart exactly when their common prefix and common suffix together reach the longer length
minus one. Words stand in padded matrices of code points, and blocks of rows are compared pair by pair: one pass over the
columns gives the common prefixes of all pairs of two blocks, one pass over the right-aligned matrices the common suffixes.

Which blocks meet follows from the same two lengths. With the longer word cut in three segments, an edit leaves all before
and all after its segment as it is; so both words share, for one of the segments, the code points outside it, and that is
the key under which they meet. A key with many words is dealt over cells of two slices each, so no task holds more than two
slices of one key. A pair counts only under the first segment that holds for it, hence once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import table
from shoptally.llm.lines import lower_ascii
from shoptally.session import checkpointed

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
SHORTEST = 5
LEAST = 3
SLIP = 97
SEGMENTS = 3
SLICE = 2048
ROWS_PER_TASK = 60_000
TILE = 32
TILES_AT_ONCE = 256


def slipped(run: Column, doc_id: Column, every=SLIP) -> Column:
    """The run without code point ``h % length`` where ``every`` divides h, the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % every == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, shortest=SHORTEST, least=LEAST, every=SLIP) -> DataFrame:
    """``(word, n)`` of all words of ``docs (doc_id, text)`` with enough code points and occurrences. A null text has none."""
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select(slipped(lower_ascii(F.col("run")), F.col("doc_id"), every).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def keyed_words(words: DataFrame, segments=SEGMENTS) -> DataFrame:
    """``(key, size, segment, word, n)``: the keys of every word, as the longer word of a pair and as the shorter one.

    ``size`` is the longer length of the pairs that the key is for. The key is a hash; words that it brings together by
    chance are told apart by the comparison.
    """
    length = F.length("word")
    both = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    cut = both.select("word", "n", "size", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"))
    start = F.floor(F.col("segment") * F.col("size") / segments).cast("int")
    stop = F.floor((F.col("segment") + 1) * F.col("size") / segments).cast("int")
    before, behind = F.substr("word", F.lit(1), start), F.col("size") - stop
    after = F.when(behind == 0, "").otherwise(F.substr("word", F.length("word") - behind + 1))
    fits = start + behind <= F.length("word")
    return cut.filter(fits).select(F.xxhash64("size", "segment", before, after).alias("key"), "size", "segment", "word", "n")


def cells(keyed: DataFrame, slice_rows=SLICE) -> DataFrame:
    """Rows that have company under their key, with ``cell``: every two slices of a key meet in one cell.

    A slice has about ``slice_rows`` words, by hash; ``slice`` is null where the key has one slice only.
    """
    sizes = checkpointed(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"))
    met = keyed.join(sizes, "key").withColumn("_slices", F.ceil(F.col("_rows") / slice_rows).cast("int"))
    mine = F.pmod(F.xxhash64("word", F.lit(5)), F.col("_slices")).cast("int")
    cut = met.withColumn("slice", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    cell = F.xxhash64("key", F.least("slice", "_other"), F.greatest("slice", "_other"))
    alone = F.col("_other") == F.col("slice")
    return cut.select("key", "size", "segment", "word", "n", "slice", cell.alias("cell"), alone.alias("alone"))


def code_points(words: list[str], width: int, right=False) -> np.ndarray:
    """Matrix of code points, one word a row, padded with zeros behind, or before with ``right``."""
    pad = str.rjust if right else str.ljust
    flat = np.frombuffer("".join(pad(w, width, "\0") for w in words).encode("utf-32-le"), dtype="<u4")
    small = np.uint8 if flat.size and flat.max() < 256 else np.uint32
    return flat.astype(small).reshape(len(words), width)


def common(a: np.ndarray, b: np.ndarray, columns) -> np.ndarray:
    """Number of leading equal columns, in the order of ``columns``, for all pairs of rows: (tiles, rows of a, rows of b)."""
    out = np.zeros((a.shape[0], a.shape[1], b.shape[1]), dtype=np.uint16)
    equal = np.ones(out.shape, dtype=bool)
    for c in columns:
        equal &= a[:, :, c, None] == b[:, None, :, c]
        if not equal.any():
            break
        out += equal
    return out


def near_pairs(rows: pd.DataFrame, tile=TILE, segments=SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the near pairs of ``rows (cell, key, size, segment, word, slice, alone)``, sorted by cell.

    Consecutive rows form tiles, and a tile is compared with those after it as far as its last cell reaches. Two slices of a
    key that meet in a cell compare their own rows only in the cell that a slice has for itself.
    """
    words = rows["word"].tolist()
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
    cell, size, segment = (rows[c].to_numpy() for c in ("cell", "size", "segment"))
    own, alone = rows["slice"].to_numpy(), rows["alone"].to_numpy()
    # A cell of two slices holds rows of both that are not ``alone``; those of one slice have met already.
    start, stop = segment * size // segments, (segment + 1) * size // segments
    n = len(words)
    tiles = -(-n // tile)
    first = cell[np.arange(tiles) * tile]
    last = cell[np.minimum(np.arange(1, tiles + 1) * tile, n) - 1]
    reach = np.searchsorted(first, last, side="right")  # tiles before this one begin within the last cell of the tile
    left = np.repeat(np.arange(tiles), reach - np.arange(tiles))
    right = np.concatenate([np.arange(t, r) for t, r in enumerate(reach)]) if tiles else left
    width = int(lengths.max(initial=1))
    full = tiles * tile
    ahead, behind = np.zeros((full, width), dtype=np.uint32), np.zeros((full, width), dtype=np.uint32)
    a, b = code_points(words, width), code_points(words, width, right=True)
    ahead, behind = ahead.astype(a.dtype), behind.astype(b.dtype)
    ahead[:n], behind[:n] = a, b
    ahead, behind = ahead.reshape(tiles, tile, width), behind.reshape(tiles, tile, width)
    place = np.arange(full).reshape(tiles, tile)
    found_i, found_j = [], []
    for at in range(0, len(left), TILES_AT_ONCE):
        x, y = left[at : at + TILES_AT_ONCE], right[at : at + TILES_AT_ONCE]
        prefix = common(ahead[x], ahead[y], range(width))
        suffix = common(behind[x], behind[y], range(width - 1, -1, -1))
        i, j = np.broadcast_arrays(place[x][:, :, None], place[y][:, None, :])
        hit = (i < j) & (j < n)
        i, j, p, s = i[hit], j[hit], prefix[hit].astype(np.int32), suffix[hit].astype(np.int32)
        longer = size[i]
        good = (cell[i] == cell[j]) & (size[j] == longer) & (segment[i] == segment[j])
        good &= np.maximum(lengths[i], lengths[j]) == longer
        good &= p + s >= longer - 1
        good &= (p >= start[i]) & (s >= longer - stop[i])
        good &= (segment[i] == 0) | (s < longer - start[i])
        good &= (own[i] != own[j]) | alone[i]
        found_i.append(i[good])
        found_j.append(j[good])
    nothing = np.zeros(0, dtype=np.int64)
    return np.concatenate([nothing, *found_i]), np.concatenate([nothing, *found_j])


def _nearest(rows: pd.DataFrame) -> pd.DataFrame:
    """For each word of a bucket of cells with near words: how many, and the best by ``n``, then by code points."""
    rows = rows.sort_values(["cell", "size", "segment"], ignore_index=True)
    i, j = near_pairs(rows)
    me, other = np.concatenate([i, j]), np.concatenate([j, i])
    words, n = rows["word"].to_numpy(), rows["n"].to_numpy()
    pairs = pd.DataFrame({"word": words[me], "near": words[other], "near_n": n[other]})
    pairs = pairs.sort_values(["word", "near_n", "near"], ascending=[True, False, True])
    grouped = pairs.groupby("word", sort=False)
    best = grouped.first()
    best["n_near"] = grouped.size()
    return best.reset_index()[["word", "n_near", "near", "near_n"]]


def near_words(words: DataFrame, segments=SEGMENTS, slice_rows=SLICE) -> DataFrame:
    """``(word, n_near, near, near_n)`` for each word of ``words (word, n)``, one row a word, that has a near word."""
    made = cells(keyed_words(words, segments), slice_rows)
    made = checkpointed(made)
    buckets = max(1, -(-made.count() // ROWS_PER_TASK))
    dealt = made.withColumn("bucket", F.pmod("cell", F.lit(buckets)))
    schema = "word string, n_near long, near string, near_n long"
    part = dealt.groupBy("bucket").applyInPandas(_nearest, schema)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    return part.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.n")).alias("near_n")
    )


def rooted(forms: DataFrame) -> DataFrame:
    """Add ``root``: from ``word``, follow ``form`` to the last.

    A form is at least twice as frequent as its word, so chains have no cycle and at most as many steps as ``n`` has bits;
    every round doubles the steps followed.
    """
    now = checkpointed(forms.withColumn("root", F.coalesce("form", "word")))
    while True:
        ahead = now.filter(F.col("root") != F.col("word")).select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = now.join(ahead, F.col("root") == F.col("at"), "left")
        moved = checkpointed(joined.withColumn("_moved", F.col("next").isNotNull()).withColumn("root", F.coalesce("next", "root")).drop("at", "next"))
        now = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, shortest=SHORTEST, least=LEAST, every=SLIP, ratio=2) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``docs (doc_id, text, ...)``.

    ``form`` is the near word of largest n, the smallest in code-point order among ties, if that is at least ``ratio`` times
    the word's own n. Null and empty texts have no word, an empty table gives no row, further columns are ignored, rows that
    repeat count as often as they stand, and a null id is an empty string in the hash. Words of any length are compared whole.
    """
    words = checkpointed(word_counts(docs.select("doc_id", "text"), shortest, least, every))
    met = words.join(near_words(words), "word", "left")
    chosen = F.col("near_n") >= ratio * F.col("n")
    forms = met.select(
        "word",
        F.when(chosen, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("near_n")).alias("form_n"),
    )
    return rooted(forms)


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    found = spelling_variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op13_spelling": op13_spelling}
