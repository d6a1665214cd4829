"""Removal of passages that a document with a smaller id holds as well, by level-wise doubling of windows.

Window hashes are built by doubling: two hashes of one length make the hash of a window up to twice as long. First level:
windows of ``length / 2`` words. Of the ones inside every window of ``length`` words the one with the smallest hash stands
for it (its seed), so equal windows have equal seeds and few positions of a text need to be compared. Second level: only
windows around a seed found in several documents are extended to ``length`` words; the others cannot repeat. Windows that
repeat at ``length`` are removed as they are, so longer levels would change no decision and are left out.

Neighbouring windows with the same seed make a stretch of up to ``1.5 * length`` words. A stretch that a smaller document
holds as a whole decides all its windows at once; only the first document of a stretch, and stretches at the edges of a
passage, are compared window by window. So a group of copies costs a row per seed, not a row per word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import NO_ID, table, words_of
from shoptally.session import checkpointed

LENGTH = 50


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the pair of hashes (a, b)."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def extended(hashes: np.ndarray, have: int, want: int) -> np.ndarray:
    """Hashes of windows of ``want`` words from those of ``have``, where have <= want <= 2 * have."""
    step = want - have
    return _mix(hashes[: len(hashes) - step], hashes[step:]) if len(hashes) > step else hashes[:0]


def window_hashes(words: list[bytes], length: int) -> np.ndarray:
    """Hash of each window of ``length`` words, by doubling from single words."""
    now = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    have = 1
    while have < length:
        want = min(2 * have, length)
        now, have = extended(now, have, want), want
    return now


def _seeds(halves: np.ndarray, width: int) -> np.ndarray:
    """For each window: the position of the first smallest of its ``width`` half-length hashes."""
    count = len(halves) - width + 1
    step, out = 1 << 16, []
    view = np.lib.stride_tricks.sliding_window_view(halves, width)
    for at in range(0, count, step):
        part = view[at : at + step]
        out.append(part.argmin(axis=1) + np.arange(at, at + len(part)))
    return np.concatenate(out)


def _seeded(text: str | None, length: int):
    """Arrays (seed hash, first window, number of windows) of one text, or None if it is too short."""
    words = words_of(text)
    if len(words) < length:
        return None
    half = (length + 1) // 2
    halves = window_hashes(words, half)
    seed_at = _seeds(halves, length - half + 1)
    first = np.flatnonzero(np.r_[True, seed_at[1:] != seed_at[:-1]])
    return halves[seed_at[first]], first, np.diff(np.r_[first, len(seed_at)])


def _rows(docs: DataFrame) -> DataFrame:
    """``(doc, tag, text)``: a row's id, and a tag that tells apart rows that share an id."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("tag"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def seeds(rows: DataFrame, length=LENGTH) -> DataFrame:
    """First level: ``(seed, doc, tag, first, n)`` of every text of ``rows (doc, tag, text)``."""

    def run(batches):
        for batch in batches:
            for doc, tag, text in zip(batch.doc, batch.tag, batch.text, strict=True):
                found = _seeded(text, length)
                if found:
                    seed, first, n = found
                    yield pd.DataFrame({"seed": seed.view(np.int64), "doc": doc, "tag": tag, "first": first.astype(np.int32), "n": n.astype(np.int32)})

    return rows.mapInPandas(_gathered(run), "seed long, doc long, tag long, first int, n int")


def parts_of(runs: DataFrame) -> DataFrame:
    """``(doc, tag, parts)``: the different runs ``(first, n)`` of each text.

    Rows that repeat an id and a text share one entry. A plain table, so that a join on a hot id can be split.
    """
    return checkpointed(runs.groupBy("doc", "tag").agg(F.collect_set(F.struct("first", "n")).alias("parts")))


def _extended_at(rows: DataFrame, chosen: DataFrame, length: int, made, schema: str) -> DataFrame:
    """``made(extend, first, n)`` as rows with ``doc`` and ``tag``, for each text with runs ``chosen (doc, tag, first, n)``.

    ``extend(at)`` are the hashes of the windows of ``length`` words at the positions ``at``, from the two halves of each.
    """
    half = (length + 1) // 2

    def run(batches):
        for batch in batches:
            for doc, tag, text, first, n in zip(batch.doc, batch.tag, batch.text, batch["first"], batch.n, strict=True):
                halves = window_hashes(words_of(text), half)
                frame = pd.DataFrame(made(lambda at, h=halves: _mix(h[at], h[at + length - half]), first, n))
                yield frame.assign(doc=doc, tag=tag)

    listed = rows.join(parts_of(chosen), ["doc", "tag"]).select("doc", "tag", "text", "parts.first", "parts.n")
    return listed.mapInPandas(_gathered(run), f"{schema}, doc long, tag long")


def stretches(rows: DataFrame, chosen: DataFrame, length=LENGTH) -> DataFrame:
    """Second level: ``(stretch, first, n, doc, tag)``, the hash of each run ``chosen`` from its first and last window."""

    def made(extend, first, n):
        ends = _mix(_mix(extend(first), extend(first + n - 1)), n.astype(np.uint64))
        return {"stretch": ends.view(np.int64), "first": first, "n": n}

    return _extended_at(rows, chosen, length, made, "stretch long, first int, n int")


def _gathered(run, size=200_000):
    """Join the small frames that ``run`` yields into frames of at least ``size`` rows."""

    def joined(batches):
        held, count = [], 0
        for frame in run(batches):
            held.append(frame)
            count += len(frame)
            if count >= size:
                yield pd.concat(held, ignore_index=True)
                held, count = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    return joined


def _shared(df: DataFrame, key: str) -> DataFrame:
    """``(key, least)``: keys that several documents hold, with the smallest of them."""
    ends = df.groupBy(key).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    return checkpointed(ends.filter("least < most").select(key, "least"))  # a plain table: its joins can be split where a key is hot


def windows(rows: DataFrame, chosen: DataFrame, length=LENGTH) -> DataFrame:
    """Second level: ``(window, first, doc, tag)``, the hash of each single window of the runs ``chosen``."""

    def made(extend, first, n):
        at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return {"window": extend(at).view(np.int64), "first": at.astype(np.int32)}

    return _extended_at(rows, chosen, length, made, "window long, first int")


def repeats(rows: DataFrame, length=LENGTH) -> DataFrame:
    """``(doc, tag, first, n)``: runs of windows that also start in a document with a smaller id."""
    half = checkpointed(seeds(rows, length))
    candidates = half.join(_shared(half, "seed").select("seed"), "seed", "left_semi").drop("seed")
    extended_runs = checkpointed(stretches(rows, candidates, length))
    decided = extended_runs.join(_shared(extended_runs, "stretch"), "stretch", "left")
    whole = F.col("doc") > F.col("least")
    single = checkpointed(windows(rows, decided.filter(~F.coalesce(whole, F.lit(False))), length))
    one_by_one = single.join(_shared(single, "window"), "window").filter("doc > least")
    return (
        decided.filter(whole)
        .select("doc", "tag", "first", "n")
        .unionByName(one_by_one.select("doc", "tag", "first", F.lit(1).alias("n")))
    )


def cut(text: str | None, first, n, length=LENGTH) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by a space) of a text whose runs ``first[i] .. first[i] + n[i]`` of windows repeat."""
    words = words_of(text)
    if first is None or not len(first):
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.asarray(first) + np.asarray(n) - 1 + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return len(words), len(words) - len(kept), b" ".join([words[i] for i in kept])


def _with_parts(docs: DataFrame, length: int) -> DataFrame:
    """``(row, parts)``: every row of ``docs`` as a struct, so that no column can clash, and its repeated runs (null: none)."""
    found = parts_of(repeats(_rows(docs), length))
    doc, tag = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("tag")
    return docs.select(F.struct(*docs.columns).alias("row"), doc, tag).join(found, ["doc", "tag"], "left").select("row", "parts")


def removal_report(docs: DataFrame, length=LENGTH) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row.

    Null, empty and blank texts have no words. Rows with equal ids do not remove each other's words (none is smaller), and
    a row without an id counts as the largest. An empty table gives an empty result; further columns are ignored.
    """

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def report(text: pd.Series, first: pd.Series, n: pd.Series) -> pd.DataFrame:
        made = [cut(*row, length) for row in zip(text, first, n, strict=True)]
        return pd.DataFrame(
            {
                "n_words": [m[0] for m in made],
                "n_removed": [m[1] for m in made],
                "kept_sha256": [hashlib.sha256(m[2]).hexdigest() for m in made],
            }
        )

    marked = _with_parts(docs.select("doc_id", "text"), length)
    return marked.select("row.doc_id", report("row.text", "parts.first", "parts.n").alias("r")).select("doc_id", "r.*")


def without_repeats(docs: DataFrame, length=LENGTH) -> DataFrame:
    """``docs`` with the repeated words cut from ``text``; texts that lose nothing stay as they are. Columns as in ``docs``.

    Nulls, repeated rows, rows without an id and empty tables as in :func:`removal_report`; a null text stays null.
    """

    @F.pandas_udf("string")
    def kept(text: pd.Series, first: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(
            [t if f is None else cut(t, f, k, length)[2].decode("utf-8", "surrogatepass") for t, f, k in zip(text, first, n, strict=True)],
            dtype=object,
        )

    cleaned = _with_parts(docs, length).select("row", kept("row.text", "parts.first", "parts.n").alias("kept"))
    return cleaned.select(*[F.col("kept" if c == "text" else f"row.{c}").alias(c) for c in docs.columns])


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))


QUERIES = {"op4_substrings": op4_substrings}
ORACLES = {
    "op4_substrings": rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
w AS (
  SELECT doc_id, p, sha256(array_to_string(list_slice(words, p, p + {LENGTH - 1}), ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {LENGTH - 2})) AS p FROM d)),
again AS (SELECT doc_id, p FROM w QUALIFY min(doc_id) OVER (PARTITION BY h) < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {LENGTH})) AS i FROM again),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
}
