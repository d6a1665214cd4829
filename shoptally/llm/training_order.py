"""Training order on disk: every sequence gets a slot by a keyed permutation, shards hold fixed ranges of slots.

Sequences are numbered from 0 to N - 1; a balanced Feistel network over the next even power of two, with cycle-walking,
permutes these numbers. The slot follows from key and number alone, so any task can compute it and a task that is repeated
after a loss computes the same. Each shard is one file of records of equal size (ids of two bytes, zero-padded), sorted
by slot: slot s is record ``s % per_shard`` of shard ``s // per_shard``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptally.llm.common import part_count, table
from shoptally.llm.packing import vocabulary_path
from shoptally.llm.word_tokens import known_words
from shoptally.session import scratch_path

LENGTH = 1024
PER_SHARD = 8192
END_ID = 2
KEY = 20_240_601
ROUNDS = 6
SLICE_BYTES = 4_000_000  # of texts that are encoded at once


def _round(half: np.ndarray, key: int, number: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, total: int, key=KEY) -> np.ndarray:
    """Slots of ``numbers`` in a keyed permutation of ``0 .. total - 1``.

    Numbers that leave the range are walked on along their cycle until they are back in it, less than four steps on average.
    """
    bits = np.uint64(max(1, ((max(1, total - 1)).bit_length() + 1) // 2))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for number in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, number) & mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= np.uint64(total)]
    return out.astype(np.int64)


def slices(batch: pa.RecordBatch, most=SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch ``(doc_id, text)`` with up to ``most`` bytes of text, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def sequences(docs: DataFrame, vocabulary: str, length=LENGTH, end_id=END_ID) -> DataFrame:
    """``(row, doc_id, start, n_tokens, ids)`` of every row of ``docs (doc_id, text)``: its ids in runs of ``length``.

    ``ids`` are little-endian unsigned 16-bit integers. ``row`` is the input partition and the place in it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with known_words(vocabulary) as known:
            if len(known.ends_word) > 1 << 16:
                raise ValueError("ids of this vocabulary do not fit two bytes")
            for batch in batches:
                for part in slices(batch):
                    ids, at = known.encode_texts(part.column(1))
                    # each text's ids, and the end id after them
                    ended = np.full(len(ids) + part.num_rows, end_id, dtype="<u2")
                    keep = np.ones(len(ended), dtype=bool)
                    at = at + np.arange(len(at))  # the end ids before a text move it
                    keep[at[1:] - 1] = False
                    ended[keep] = ids
                    sizes = np.diff(at)
                    runs = -(-sizes // length)
                    row = np.repeat(np.arange(part.num_rows), runs)
                    start = length * (np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs))
                    stop = np.minimum(start + length, sizes[row])
                    places = np.concatenate([[0], np.cumsum(stop - start)]) * 2  # runs lie one after the other, as the texts do
                    data = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(ended)])
                    made = [part.column(0).take(pa.array(row)), pa.array(start), pa.array(stop - start), data.cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays(made, names=["doc_id", "start", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, f"doc_id {kind}, start long, n_tokens long, ids binary")
    return made.select(F.monotonically_increasing_id().alias("row"), "*")


def ordered(made: DataFrame, key=KEY, per_shard=PER_SHARD) -> DataFrame:
    """Add ``slot`` and ``shard`` to a written table of sequences.

    A sequence's number is its place in the table as it was read, partition after partition. One count per input partition
    reaches the driver, and the ids are shuffled only once, into their shards.
    """
    counts = {r["part"]: r["count"] for r in made.groupBy(F.shiftright("row", 33).alias("part")).count().collect()}
    before = np.concatenate([[0], np.cumsum([counts.get(p, 0) for p in range(max(counts, default=0) + 1)])])
    total = int(before[-1])

    @F.pandas_udf("long")
    def slot(row: pd.Series) -> pd.Series:
        at = row.to_numpy()
        return pd.Series(permuted(before[at >> 33] + (at & ((1 << 33) - 1)), total, key))

    placed = made.withColumn("slot", slot("row")).drop("row")
    return placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))


def write_shards(placed: DataFrame, path: str, length=LENGTH) -> None:
    """Write one folder per shard with one file of records ``(slot, doc_id, start, n_tokens, record)`` in slot order.

    ``record`` has ``2 * length`` bytes. A run that is repeated after a loss writes the same records.
    """
    spark = placed.sparkSession
    dealt = placed.repartitionByRange(part_count(spark), "shard").sortWithinPartitions("shard", "slot")
    padding = F.repeat(F.lit("\0"), (2 * length - F.octet_length("ids")).cast("int")).cast("binary")
    records = dealt.select("shard", "slot", "doc_id", "start", "n_tokens", F.concat("ids", padding).alias("record"))
    records.write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, from_slot=0, per_shard=PER_SHARD) -> DataFrame:
    """Records from a slot on: only the shards that hold them are opened."""
    schema = "slot long, doc_id long, start long, n_tokens long, record binary, shard long"
    found = spark.read.schema(schema).parquet(path)
    return found.filter((F.col("shard") >= from_slot // per_shard) & (F.col("slot") >= from_slot))


def materialise(docs: DataFrame, path: str, vocabulary: str, length=LENGTH, per_shard=PER_SHARD, key=KEY, end_id=END_ID) -> DataFrame:
    """Write the shards of all rows of ``docs`` to ``path`` and return a reader of their records.

    A null or empty text is one sequence of its end id; rows that repeat an id or have none are sequences of their own; an
    empty table writes no shard; further columns are ignored.
    """
    spark, table_path = docs.sparkSession, scratch_path(docs.sparkSession, "sequences")
    made = sequences(docs.select("doc_id", "text"), vocabulary, length, end_id)
    made.write.option("compression", "zstd").parquet(table_path)
    made = spark.read.schema(made.schema).parquet(table_path)
    write_shards(ordered(made, key, per_shard), path, length)
    return read_shards(spark, path, per_shard=per_shard)


def op5_training_order(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    records = materialise(docs, scratch_path(spark, "shards"), vocabulary_path())
    crc = F.crc32(F.substring("record", F.lit(1), (2 * F.col("n_tokens")).cast("int")))
    return records.select(
        "doc_id", "start", "n_tokens", "slot", "shard", (F.col("slot") % PER_SHARD).alias("position"), crc.alias("ids_crc32")
    )


QUERIES = {"op5_training_order": op5_training_order}
