"""Exact top-k inner products by tiled matrix products.

Vectors are floored to integers. Queries and candidates are dealt into groups of bounded size; every pair of groups is one
tile. A tile multiplies its two matrices block by block and keeps each query's best candidates; a tree of merges with a
fixed fan-in joins the lists of the tiles. All rows are compared, no index is involved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import part_count, table
from shoptally.session import checkpointed

SCALE = 1024
K = 10
EVERY = 100
GROUP_COMPONENTS = 1 << 20
QUERY_BLOCK = 256
FAN_IN = 8


def integer_vectors(df: DataFrame, id_column="vec_id", vector_column="embedding") -> DataFrame:
    """``(vec_id, vector array<bigint>, dim)`` of the rows whose id and components are all present and finite."""
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    vectors = df.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("vec_id").isNotNull() & usable)
    return vectors.select("vec_id", F.transform("x", lambda c: F.floor(SCALE * c)).alias("vector"), F.size("x").alias("dim"))


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while they are exact there, then in long integers, then in Python integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    bound = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if bound < 2**52:
        return a.astype(np.float64) @ b.astype(np.float64).T
    exact = a.astype(object) @ b.astype(object).T if bound >= 2**62 else a @ b.T
    return exact


def best(query_ids, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k=K) -> list[list[tuple[int, int]]]:
    """For each query its ``k`` largest (score, id), ties to the smaller id; rows with the query's own id take no part."""
    order = np.argsort(ids, kind="stable")
    ids, vectors, out = ids[order], vectors[order], []
    for at in range(0, len(queries), QUERY_BLOCK):
        scores = _scores(queries[at : at + QUERY_BLOCK], vectors)
        for own, row in zip(query_ids[at : at + QUERY_BLOCK], scores, strict=True):
            other = np.flatnonzero(ids != own)
            row = row[other]
            if len(row) > k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                near = np.flatnonzero(row >= least)
                other, row = other[near], row[near]
            first = np.argsort(-row, kind="stable")[:k]
            out.append([(int(row[i]), int(ids[other[i]])) for i in first])
    return out


def search(queries: DataFrame, candidates: DataFrame, k=K) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` from tables of ``integer_vectors``.

    Candidates are all rows but those with the query's id, of equal dimension. Equal query rows are asked once; repeated
    candidate rows count each. Scores beyond the range of a long are cut to it. Empty tables give an empty result.
    """
    spark = candidates.sparkSession
    queries = queries.dropDuplicates(["vec_id", "vector"]).withColumn("asked", F.xxhash64("vec_id", "vector"))
    size = candidates.agg(F.count(F.lit(1)), F.max("dim")).first()
    n, dim = size[0], size[1] or 1
    room = max(256, GROUP_COMPONENTS // max(1, dim))
    groups = max(1, -(-n // room), min(part_count(spark), -(-n // 1024)))
    query_groups = max(1, -(-queries.count() // max(64, room // 4)))

    def part(of: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(of)).cast("int")

    def every(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    left = queries.select("asked", "vec_id", "vector", "dim", part(query_groups).alias("q"), every(groups).alias("g"))
    right = candidates.select("vec_id", "vector", "dim", part(groups).alias("g"), every(query_groups).alias("q"))
    right = right.toDF("held_id", "held_vector", "held_dim", "held_g", "held_q")  # both sides may stem from one table

    def tile(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"asked": [], "query_id": [], "g": [], "top": []}, dtype=object)
        found = best(
            asked.vec_id.to_numpy(),
            np.array(asked.vector.tolist(), dtype=np.int64).reshape(len(asked), -1),
            held.held_id.to_numpy(),
            np.array(held.held_vector.tolist(), dtype=np.int64).reshape(len(held), -1),
            k,
        )
        lowest, highest = -(2**63) + 1, 2**63 - 1
        tops = [[{"lost": -min(max(s, lowest), highest), "vec_id": i} for s, i in row] for row in found]
        return pd.DataFrame({"asked": asked.asked, "query_id": asked.vec_id, "g": key[2], "top": tops})

    lists = (
        left.groupBy("dim", "q", "g")
        .cogroup(right.groupBy("held_dim", "held_q", "held_g"))
        .applyInPandas(tile, "asked long, query_id long, g int, top array<struct<lost:long,vec_id:long>>")
    )
    while True:
        lists = lists.groupBy("asked", "query_id", F.floor(F.col("g") / FAN_IN).cast("int").alias("g")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top")
        )
        groups = -(-groups // FAN_IN)
        if groups == 1:
            break
    ranked = lists.select("query_id", F.posexplode("top").alias("at", "hit"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.lost")).alias("score")
    )


def op2_topk(spark, sf_dir: str) -> DataFrame:
    vectors = checkpointed(integer_vectors(table(spark, sf_dir, "embeddings")))
    return search(vectors.filter(F.col("vec_id") % EVERY == 0), vectors)


QUERIES = {"op2_topk": op2_topk}
ORACLES = {
    "op2_topk": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= {K}
"""
}
