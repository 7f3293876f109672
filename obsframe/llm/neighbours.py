"""Nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A table rotates unit vectors by three rounds of random signs and a Hadamard transform and
assigns each to the nearest signed axis of the rotated space: one of twice the (padded)
dimension. A query looks into the buckets of its ``PROBES`` nearest signed axes (an eighth of
the padded dimension, 4 at least) in each of ``TABLES`` tables; what it meets there is
reranked by the cosine in double precision.

Rows are dealt at random into blocks of about ``BLOCK_FACTOR`` times the square root of their
number, each with tables of its own; queries meet each block in blocks of ``QUERY_BLOCK``. So
a bucket, or a group of equal vectors, never gathers in one task, every row is indexed, and a
task holds one block of each. A query's best of each block are merged by a window that keeps
``k`` rows a query.

The rotations come from a fixed seed and do not depend on the data. A query that meets fewer
than ``k`` rows of a block reranks the whole block, so none is left with too few.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components, and
rows without an id, take no part; vectors of different lengths are not compared; equal scores
go by the smaller id; rows that repeat an id count once, with their best score, and never as
their own neighbour; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLES = 16
SEED = 20_240_229
BLOCK_FACTOR = 16
LEAST_BLOCK, LARGEST_BLOCK = 2048, 1 << 18
QUERY_BLOCK = 1 << 13


def padded(dimension: int) -> int:
    return max(2, 1 << (dimension - 1).bit_length())


def probes(dimension: int) -> int:
    return min(2 * padded(dimension), max(4, padded(dimension) // 8))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; the number of columns is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, table: int) -> np.ndarray:
    """One pseudo-rotation: three rounds of random signs and a transform."""
    size = padded(unit.shape[1])
    signs = np.random.default_rng((SEED, table)).choice((-1.0, 1.0), (3, size))
    x = np.pad(unit, ((0, 0), (0, size - unit.shape[1])))
    for round_signs in signs:
        x = hadamard(x * round_signs)
    return x


def nearest_axes(x: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of every row: 0 to n-1, and n more for the negative ones."""
    sides = np.hstack([x, -x])
    if count == 1:
        return sides.argmax(axis=1)[:, None]
    return np.argpartition(-sides, count - 1, axis=1)[:, :count]


def _scaled(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The vectors, and their lengths; extreme ones are first brought to a size that can be squared."""
    x = np.array(vectors.tolist(), np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)
    x = np.where((top > 1e100) | (top < 1e-100), x / top, x)
    return x, np.sqrt((x * x).sum(axis=1))


def _searcher(k: int, tables: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(queries) and len(rows):
            q, q_length = _scaled(queries["vector"])
            x, x_length = _scaled(rows["vector"])
            q_unit, x_unit = q / q_length[:, None], x / x_length[:, None]
            q_ids, ids = queries["vec_id"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
            count = probes(q.shape[1])
            buckets = [nearest_axes(rotated(x_unit, t), 1)[:, 0] for t in range(tables)]
            probed = [nearest_axes(rotated(q_unit, t), count) for t in range(tables)]
            asked = np.zeros(2 * padded(q.shape[1]), bool)
            repeats = len(np.unique(ids)) < len(ids)
            for n in range(len(q)):
                met = np.zeros(len(x), bool)
                for t in range(tables):
                    asked[probed[t][n]] = True
                    met |= asked[buckets[t]]
                    asked[probed[t][n]] = False
                own = ids == q_ids[n]
                if np.count_nonzero(met & ~own) < k or repeats:
                    met[:] = True
                place = np.flatnonzero(met & ~own)
                if len(place) > k and not repeats:
                    near = x_unit[place] @ q_unit[n]
                    least = np.partition(near, len(near) - k)[len(near) - k]
                    place = place[near >= least - 1e-9]  # the exact scores decide among these
                score = (x[place] * q[n]).sum(axis=1) / (x_length[place] * q_length[n])
                seen: set[int] = set()
                for at in np.lexsort((ids[place], -score)):
                    if len(seen) == k:
                        break
                    if ids[place[at]] not in seen:
                        seen.add(ids[place[at]])
                        found.append((q_ids[n], ids[place[at]], score[at]))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
    return search


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, tables: int = TABLES, vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found of every query row."""
    rows = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks")).where(
        F.col("vec_id").isNotNull()).where(usable(F.col("vector"))).withColumn("dimension", F.size("vector"))
    n, asking = rows.agg(F.count("*"), F.count_if(F.col("asks"))).first()
    held = min(max(LEAST_BLOCK, int(BLOCK_FACTOR * n ** 0.5)), LARGEST_BLOCK)
    row_blocks, query_blocks = max(1, -(-n // held)), max(1, -(-asking // QUERY_BLOCK))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    key = ["dimension", "row_block", "query_block"]
    indexed = rows.select("dimension", dealt(row_blocks).alias("row_block"), "vec_id", "vector").withColumn(
        "query_block", every(query_blocks))
    asked = rows.where("asks").select("dimension", dealt(query_blocks).alias("query_block"), "vec_id", "vector").withColumn(
        "row_block", every(row_blocks))
    parts = asked.groupBy(*key).cogroup(indexed.groupBy(*key)).applyInPandas(
        _searcher(k, tables), "query_id bigint, vec_id bigint, score double")
    best = parts.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
