"""Exact top-k by inner product: query tiles times vector shards, merged as a tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EXACT = 2**53


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, q: floor(scale * x) per component. Vectors that are null, or hold null or non-finite components, are left out."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(sound).select(
        F.col("vec_id").cast("long"), x.alias("q")
    )


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows packed within their partition into (dims, ids, matrix) blocks of at most `rows` vectors of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lengths = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths):
                own = np.flatnonzero(lengths == dims)
                matrix = batch.column(1).take(pa.array(own)).flatten().to_numpy(zero_copy_only=False)
                matrix = matrix.reshape(len(own), dims).astype("<i8")
                for s in range(0, len(own), rows):
                    part = slice(s, s + rows)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "dims": pa.array([int(dims)], pa.int32()),
                            "ids": [ids[own[part]].astype("<i8").tobytes()],
                            "matrix": [matrix[part].tobytes()],
                        }
                    )

    return vectors.mapInArrow(run, "dims int, ids binary, matrix binary")


def _product(q: np.ndarray, c: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Integer inner products; in float64 where every sum is exact there, else in Python's integers.

    `own` marks a query's own row, whose product is not asked for. A score beyond 64 bits is an error.
    """
    if not q.shape[1]:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    bound = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(c.astype(float)).max(initial=0)) * q.shape[1]
    if bound < EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return np.where(own, 0, q.astype(object) @ c.astype(object).T).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of each row's k best scores, ties to the smaller id; a query's own row is left out."""
    hidden = np.iinfo(np.int64).min
    score = np.where(ids[None, :] == own[:, None], hidden, score)
    if score.shape[1] > k:
        bar = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        row, col = np.nonzero(score >= bar[:, None])
    else:
        row, col = np.nonzero(np.ones(score.shape, dtype=bool))
    keep = score[row, col] != hidden
    row, col = row[keep], col[keep]
    order = np.lexsort((ids[col], -score[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, row, side="left")
    top = np.arange(len(row)) - start < k
    return row[top], col[top]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    query_tile: int = 512,
    shard: int = 8192,
    lanes: int | None = None,
    fan: int = 64,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best vectors, all of them compared.

    `vectors` and `queries` have vec_id and q (see `quantised`). Vectors are packed into
    shards where they lie; query tiles are copied to every lane and meet the shards dealt to
    that lane, so each (tile, shard) pair is one matrix product in one task, of bounded size.
    Only k rows per query and pair leave it; they merge lane by lane, then over all lanes.
    Only vectors of equal length meet. A vec_id that comes twice as a query counts once (the
    lesser vector); as candidates repeated rows each take part. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    lanes = lanes or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    shards = _blocks(vectors, shard).withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
    tiles = _blocks(asked, query_tile).select(
        "dims", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"),
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"),
    )
    pairs = shards.join(tiles, ["lane", "dims"]).select("lane", "dims", "q_ids", "q_matrix", "ids", "matrix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lane, dims, q_ids, q_matrix, ids, matrix in zip(*(c.to_pylist() for c in batch.columns)):
                own, all_ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                q = np.frombuffer(q_matrix, "<i8").reshape(len(own), dims)
                c = np.frombuffer(matrix, "<i8").reshape(len(all_ids), dims)
                score = _product(q, c, all_ids[None, :] == own[:, None])
                row, col = _best(score, all_ids, own, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), lane, np.int32)), pa.array(own[row]), pa.array(all_ids[col]), pa.array(score[row, col])],
                    ["lane", "query_id", "vec_id", "score"],
                )

    best = pairs.mapInArrow(run, "lane int, query_id long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id")]
    # the tree: a query's lists of neighbouring lanes first, then the few that are left
    near = Window.partitionBy("query_id", F.pmod("lane", F.lit(fan))).orderBy(*order)
    best = best.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k)
    last = Window.partitionBy("query_id").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
