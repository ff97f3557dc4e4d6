"""Vector tables for the search operators: cleaning, shards and blocks of bounded size, pairing, and final ranks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylytics.session import settle


def usable(rows: DataFrame, zero_too: bool, one_per_id: bool = True) -> DataFrame:
    """(row, vec_id, vec): rows whose vector has only finite components; without ``zero_too`` some component is not 0.

    A null vec_id takes no part. With ``one_per_id`` the smallest vector of rows that repeat a vec_id counts, and ``row`` is the
    vec_id; else each row stands for itself and ``row`` is a number of its own, fixed once the table is stored.
    """
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    kept = rows.select(F.col("vec_id").cast("long"), vec.alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL").where(finite)
    if not zero_too:
        kept = kept.where(F.exists("vec", lambda x: x != 0))
    if not one_per_id:
        return kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec")
    return kept.groupBy("vec_id").agg(F.min("vec").alias("vec")).select(F.col("vec_id").alias("row"), "vec_id", "vec")


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors are padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def search(vectors: DataFrame, every: int, rows_a_shard: int, queries_a_block: int, find: Callable, score_type: str, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): ``find`` runs once for each shard of rows and block of queries.

    ``vectors``: row, vec_id, vec, unique in row; queries are the rows whose vec_id is divisible by ``every``.
    ``find(ids, vecs, query_rows, query_vecs, rows)`` returns flat (query_row, vec_id, score) columns, at most k rows a query.
    A task holds one shard and one block, both of bounded size at any number of rows.
    """
    vectors = settle(vectors)
    n, asked = vectors.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    shards, blocks = max(1, -(-n // rows_a_shard)), max(1, -(-asked // queries_a_block))
    queries = vectors.where(F.col("vec_id") % every == 0).withColumn("block", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(blocks)))
    held = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    left = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        if not held.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], t) for n, t in types.items()})
        width = max(max(len(x) for x in t.column("vec")) for t in (held, asked))
        queries = asked.column("row").to_numpy()
        q, v, s = find(held.column("vec_id").to_numpy(), matrix(held.column("vec"), width),
                       queries, matrix(asked.column("vec"), width), held.column("row").to_numpy())
        order = np.argsort(queries)
        query_ids = asked.column("vec_id").to_numpy()[order[np.searchsorted(queries, q, sorter=order)]]
        return pa.table({n: pa.array(c, t) for c, (n, t) in zip((q, query_ids, v, s), types.items(), strict=True)})

    types = {"query_row": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": {"double": pa.float64(), "long": pa.int64()}[score_type]}
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        run, f"query_row long, query_id long, vec_id long, score {score_type}"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row of ``scores`` (highest first, ties to the smaller id); both are matrices."""
    if scores.shape[1] > 4 * k:  # the k-th score, then all that reach it
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        ids = np.where(scores >= kth[:, None], ids, np.iinfo(np.int64).max)
        scores = np.where(scores >= kth[:, None], scores, scores.min())
    return np.lexsort((ids, -scores), axis=1)[:, :k]

