"""Exact top-k by integer inner product: document-range blocks in the order of their score bounds.

Rows of a shard are put in document order by their largest component and cut into ranges of ``BLOCK_ROWS``. A block
keeps the maximum and minimum of each term (component). Query weight times the better of both, summed over the terms,
bounds every score in the block. A query takes its blocks in the order of these bounds and scores their rows through the
block's forward index (its rows as a matrix), until the next bound is below its k-th score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from staylytics.llm import vectors as vs

SCALE = 1024
BLOCK_ROWS = 256
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
_EXACT = float(1 << 53)  # integers below this are exact in double precision
_LONG = (1 << 63) - 1


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued matrices as long, held at the ends of its range."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    if float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1] < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(queries).astype(object) @ whole(rows).astype(object).T
    return np.clip(exact, -_LONG - 1, _LONG).astype(np.int64)


def find(ids: np.ndarray, vecs: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int, numbers: np.ndarray | None = None) -> tuple:
    """The k best rows of one shard for each query, as flat (query_row, vec_id, score).

    ``query_rows`` tells which row of the shard is the query's own, by its number in ``numbers`` (by its id without them).
    """
    numbers = ids if numbers is None else numbers
    rows, queries = np.floor(SCALE * vecs), np.floor(SCALE * queries)
    order = np.lexsort((ids, rows.argmax(1) if rows.shape[1] else ids))
    rows, ids, numbers = rows[order], ids[order], numbers[order]
    cuts = np.arange(0, len(rows), BLOCK_ROWS)
    high, low = np.maximum.reduceat(rows, cuts), np.minimum.reduceat(rows, cuts)
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    # rounding only ever adds blocks; large terms that cancel out leave errors of their own size
    bound += np.abs(queries) @ np.maximum(np.abs(high), np.abs(low)).T * 1e-9 + 1
    turns = np.argsort(-bound, axis=1, kind="stable")
    score = np.zeros((len(queries), k), np.int64)
    best = np.full((len(queries), k), -1, np.int64)
    filled = np.zeros(len(queries), np.int64)
    for turn in range(len(cuts)):
        block = turns[:, turn]
        active = np.flatnonzero((filled < k) | (bound[np.arange(len(queries)), block] >= score[:, -1]))
        if not len(active):
            break
        active = active[np.argsort(block[active], kind="stable")]
        for part in np.split(active, np.flatnonzero(np.diff(block[active])) + 1):
            span = slice(cuts[block[part[0]]], cuts[block[part[0]]] + BLOCK_ROWS)
            found = products(queries[part], rows[span])
            for i, dots in zip(part, found, strict=True):
                other = numbers[span] != query_rows[i]
                if filled[i] == k:
                    other &= dots >= score[i, -1]
                if not other.any():
                    continue
                all_scores = np.concatenate([score[i, : filled[i]], dots[other]])
                all_ids = np.concatenate([best[i, : filled[i]], ids[span][other]])
                chosen = np.lexsort((all_ids, ~all_scores))[:k]
                filled[i] = len(chosen)
                score[i, : filled[i]], best[i, : filled[i]] = all_scores[chosen], all_ids[chosen]
    hit = np.arange(k) < filled[:, None]
    return np.repeat(query_rows, filled), best[hit], score[hit]


def top_k(rows: DataFrame, every: int = 100, k: int = 10, one_per_id: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``rows`` (vec_id, embedding) whose vec_id is divisible by ``every``.

    Components x become floor(1024 x); the score is the integer inner product, exact, held within long. Candidates are
    all rows but the query's own, ties go to the smaller vec_id. Null vectors and those with a null or non-finite
    component take no part; a shorter vector counts as padded with zeros; of rows that repeat a vec_id the smallest
    vector counts, or without ``one_per_id`` each row is a candidate, and a query if its vec_id says so. With fewer than k
    candidates all are returned.
    """

    def run(ids: np.ndarray, vecs: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, numbers: np.ndarray) -> tuple:
        return find(ids, vecs, query_rows, queries, k, numbers)

    return vs.search(vs.usable(rows, zero_too=True, one_per_id=one_per_id), every, SHARD_ROWS, BLOCK_QUERIES, run, "long", k)
