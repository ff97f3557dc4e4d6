"""Nearest neighbours by inner product: a vantage-point tree for each shard.

Inner product becomes a metric by one more component: rows of a shard get sqrt(M^2 - |x|^2), M the largest norm, queries
get 0; then |q - x|^2 = |q|^2 + M^2 - 2 q.x. A tree splits its rows at the median distance from a vantage point, down
to leaves of ``LEAF`` rows. For a query the triangle inequality bounds its distance to each leaf from below; leaves are
visited in the order of these bounds until ``factor`` times the bound exceeds the distance of the k-th row found.
Factor 1, the default, is exact; a larger one skips leaves whose bound is within that factor of the k-th distance, and how
much that misses depends on the vectors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from staylytics.llm import vectors as vs

LEAF = 256
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
SLACK = 1e-9  # rounding allowance of the bounds


class Tree:
    """Leaves (places of rows), vantage points, and for each leaf the distance range seen from each vantage above it."""

    def __init__(self, points: np.ndarray) -> None:
        self.vantage: list[np.ndarray] = []
        self.leaves: list[np.ndarray] = []
        self.above: list[list[tuple[int, float, float]]] = []
        stack: list[tuple[np.ndarray, list]] = [(np.arange(len(points)), [])]
        while stack:
            rows, path = stack.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                self.above.append(path)
                continue
            # the row farthest from the first one lies at the edge of the set, which spreads distances best
            start = points[rows] - points[rows[0]]
            centre = points[rows[int((start * start).sum(1).argmax())]]
            apart = points[rows] - centre
            distance = np.sqrt((apart * apart).sum(1))
            order = np.argsort(distance, kind="stable")
            half = len(rows) // 2
            for part in (order[half:], order[:half]):
                stack.append((rows[part], [*path, (len(self.vantage), distance[part].min(), distance[part].max())]))
            self.vantage.append(centre)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Lower bound of the distance of each query to each leaf."""
        out = np.zeros((len(queries), len(self.leaves)))
        if not self.vantage:
            return out
        v = np.array(self.vantage)
        d = np.sqrt(np.maximum((queries * queries).sum(1)[:, None] + (v * v).sum(1) - 2 * queries @ v.T, 0))
        for leaf, path in enumerate(self.above):
            for i, near, far in path:
                np.maximum(out[:, leaf], np.maximum(near - d[:, i], d[:, i] - far), out=out[:, leaf])
        return out


def fixed_dots(queries: np.ndarray, vecs: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of ``queries[q]`` and ``vecs[v]``, pair by pair, each added up from the first component to the last.

    Matrix products add in an order that depends on where a row stands, so equal vectors could differ in the last bit.
    """
    out = np.zeros(len(q))
    for k in range(queries.shape[1]):
        out += queries[q, k] * vecs[v, k]
    return out


def find(
    ids: np.ndarray, vecs: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int, factor: float, numbers: np.ndarray | None = None
) -> tuple:
    """The k rows of one shard found nearest to each query, as flat (query_row, vec_id, score).

    ``query_rows`` tells which row of the shard is the query's own, by its number in ``numbers`` (by its id without them).
    Matrix products sort out what cannot be among the k; the rest is scored in one fixed order of addition.
    """
    numbers = ids if numbers is None else numbers
    norms = (vecs * vecs).sum(1)
    largest = norms.max()
    points = np.column_stack([vecs, np.sqrt(np.maximum(largest - norms, 0))])
    tree = Tree(points)
    bound = tree.bounds(np.column_stack([queries, np.zeros(len(queries))]))
    lengths = (queries * queries).sum(1)
    reach, rounding = lengths + largest, SLACK * np.sqrt(lengths * largest)
    order = np.argsort(bound, axis=1, kind="stable")
    score = np.full((len(queries), k), -np.inf)
    best = np.full((len(queries), k), np.iinfo(np.int64).max)
    for turn in range(len(tree.leaves)):
        leaf = order[:, turn]
        radius = np.sqrt(np.maximum(reach - 2 * score[:, -1], 0))
        low = bound[np.arange(len(queries)), leaf]
        active = np.flatnonzero(low * factor <= radius * (1 + SLACK) + SLACK)
        if not len(active):
            break
        active = active[np.argsort(leaf[active], kind="stable")]
        for part in np.split(active, np.flatnonzero(np.diff(leaf[active])) + 1):
            rows = tree.leaves[leaf[part[0]]]
            dots = queries[part] @ vecs[rows].T
            own = query_rows[part][:, None] == numbers[rows]
            dots[own] = -np.inf
            floor = score[part, -1]
            if len(rows) > k:
                floor = np.maximum(floor, -np.partition(-dots, k - 1, axis=1)[:, k - 1])
            near = (dots >= (floor - rounding[part])[:, None]) & ~own
            better = near.any(1)
            part, near = part[better], near[better]
            if not len(part):
                continue
            q, v = np.nonzero(near)
            exact = np.full(near.shape, -np.inf)
            exact[q, v] = fixed_dots(queries, vecs, part[q], rows[v])
            all_scores = np.concatenate([score[part], exact], axis=1)
            all_ids = np.concatenate([best[part], np.where(near, ids[rows], np.iinfo(np.int64).max)], axis=1)
            chosen = vs.top(all_scores, all_ids, k)
            score[part] = np.take_along_axis(all_scores, chosen, 1)
            best[part] = np.take_along_axis(all_ids, chosen, 1)
    hit = score > -np.inf
    return np.repeat(query_rows, hit.sum(1)), best[hit], score[hit]


def nearest(rows: DataFrame, every: int = 20, k: int = 20, factor: float = 1.0, one_per_id: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``rows`` (vec_id, embedding) whose vec_id is divisible by ``every``.

    Candidates are all rows but the query's own; score is the inner product in double precision of the original
    vectors, highest first, ties to the smaller vec_id. Null vectors, zero vectors and vectors with a null or
    non-finite component take no part; a shorter vector counts as padded with zeros; of rows that repeat a vec_id the
    smallest vector counts, or without ``one_per_id`` each row is a candidate, and a query if its vec_id says so. With fewer
    than k candidates all are returned.
    """

    def run(ids: np.ndarray, vecs: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, numbers: np.ndarray) -> tuple:
        return find(ids, vecs, query_rows, queries, k, factor, numbers)

    return vs.search(vs.usable(rows, zero_too=False, one_per_id=one_per_id), every, SHARD_ROWS, BLOCK_QUERIES, run, "double", k)
