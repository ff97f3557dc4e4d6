"""The registered searches on vectors that lie otherwise than those of the embeddings table."""

import numpy as np
import pytest

from staylytics.llm import block_topk, vptree

RNG = np.random.default_rng(3)
TABLES = {
    "uneven lengths": RNG.normal(size=(1500, 32)) * RNG.lognormal(size=(1500, 1)),
    "one orthant": RNG.uniform(size=(1500, 16)),
    "no clusters": RNG.normal(size=(1500, 64)),
}


@pytest.mark.parametrize("name", TABLES)
def test_tree_search_finds_the_nearest_of_any_vectors(spark, name):
    vecs = TABLES[name]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(vptree.nearest(df).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in range(0, len(vecs), 20):
        s = np.zeros(len(vecs))
        for k in range(vecs.shape[1]):
            s += vecs[q, k] * vecs[:, k]
        assert got[q] == sorted((j for j in range(len(vecs)) if j != q), key=lambda j: (-s[j], j))[:20]


def test_rows_that_repeat_an_id_are_all_candidates(spark):
    """Every row but the query's own is a candidate of the registered searches."""
    vecs = RNG.normal(size=(300, 8)).astype(np.float32)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    data += [data[7], data[7], (9, [float(x) for x in 3 * vecs[0]]), data[100]]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    ids, held = [i for i, _ in data], np.floor(1024 * np.array([v for _, v in data]))
    want = []
    for q, i in enumerate(ids):
        if i % 100 == 0:
            s = (held @ held[q]).astype(np.int64)
            order = sorted((j for j in range(len(ids)) if j != q), key=lambda j: (-s[j], ids[j]))[:10]
            want += [(i, rank, ids[j], int(s[j])) for rank, j in enumerate(order, 1)]
    assert sorted(map(tuple, block_topk.top_k(df, one_per_id=False).collect())) == sorted(want)
    near = vptree.nearest(df, one_per_id=False).where("query_id = 0").collect()
    dots = np.array([v for _, v in data], float) @ vecs[0].astype(float)
    order = sorted((j for j in range(len(ids)) if j != 0), key=lambda j: (-dots[j], ids[j]))[:20]
    assert [r["vec_id"] for r in sorted(near, key=lambda r: r["rank"])] == [ids[j] for j in order]


def test_bounds_hold_where_large_terms_cancel_out():
    """A block whose terms cancel out has a bound near 0 with an error of the size of the terms."""
    for seed in range(200):
        rng = np.random.default_rng(seed)
        query = rng.integers(-(2**40), 2**40, size=(1, 12)) / 1024.0
        base = rng.integers(-(2**40), 2**40, size=12) / 1024.0
        base = base - query[0] * (base @ query[0]) / (query[0] @ query[0])
        vecs = np.vstack([np.repeat(base[None] + i, 256, 0) * [1] for i in range(4)])
        vecs = np.vstack([query, vecs])
        ids = np.arange(len(vecs))
        whole = [[int(x) for x in np.floor(1024 * v)] for v in vecs]
        s = [max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[0], w)))) for w in whole]
        order = sorted(range(1, len(vecs)), key=lambda j: (-s[j], j))[:10]
        assert block_topk.find(ids, vecs, ids[:1], vecs[:1], 10)[1].tolist() == order
