"""Vector searches against brute force, with unusable, repeated and tied vectors."""

import numpy as np
import pytest

import __spark_entry__ as entry
from staylytics.llm import block_topk, vptree

SCHEMA = "vec_id long, embedding array<float>, score string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    data = [(i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(size=12))], "x") for i in range(900)]
    data[40] = (40, data[20][1], "same vector as a query")
    data[41] = (41, data[20][1], "and once more")
    return data


def usable(rows, zero_too):
    out = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not zero_too and not any(v):
            continue
        v = list(v) + [0.0] * (12 - len(v))
        out[i] = min(out.get(i, v), v)
    return list(out), np.array(list(out.values()), float)


def best(ids, vecs, every, k):
    out = {}
    for q, i in enumerate(ids):
        if i % every == 0:
            s = vecs @ vecs[q]
            order = sorted((j for j in range(len(ids)) if j != q), key=lambda j: (-s[j], ids[j]))[:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


ODD = [
    (2000, None, "null"), (2020, [0.0] * 12, "zero"), (2040, [1.0, None] + [0.0] * 10, "null part"), (2060, [float("nan")] + [1.0] * 11, "nan"),
    (2080, [float("inf")] + [1.0] * 11, "infinite"), (2100, [5.0, 1.0], "short"), (None, [1.0] * 12, "no id"), (20, [90.0] * 12, "repeated id"),
]


@pytest.mark.parametrize("extra", [[], ODD])
def test_tree_search_is_exact_at_factor_one_and_close_by_default(spark, rows, extra, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF", 16)
    monkeypatch.setattr(vptree, "SHARD_ROWS", 200)
    df = spark.createDataFrame(rows + extra, SCHEMA)
    ids, vecs = usable(rows + extra, False)
    want = best(ids, vecs, 20, 20)

    def found(factor):
        out = {}
        for r in sorted(vptree.nearest(df, factor=factor).collect(), key=lambda r: (r["query_id"], r["rank"])):
            out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        return out

    exact, usual = found(1.0), found(4.0)
    assert {k: [x for x, _ in v] for k, v in exact.items()} == {k: [x for x, _ in v] for k, v in want.items()}
    assert all(np.allclose([s for _, s in exact[k]], [s for _, s in want[k]]) for k in want)
    hits = sum(len({x for x, _ in usual[k]} & {x for x, _ in v}) for k, v in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("extra", [[], ODD])
def test_block_search_is_exact(spark, rows, extra, monkeypatch):
    monkeypatch.setattr(block_topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(block_topk, "SHARD_ROWS", 200)
    ids, vecs = usable(rows + extra, True)
    want = best(ids, np.floor(1024 * vecs).astype(np.int64), 20, 10)
    got = {}
    for r in sorted(block_topk.top_k(spark.createDataFrame(rows + extra, SCHEMA), 20).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == want


def test_large_components_stay_exact():
    q, r = np.array([[2.0**52, 3.0], [1e300, -1.0]]), np.array([[2.0**10, 1.0], [7.0, 2.0**40]])
    exact = [[int(a[0]) * int(b[0]) + int(a[1]) * int(b[1]) for b in r] for a in q]
    assert block_topk.products(q, r).tolist() == [[max(-(2**63), min(2**63 - 1, x)) for x in row] for row in exact]


def test_few_rows_and_empty_tables(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], "x")], SCHEMA)
    for search in (vptree.nearest, block_topk.top_k):
        assert search(one).collect() == []
        assert search(one.limit(0)).collect() == []
    two = spark.createDataFrame([(0, [1.0, 2.0], "x"), (3, [1.0, 1.0], "x")], SCHEMA)
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vptree.nearest(two).collect()] == [(0, 1, 3, 3.0)]


def test_recall_on_the_embeddings_table(spark):
    root = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{root}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vecs = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    want = best(ids, vecs, 20, 20)
    got = {}
    for r in entry.queries()["op1_vptree"](spark, root).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert got.keys() == want.keys()
    assert sum(len(got[k] & {x for x, _ in v}) for k, v in want.items()) >= 0.99 * sum(map(len, want.values()))


def test_copies_of_a_vector_rank_by_id_in_every_shard(spark, monkeypatch):
    """Equal vectors must get equal scores, wherever they stand in a matrix."""
    monkeypatch.setattr(vptree, "SHARD_ROWS", 700)
    rng = np.random.default_rng(11)
    data = rng.normal(size=(1500, 64)).astype(np.float32)
    copies = rng.choice(1500, 400, replace=False)
    data[copies] = data[copies[0]]
    df = spark.createDataFrame([(i, [float(x) for x in v], "x") for i, v in enumerate(data)], SCHEMA)
    vecs = data.astype(float)
    got = {}
    for r in sorted(vptree.nearest(df, every=5, factor=1.0).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for q in range(0, 1500, 5):
        s = np.zeros(1500)
        for k in range(64):
            s += vecs[q, k] * vecs[:, k]
        order = sorted((j for j in range(1500) if j != q), key=lambda j: (-s[j], j))[:20]
        assert got[q] == [(j, s[j]) for j in order]


@pytest.mark.parametrize("seed", range(20))
def test_ties_inside_a_shard(seed):
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(1500, 64))
    copies = rng.choice(1500, 400, replace=False)
    vecs[copies] = vecs[copies[0]]
    ids = np.arange(1500)
    queries = np.arange(0, 1500, 20)
    q, v, s = vptree.find(ids, vecs, queries, vecs[queries], 20, 1.0)
    for query in queries:
        score = np.zeros(1500)
        for k in range(64):
            score += vecs[query, k] * vecs[:, k]
        order = sorted((j for j in range(1500) if j != query), key=lambda j: (-score[j], j))[:20]
        assert v[q == query].tolist() == order and s[q == query].tolist() == score[order].tolist()
