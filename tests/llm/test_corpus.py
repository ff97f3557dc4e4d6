"""N-gram join, mixing, chat formatting, packing and the pipeline."""

import hashlib
import os
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from staylytics.llm import chat, components, mixing, ngram_join, packing
from staylytics.sources.lake import TABLES

ROOT = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def folded(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, width=5):
    w = folded(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def roots(n, links):
    up = list(range(n))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        up[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    links = []
    holders = {}
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders.get(g, ()))
        links += [(i, j) for j, k in common.items() if 100 * k >= 75 * (len(s) + len(sets[j]) - k)]
        for g in s:
            holders.setdefault(g, []).append(i)
    root = roots(len(rows), links)
    least = {}
    for (doc, _), r in zip(rows, root):
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((d, len(s), least.get(r)) for (d, _), s, r in zip(rows, sets, root)), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(df).collect()), key=repr)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.integers(0, len(words), edits):
            words[at] = f"e{rng.integers(1 << 30)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    out = [" ".join(word(int(n))) for n in rng.integers(1, 120, 120)]
    for n, length, edits in ((40, 90, 1), (60, 200, 4), (30, 40, 2), (25, 12, 1)):
        out += near_copies(rng, word(length), n, edits)
    passage = " ".join(word(55))
    out += [passage + " " + " ".join(word(int(n))) for n in rng.integers(3, 60, 40)]
    return out + ["a b c d", "A  B\tc d", "a b c", "a b c d e", "A B C D E", "\u00a0x y", "x"] * 3


def test_components_equal_brute_force(spark, texts):
    rows = list(enumerate(texts)) + [(9000, None), (9001, ""), (9002, " \t"), (9001, ""), (None, texts[0]), (None, "only this text here now"), (5, texts[200]), (3, texts[3])]
    df = spark.createDataFrame([(d, t, "component") for d, t in rows], "doc_id long, text string, component_id string")
    want = [(d, n, c if n else d) for d, n, c in brute_components(rows)]
    assert found(df) == sorted(want, key=repr)


def test_groups_cut_in_chunks_lose_no_link(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_WEIGHT", 3000)
    monkeypatch.setattr(ngram_join, "TASK_WEIGHT", 9000)
    monkeypatch.setattr(ngram_join, "KEYS_PER_PART", 200)
    rows = list(enumerate(texts))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_frequent_keys_are_dealt_over_parts(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_KEY", 1)
    rows = list(enumerate(texts))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_trie_walk_equals_all_pairs():
    rng = np.random.default_rng(8)
    counts = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint32)
    for _ in range(30):
        sets = []
        for _ in range(3):
            base = rng.integers(1, 1 << 60, 25).astype(np.uint64)
            sets += [np.unique(np.append(base[rng.random(25) > 0.1], rng.integers(1, 1 << 60, 2).astype(np.uint64))) for _ in range(6)]
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
        same = lambda links: [[roots(len(sets), links)[i] == roots(len(sets), links)[j] for i in range(len(sets))] for j in range(len(sets))]
        assert same(ngram_join._trie_links(sets, counts, 75, 100)) == same(pairs)


def test_empty_documents_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.ngram_components(empty).collect() == []
    assert mixing.mix_report(empty).collect() == [] and mixing.mix(empty).collect() == []
    assert packing.pack(empty).collect() == []


def test_keep_one(spark, texts):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1), (900, None, None, None, None), (901, "", None, None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    want = {d for d, n, c in brute_components([r[:2] for r in rows]) if not n or d == c}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)] + [(7, 7)]
    root = roots(3000, edges)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: least[root[i]] for e in edges if e[0] != e[1] for i in e}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", ["op2_block_topk", "op4_ngram_join", "op5_source_mix", "op6_chat"])
def test_matches_duckdb(spark, duck, key):
    plain = lambda v: round(v, 9) + 0.0 if isinstance(v, float) else v
    cursor = duck.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    got = sorted(repr([plain(r[n]) for n in names]) for r in entry.queries()[key](spark, ROOT).collect())
    assert got == sorted(repr([plain(v) for v in r]) for r in cursor.fetchall())


def test_mix_takes_rows_without_an_id_one_by_one(spark):
    rows = [(i, f"w{i} " * 10, "en", "a", 20) for i in range(40)] + [(d, f"v{i} " * 10, "en", s, 30) for i in range(40) for d, s in ((None, "b"), (7777, "c"))]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_report(df).collect()
    mixed = Counter(r["doc_id"] for r in mixing.mix(df).collect())
    for doc in (None, 7777):
        mine = [r for r in got if r["doc_id"] == doc]
        taken = sum(r["taken"] for r in mine)
        assert len(mine) == 40 and taken == 10 * mixed[doc] and abs(taken - mine[0]["target"]) <= 5


def test_mix_follows_targets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join("w" * 1 for _ in range(int(rng.integers(1, 60)))), "en", f"s{min(7, int(rng.exponential(2)))}", 0) for i in range(3000)]
    rows += [(5000, None, None, None, None), (5001, "a b", None, None, 3), (5002, "", "en", "empty", 0), (5003, "x " * 30_000, "en", "long", 0), (5001, "a b", None, None, 3)]
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "taken")
    got = mixing.mix_report(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_report(df.repartition(7)).collect()))
    sizes, largest, taken, target = Counter(), Counter(), Counter(), {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        largest[s] = max(largest[s], r["size"])
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(t <= 2 * sizes[s] for s, t in target.items())
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values())
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    count = Counter(r["doc_id"] for r in mixed.collect())
    assert all(count[r["doc_id"]] * r["size"] in (r["taken"], 2 * r["taken"]) for r in got if r["size"])


def test_chat_round_trip(spark):
    x = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", x), (1, 1, "assistant", x), (2, None, None, None), (2, 0, "a: b</turn>", "####\\h\\\\b\\l"), (2, 0, "assistant", ""), (2, 0, "assistant", ""),
            (3, 5, "assistant", "é\n</turn>\n### user: " * 3), (None, 0, "user", "q"), (None, 1, "assistant", "z" * 100_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_trees(chat.thread_nodes(df))).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        told = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_trees(chat.thread_nodes(df.limit(0))).collect() == []


def test_reply_trees_rank_branches(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "low", 0.1), (1, 3, 1, "assistant", "high", 0.9), (1, 4, 3, "user", "thanks", 0.3),
             (1, 5, 3, "user", "more", 0.3), (2, 6, 99, "user", "its parent is gone", None), (3, 7, 8, "user", "circle", 0.0), (3, 8, 7, "user", "circle", 0.0)]
    df = spark.createDataFrame(nodes, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    got = {(r["tree_id"], r["rank"]): (r["leaf_id"], [m["text"] for m in r["m"]]) for r in
           chat.format_trees(df, branches=2).withColumn("m", chat.read_back(chat.F.col("formatted"))).collect()}
    assert got == {(1, 1): (4, ["q", "high", "thanks"]), (1, 2): (5, ["q", "high", "more"]), (2, 1): (6, ["its parent is gone"])}


def plain_best_fit(pieces, capacity):
    bins = []
    for length, mask in pieces:
        open_ = [(b[0], i) for i, b in enumerate(bins) if b[0] >= length and not b[1] & mask]
        if open_:
            i = min(open_)[1]
        else:
            bins.append([capacity, 0])
            i = len(bins) - 1
        bins[i][0] -= length
        bins[i][1] |= mask
        yield i


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    rng = np.random.default_rng(seed)
    lengths = sorted(rng.integers(1, 101, 400).tolist(), reverse=True)
    masks = [(1 << int(min(s, 9))) | (1 << int(64 + c) if c < 6 else 0) for s, c in zip(rng.exponential(2, 400), rng.integers(0, 30, 400))]
    assert packing.best_fit(lengths, masks, 100) == list(plain_best_fit(zip(lengths, masks), 100))


def test_packing_keeps_all_and_its_conflicts(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 100)
    rng = np.random.default_rng(6)
    rows = [(i, f"t{rng.integers(60)} " + "w " * int(rng.integers(0, 90)), "en", f"s{min(4, int(rng.exponential(1)))}", 0) for i in range(500)]
    rows += [(600, None, None, None, None), (601, "", "en", "s0", 0), (602, "x " * 350, "en", None, 0), (602, "x " * 350, "en", None, 0)]
    got = packing.pack(spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "bin_id"), 100).collect()
    info = {r[0]: (r[1] or "", r[3]) for r in rows}
    words = Counter()
    bins = {}
    for r in got:
        words[r["doc_id"]] += r["length"]
        if r["bin_id"] is None:
            assert r["length"] == 0
        else:
            bins.setdefault(r["bin_id"], []).append(r)
    assert all(words[d] == len(WORD.findall(t)) * (2 if d == 602 else 1) for d, (t, _) in info.items())
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        assert sum(r["length"] for r in held) <= 100
        assert [r["bin_offset"] for r in held] == np.cumsum([0, *(r["length"] for r in held)])[:-1].tolist()
        assert len({info[r["doc_id"]][1] for r in held}) == len(held) == len({info[r["doc_id"]][0] for r in held})


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    seen = {r["doc_id"]: r for r in docs.collect()}
    good = corpus_pipeline.STAGES[0][1](spark, docs, ROOT)
    verdicts = {r["doc_id"]: r["predicted"] for r in entry.queries()["op9_quality"](spark, ROOT).collect()}
    left = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns and left == {d for d, p in verdicts.items() if p}
    single = corpus_pipeline.STAGES[1][1](spark, good, ROOT)
    want = {d for d, n, c in brute_components([(d, seen[d]["text"]) for d in left]) if not n or d == c}
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == want
    mixed = corpus_pipeline.STAGES[2][1](spark, single, ROOT)
    plan = {r["doc_id"]: r for r in mixing.mix_report(single).collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and all(copies[d] * r["size"] == r["taken"] for d, r in plan.items())
    packed = corpus_pipeline.STAGES[3][1](spark, mixed, ROOT).collect()
    words = Counter()
    for r in packed:
        words[r["doc_id"]] += r["length"]
    assert words == Counter({d: n * len(WORD.findall(seen[d]["text"])) for d, n in copies.items()})
    rows = lambda got: sorted(map(repr, (tuple(r) for r in got)))
    assert rows(packed) == rows(corpus_pipeline.run(spark, ROOT).collect())


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    schema = DOCS + ", score string"
    odd = [(1, None, None, None, None, None), (None, "a b c d e f", "en", None, 1, "x"), (2, "", "en", "s", 0, "x"), (3, "a b c d e f", "en", "s", 1, "x"), (3, "a b c d e f", "en", "s", 1, "x")]
    for name, rows in (("none", []), ("odd", odd)):
        root = os.path.join(tmp_path, name)
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        assert corpus_pipeline.run(spark, root).columns == ["doc_id", "piece", "start", "length", "bin_id", "bin_offset"]
        corpus_pipeline.run(spark, root).collect()
        docs = spark.read.parquet(f"{root}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            docs = stage(spark, docs, root)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            docs.collect()
