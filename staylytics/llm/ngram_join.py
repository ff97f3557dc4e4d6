"""N-gram Jaccard self-join by prefix trees, and the connected classes of its links.

1. ``profile``: every text becomes the set of its hashed word shingles; equal sets form one class. In the same pass
   each task counts shingles in a hashed table of fixed size, which gives one global order: rare first, then by hash.
2. ``_keys``: two sets that reach the threshold share one of their first ``n - ceil(t n) + 1`` elements in any global
   order, so each class is filed under those only. A frequent passage comes last and is no key.
3. ``_routes``: the classes under a key fall into runs of sizes between which a link is possible, given the place of the key
   in each set. The smallest class of a run is its pivot; members meet at the pivot instead of in pairs.
4. ``_trie_links``: the sets that meet at a pivot are stored in a compressed trie in the global order. A probe walks
   it once, adding up overlap along shared branches, and leaves a branch when the lengths that remain cannot reach the
   threshold, or when all its sets are connected with the probe already.
5. Pivot groups over ``GROUP_WEIGHT`` are cut in chunks. Once components are known, only members not connected with
   their pivot can still have links into other chunks; these are probed against every chunk, in blocks.

Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm import counters
from staylytics.llm import text as tx
from staylytics.llm.components import components
from staylytics.llm.frames import row_hash
from staylytics.session import settle

SKETCH_BITS = 20  # counters of the shingle order
KEYS_PER_PART = 400_000
HOT_KEY = 200_000  # classes under one key above which the key is dealt over several parts
MEMBER_WEIGHT = 400  # fixed weight of a set beside its length
GROUP_WEIGHT = 400_000  # weight of one chunk of a pivot group
TASK_WEIGHT = 1_000_000
FILTER_BITS = 24  # bits of the filter on identifiers whose texts are fetched


def set_class(values: np.ndarray) -> int:
    """Class of a shingle set: a 64-bit hash of the set."""
    total = np.append(tx.mix(values), tx.mix(np.array([len(values)], np.uint64)))
    return int(tx.mix(total.sum(keepdims=True, dtype=np.uint64)).view(np.int64)[0])


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-n * num // den) + 1


def _buckets(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _global_order(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.lexsort((values, counts[_buckets(values)]))


def profile(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, class, n) of all documents and rows (slice, task, counts) of the shingle counters, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            classes, sizes = [], []
            for values in tx.shingle_sets(batch.column("text"), width):
                np.add.at(counts, _buckets(values), np.uint32(1))
                classes.append(set_class(values))
                sizes.append(len(values))
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "class": pa.array(classes, pa.int64()), "n": pa.array(sizes, pa.int64()),
                "slice": none.cast(pa.int32()), "task": none.cast(pa.int32()), "counts": none.cast(pa.binary()),
            })
        table = counters.ship(counts)
        none = pa.nulls(len(table["slice"]), pa.int64())
        yield pa.RecordBatch.from_pydict({"doc_id": none, "class": none, "n": none, **table})
        tx.release()

    schema = f"doc_id long, class long, n long, {counters.SCHEMA}"
    return settle(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema))


# key, class, size of the set, and how far into the prefix the key stands (0 to 255, rounded down)
_ENTRY = np.dtype([("h", np.uint64), ("c", np.int64), ("n", np.uint32), ("at", np.uint8)])


def _keys(docs: DataFrame, shared, width: int, num: int, den: int, parts: int) -> DataFrame:
    """(part, entries): packed (key, class) entries of the prefixes of all sets, each class once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        usual = int(np.median(counts))
        held, size, seen = [], 0, set()

        def flush() -> pa.RecordBatch:
            entries = np.concatenate(held)
            over = np.maximum(counts[_buckets(entries["h"])].astype(np.int64) - usual, 0)
            salt = tx.mix(entries["c"].view(np.uint64)) % (over // HOT_KEY + 1).astype(np.uint64)
            part = (tx.mix(entries["h"] + salt) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            blobs = [x.tobytes() for x in np.split(entries[order], cuts[1:])]
            held.clear()
            return pa.RecordBatch.from_pydict({"part": pa.array(part[order][cuts], pa.int64()), "entries": pa.array(blobs, pa.binary())})

        for batch in batches:
            for values in tx.shingle_sets(batch.column("text"), width):
                if not len(values) or (own := set_class(values)) in seen:
                    continue
                seen.add(own)
                entry = np.empty(prefix_length(len(values), num, den), _ENTRY)
                entry["h"] = values[_global_order(values, counts)[: len(entry)]]
                entry["c"], entry["n"] = own, len(values)
                entry["at"] = np.arange(len(entry)) * 255 // max(1, len(entry) - 1)
                held.append(entry)
                size += len(entry)
                if size >= KEYS_PER_PART:
                    yield flush()
                    size = 0
        if held:
            yield flush()
        tx.release()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "part long, entries binary")


def _routes(keys: DataFrame, shared, num: int, den: int) -> DataFrame:
    """Distinct (pivot, class): classes in one run under a key with a smaller class, the pivot of that run."""

    def pair(table: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x.as_buffer(), _ENTRY) for x in table.column("entries")])
        e = e[np.lexsort((e["n"], e["h"]))]
        n = e["n"].astype(np.float64)
        first = np.ones(len(e), bool)
        first[1:] = e["h"][1:] != e["h"][:-1]
        over = shared.value[_buckets(e["h"])].astype(np.int64) - int(np.median(shared.value))
        dealt = over >= HOT_KEY  # such a key is spread over several parts and stays one run
        # if this key is the first that two linked sets share, what follows it in each must hold the needed overlap;
        # that bounds the size of the other set
        before = e["at"] / 255 * np.maximum(n - np.ceil(n * num / den), 0)
        largest = (num + den) / num * (n - before) - n + 0.5
        key = np.cumsum(first) * (largest.max() + n.max() + 1)
        reach = np.maximum.accumulate(largest + key)
        fresh = first.copy()
        fresh[1:] |= (n[1:] + key[1:] > reach[:-1]) & ~dealt[1:]
        pivot = np.minimum.reduceat(e["c"], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        met = pivot != e["c"]
        pairs = np.unique(np.stack([pivot[met], e["c"][met]]), axis=1)
        tops = first & dealt
        tx.release()
        return pa.table({
            "dealt": np.concatenate([np.zeros(pairs.shape[1], bool), np.ones(tops.sum(), bool)]),
            "a": np.concatenate([pairs[0], e["h"][tops].view(np.int64)]), "b": np.concatenate([pairs[1], pivot[tops]]),
        })

    found = settle(keys.groupBy("part").applyInArrow(pair, "dealt boolean, a long, b long"))
    dealt = found.where("dealt").select("a", "b").distinct()
    least = dealt.groupBy("a").agg(F.min("b").alias("pivot"))
    joined = dealt.join(least, "a").where("b <> pivot").select("pivot", F.col("b").alias("class"))
    # a member of a dealt key also has to meet the key's overall pivot, not only that of its own part
    upward = joined.select(F.col("class").alias("old"), "pivot")
    direct = found.where("NOT dealt").select(F.col("a").alias("pivot"), F.col("b").alias("class"))
    lifted = direct.join(upward, F.col("class").isNotNull() & (direct["pivot"] == upward["old"])).select(upward["pivot"], "class")
    return settle(direct.union(joined).union(lifted.where("pivot <> class")).distinct())


class Trie:
    """Compressed prefix tree over distinct ascending integer sequences, held as sorted sequences and their overlaps."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.rows = [sequences[i] for i in self.order]
        self.length = np.array([len(r) for r in self.rows])
        self.shared = np.zeros(len(self.rows), np.int64)
        for i in range(1, len(self.rows)):
            n = min(self.length[i - 1], self.length[i])
            differ = self.rows[i - 1][:n] != self.rows[i][:n]
            self.shared[i] = differ.argmax() if differ.any() else n
        self.nodes: dict[tuple[int, int], tuple] = {}

    def node(self, lo: int, hi: int) -> tuple:
        """(end of the branch, shortest, longest, children) of the subtree that holds rows lo to hi."""
        got = self.nodes.get((lo, hi))
        if got is None:
            lengths = self.length[lo:hi]
            if hi - lo == 1:
                got = (int(lengths[0]), int(lengths[0]), int(lengths[0]), ())
            else:
                gaps = self.shared[lo + 1 : hi]
                end = int(gaps.min())
                cuts = [lo, *(lo + 1 + np.flatnonzero(gaps == end)).tolist(), hi]
                got = (end, int(lengths.min()), int(lengths.max()), tuple(zip(cuts[:-1], cuts[1:], strict=True)))
            self.nodes[lo, hi] = got
        return got


def _trie_links(sets: list[np.ndarray], counts: np.ndarray, num: int, den: int, probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges between places of ``sets`` that connect whatever the threshold links.

    Without ``probes`` every set is probed; else only those marked, against the unmarked. No edge is given within a part that
    earlier edges have connected.
    """
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    rank = np.empty(len(values), np.int64)
    rank[_global_order(values, counts)] = np.arange(len(values))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    trie = Trie([np.sort(r) for r in np.split(rank[place], cuts)])
    part = np.arange(len(sets))
    role = np.zeros(len(sets), bool) if probes is None else np.asarray(probes)[trie.order]
    inside = np.zeros(len(values), bool)
    links = []
    for i, row in enumerate(trie.rows):
        if probes is not None and not role[i]:
            continue
        n = len(row)
        inside[row] = True
        stack = [(0, len(sets), 0, 0)]
        while stack:
            lo, hi, begin, overlap = stack.pop()
            if probes is None and hi <= i + 1 or (part[lo:hi] == part[i]).all():
                continue
            end, shortest, longest, children = trie.node(lo, hi)
            if den * longest < num * n or den * n < num * shortest:
                continue
            branch = trie.rows[lo][begin:end]
            overlap += int(np.count_nonzero(inside[branch]))
            left = n - int(np.searchsorted(row, branch[-1], "right")) if len(branch) else n - overlap
            # at the threshold the overlap is num / (num + den) of both lengths together
            if (num + den) * (overlap + min(left, longest - end)) < num * (n + shortest):
                continue
            if not children:
                if part[lo] != part[i] and (probes is None or not role[lo]) and den * overlap >= num * (n + end - overlap):
                    links.append((trie.order[i], trie.order[lo]))
                    part[part == part[lo]] = part[i]
                continue
            stack.extend((a, b, end, overlap) for a, b in reversed(children))
        inside[row] = False
    return links


def _may_be_wanted(wanted: DataFrame) -> Callable[[Column], Column]:
    """Condition on doc_id that holds for all of ``wanted`` and few others: a bitmap of hashed identifiers of fixed size.

    It only spares shuffling texts; the join that follows decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    words = wanted.select(F.shiftright(place, 6).alias("word"), (place % 64).cast("int").alias("bit"))
    marks = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()  # 2 ** FILTER_BITS / 64 rows at most
    bitmap = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bitmap[marks.column("word").to_numpy()] = marks.column("bits").to_numpy()
    shared = wanted.sparkSession.sparkContext.broadcast(bitmap)

    def marked(places: pa.Array) -> pa.Array:
        at = places.to_numpy()
        return pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return lambda doc_id: F.arrow_udf(marked, "boolean")(F.pmod(F.xxhash64(doc_id), F.lit(1 << FILTER_BITS)))


def _meet(docs: DataFrame, wanted: DataFrame, shared, width: int, num: int, den: int, tasks: int) -> DataFrame:
    """Edges (a, b) found where texts meet. ``wanted``: doc_id, class, pivot, chunk, probe (null: all with all)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(_may_be_wanted(wanted)(F.col("doc_id").cast("long")))
    sent = (
        texts.join(wanted.hint("shuffle_hash"), texts["doc_id"].eqNullSafe(wanted["doc_id"]))
        .select("text", "class", "pivot", "chunk", "probe")
        .withColumn("task", F.pmod(F.xxhash64("pivot", "chunk"), F.lit(tasks)))
    )

    def run(table: pa.Table) -> pa.Table:
        groups: dict[tuple, dict[int, tuple]] = {}
        counts = shared.value
        rows = zip(*(table.column(c).to_pylist() for c in ("pivot", "chunk", "class", "probe")), strict=True)
        for values, (pivot, chunk, own, probe) in zip(tx.shingle_sets(table.column("text"), width), rows, strict=True):
            if set_class(values) == own:  # else another row with the identifier of this class
                groups.setdefault((pivot, chunk), {})[own] = (values, probe)
        edges = []
        for members in groups.values():
            if len(members) > 1:
                names, probe = list(members), [m[1] for m in members.values()]
                found = _trie_links([m[0] for m in members.values()], counts, num, den, None if probe[0] is None else np.array(probe))
                edges += [(names[i], names[j]) for i, j in found]
        a, b = zip(*edges, strict=True) if edges else ((), ())
        groups.clear()
        tx.release()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return sent.groupBy("task").applyInArrow(run, "a long, b long")


def _across_chunks(groups: DataFrame, first: DataFrame, edges: DataFrame) -> DataFrame | None:
    """What is left of pivot groups in several chunks: members not connected with their pivot, against every chunk."""
    cut = groups.where("chunks > 1")
    if cut.isEmpty():
        return None
    roots = components(edges)
    own, top = roots.toDF("class", "own"), roots.toDF("pivot", "top")
    apart = cut.join(own, "class", "left").join(top, "pivot", "left")
    apart = apart.where("class <> pivot AND coalesce(own, class) <> coalesce(top, pivot)").select("pivot", "class", "chunks", "n")
    apart = settle(apart.distinct())
    blocks = apart.groupBy("pivot").agg(F.ceil(F.sum(F.col("n") + MEMBER_WEIGHT) / GROUP_WEIGHT).cast("long").alias("blocks"))
    apart = apart.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), F.col("blocks")))
    probes = apart.select("pivot", "class", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "block", F.lit(True).alias("probe"))
    held = cut.join(blocks, "pivot").select("pivot", "class", "chunk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("probe"))
    both = probes.union(held).groupBy("pivot", "chunk", "block", "class").agg(F.min("probe").alias("probe"))
    return both.withColumn("chunk", F.xxhash64("chunk", "block")).drop("block").join(first, "class")


def ngram_components(docs: DataFrame, width: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Links are pairs with ``den * |A and B| >= num * |A or B|`` over distinct ``width``-word shingles, A-Z lower-cased;
    component_id is the smallest doc_id reachable by links. A text with fewer words has one shingle, all its words. A
    null text, or one without words, has none, and is its own component. Rows that repeat a doc_id are documents of
    their own and share that number; a null doc_id takes part and is never the smallest.
    """
    spark = docs.sparkSession
    seen = profile(docs, width)
    rows = seen.where("slice IS NULL").select("doc_id", "class", "n")
    shared = spark.sparkContext.broadcast(counters.added(seen.where("slice IS NOT NULL").select("slice", "task", "counts"), 1 << SKETCH_BITS))  # 2 ** SKETCH_BITS counters
    classes = settle(rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")))
    kept = F.col("n") - F.ceil(F.col("n") * num / den) + 1
    total = classes.agg(F.sum(kept)).first()[0] or 0
    parts = max(64, -(-int(total) // KEYS_PER_PART))
    routes = _routes(_keys(docs, shared, width, num, den, parts), shared, num, den)

    pivots = routes.select("pivot").distinct()
    members = settle(routes.union(pivots.select("pivot", F.col("pivot").alias("class"))).join(classes.select("class", "n"), "class"))
    weight = members.groupBy("pivot").agg(F.sum(F.col("n") + MEMBER_WEIGHT).alias("w"))
    chunks = F.ceil(F.col("w") / GROUP_WEIGHT).cast("long")
    # few groups need more than one chunk; all others go on without being placed by their pivot
    large = settle(weight.select("pivot", chunks.alias("chunks")).where("chunks > 1"))
    one = F.coalesce("chunks", F.lit(1).cast("long"))
    groups = settle(
        members.join(large, "pivot", "left").withColumn("chunks", one).withColumn(
            "chunk",
            F.explode(
                F.when(F.col("class") == F.col("pivot"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
                    F.array(F.pmod(F.xxhash64("class"), F.col("chunks")))
                )
            ),
        )
    )
    first = classes.select("class", "doc_id")
    tasks = max(64, int((groups.agg(F.sum(F.col("n") + MEMBER_WEIGHT)).first()[0] or 0) // TASK_WEIGHT) + 1)
    wanted = settle(groups.select("class", "pivot", "chunk", F.lit(None).cast("boolean").alias("probe")).join(first, "class"))
    edges = settle(_meet(docs, wanted, shared, width, num, den, tasks))
    rest = _across_chunks(groups, first, edges)
    if rest is not None:
        rest = settle(rest)
    if rest is not None and not rest.isEmpty():
        tasks = max(64, int(rest.join(classes.select("class", "n"), "class").agg(F.sum(F.col("n") + MEMBER_WEIGHT)).first()[0] or 0) // TASK_WEIGHT + 1)
        edges = edges.union(_meet(docs, rest, shared, width, num, den, tasks))

    roots = components(edges).withColumnRenamed("node", "class")
    named = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    table = settle(named.join(least, "root").select("class", "component_id"))
    return (
        rows.withColumn("class", F.when(F.col("n") > 0, F.col("class")))
        .join(table, "class", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def keep_one(docs: DataFrame, width: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """``docs`` without all but one document of each component: the one with the smallest doc_id stays.

    Rows equal in doc_id and text count as one. Rows that repeat a doc_id with other texts go only if none of them is
    the smallest of its component. Rows with a null doc_id cannot be told apart and stay. Other columns may have any
    name and type; of rows equal in doc_id and text the one with the smallest hash stays.
    """
    found = ngram_components(docs, width, num, den)
    gone = found.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone").select("doc_id")
    left = docs.join(gone, "doc_id", "left_anti")
    twice = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    if twice.isEmpty():
        return left
    repeated = left.join(twice, "doc_id", "left_semi")
    once = repeated.groupBy("doc_id", "text").agg(F.min_by(F.struct("*"), row_hash(repeated)).alias("row")).select("row.*")
    return left.join(twice, "doc_id", "left_anti").unionByName(once)
