"""Best-fit packing of documents into sequences of fixed length, under conflicts.

Two pieces conflict if they share a source or a cluster of duplicates. Pieces are dealt over shards of bounded size by
hash; in a shard, longest piece first, each goes to the tightest bin that has room and no conflict. Bins are kept by
residual; each carries a bitmap of source and cluster slots. For each slot the shard counts the bins of every residual
that lack it, so the successor search steps only over residuals where a compatible bin can be.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm.mixing import word_count
from staylytics.session import settle

SLOTS = 64  # bitmap slots for sources, and as many for clusters; the more frequent have one alone, the rest share
SHARD_PIECES = 4096


def slots(names: list, first: int, alone: int) -> list[int]:
    """Slot of each name: the ``SLOTS`` - 1 most frequent have their own, later ones share; -1 below ``alone`` uses."""
    uses = Counter(names)
    ranked = sorted((k for k, n in uses.items() if n >= alone), key=lambda k: (-uses[k], str(k)))
    place = {k: first + (r if r < SLOTS - 1 else SLOTS - 1) for r, k in enumerate(ranked)}
    return [place.get(k, -1) for k in names]


def best_fit(lengths: list[int], masks: list[int], capacity: int) -> list[int]:
    """Bin of each piece, in the given order. ``masks``: the piece's slots as bits.

    A piece goes to the compatible bin with the smallest residual that holds it, the oldest of several, else to a new one.
    """
    width = 2 * SLOTS
    lacking = np.zeros((width, capacity + 1), np.int32)
    groups: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
    bits = np.arange(width)

    def count(mask: int, residual: int, step: int) -> None:
        free = np.array([not mask >> b & 1 for b in bits.tolist()]) if mask else slice(None)
        lacking[free, residual] += step

    out, opened = [], 0
    for length, need in zip(lengths, masks, strict=True):
        wanted = [b for b in range(width) if need >> b & 1]
        open_ = lacking[wanted or [0], length:].min(axis=0) > 0 if wanted else np.array([bool(g) for g in groups[length:]])
        for residual in (np.flatnonzero(open_) + length).tolist():
            fits = [(ids[0], mask) for mask, ids in groups[residual].items() if not mask & need]
            if fits:
                chosen, mask = min(fits)
                heapq.heappop(groups[residual][mask])
                if not groups[residual][mask]:
                    del groups[residual][mask]
                count(mask, residual, -1)
                break
        else:
            chosen, mask, residual = opened, 0, capacity
            opened += 1
        residual, mask = residual - length, mask | need
        heapq.heappush(groups[residual].setdefault(mask, []), chosen)
        count(mask, residual, 1)
        out.append(chosen)
    return out


def _pack_shard(table: pa.Table, capacity: int) -> pa.Table:
    columns = {c: table.column(c).to_pylist() for c in table.column_names}
    order = sorted(
        range(table.num_rows),
        key=lambda i: (-columns["length"][i], columns["cluster"][i], columns["piece"][i], columns["doc_id"][i] is None, columns["doc_id"][i] or 0),
    )
    source = slots(columns["source"], 0, 1)
    cluster = slots(columns["cluster"], SLOTS, 2)
    masks = [(1 << source[i]) | (1 << cluster[i] if cluster[i] >= 0 else 0) for i in order]
    bins = best_fit([columns["length"][i] for i in order], masks, capacity)
    filled: Counter = Counter()
    at = []
    for i, b in zip(order, bins, strict=True):
        at.append(filled[b])
        filled[b] += columns["length"][i]
    shard = columns["shard"][0]
    taken = table.take(pa.array(order))
    return pa.table({
        "doc_id": taken.column("doc_id"), "piece": taken.column("piece"), "start": taken.column("start"), "length": taken.column("length"),
        "bin_id": pa.array([(shard << 32) + b for b in bins], pa.int64()), "bin_offset": pa.array(at, pa.int64()),
    })


def pack(docs: DataFrame, capacity: int = 2048, length: Column | None = None, cluster: Column | None = None) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text, source): doc_id, piece, start, length, bin_id, bin_offset.

    ``length`` defaults to the number of words, ``cluster`` to a hash of the whole text. A document longer than
    ``capacity`` is cut at multiples of it; one of length 0 (empty, or null text) has one row with null bin. Null is a
    source of its own. Rows repeated in full are pieces of their own and, being one cluster, never share a bin.
    """
    rows = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("source"),
        (word_count() if length is None else length.cast("long")).alias("total"),
        (F.xxhash64(F.coalesce("text", F.lit(""))) if cluster is None else F.xxhash64(cluster)).alias("cluster"),
    ))
    last = F.greatest(F.ceil(F.col("total") / capacity).cast("long") - 1, F.lit(0))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("start", F.col("piece") * capacity)
    pieces = pieces.withColumn("length", F.least(F.lit(capacity), F.col("total") - F.col("start")).cast("long")).drop("total")
    shards = max(1, -(-pieces.count() // SHARD_PIECES))
    dealt = pieces.where("length > 0").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInArrow(
        lambda table: _pack_shard(table, capacity),
        "doc_id long, piece long, start long, length long, bin_id long, bin_offset long",
    )
    none = F.lit(None).cast("long")
    return packed.union(pieces.where("length = 0").select("doc_id", "piece", "start", "length", none, none))
