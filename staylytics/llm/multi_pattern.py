"""Benchmark decontamination by Wu-Manber search: which words of a text lie in a passage that a benchmark item holds.

Texts and items are brought to one form: A-Z lower-cased, words joined by single spaces, a space at either end. A window
of an item is then a byte string, and an occurrence of it in a document is an occurrence of its words.

1. ``windows``: the distinct windows of all items, filed by length class and dealt over blocks of at most
   ``BLOCK_BYTES``. A block is compiled into tables and broadcast; more blocks mean more passes, not larger tables.
2. ``Searcher.find``: for each length class, a shift table over hashed blocks of bytes says how far the search may move
   on; where it says zero, the bucket of that suffix hash and of the hash of the window's first bytes names the windows to
   compare, byte by byte. A text is cut in lanes that overlap by the length the shifts look back, and all lanes move on together.
3. Words in any occurrence are counted once. With several blocks, their spans are united per row.

Memory of a task follows its longest single text (about six bytes per byte of it) beyond ``PIECE_BYTES``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.llm import text as tx
from staylytics.session import settle

PIECE_BYTES = 2_000_000  # texts searched together
BLOCK_BYTES = 32_000_000  # windows compiled together
LANE = 2_048  # bytes that one lane searches
HEAD = 3  # bytes of a window's beginning that its bucket depends on
CLASSES = (3, 6, 12, 24, 48)  # least lengths of the classes; a word with its spaces has three bytes at least
TABLE_BITS = (14, 22)  # least and most bits of a shift table

_END = 0xFF  # never part of UTF-8
_SPACE = 0x20


def _letters() -> np.ndarray:
    """What each byte becomes: itself, lower case, or a space where it is no part of a word."""
    out = np.full(256, _SPACE, np.uint8)
    for lo, hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        out[lo : hi + 1] = np.arange(lo, hi + 1)
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    return out


_LETTERS = _letters()


def plain_form(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in their one form, each with ``_END`` before and behind it, and the places of those marks."""
    joined = b" \xff " + b" \xff ".join([x.replace(b"\xff", b"\xfe") if b"\xff" in x else x for x in texts]) + b" \xff "
    data = _LETTERS[np.frombuffer(joined, np.uint8)]
    gap = data == _SPACE
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    data = data[keep]
    return data, np.flatnonzero(data == _END)


@dataclass(frozen=True)
class _Class:
    """Tables of the windows of one length class. ``length``: bytes of the shortest, the ``block`` last of which are looked up."""

    length: int
    block: int
    bits: int
    shift: np.ndarray  # by hashed block
    keys: np.ndarray  # ascending suffix and head hashes, one a window
    strings: list[bytes]  # windows in the order of their keys
    places: np.ndarray  # their places in the block's list


def _hash(data: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the ``n`` bytes from every place in ``first``."""
    value = np.zeros(len(first), np.uint64)
    for k in range(n):
        value = (value + data[first + k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


def _compile(strings: list[bytes], places: list[int]) -> _Class:
    data = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    first = np.cumsum(sizes) - sizes
    length = int(sizes.min())
    # blocks long enough that most places of a text hold none of the windows' blocks
    block = max(2, min(length // 2, 2 + int(np.ceil(np.log(2 * length * len(strings)) / np.log(30)))))
    bits = int(np.clip(np.ceil(np.log2(8.0 * length * len(strings))), *TABLE_BITS))
    shift = np.full(1 << bits, length - block + 1, np.int32)
    for at in range(length - block + 1):
        # later places are nearer to the end and come last
        shift[_hash(data, first + at, block) >> np.uint64(64 - bits)] = length - block - at
    keys = _key(data, first, length, block)
    order = np.argsort(keys, kind="stable")
    return _Class(length, block, bits, shift, keys[order], [strings[i] for i in order.tolist()], np.array(places, np.int64)[order])


def _key(data: np.ndarray, first: np.ndarray, length: int, block: int) -> np.ndarray:
    return tx.mix(_hash(data, first + length - block, block)) ^ _hash(data, first, HEAD)


class Searcher:
    """Shift tables and buckets of one block of windows; ``owners`` names, window by window, the items that hold it."""

    def __init__(self, strings: list[bytes], owners: list[tuple[int, ...]]) -> None:
        self.owners = owners
        rank = np.searchsorted(CLASSES, [len(s) for s in strings], "right")
        self.classes = [
            _compile([strings[i] for i in here], here) for r in np.unique(rank).tolist() if (here := np.flatnonzero(rank == r).tolist())
        ]

    def find(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first byte, end, place of the window) of all occurrences in bytes of the one form."""
        raw = data.tobytes()
        for c in self.classes:
            # a place is the first byte of a window; the search of a lane ends where the next one's begins
            lane = np.arange(0, len(data) - c.length + 1, LANE)
            at, end = lane.copy(), np.minimum(lane + LANE, len(data) - c.length + 1)
            while len(at):
                step = c.shift[_hash(data, at + c.length - c.block, c.block) >> np.uint64(64 - c.bits)]
                hit = at[step == 0]
                if len(hit):
                    keys = _key(data, hit, c.length, c.block)
                    lo, hi = np.searchsorted(c.keys, keys), np.searchsorted(c.keys, keys, "right")
                    for place, x, y in zip(hit[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                        for k in range(x, y):
                            string = c.strings[k]
                            if raw.startswith(string, place):
                                yield place, place + len(string), int(c.places[k])
                at = at + np.maximum(step, 1)
                open_ = at < end
                at, end = at[open_], end[open_]


def windows(items: DataFrame, width: int) -> DataFrame:
    """Distinct (window, item_ids, size) of all items; an item of fewer words, but not none, is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("item_id"), batch.column("text").cast(pa.binary()), strict=True):
                data, marks = plain_form([text.as_py() or b""])
                spaces = np.flatnonzero(data[: marks[1]] == _SPACE)
                n = len(spaces) - 1
                if n < 1:
                    continue
                w = min(width, n)
                raw = data.tobytes()
                found = list({raw[a : b + 1] for a, b in zip(spaces[: n - w + 1].tolist(), spaces[w:].tolist(), strict=True)})
                yield pa.RecordBatch.from_pydict({"window": pa.array(found, pa.binary()), "item_id": pa.array([name.as_py()] * len(found), pa.int64())})

    cut = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "window binary, item_id long")
    return cut.groupBy("window").agg(F.collect_set("item_id").alias("item_ids")).withColumn("size", F.length("window") + 8 * F.size("item_ids"))


_FOUND = "doc_id long, n_words long, spans array<int>, items array<long>"


def _search(docs: DataFrame, shared, keyed: bool) -> DataFrame:
    """Rows of ``docs`` with the spans of their hit words (first and behind the last, in turn) and the items met; with a
    hash of the text if ``keyed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*shared.value)
        for batch in batches:
            texts = batch.column("text")
            texts = texts.cast(pa.binary())
            rows, size, lo = [], 0, 0
            for hi in range(len(texts) + 1):
                if hi < len(texts) and size < PIECE_BYTES:
                    rows.append(texts[hi].as_py() or b"")
                    size += len(rows[-1])
                    continue
                if rows:
                    table = _piece(rows, searcher)
                    table["doc_id"] = batch.column("doc_id").slice(lo, len(rows))
                    if keyed:
                        table["key"] = pa.array([hashlib.sha256(x).digest() for x in rows], pa.binary())
                    yield pa.RecordBatch.from_pydict({name: table[name] for name in names})
                if hi < len(texts):
                    rows, lo = [texts[hi].as_py() or b""], hi
                    size = len(rows[0])

    schema = _FOUND + (", key binary" if keyed else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _piece(rows: list[bytes], searcher: Searcher) -> dict[str, pa.Array]:
    data, marks = plain_form(rows)
    spaces = np.flatnonzero(data == _SPACE)
    first = np.searchsorted(spaces, marks)  # spaces before each row
    found = list(searcher.find(data))
    spans: list[list[int]] = [[] for _ in rows]
    items: list[set[int]] = [set() for _ in rows]
    if found:
        begin, end, place = (np.array(x, np.int64) for x in zip(*found, strict=True))
        row = np.searchsorted(marks, begin) - 1
        # the space at a window's beginning is that before its first word
        word, behind = np.searchsorted(spaces, begin) - first[row], np.searchsorted(spaces, end - 1) - first[row]
        order = np.argsort(begin, kind="stable")
        for r, a, b, p in zip(*(x[order].tolist() for x in (row, word, behind, place)), strict=True):
            items[r].update(searcher.owners[p])
            own = spans[r]
            if own and a <= own[-1]:
                own[-1] = max(own[-1], b)
            else:
                own += (a, b)
    return {
        "n_words": pa.array(np.diff(first) - 1, pa.int64()),
        "spans": pa.array(spans, pa.list_(pa.int32())), "items": pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
    }


def _united(spans: list[list[int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted((s[k], s[k + 1]) for s in spans for k in range(0, len(s), 2)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def contaminated(docs: DataFrame, items: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, the spans of its words that lie in item windows, the items met.

    ``spans`` holds first word and end (behind the last) of each stretch of hit words in turn, ascending and apart;
    ``items`` the ids of items (item_id, text) with a window that occurs, ascending. Null or empty texts have no words; an
    item without words has no window. Items that share an id count as one; one without an id marks words but is not listed.
    Rows with a null or repeated doc_id are rows of their own; other columns are not read.
    """
    spark = docs.sparkSession
    cut = settle(windows(items, width))
    total = cut.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    parts = []
    for k in range(blocks):
        here = cut.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).toArrow()  # block_bytes and the spread of the hash
        tables = here.column("window").to_pylist(), [tuple(x) for x in here.column("item_ids").to_pylist()]
        parts.append(_search(docs, spark.sparkContext.broadcast(tables), keyed=blocks > 1))
    if blocks == 1:
        return parts[0]
    # equal rows have equal results, so one of each block stands for all; the first block's rows stand for the documents
    rows, none = parts[0].select("doc_id", "key", "n_words"), F.array().cast("array<int>")
    hits = settle(parts[0].where("size(spans) > 0").withColumn("block", F.lit(0)))
    for k, part in enumerate(parts[1:], 1):
        hits = hits.union(settle(part.where("size(spans) > 0").withColumn("block", F.lit(k))))
    each = hits.groupBy("doc_id", "key", "block").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))
    unite = F.udf(_united, "array<int>")  # at most one list a block
    both = each.groupBy("doc_id", "key").agg(
        unite(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    same = rows["doc_id"].eqNullSafe(both["doc_id"]) & (rows["key"] == both["key"])
    joined = rows.join(both, same, "left")
    return joined.select(rows["doc_id"], "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.array().cast("array<long>")).alias("items"))


def leak_report(docs: DataFrame, items: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``contaminated`` in figures: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contaminated(docs, items, width, block_bytes)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: x - total)  # ends less beginnings: alternating sum
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
