"""Alignment of two tokenizers' outputs: groups of tokens between shared cuts, and how often token pairs are linked.

1. ``Encoder``: texts are cut before every space that follows a character other than white space. Neither tokenizer
   merges across such a place (checked for the pieces when the files are read), so the tokens of a text are those of its
   stretches, and each distinct stretch is encoded once for as long as the task remembers it.
2. ``shared_cuts``: divide and conquer. Every open interval looks for a common end near its middle: it bisects for the
   middle token's end among the other side's ends, and from there leaps outward from end to end. A cut found splits the
   interval in two; an interval without one is a leaf, a group. All intervals of a batch take their steps together.
3. ``link_report``: token pairs that end together are counted per task, then corpus-wide. The counts go back to the
   documents in slices of at most ``SLICE_PAIRS`` pairs, one pass over the documents' packed pairs each, so neither the
   driver nor a task holds more than one slice however many pairs the corpus has.

Memory of a task follows its longest single text (about 100 bytes per byte of it) beyond ``PIECE_CHARS`` characters.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylytics.session import settle

PIECE_CHARS = 500_000  # texts handled together
TABLE_WORDS = 400_000  # distinct stretches remembered by a task
JOINED_WORDS = 1_000  # new stretches encoded together
COUNT_PAIRS = 1_000_000  # pairs counted in a task before they are handed on
SLICE_PAIRS = 2_000_000  # counted pairs broadcast at once

# Fixed value: the pattern by which byte-level tokenizers of this kind cut words
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_BOUNDARY = re.compile(r"(?<=\S)(?= )")
_ODD_SPACE = re.compile(r"\s ")


@dataclass(frozen=True)
class Files:
    """Contents of the tokenizer files, read on the driver and sent to the tasks (a few MB)."""

    byte_level: str  # JSON of a byte-level BPE
    pieces: bytes  # model of a piece BPE with byte fallback

    @staticmethod
    def read(byte_level: str, pieces: str) -> Files:
        return Files(Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes())


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the others, in order, for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Places(dict):
    """Numbers keys in the order of their first use and notes new ones."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        place = self[key] = len(self)
        self.fresh.append(key)
        return place


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of every run, one run after another."""
    total = np.cumsum(counts)
    return np.repeat(starts - (total - counts), counts) + np.arange(total[-1] if len(total) else 0)


class Encoder:
    """Token ids of both tokenizers for many texts; text is encoded with one space in front, special strings as plain text."""

    def __init__(self, files: Files) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        letters = _byte_letters()
        vocabulary = json.loads(files.byte_level)["model"]["vocab"]
        self.a_bytes = [b""] * (max(self.a.get_vocab_size(), *vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(len(self.b))]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.ranked = self._ranked(json.loads(files.byte_level))
        self.apart = not any(re.search("[^▁]▁", p) for p in pieces)
        self.lone_space = self.b.piece_to_id("▁")
        self._forget()

    def _ranked(self, spec: dict):
        """The same byte-level BPE in a faster library, if the file has its usual form: merges in id order, words by one pattern."""
        plain = spec.get("normalizer") is None and not spec["model"].get("dropout") and not spec["model"].get("ignore_merges")
        cut = spec.get("pre_tokenizer") or {}
        plain = plain and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if not plain or made != sorted(made):
            return None
        import tiktoken

        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {self.a_bytes[k]: k for token, k in vocabulary.items() if token not in special}
        return tiktoken.Encoding("byte level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _forget(self) -> None:
        self.places = _Places()
        self.ids = array("i"), array("i")
        self.starts = array("q", [0]), array("q", [0])
        self.good = array("b")

    def _stretches(self, text: str) -> list[str]:
        """Pieces of ``text`` that the tokenizers treat apart, each without the space in front of it."""
        if not self.apart:
            return [text]
        if text[:1] != " " and not _ODD_SPACE.search(text):
            return text.split(" ")
        return [x[1:] for x in _BOUNDARY.split(" " + text)]

    def _learn(self) -> None:
        """Encode the new stretches, many in one go: joined again they are a text that both tokenizers cut at the same places."""
        fresh = self.places.fresh
        for lo in range(0, len(fresh), JOINED_WORDS):
            words = fresh[lo : lo + JOINED_WORDS]
            if not self.apart or any(not w or w[-1].isspace() for w in words) or not self._learn_joined(words):
                for word in words:
                    self._learn_one(word)
        fresh.clear()

    def _both(self, text: str, short: bool = False) -> tuple[list[int], list[int]]:
        a = self.ranked.encode_ordinary(" " + text) if short and self.ranked else self.a.encode(" " + text, add_special_tokens=False).ids
        return a, self.b.encode(text) if text else [self.lone_space]

    def _learn_joined(self, words: list[str]) -> bool:
        text = " ".join(words)
        # its pattern search overflows on very long runs of white space
        both, data = self._both(text, short=max(map(len, words)) <= 1000), b" " + text.encode()
        if any(b"".join(map(names.__getitem__, ids)) != data for names, ids in zip((self.a_bytes, self.b_bytes), both, strict=True)):
            return False
        last = np.cumsum([len(w.encode()) + 1 for w in words])
        for side, (ids, size) in enumerate(zip(both, (self.a_size, self.b_size), strict=True)):
            cuts = np.searchsorted(np.cumsum(size[ids]), last) + 1
            begin = len(self.ids[side])
            self.ids[side].extend(ids)
            self.starts[side].frombytes((cuts + begin).astype(np.int64).tobytes())
        self.good.extend([1] * len(words))
        return True

    def _learn_one(self, word: str) -> None:
        both, data = self._both(word), b" " + word.encode()
        self.good.append(all(b"".join(map(names.__getitem__, ids)) == data for names, ids in zip((self.a_bytes, self.b_bytes), both, strict=True)))
        for side, ids in enumerate(both):
            self.ids[side].extend(ids)
            self.starts[side].append(len(self.ids[side]))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each side the ids of all texts and the place where each text's ids begin, with the end.

        Texts that are null, empty, or not given back byte for byte by either side have none.
        """
        if len(self.places) > TABLE_WORDS:
            self._forget()
        words, cuts = array("q"), np.zeros(len(texts) + 1, np.int64)
        for row, text in enumerate(texts):
            if text:
                words.extend(map(self.places.__getitem__, self._stretches(text)))
            cuts[row + 1] = len(words)
        self._learn()
        place = np.frombuffer(words, np.int64) if words else np.zeros(0, np.int64)
        good = np.frombuffer(self.good, np.int8)[place] > 0 if len(place) else np.zeros(0, bool)
        bad = np.concatenate([[0], np.cumsum(~good)])
        whole = bad[cuts[1:]] == bad[cuts[:-1]]
        keep = np.repeat(whole, np.diff(cuts))
        place, out = place[keep], []
        ends = np.concatenate([[0], np.cumsum(np.diff(cuts) * whole)])
        for ids, starts in zip(self.ids, self.starts, strict=True):
            first = np.frombuffer(starts, np.int64)
            counts = first[place + 1] - first[place]
            got = np.frombuffer(ids, np.int32)[_spread(first[place], counts)] if len(place) else np.zeros(0, np.int32)
            out.append((got, np.concatenate([[0], np.cumsum(counts)])[ends]))
        return out


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_rows: np.ndarray, b_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a_ends`` and ``b_ends``, ascending, of the ends that both hold.

    Both are strictly ascending over all rows; row r owns the places ``rows[r]`` to ``rows[r + 1]``, and its last ends agree.
    """
    full = np.flatnonzero(np.diff(a_rows) > 0)
    cut_a, cut_b = [a_rows[full + 1] - 1], [b_rows[full + 1] - 1]
    # an open interval has its possible cuts at places lo to hi - 1 of a_ends; mid is where the search began, at where it is
    lo, hi = a_rows[full], a_rows[full + 1] - 1
    lo, hi = lo[lo < hi], hi[lo < hi]
    mid = (lo + hi) // 2
    at, ahead = mid.copy(), np.ones(len(lo), bool)
    while len(lo):
        end = a_ends[at]
        other = np.searchsorted(b_ends, end)  # the first end that is not smaller
        found = b_ends[other] == end
        cut_a.append(at[found])
        cut_b.append(other[found])
        # a cut ahead of the middle leaves what lies before the middle and what lies behind the cut; nothing is between
        right = found & ahead
        new_lo = np.concatenate([lo[right], at[right] + 1, lo[found & ~ahead]])
        new_hi = np.concatenate([mid[right], hi[right], at[found & ~ahead]])
        # no cut here: leap to the next end that the other side allows; past the interval, turn round at the middle
        open_ = ~found
        lo, hi, mid, ahead = lo[open_], hi[open_], mid[open_], ahead[open_]
        other = other[open_] - ~ahead  # walking back, the last end that is smaller; -1 if there is none
        end = np.where(other < 0, 0, b_ends[other])
        at = np.searchsorted(a_ends, end)
        at -= ~ahead & (a_ends[at] != end)
        turn = ahead & (at >= hi)
        at[turn] = mid[turn] - 1
        ahead = ahead & ~turn
        stay = at >= lo
        fresh = new_lo < new_hi
        new_lo, new_hi = new_lo[fresh], new_hi[fresh]
        new_mid = (new_lo + new_hi) // 2
        lo, hi, mid, at, ahead = (
            np.concatenate([old[stay], new])
            for old, new in ((lo, new_lo), (hi, new_hi), (mid, new_mid), (at, new_mid), (ahead, np.ones(len(new_lo), bool)))
        )
    cut_a, cut_b = np.concatenate(cut_a), np.concatenate(cut_b)
    order = np.argsort(cut_a)
    return cut_a[order], cut_b[order]


_ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"


def _lists(values: np.ndarray, rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(values, pa.int32()))


def _aligned(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, names = batch.column("text"), batch.column("doc_id")
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + PIECE_CHARS, "right")))
            (a, a_rows), (b, b_rows) = encoder.encode(texts.slice(lo, hi - lo).to_pylist())
            a_cuts, b_cuts = shared_cuts(np.cumsum(encoder.a_size[a]), np.cumsum(encoder.b_size[b]), a_rows, b_rows)
            cut_rows = np.searchsorted(a_cuts, a_rows)
            row = np.repeat(np.arange(hi - lo), np.diff(cut_rows))
            columns = [names.slice(lo, hi - lo), _lists(a, a_rows), _lists(b, b_rows)]
            columns += [_lists(a_cuts + 1 - a_rows[row], cut_rows), _lists(b_cuts + 1 - b_rows[row], cut_rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])
            lo = hi


def align(docs: DataFrame, files: Files) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its token ids by both tokenizers, and where its groups end.

    ``a_cuts`` and ``b_cuts`` hold, group by group, how many ids of each side lie up to its end. Texts that are null, empty,
    or not given back byte for byte by either tokenizer (say, one with the character U+2581) have empty arrays. Rows
    with a null or repeated doc_id are rows of their own; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _aligned(batches, Encoder(shared.value))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ALIGNED)


class _Decimals:
    """Decimal strings of many ids at once."""

    def __init__(self, size: int) -> None:
        names = [str(k).encode() for k in range(size)]
        self.digits = np.array([len(x) for x in names], np.int64)
        width = int(self.digits.max())
        self.chars = np.frombuffer(b"".join(x.ljust(width + 1, b" ") for x in names), np.uint8).reshape(size, width + 1)

    def render(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, each followed by its mark, and where each one ends."""
        chars, digits = self.chars[ids], self.digits[ids]
        chars[np.arange(len(ids)), digits] = marks
        return chars[np.arange(chars.shape[1]) <= digits[:, None]], np.cumsum(digits + 1)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.values.to_numpy(), column.offsets.to_numpy().astype(np.int64)


def _digests(batch: pa.RecordBatch, decimals: _Decimals) -> list[str]:
    """For each row of ``_aligned`` the hash of its groups ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
    (a, a_rows), (b, b_rows), (a_cuts, cut_rows), (b_cuts, _) = (_flat(batch.column(k)) for k in range(1, 5))
    row = np.repeat(np.arange(len(batch)), np.diff(cut_rows))
    a_cuts, b_cuts = a_cuts + a_rows[row], b_cuts + b_rows[row]  # ids of the batch up to the end of each group
    a_place, b_place = np.arange(len(a)), np.arange(len(b))
    a_group, b_group = np.searchsorted(a_cuts, a_place, "right"), np.searchsorted(b_cuts, b_place, "right")
    merged, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    merged[a_place + np.concatenate([[0], b_cuts])[a_group]] = a
    merged[b_place + a_cuts[b_group]] = b
    starts = np.concatenate([[0], b_cuts[:-1]]) if len(b_cuts) else b_cuts
    marks[a_cuts - 1 + starts] = ord("|")
    marks[a_cuts + b_cuts - 1] = ord(";")
    chars, ends = decimals.render(merged, marks)
    ends = np.concatenate([[0], ends])[a_rows + b_rows]
    return [hashlib.sha256(chars[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class _Counter:
    """Pair counts of one task, handed on whenever there are many."""

    def __init__(self) -> None:
        self.codes, self.times, self.size = [], [], 0

    def add(self, codes: np.ndarray, times: np.ndarray) -> None:
        self.codes.append(codes)
        self.times.append(times)
        self.size += len(codes)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        codes, place = np.unique(np.concatenate(self.codes), return_inverse=True)
        times = np.bincount(place, np.concatenate(self.times), len(codes)).astype(np.int64)
        self.__init__()
        return codes, times


_REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_PACKED = _REPORT + ", pairs binary, times binary"


def _packed(batch: pa.RecordBatch, decimals: _Decimals, b_vocabulary: int, counter: _Counter) -> dict[str, pa.Array]:
    (a, a_rows), (b, b_rows), (a_cuts, cut_rows), (b_cuts, _) = (_flat(batch.column(k)) for k in range(1, 5))
    row = np.repeat(np.arange(len(batch)), np.diff(cut_rows))
    codes = a[a_cuts + a_rows[row] - 1].astype(np.int64) * b_vocabulary + b[b_cuts + b_rows[row] - 1]
    pairs, times = [], []
    for x, y in zip(cut_rows[:-1].tolist(), cut_rows[1:].tolist(), strict=True):
        code, count = np.unique(codes[x:y], return_counts=True)
        pairs.append(code.tobytes())
        times.append(count.astype(np.int32).tobytes())
    if len(codes):
        code, count = np.unique(codes, return_counts=True)
        counter.add(code, count)
    groups, zero = pa.array(np.diff(cut_rows), pa.int64()), pa.array(np.zeros(len(batch), np.int64))
    return {
        "doc_id": batch.column("doc_id"), "n_a": pa.array(np.diff(a_rows), pa.int64()), "n_b": pa.array(np.diff(b_rows), pa.int64()),
        "n_groups": groups, "n_links": groups, "n_best": zero, "count_sum": zero, "groups_sha256": pa.array(_digests(batch, decimals), pa.string()),
        "pairs": pa.array(pairs, pa.binary()), "times": pa.array(times, pa.binary()),
    }


def link_report(docs: DataFrame, files: Files) -> DataFrame:
    """One row per row of ``docs``: the sizes of its alignment, a hash of its groups, and its links by corpus-wide counts.

    A link is a pair of tokens, one of each side, that end at the same byte; ends ascend, so every group holds exactly
    one, that of its last tokens. ``n_best`` counts links whose pair is met as often as any other pair of its b id,
    ``count_sum`` adds up how often the document's linked pairs are met in the corpus. Rows without tokens (see ``align``)
    have zeros and an empty hash; an empty table gives none.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        decimals, counter = _Decimals(max(len(encoder.a_bytes), len(encoder.b_bytes))), _Counter()

        def counted() -> pa.RecordBatch:
            codes, times = counter.take()
            none = {name: pa.nulls(len(codes), kind) for name, kind in kinds.items()}
            return pa.RecordBatch.from_pydict(none | {"code": pa.array(codes), "met": pa.array(times)})

        kinds: dict[str, pa.DataType] = {}
        for batch in _aligned(batches, encoder):
            table = _packed(batch, decimals, len(encoder.b_bytes), counter)
            kinds = {name: column.type for name, column in table.items()}
            none = pa.nulls(len(batch), pa.int64())
            yield pa.RecordBatch.from_pydict(table | {"code": none, "met": none})
            if counter.size > COUNT_PAIRS:
                yield counted()
        if counter.size:
            yield counted()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    seen = settle(texts.mapInArrow(run, _PACKED + ", code long, met long"))
    met = seen.where("code IS NOT NULL").groupBy("code").agg(F.sum("met").alias("met"))
    b_vocabulary = len(Encoder(files).b_bytes)
    # at most as many rows to one b id as the other vocabulary has ids
    most = F.max("met").over(Window.partitionBy(F.col("code") % b_vocabulary))
    counts = settle(met.select("code", "met", (F.col("met") == most).alias("best")))
    slices = -(-counts.count() // SLICE_PAIRS)
    report = seen.where("code IS NULL").drop("code", "met")
    for k in range(slices):
        here = counts.where(F.pmod(F.xxhash64("code"), F.lit(slices)) == k)
        report = _look_up(report if k == 0 else settle(report), here)
    return report.select(*[c.split()[0] for c in _REPORT.split(", ")])


def _look_up(report: DataFrame, counts: DataFrame) -> DataFrame:
    """``report`` with what the pairs of one slice of ``counts`` add to its sums."""
    table = counts.toArrow().sort_by("code")  # SLICE_PAIRS rows and the spread of their hash
    columns = (table.column("code").to_numpy(), table.column("met").to_numpy(), table.column("best").to_numpy())
    shared = counts.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, met, best = shared.value
        for batch in batches:
            sums = []
            for pairs, times in zip(batch.column("pairs"), batch.column("times"), strict=True):
                pairs, times = np.frombuffer(pairs.as_buffer(), np.int64), np.frombuffer(times.as_buffer(), np.int32)
                place = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
                times = times * (codes[place] == pairs)
                sums.append((int(times[best[place]].sum()), int((met[place] * times).sum())))
            for name, column in zip(("n_best", "count_sum"), zip(*sums, strict=True), strict=True):
                place = batch.schema.get_field_index(name)
                batch = batch.set_column(place, name, pa.array(np.array(column) + batch.column(place).to_numpy(), pa.int64()))
            yield batch

    return report.mapInArrow(run, _PACKED)
