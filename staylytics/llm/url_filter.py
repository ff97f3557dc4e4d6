"""URL filter: explicit rules first, then a ratio of two character language models.

Both models, for accepted and rejected URLs, are variable-order Markov models: the chance of a byte mixes the counts after
its last ``ORDER`` bytes with the chance given one byte less, down to uniform; contexts never seen fall through. They are
counted over all URLs that a rule decides (but a fifth of them, kept for calibration). A Spark aggregation counts every
context, and every context with its byte, by a 64-bit hash; the table grows with what the URLs hold, and is sent to the tasks in
slices of bounded size (``scored``). The log-likelihood difference is divided by the number of bytes. Its cut is the one with the least mean of both error
rates on the kept fifth of the distinct URLs. Where the fifth or the rest lacks a class (few distinct URLs), both models
are counted over all URLs that a rule decides, and the cut is 0: the likelier class wins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm import text as tx
from staylytics.session import settle

ORDER = 5
PRIOR = 2.0  # weight of the shorter context, in observations
SLICE_KEYS = 2_000_000  # counts broadcast at once, 24 bytes each
CUTS = 2000  # score bins of the calibration, 0.01 wide
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. Ties go to the longer host."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


@dataclass(frozen=True)
class Counts:
    keys: np.ndarray  # hashes of contexts and of contexts with a byte, ascending
    times: np.ndarray  # [rejected, accepted][key]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """[rejected, accepted][place of keys], 0 for what was never counted."""
        if not len(self.keys):
            return np.zeros((2, len(keys)), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.times[:, at], 0)


def contexts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For orders 0 to ``ORDER``: which bytes have that many before them in their text, the hash of that context, and the
    hash of context and byte."""
    n = len(data)
    depth = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    codes = data.astype(np.uint64)
    context = np.zeros(n, np.uint64)
    for order in range(ORDER + 1):
        if order:
            before = np.zeros(n, np.uint64)
            before[order:] = codes[:-order]
            context = tx.mix(context * np.uint64(257) + before + np.uint64(1))
        yield depth >= order, tx.mix(context + np.uint64(order)), tx.mix(context * np.uint64(263) + codes + np.uint64(7))


def counted(urls: DataFrame) -> DataFrame:
    """(key, rejected, accepted): how often each context, and each context with its byte, occurs in all rows of ``urls`` (url,
    accepted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            accepted = np.array(batch.column("accepted").to_pylist(), bool)
            for first, data, offsets in tx.pieces(batch.column("url")):
                kind = np.repeat(accepted[first : first + len(offsets) - 1], np.diff(offsets))
                for there, *hashed in contexts(data, offsets):
                    for keys in hashed:
                        distinct, at = np.unique(keys[there], return_inverse=True)
                        times = [np.bincount(at[kind[there] == bool(c)], minlength=len(distinct)).astype(np.int64) for c in (0, 1)]
                        yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *map(pa.array, times)], names=["key", "rejected", "accepted"])

    parts = urls.mapInArrow(run, "key long, rejected long, accepted long")
    return parts.groupBy("key").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted"))


def held(counts: DataFrame) -> Counts:
    """A table of counts in memory: the whole one, or a slice of it."""
    table = counts.toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Counts(keys[order], np.stack([table.column(c).to_numpy()[order] for c in ("rejected", "accepted")]))


def count(urls: DataFrame) -> Counts:
    return held(counted(urls))


def looked_up(data: np.ndarray, offsets: np.ndarray, table: Counts) -> np.ndarray:
    """[order, context or event, rejected or accepted, byte]: the counts that a table has for every byte of some texts."""
    return np.stack([np.stack([table.of(context), table.of(event)]) for _, context, event in contexts(data, offsets)])


def _per_byte(data: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-likelihood difference (accepted less rejected) per byte of each text, from the counts of its bytes; 0 for an empty one."""
    chance = np.full((2, len(data)), 1 / 256)
    depth = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for order, (context, event) in enumerate(counts):
        chance = np.where(depth >= order, (event + PRIOR * chance) / (context + PRIOR), chance)
    gain = np.concatenate([[0.0], np.cumsum(np.log(chance[1]) - np.log(chance[0]))])
    return (gain[offsets[1:]] - gain[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def ratios(column: pa.Array, table: Counts) -> np.ndarray:
    """``_per_byte`` of each text by one table that holds all counts."""
    out = np.zeros(len(column))
    for first, data, offsets in tx.pieces(column):
        out[first : first + len(offsets) - 1] = _per_byte(data, offsets, looked_up(data, offsets, table))
    return out


def scored(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """``parts`` (url, ...) with score. A task holds at most a slice of ``SLICE_KEYS`` counts; with more, the counts of each URL's bytes
    are gathered slice by slice in a column of their own, and then scored."""
    spark = parts.sparkSession
    counts = settle(counts)
    slices = max(1, -(-counts.count() // SLICE_KEYS))

    def broadcast(k: int):
        return spark.sparkContext.broadcast(held(counts.where(F.pmod(F.xxhash64("key"), F.lit(slices)) == k)))

    if slices == 1:
        table = broadcast(0)
        return parts.withColumn("score", F.arrow_udf(lambda url: pa.array(ratios(url, table.value), pa.float64()), "double")("url"))

    def gather(table):
        def run(url: pa.Array, found: pa.Array) -> pa.Array:
            out = []
            for first, data, offsets in tx.pieces(url):
                new = looked_up(data, offsets, table.value).astype(np.int32)
                for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    mine, old = new[..., a:b], found[first + k].as_py()
                    out.append((mine if old is None else mine + np.frombuffer(old, np.int32).reshape(mine.shape)).tobytes())
            return pa.array(out, pa.binary())

        return F.arrow_udf(run, "binary")("url", "found")

    def finish(url: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for first, data, offsets in tx.pieces(url):
            for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                mine = np.frombuffer(found[first + k].as_py(), np.int32).reshape(ORDER + 1, 2, 2, b - a)
                out.append(float(_per_byte(data[a:b], np.array([0, b - a]), mine)[0]))
        return pa.array(out, pa.float64())

    parts = parts.withColumn("found", F.lit(None).cast("binary"))
    for k in range(slices):
        parts = settle(parts.withColumn("found", gather(broadcast(k))))
    return parts.withColumn("score", F.arrow_udf(finish, "double")("url", "found")).drop("found")


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, score.

    A rule fits its host and all subdomains where the path starts with the rule's path; the longest decides. Other URLs
    are allowed if their score reaches the calibrated cut, or 0 where few distinct URLs leave a part without a class; a null or empty URL is allowed. If the rules leave no
    accepted or no rejected URL there is nothing to compare, and the rest is allowed. ``rules`` is a short list (it becomes
    one expression).
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    parts = settle(pages.select("page_id", F.col("url").cast("string"), host.alias("host"), path.alias("path")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    known = parts.select("url", (verdict == "allow").alias("accepted"), (F.pmod(F.xxhash64("url"), F.lit(5)) == 0).alias("kept"))
    known = known.where("accepted IS NOT NULL")
    parted = {(r["kept"], r["accepted"]) for r in known.select("kept", "accepted").distinct().collect()}
    classes = {accepted for _, accepted in parted}
    learnt = known.where("NOT kept") if len(parted) == 4 else known
    done = settle(scored(parts, counted(learnt.select("url", "accepted"))))
    if len(parted) == 4:
        bin_ = F.greatest(F.lit(0), F.least(F.lit(CUTS - 1), F.floor(F.col("score") * 100) + CUTS // 2)).cast("int")
        judged = done.select((verdict == "allow").alias("accepted"), bin_.alias("bin")).where(F.pmod(F.xxhash64("url"), F.lit(5)) == 0).where("accepted IS NOT NULL")
        kept = judged.groupBy("accepted", "bin").count().collect()  # 2 CUTS rows
        seen = np.zeros((2, CUTS + 1))
        for row in kept:
            seen[int(row["accepted"]), row["bin"]] = row["count"]
        below = np.concatenate([np.zeros((2, 1)), np.cumsum(seen, axis=1)], axis=1) / seen.sum(1, keepdims=True)
        cut = (int((below[1] + 1 - below[0]).argmin()) - CUTS // 2) / 100
    else:
        cut = 0.0 if len(classes) == 2 else float("-inf")
    by_model = F.when((F.coalesce(F.length("url"), F.lit(0)) == 0) | (F.col("score") >= cut), "allow").otherwise("block")
    return done.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "score")
