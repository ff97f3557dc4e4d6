"""A stored inverted index with impact-ordered postings, and exact BM25 top-k that reads only as much of it as needed.

Layout below a path, every table in segments (``segment=<n>``):

* ``docs``: doc_id, dl (tokens), terms and tfs (its distinct terms and how often they occur), for exact scores;
* ``terms``: term, df;
* ``blocks``: term, up to ``BLOCK`` postings (doc ids, tfs, dls), peak (the largest impact), in tiers: tier 0 holds a term's
  best block, tier k the next ``3 * 4**(k - 1)``. A tier is a folder, so what a search does not need is not opened;
* ``gone``: documents that a later segment removed or replaced.

An impact is the part of BM25 that does not depend on the query, with the mean length at the time the segment was written.
When the mean length changes, stored peaks stay upper bounds after scaling (``_peak_scale``); exact scores come from ``docs``.
"""

from __future__ import annotations

import io
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylytics.functions.arrays import exploded
from staylytics.operators.cleaning import strip
from staylytics.operators.joins import parts_of as _parts
from staylytics.operators.joins import placed as _placed
from staylytics.operators.ordering import with_running_totals
from staylytics.session import discard, settle, store

K1, B, EPSILON = 1.5, 0.75, 0.25
BLOCK = 128  # postings in one row
TASK_CHARS, TASK_POSTINGS, TASK_PAIRS = 16_000_000, 2_000_000, 2_000_000  # what a task holds of texts, postings and scored pairs
SENT_ROWS, SENT_QUERIES = 1_000_000, 20_000  # what is broadcast of narrow rows, and of queries with their terms
HELD_POSTINGS, ROWS_OUT = 1_000_000, 2000  # postings that a Python worker holds, blocks that it hands on at once
SLACK = 1e-9  # bounds are compared with this margin, since sums of floats depend on their order
_FORWARD = "doc_id long, dl int, terms array<string>, tfs array<int>"
_DOCS = f"{_FORWARD}, segment int"
_TERMS = "term string, df long, segment int"
_BLOCKS = "term string, ids array<long>, tfs array<int>, dls array<int>, peak double, avgdl double, segment int, tier int"
_GONE = "doc_id long, before int"


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(strip(F.lower(text)), r"\s+"), lambda w: w != "")


def impact(tf: Column, dl: Column, avgdl: Column) -> Column:
    return tf * (K1 + 1) / (tf + F.lit(K1) * (1 - B + F.lit(B) * dl / avgdl))


# ---- writing ---------------------------------------------------------------------------------------------------


def _counter(most: int):
    """Texts as words by white space, a document's words counted and sorted; at most ``most`` characters are held before rows go out.

    White space is what ``\\s`` means in the JVM, which is what bytes are split at.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lengths, ends, terms, tfs, held = [], [], [0], [], [], 0

        def rows() -> pa.RecordBatch:
            at = pa.array(ends, pa.int32())
            words = pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).view(pa.string()))
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(lengths, pa.int32()), words, pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))],
                names=["doc_id", "dl", "terms", "tfs"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or b""
                words = text.split()
                found = Counter(words)
                names.append(name)
                lengths.append(len(words))
                terms.extend(sorted(found))
                tfs.extend(found[w] for w in terms[ends[-1] :])
                ends.append(len(terms))
                held += len(text)
                if held >= most or len(names) >= most:
                    yield rows()
                    names, lengths, ends, terms, tfs, held = [], [], [0], [], [], 0
        if names:
            yield rows()

    return count


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _inverter(most: int, buckets: int):
    """Documents as postings: for about ``most`` postings at a time and each bucket of terms a packed table, a row per term with its
    documents by doc_id and as distances from one to the next."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            words = table["terms"].combine_chunks().flatten().dictionary_encode()
            sizes = pc.list_value_length(table["terms"]).to_numpy()
            place = np.array([zlib.crc32(w) % buckets for w in words.dictionary.cast(pa.binary()).to_pylist()], dtype=np.int64)
            codes = words.indices.to_numpy().astype(np.int64)
            ids = np.repeat(table["doc_id"].to_numpy(), sizes)
            order = np.lexsort((ids, codes, place[codes]))
            codes, ids = codes[order], ids[order]
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            ends = np.append(starts, len(codes))
            steps = np.diff(ids, prepend=0)
            steps[starts] = ids[starts]
            tfs = table["tfs"].combine_chunks().flatten().to_numpy()[order]
            dls = np.repeat(table["dl"].to_numpy(), sizes)[order]
            packed = pa.RecordBatch.from_arrays(
                [words.dictionary.take(pa.array(codes[starts])), _lists(steps, ends, pa.int64()), _lists(tfs, ends, pa.int32()), _lists(dls, ends, pa.int32())],
                names=["term", "steps", "tfs", "dls"])
            of = place[codes[starts]]
            cuts = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
            return pa.RecordBatch.from_arrays(
                [pa.array(of[cuts[:-1]], pa.int32()), pa.array([_packed(packed.slice(i, j - i)) for i, j in zip(cuts, cuts[1:])], pa.binary())],
                names=["bucket", "packed"])

        held, size = [], 0
        for batch in batches:
            for part in _cut(batch, batch.column(2), most):
                held.append(part)
                size += len(part.column(2).flatten())
                if size >= most:
                    yield rows(held)
                    held, size = [], 0
        if size:
            yield rows(held)

    return invert


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _packed(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue()


def _cut(batch: pa.RecordBatch, lists: pa.ListArray, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``most`` list elements, or one row."""
    total, at = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()), 0
    while at < len(total):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _blocker(avgdl: float, size: int, common: frozenset[str]):
    """Rows of ``_inverter`` sorted by bucket as blocks of ``size`` by impact; a bucket's postings are held. ``common`` terms are left out."""

    def blocks(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in packed])
        if common:
            table = table.filter(pc.invert(pc.is_in(table["term"], pa.array(sorted(common), pa.string()))))
        if not len(table):
            return
        words = table["term"].combine_chunks().dictionary_encode()
        steps, tfs, dls = (table[c].combine_chunks() for c in ("steps", "tfs", "dls"))
        sizes = pc.list_value_length(steps).to_numpy()
        ids, firsts = np.cumsum(steps.flatten().to_numpy()), np.cumsum(sizes) - sizes
        # a row's distances start from zero
        ids = ids - np.repeat(np.append(0, ids)[firsts], sizes)
        tfs, dls = tfs.flatten().to_numpy(), dls.flatten().to_numpy()
        codes = np.repeat(words.indices.to_numpy().astype(np.int64), sizes)
        gains = tfs * (K1 + 1) / (tfs + K1 * (1 - B + B * dls / avgdl))
        order = np.lexsort((ids, -gains, codes))
        codes, ids, tfs, dls, gains = codes[order], ids[order], tfs[order], dls[order], gains[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        place = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
        starts = np.flatnonzero(place % size == 0)
        number = place[starts] // size
        # the next 3 * 4**(k - 1) blocks are tier k
        tiers = np.where(number == 0, 0, (np.frexp(number.astype(np.float64))[1] - 1) // 2 + 1)
        for i in range(0, len(starts), ROWS_OUT):
            at = starts[i : i + ROWS_OUT]
            end = starts[i + ROWS_OUT] if i + ROWS_OUT < len(starts) else len(codes)
            part, ends = slice(at[0], end), np.append(at, end) - at[0]
            yield pa.RecordBatch.from_arrays(
                [words.dictionary.take(pa.array(codes[at])), _lists(ids[part], ends, pa.int64()), _lists(tfs[part], ends, pa.int32()), _lists(dls[part], ends, pa.int32()),
                 pa.array(gains[at], pa.float64()), pa.array(np.full(len(at), avgdl), pa.float64()), pa.array(tiers[i : i + ROWS_OUT], pa.int32())],
                names=["term", "ids", "tfs", "dls", "peak", "avgdl", "tier"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((number, x) for batch in batches for number, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for _, held in groupby(rows, key=lambda row: row[0]):
            yield from blocks([x for _, x in held])

    return block


def _forward(docs: DataFrame) -> DataFrame:
    """(doc_id, dl, terms, tfs) of documents (doc_id, text). Texts are counted where they are read; only rows that share a doc_id are
    brought together, as counts."""
    spark = docs.sparkSession
    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    words = named.select("doc_id", strip(F.lower("text")).cast("binary").alias("text"))
    counted = words.mapInArrow(_counter(TASK_CHARS), "doc_id long, dl int, terms array<string>, tfs array<int>")
    repeated = settle(named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if repeated.isEmpty():
        return counted
    counted = settle(counted)
    more = counted.join(repeated, "doc_id", "left_semi")
    more = _placed(more, _parts(spark, more.agg(F.sum(F.size("terms"))).first()[0], TASK_POSTINGS), "doc_id")
    flat = more.select("doc_id", F.explode_outer(F.arrays_zip("terms", "tfs")).alias("e"))
    summed = flat.groupBy("doc_id", F.col("e.terms").alias("term")).agg(F.sum("e.tfs").cast("int").alias("tf"))
    # a document without tokens still counts towards the corpus
    entry = F.when(F.col("term").isNotNull(), F.struct("term", "tf"))
    whole = summed.groupBy("doc_id").agg(F.array_sort(F.collect_list(entry)).alias("e")).select(
        "doc_id", F.aggregate("e", F.lit(0), lambda n, x: n + x["tf"]).alias("dl"),
        F.transform("e", lambda x: x["term"]).alias("terms"), F.transform("e", lambda x: x["tf"]).alias("tfs"),
    )
    return counted.join(repeated, "doc_id", "left_anti").unionByName(whole)


def _spread_blocks(forward: DataFrame, common: DataFrame, avgdl: float, parts: int | None) -> DataFrame:
    """Blocks of terms (``common``) with more postings than a task holds: spread over many tasks, each of which knows how many come
    before its own."""
    flat = forward.select("doc_id", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
    postings = flat.select("doc_id", "dl", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf")).join(F.broadcast(common), "term")
    postings = postings.withColumn("worst", -impact(F.col("tf"), F.col("dl"), F.lit(avgdl)))
    placed = with_running_totals(postings, ["term"], ["worst", "doc_id"], {"at": F.lit(1)}, parts)
    placed = _placed(placed.withColumn("block", F.floor((F.col("at") - 1) / BLOCK)), parts, "term", "block")
    entry = F.struct("worst", "doc_id", "tf", "dl")
    return placed.groupBy("term", "block").agg(F.array_sort(F.collect_list(entry)).alias("e")).select(
        "term", *[F.col(f"e.{name}").alias(out) for name, out in (("doc_id", "ids"), ("tf", "tfs"), ("dl", "dls"))],
        (-F.element_at("e", 1)["worst"]).alias("peak"), F.lit(avgdl).alias("avgdl"),
        F.when(F.col("block") == 0, 0).otherwise(F.floor(F.log(4.0, F.col("block").cast("double")) + 1e-12) + 1).cast("int").alias("tier"),
    )


def _write_segment(docs: DataFrame, path: str, segment: int) -> None:
    """Documents (doc_id, text) as a segment; rows that share a doc_id are one document, their texts' tokens together."""
    spark = docs.sparkSession
    store(_forward(docs).write.mode("overwrite").option("compression", "zstd"), f"{path}/docs/segment={segment}")
    forward = spark.read.schema(_FORWARD).parquet(f"{path}/docs/segment={segment}")
    avgdl, total = forward.agg(F.avg("dl"), F.sum(F.size("terms"))).first()
    avgdl, parts = float(avgdl or 0), _parts(spark, total, TASK_POSTINGS)
    df = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    store(df.write.mode("overwrite"), f"{path}/terms/segment={segment}")
    common = spark.read.schema("term string, df long").parquet(f"{path}/terms/segment={segment}").where(F.col("df") > TASK_POSTINGS).select("term")
    few = frozenset(r["term"] for r in common.collect())  # fewer than a task's share of all postings
    # a bucket is what a task sorts at once; it has at most one half of a task's postings, but for those of a common term
    buckets = max(-(-(total or 0) // (TASK_POSTINGS // 2 or 1)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = _placed(forward.mapInArrow(_inverter(HELD_POSTINGS, buckets), "bucket int, packed binary"), parts, "bucket")
    blocks = packed.sortWithinPartitions("bucket").mapInArrow(_blocker(avgdl, BLOCK, few), _BLOCKS.replace("segment int, ", ""))
    if few:
        blocks = blocks.unionByName(_spread_blocks(forward, common, avgdl, parts))
    store(blocks.write.mode("overwrite").option("compression", "zstd").partitionBy("tier"), f"{path}/blocks/segment={segment}")


def build(docs: DataFrame, path: str) -> None:
    """A new index of ``docs`` (doc_id, text) in one segment. A null doc_id is left out, a null text has no tokens."""
    _write_segment(docs, path, 0)
    docs.sparkSession.createDataFrame([], _GONE).write.mode("overwrite").parquet(f"{path}/gone/segment=0")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``build`` has finished an index at ``path``."""
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/gone/segment=0/_SUCCESS")
    return gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(gone)


def update(path: str, segment: int, changed: DataFrame, removed: DataFrame) -> None:
    """Add ``changed`` (doc_id, text; new or replaced documents) as a segment and take ``removed`` (doc_id) out. Segments written
    so far stay as they are; writing the same number again replaces it. Numbers ascend."""
    _write_segment(changed, path, segment)
    gone = changed.select("doc_id").union(removed.select("doc_id")).distinct().select(F.col("doc_id").cast("long"), F.lit(segment).alias("before"))
    gone.write.mode("overwrite").parquet(f"{path}/gone/segment={segment}")


# ---- reading ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """The live documents of an index: tables, and the corpus figures that BM25 needs."""

    docs: DataFrame
    blocks: DataFrame
    gone: DataFrame
    weights: DataFrame  # term, idf
    avgdl: float
    tiers: int
    negative: bool  # whether a term may count against a document, which happens in tiny corpora only


def _live(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows with doc_id and segment that no later segment has taken out."""
    latest = gone.groupBy(F.col("doc_id").alias("_d")).agg(F.max("before").alias("_before"))
    return rows.join(latest, (rows["doc_id"] == F.col("_d")) & (rows["segment"] < F.col("_before")), "left_anti")


def load(spark: SparkSession, path: str) -> Index:
    docs, blocks = (spark.read.schema(s).parquet(f"{path}/{t}") for t, s in (("docs", _DOCS), ("blocks", _BLOCKS)))
    gone = spark.read.schema(_GONE).parquet(f"{path}/gone").drop("segment")
    terms = spark.read.schema(_TERMS).parquet(f"{path}/terms")
    # found by their numbers alone; whole rows are only shuffled where too many are gone to be sent to all tasks
    latest = gone.groupBy(F.col("doc_id").alias("_d")).agg(F.max("before").alias("_before"))
    numbers = docs.select("doc_id", "segment")
    out = settle(numbers.join(latest, (numbers["doc_id"] == F.col("_d")) & (numbers["segment"] < F.col("_before")), "left_semi"))
    sent = F.broadcast(out) if out.count() <= SENT_ROWS else out
    live = docs.join(sent, ["doc_id", "segment"], "left_anti")
    n, avgdl = live.agg(F.count("*"), F.avg("dl")).first()
    # documents taken out still count in their segment's table of terms
    dead = docs.join(sent, ["doc_id", "segment"], "left_semi")
    less = dead.select(F.explode("terms").alias("term")).groupBy("term").agg((-F.count("*")).alias("df"))
    df = terms.select("term", "df").union(less).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    raw = settle(df.withColumn("raw", F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)))
    floor = (raw.agg(F.avg("raw")).first()[0] or 0.0) * EPSILON
    weights = raw.select("term", F.when(F.col("raw") < 0, F.lit(floor)).otherwise(F.col("raw")).alias("idf"))
    tiers = (blocks.agg(F.max("tier")).first()[0] or 0) + 1
    return Index(live, blocks, gone, weights, avgdl or 1.0, tiers, floor < 0)


def restricted(index: Index, allowed: DataFrame) -> Index:
    """The same corpus figures, but only documents in ``allowed`` (doc_id) are found."""
    out = index.docs.join(allowed.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit(2**31 - 1).alias("before"))
    return replace(index, docs=index.docs.join(allowed.select("doc_id"), "doc_id", "left_semi"), gone=settle(index.gone.unionByName(out)))


def query_terms(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, term, w): weight of each known term of a query, its idf times its occurrences there."""
    asked = exploded(queries, whitespace_tokens(F.col("query_text")), "term", "query_id").groupBy("query_id", "term").agg(F.count("*").alias("qn"))
    return asked.join(index.weights, "term").select("query_id", "term", (F.col("qn") * F.col("idf")).alias("w"))


def _scorer(avgdl: float, most: int):
    """Rows of one document follow each other, so its terms are looked up in one table; up to ``most`` queries are kept."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tfs, queries = None, {}, {}
        for batch in batches:
            query, doc, length, terms, counts, asked, weights = (batch.column(i) for i in range(7))
            found = [], [], []
            for i, (q, d, dl) in enumerate(zip(query.to_pylist(), doc.to_pylist(), length.to_pylist(), strict=True)):
                if d != held:
                    held, tfs = d, dict(zip(terms[i].as_py(), counts[i].as_py(), strict=True))
                if q not in queries:
                    if len(queries) >= most:
                        queries.clear()
                    queries[q] = list(zip(asked[i].as_py(), weights[i].as_py(), strict=True))
                norm = K1 * (1 - B + B * dl / avgdl)
                gains = [w * (tf * (K1 + 1) / (tf + norm)) for term, w in queries[q] if (tf := tfs.get(term))]
                if gains:
                    for column, value in zip(found, (q, d, sum(gains)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], query.type), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=["query_id", "doc_id", "bm25"])

    return score


def score_pairs(index: Index, wanted: DataFrame, pairs: DataFrame) -> DataFrame:
    """(query_id, doc_id, bm25): exact scores of given pairs; pairs without a common term have none."""
    asked = wanted.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("e")).select("query_id", F.col("e.term").alias("asked"), F.col("e.w").alias("weights"))
    # documents with all their terms are only shuffled where too many pairs are wanted to be sent to all tasks
    few = F.broadcast(pairs) if pairs.count() <= SENT_ROWS else pairs
    rows = index.docs.select("doc_id", "dl", "terms", "tfs").join(few, "doc_id")
    rows = rows.join(F.broadcast(asked) if asked.count() <= SENT_QUERIES else asked, "query_id").select("query_id", "doc_id", "dl", "terms", "tfs", "asked", "weights")
    found = rows.mapInArrow(_scorer(index.avgdl, SENT_QUERIES), f"query_id {dict(pairs.dtypes)['query_id']}, doc_id long, bm25 double")
    return found.groupBy("query_id", "doc_id").agg(F.sum("bm25").alias("bm25"))  # a pair given more than once stays one row


def scores(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, bm25) of every document that shares a term with a query (query_id, query_text).

    Documents are placed by doc_id before their terms meet those of the queries, so the pairs are summed where they arise; a task
    gets few enough to hold their pairs with all queries.
    """
    wanted = settle(query_terms(index, queries))
    pairs = index.docs.count() * wanted.select("query_id").distinct().count()
    flat = _placed(index.docs, _parts(index.docs.sparkSession, pairs, TASK_PAIRS), "doc_id").select("doc_id", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
    flat = flat.select("doc_id", "dl", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf"))
    gain = F.col("w") * impact(F.col("tf"), F.col("dl"), F.lit(index.avgdl))
    return flat.join(wanted, "term").groupBy("query_id", "doc_id").agg(F.sum(gain).alias("bm25"))


def ranked(found: DataFrame) -> DataFrame:
    """``found`` (query_id, doc_id, bm25) with ``rank``, ties to the smaller doc_id, and ``sparse``, the score over the query's best.

    A query finds most documents, so its ranks are counted over many tasks and not in one window.
    """
    found = settle(found.withColumn("_worst", -F.round("bm25", 9)))
    peaks = found.groupBy("query_id").agg(F.max("bm25").alias("_peak"))
    parts = _parts(found.sparkSession, found.count(), TASK_PAIRS)
    placed = with_running_totals(found, ["query_id"], ["_worst", "doc_id"], {"rank": F.lit(1)}, parts)
    share = F.col("bm25") / F.when(F.col("_peak") > 0, F.col("_peak")).otherwise(1.0)
    return placed.join(peaks, "query_id").withColumn("sparse", share).drop("_worst", "_peak")


def _peak_scale(index: Index) -> Column:
    """With a longer mean length an impact grows, by the ratio of the lengths at most."""
    return F.greatest(F.lit(1.0), F.lit(index.avgdl) / F.col("avgdl"))


def _next_peaks(index: Index, wanted: DataFrame, tier: int) -> DataFrame:
    """(query_id, term, w, next): the most that a posting of the term behind the tiers up to ``tier`` can add."""
    rest = index.blocks.where(F.col("tier") == tier + 1).groupBy("term").agg(F.max(F.col("peak") * _peak_scale(index)).alias("next"))
    return wanted.join(rest, "term", "left").select("query_id", "term", "w", (F.col("w") * F.coalesce("next", F.lit(0.0))).alias("next"))


def _gains(index: Index, wanted: DataFrame, tier: int) -> DataFrame:
    """(query_id, doc_id, term, gain) of the postings in one tier for the terms of the queries still open."""
    held = index.blocks.where(F.col("tier") == tier).join(wanted, "term")
    flat = held.select("query_id", "term", "w", "segment", F.explode(F.arrays_zip("ids", "tfs", "dls")).alias("e"))
    flat = flat.select("query_id", "term", "segment", F.col("e.ids").alias("doc_id"), (F.col("w") * impact(F.col("e.tfs"), F.col("e.dls"), F.lit(index.avgdl))).alias("gain"))
    return _live(flat, index.gone).select("query_id", "term", "doc_id", "gain")


@dataclass(frozen=True)
class Found:
    """Top documents per query, and in how many tiers each query was settled."""

    top: DataFrame  # query_id, doc_id, bm25, rank
    rounds: DataFrame  # query_id, tiers


def top_k(index: Index, queries: DataFrame, k: int) -> Found:
    """The k best documents per query (query_id, query_text) by exact BM25, ties to the smaller doc_id; documents without a
    common term are never found.

    Round by round one more tier of the open queries' terms is read. What a document has so far is a lower bound of its score;
    with the next peaks of its terms not met yet, an upper one. A query is settled when no unmet document can reach its k-th
    lower bound; then only documents whose upper bound reaches it are scored exactly.
    """
    wanted = settle(query_terms(index, queries))
    open_, gains, stored = wanted, None, None
    candidates, rounds = [], []
    for tier in range(index.tiers):
        read = _gains(index, open_, tier)
        old, stored = stored, settle(read if gains is None else gains.unionByName(read))
        if old is not None:
            discard(old)
        bounds = settle(_next_peaks(index, open_, tier))
        # read three times, for the k-th bounds, the candidates and what is carried on, and far fewer rows than the gains
        met = settle(stored.join(bounds.drop("w"), ["query_id", "term"]).groupBy("query_id", "doc_id").agg(F.sum("gain").alias("low"), F.sum("next").alias("met")))
        best = Window.partitionBy("query_id").orderBy(F.desc("low"), "doc_id")
        kth = met.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("query_id").agg(
            F.when(F.count("*") == k, F.min("low")).alias("kth")
        )
        unmet = bounds.groupBy("query_id").agg(F.sum("next").alias("unmet"))
        limits = unmet.join(kth, "query_id", "left")
        # nothing is left behind the last tier; terms with negative weight break the bounds, so all is read then
        last = tier == index.tiers - 1
        done = F.lit(True) if last else F.lit(not index.negative) & F.coalesce(F.col("unmet") + SLACK < F.col("kth"), F.lit(False))
        limits = settle(limits.withColumn("done", done))
        reach = F.col("low") + F.col("unmet") - F.col("met") + SLACK >= F.coalesce("kth", F.lit(float("-inf")))
        reached = met.join(limits, "query_id").where(F.lit(index.negative) | reach)
        candidates.append(settle(reached.where("done").select("query_id", "doc_id")))
        rounds.append(limits.where("done").select("query_id", F.lit(tier + 1).alias("tiers")))
        if last or limits.where("NOT done").isEmpty():
            break
        open_ = settle(open_.join(limits.where("NOT done").select("query_id"), "query_id", "left_semi"))
        # a document out of reach of the k-th bound stays so; what it is met with later is less than its score
        kept = settle(reached.where("NOT done").select("query_id", "doc_id"))
        gains = stored.join(F.broadcast(kept) if kept.count() <= SENT_ROWS else kept, ["query_id", "doc_id"], "left_semi")
        discard(met)
    for frame in (stored, met):
        discard(frame)
    exact = score_pairs(index, wanted, reduce(DataFrame.unionByName, candidates))
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("bm25", 9)), "doc_id")
    top = exact.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return Found(top, reduce(DataFrame.unionByName, rounds))


def scaled(top: DataFrame) -> DataFrame:
    """``top`` with ``sparse``: the score over the query's best in the corpus, which is among its top documents."""
    peak = F.max("bm25").over(Window.partitionBy("query_id"))
    return top.withColumn("sparse", F.col("bm25") / F.when(peak > 0, peak).otherwise(1.0))
