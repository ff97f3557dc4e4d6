"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source is a queue of its documents in a fixed shuffled order, read twice at most. A copy's virtual finish time is
the words of its queue up to and including it, divided by the target of the source. The targets add up to the total
budget, so the budget is used up at virtual time one: the mix is all copies in the order of finish time, cut there. A
copy that straddles the cut is taken if at least half of it lies before, so no source ends farther from its target than
half a document.

A source may hold most rows, so no window spans one: queues are cut at 4096 ranges of the shuffle key, whose totals
are carried forward.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics.llm.frames import all_columns, row_hash
from staylytics.operators.ordering import with_global_index
from staylytics.session import settle

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _placed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, size, place, tie) of ``docs``: the whole row, what the mix needs of it, its shuffle key, whose first
    three digits number one of 4096 equal ranges, and a hash of the row.

    The key is of doc_id, or of the whole row where that is null; the tie orders rows that repeat a doc_id.
    """
    tie = row_hash(docs)
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row:"), tie.cast("string")))
    return docs.select(
        F.struct(*all_columns(docs)).alias("row"), "doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"),
        F.md5(F.concat(F.lit("mix:"), name).cast("binary")).alias("place"), tie.alias("tie"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all words by weight, none above ``most`` times its source's words.

    Sources in code point order, null last, take the weights in turn. What a full source cannot take goes to the open
    ones by weight, until none is above its limit.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_index(totals.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = settle(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * float(most)).alias("cap")))
    budget = float(table.agg(F.sum("source_size")).first()[0] or 0) * share
    full = F.lit(False)
    while True:
        open_, used = table.agg(F.sum(F.when(~full, F.col("w"))), F.sum(F.when(full, F.col("cap")))).first()
        rate = (budget - (used or 0.0)) / open_ if open_ else 0.0
        above = full | (F.col("w") * F.lit(rate) > F.col("cap"))
        if table.where(above & ~full).isEmpty():
            break
        full = above
    return table.select("source", "source_size", F.when(full, F.col("cap")).otherwise(F.col("w") * F.lit(rate)).alias("target"))


def _queues(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, place, tie, source_size, target, upto, own): words up to each row of a queue, and of the row itself.

    Equal rows count as one. Sources without words have no queue.
    """
    queue = rows.groupBy("source", "place", "tie").agg(F.sum("size").alias("own")).withColumn("bucket", F.substring("place", 1, 3))
    upto = Window.partitionBy("source", "bucket").orderBy("place", "tie").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = queue.groupBy("source", "bucket").agg(F.sum("own").alias("s"))
    carried = carried.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("carry"))
    inside = queue.withColumn("inside", F.sum("own").over(upto))
    done = inside.join(carried, inside["source"].eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    goal = targets.withColumnRenamed("source", "_t")
    done = done.join(goal, done["source"].eqNullSafe(F.col("_t"))).where("target > 0")
    return done.select("source", "place", "tie", "source_size", "target", (F.col("inside") + F.col("carry")).alias("upto"), "own")


def _taken(copy: int) -> Column:
    """Whether the middle of the first (0) or second (1) copy lies within the target."""
    return F.col("upto") - F.col("own") / 2 + F.col("source_size") * copy <= F.col("target")


def _rows(docs: DataFrame) -> DataFrame:
    return settle(_placed(docs).drop("row"))


def _in_order(copies: DataFrame) -> DataFrame:
    order = ["finish", "place", "tie"]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order)


def _copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(_p, _q, _r, finish): finish times of the copies of each row (source, place, tie) that lie before the cut."""
    finish = [F.when(_taken(k), (F.col("upto") + F.col("source_size") * k) / F.col("target")) for k in (0, 1)]
    held = F.array_compact(F.array(*finish)).alias("finish")
    queues = _queues(rows, targets).select(F.col("source").alias("_p"), F.col("place").alias("_q"), F.col("tie").alias("_r"), held)
    return queues.where(F.size("finish") > 0)


def _is_of(source: Column) -> Column:
    return source.eqNullSafe(F.col("_p")) & (F.col("place") == F.col("_q")) & (F.col("tie") == F.col("_r"))


def mix_report(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken.

    ``taken`` counts the words of the row's copies in the mix, repeats included; it is 0, 1 or 2 times ``size``. A null or
    empty text has size 0. Only rows that are equal in all columns are taken or left together. ``most`` is at most 2.
    """
    rows = _rows(docs)
    targets = settle(source_targets(rows, weights, share, most))
    copies = _copies(rows, targets).select("_p", F.col("_q").alias("place"), F.col("_r").alias("tie"), F.explode("finish").alias("finish"))
    mixed = settle(_in_order(copies))  # the mix without its texts
    count = mixed.groupBy("_p", F.col("place").alias("_q"), F.col("tie").alias("_r")).agg(F.count("*").alias("copies"))
    both = rows.join(count, _is_of(rows["source"]), "left").select("doc_id", "source", "size", F.coalesce("copies", F.lit(0)).alias("copies"))
    both = both.join(targets.withColumnRenamed("source", "_t"), both["source"].eqNullSafe(F.col("_t")))
    return both.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: every taken row of ``docs``, columns unchanged, once per copy, range-sorted by virtual finish time.

    Whole documents only. A source without any word is left out. Other columns may have any name and type. See
    ``mix_report``.
    """
    rows = _rows(docs)
    taken = _copies(rows, settle(source_targets(rows, weights, share, most)))
    held = _placed(docs).select("row", "source", "place", "tie")
    both = held.join(taken.hint("shuffle_hash"), _is_of(F.col("source")))
    return _in_order(both.select("row", F.explode("finish").alias("finish"), "place", "tie")).select("row.*")
