"""Chat formatting of reply trees, in DataFrame operations only.

Self-joins with doubling reach (1, 2, 4 ... replies up) give every message its summed score and depth in a number of rounds
that grows with the logarithm of the deepest tree; the same tables, read backwards, list the messages of the chosen
root-to-leaf paths without touching the others. Each path becomes one text

    ### role: text</turn>

per message, a newline after each, and the places of what is trained on. In texts and roles a backslash becomes ``\\b``,
``###`` becomes ``\\h\\h\\h``, ``</turn>`` becomes ``\\l/turn>``, and in roles a colon becomes ``\\c``: marks of the template
cannot occur inside, and ``read_back`` restores the messages exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics.operators.ordering import with_global_index
from staylytics.session import settle

HEAD, TAIL = "### ", "</turn>\n"
_ESCAPES = [("\\", "\\b"), ("###", "\\h\\h\\h"), ("</turn>", "\\l/turn>")]
_RESTORED = [("\\h", "#"), ("\\l", "<"), ("\\c", ":"), ("\\b", "\\")]


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in [*_ESCAPES, *([(":", "\\c")] if role else [])]:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for coded, plain in _RESTORED:
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def thread_nodes(rows: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) as reply trees: each row answers the one before it.

    Rows are ordered by turn, a null turn first; equal turns by role and text, so repeated rows are turns of their own.
    Positions come from a range sort, so a conversation with most rows is not one task.
    """
    order = ["conv_id", "turn", "role", "text"]
    placed = settle(with_global_index(rows.select(*order), order, "node_id"))
    before = placed.select((F.col("node_id") + 1).alias("_next"), F.col("node_id").alias("parent_id"), F.col("conv_id").alias("_conv"))
    same = (F.col("node_id") == F.col("_next")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    joined = placed.join(before, same, "left")
    return joined.select(F.col("conv_id").alias("tree_id"), "node_id", "parent_id", "role", "text", F.lit(0.0).alias("score"))


def _reaches(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables (node, up) for 1, 2, 4 ... replies, and (node, total, depth) of all messages below a root."""
    known = nodes.select(F.col("node_id").alias("parent_id"), F.col("node_id").alias("up"))
    rooted = nodes.where("parent_id IS NULL").select("node_id", F.lit(None).cast("long").alias("up"), "score")
    linked = nodes.where("parent_id IS NOT NULL").join(known, "parent_id", "left").select("node_id", "up", "score")
    both = rooted.union(linked).select(F.col("node_id").alias("node"), "up", F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("depth"))
    now, jumps = settle(both), []
    rounds = now.count().bit_length()
    for _ in range(rounds):  # a longer walk than there are messages goes round in a circle
        climbing = now.where("up IS NOT NULL")
        if climbing.isEmpty():
            break
        jumps.append(climbing.select("node", "up"))
        higher = now.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        moved = climbing.join(higher, "up").select("node", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"), (F.col("depth") + F.col("_depth")).alias("depth"))
        now = settle(moved.union(now.where("up IS NULL")))
    return jumps, now.where("up IS NULL").select("node", "total", "depth")


def format_trees(nodes: DataFrame, branches: int = 1, trained_role: str = "assistant") -> DataFrame:
    """The ``branches`` best root-to-leaf paths of each tree as one conversation each.

    ``nodes``: tree_id, node_id (unique long), parent_id, role, text, score. Returns tree_id, leaf_id, rank, score,
    n_turns, formatted, loss_spans (start, length in code points of ``formatted``, in order). A path's score is the mean
    of its messages' scores (null: 0); ties go to the smaller leaf. A parent that does not exist makes its reply a root;
    messages that only lead into a circle take no part. Null role and text read as empty.
    """
    nodes = settle(nodes)
    jumps, totals = _reaches(nodes)
    parents = nodes.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("node")).distinct()
    leaves = totals.join(parents, "node", "left_anti").join(nodes.select(F.col("node_id").alias("node"), "tree_id"), "node")
    leaves = leaves.withColumn("score", F.col("total") / F.col("depth"))
    best = Window.partitionBy("tree_id").orderBy(F.desc("score"), "node")
    chosen = settle(leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches))
    path = chosen.select(F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up_by"))
    for k in reversed(range(len(jumps))):
        onward = path.join(jumps[k], "node", "left")
        steps = F.array(F.struct("node", "up_by"), F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("node"), (F.col("up_by") + (1 << k)).alias("up_by"))))
        path = settle(onward.select("leaf", F.explode(F.array_compact(steps)).alias("s")).select("leaf", "s.node", "s.up_by"))

    texts = nodes.select(F.col("node_id").alias("node"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(HEAD), escape(F.col("role"), role=True), F.lit(": "))
    turns = path.join(texts, "node").select("leaf", "up_by", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    upto = Window.partitionBy("leaf").orderBy(F.desc("up_by")).rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + len(TAIL)
    turns = turns.withColumn("at", F.coalesce(F.sum(length).over(upto), F.lit(0)))
    span = F.struct(F.col("at").alias("at"), (F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    whole = turns.groupBy("leaf").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("at", F.concat("head", "body", F.lit(TAIL)).alias("turn")))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("role") == trained_role, span))).alias("spans"),
    )
    return whole.join(chosen.select(F.col("node").alias("leaf"), "tree_id", "rank", "score"), "leaf").select(
        "tree_id", F.col("leaf").alias("leaf_id"), "rank", "score", "n_turns", F.array_join("turns.turn", "").alias("formatted"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The messages of a formatted conversation, as an array of (role, text)."""
    turns = F.split(formatted, TAIL, -1)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def message(turn: Column) -> Column:
        role = F.substring_index(F.substr(turn, F.lit(len(HEAD) + 1)), ": ", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(turn, F.length(role) + len(HEAD) + 3)).alias("text"))

    return F.transform(turns, message)


def loss_text(formatted: Column, spans: Column) -> Column:
    """What the loss mask covers, restored and joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from ``formatted``."""
    turns = read_back(F.col("formatted"))
    seen = formatted.select("tree_id", "formatted", turns.alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return seen.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
