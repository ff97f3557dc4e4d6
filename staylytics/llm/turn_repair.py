"""Repair of conversations: the cheapest edits that make the roles of the turns follow ``(s?(ua)+)?``.

Rows are placed by conversation and sorted, and a task reads them as a stream (``_repairs``). Every ``SEGMENT`` rows a
depth-first branch-and-bound with an explicit stack (``search``) extends the best prefix of each state by a segment:
suffix lower bounds and the incumbent cut off prefixes that cannot end better, a dominance table per (row, state) drops
those that are worse than one seen there. Prefixes are compared by (cost, audit). What all remaining prefixes have in
common is handed on and forgotten, so a task holds about a segment of one conversation, however long that is.

States: 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant turn; 0 and 3 may end.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 32  # rows searched at a time; with far longer ones worse prefixes are met too late to be dropped
SPREAD = 10  # the most that one state's best continuation costs more than another's: two inserted turns
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; the last for a truncated row that stays
WHITE_SPACE = " \t\n\x0b\x0c\r"
_NEXT = (2, 2, 3, 2)  # the state after a user or assistant turn that fits, by state
_ROLE = {2: "user", 3: "assistant"}


@dataclass(frozen=True)
class Row:
    role: str
    text: str
    fault: str  # '', 'blank', 'duplicate' or 'truncated'


def _moves(state: int, row: Row) -> list[tuple[int, str, int]]:
    """(cost, audit, state) of the edits of a row in ``state``, dearest first."""
    out = [(DELETE, "D", state)]
    if row.fault in ("", "truncated"):
        stays = TRUNCATED if row.fault else 0
        out.append((REROLE + stays, "R", _NEXT[state]))
        first = row.role[:1]
        if first == "s" and state == 0:
            out.append((stays, "K", 1))
        elif first and first == _ROLE[_NEXT[state]][0]:
            out.append((stays, "K", _NEXT[state]))
    return sorted(out, reverse=True)


def suffix_bounds(rows: list[Row]) -> list[int]:
    """For every row a lower bound of what it and those behind it cost, whatever the state.

    A row costs its cheapest edit; two neighbours that could both stay for nothing, but not side by side, cost one more.
    """
    least = [0 if not r.fault and r.role[:1] in ("s", "u", "a") else REROLE if not r.fault else DELETE for r in rows]
    bound = [0] * (len(rows) + 2)
    for i in range(len(rows) - 1, -1, -1):
        bound[i] = least[i] + bound[i + 1]
        if i + 1 < len(rows) and least[i] == least[i + 1] == 0 and rows[i].role[:1] + rows[i + 1].role[:1] not in ("su", "ua", "au"):
            bound[i] = max(bound[i], 1 + bound[i + 2])
    return bound


def search(rows: list[Row], begin: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """Best (cost, audit) by state behind ``rows`` for the best ones before them; the one that ends if ``last``.

    Prefixes that differ in state behind the rows are kept while their costs are within ``SPREAD``: a dearer one cannot
    win any more, since the cheaper one's state can be led to do the same for that much.
    """
    n, bound = len(rows), suffix_bounds(rows)
    slack = 0 if last else SPREAD
    table: dict[tuple[int, int], tuple[int, str]] = {}
    incumbent: tuple[int, str] | None = None
    stack = [(0, state, cost, audit) for state, (cost, audit) in sorted(begin.items(), key=lambda x: x[1], reverse=True)]
    while stack:
        i, state, cost, audit = stack.pop()
        if incumbent is not None:
            over = cost + bound[i] - incumbent[0] - slack
            if over > 0 or over == 0 and last and audit > incumbent[1][: len(audit)]:
                continue
        seen = table.get((i, state))
        if seen is not None and seen <= (cost, audit):
            continue
        table[i, state] = cost, audit
        if i == n and (not last or state in (0, 3)):
            if incumbent is None or (cost, audit) < incumbent:
                incumbent = cost, audit
            continue
        stack.append((i, _NEXT[state], cost + INSERT, audit + "I"))
        if i < n:
            stack.extend((i + 1, to, cost + more, audit + mark) for more, mark, to in _moves(state, rows[i]))
    if last:
        return {state: table[n, state] for state in (0, 3) if table.get((n, state)) == incumbent}
    return {state: got for state in range(4) if (got := table.get((n, state))) is not None and got[0] <= incumbent[0] + SPREAD}


@dataclass
class Turn:
    """A turn of the repaired conversation, or a deleted one: edit K, R, D or I."""

    edit: str
    role: str
    text: str


@dataclass
class _Conversation:
    """What a task holds of the conversation it reads."""

    conv_id: int | None
    best: dict[int, tuple[int, str]] = field(default_factory=lambda: {0: (0, "")})
    state: int = 0  # where the prefixes of ``best`` begin
    pending: list[Row] = field(default_factory=list)  # rows from there on
    done: int = 0  # how many of them the prefixes cover
    faults: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0
    previous: str | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0

    def add(self, turn: int | None, row: Row) -> None:
        if row.fault:
            self.faults[row.fault] += 1
        if self.previous is not None and self.previous + row.role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.previous = row.role[:1]
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        self.pending.append(row)

    def advance(self, last: bool) -> Iterator[Turn]:
        """Search what is pending; give back the turns that every remaining prefix agrees on."""
        self.best = search(self.pending[self.done :], self.best, last)
        self.done = len(self.pending)
        sure = os.path.commonprefix([audit for _, audit in self.best.values()])
        used = 0
        for edit in sure:
            row = None if edit == "I" else self.pending[used]
            used += edit != "I"
            if edit == "D":
                yield Turn("D", row.role, row.text)
                continue
            if edit == "K":
                role, self.state = row.role, 1 if row.role[0] == "s" else _NEXT[self.state]
            else:
                self.state = _NEXT[self.state]
                role = _ROLE[self.state]
            yield Turn(edit, role, row.text if row else "")
        del self.pending[:used]
        self.done -= used
        self.best = {state: (cost, audit[len(sure) :]) for state, (cost, audit) in self.best.items()}

    def summary(self) -> dict[str, int]:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {"gaps": gaps, **self.faults, "illegal": self.illegal, "cost": min(self.best.values())[0]}


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Turn | dict[str, int]]]:
    """From sorted rows, for each conversation its turns in order and then its summary, each with the conv_id."""
    now: _Conversation | None = None
    for batch in batches:
        for conv_id, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield from ((now.conv_id, x) for x in now.advance(True))
                    yield now.conv_id, now.summary()
                now = _Conversation(conv_id)
            if fault == "dropped":
                continue
            now.add(turn, Row(role, text, fault))
            if len(now.pending) - now.done >= SEGMENT:
                yield from ((conv_id, x) for x in now.advance(False))
    if now is not None:
        yield from ((now.conv_id, x) for x in now.advance(True))
        yield now.conv_id, now.summary()


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with nulls in role and text read as one space, damaged by a hash of
    ``conv_id:turn`` (null: one space); ``dropped`` marks rows that are gone, so that every conv_id stays."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _fault() -> Column:
    bare = F.rtrim("text", F.lit(WHITE_SPACE))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.col("turn").asc_nulls_first())) > 1
    ends = F.substring(bare, -1, 1).isin(".", "!", "?")
    return F.when(F.col("dropped"), "dropped").when(bare == "", "blank").when(again, "duplicate").when(~ends, "truncated").otherwise("")


def _streamed(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, all of a conversation in one partition, in order."""
    placed = rows.withColumn("fault", _fault()).drop("dropped").repartition("conv_id")
    return placed.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


_TURNS = "conv_id long, place long, edit string, role string, text string"
_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_BATCH = 2_000


def _batches(rows: Iterator[dict], schema: str, batch: int = _BATCH) -> Iterator[pa.RecordBatch]:
    names = [c.split() for c in schema.split(", ")]
    fields = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in names])
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row.get("text") or "")
        if len(held) >= batch or size > 4_000_000:
            yield pa.RecordBatch.from_pylist(held, fields)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, fields)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations turn by turn: conv_id, place (from 0), edit, role, text; deleted rows without a place.

    ``rows`` has conv_id, turn, role, text and dropped (rows that only keep a conv_id alive). Order is by turn, nulls
    first, then role and text. A row whose role is empty, or starts with neither s, u nor a, cannot stay as it is. Rows
    without a conv_id form one conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[dict]:
            own, place = object(), 0
            for conv_id, x in _repairs(batches):
                if isinstance(x, dict):
                    continue
                place, own = (0 if conv_id != own else place), conv_id
                yield {"conv_id": conv_id, "place": None if x.edit == "D" else place, "edit": x.edit, "role": x.role, "text": x.text}
                place += x.edit != "D"

        yield from _batches(turns(), _TURNS)

    return _streamed(rows).mapInArrow(run, _TURNS)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conv_id: what ``repaired_turns`` found and did, its turns as a hash of ``role:text`` lines.

    gaps counts missing numbers between the least and greatest turn (none without turns); blank, duplicate and truncated
    count rows by their first fault; illegal counts neighbours whose roles may not follow each other. A conversation
    without rows has zeros, an empty audit and the hash of the empty string; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reports() -> Iterator[dict]:
            digest, lines, audit = hashlib.sha256(), 0, []
            for conv_id, x in _repairs(batches):
                if isinstance(x, dict):
                    yield {"conv_id": conv_id, **x, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                    digest, lines, audit = hashlib.sha256(), 0, []
                    continue
                audit.append(x.edit)
                if x.edit != "D":
                    digest.update(("\n" if lines else "").encode() + f"{x.role}:{x.text}".encode())
                    lines += 1

        yield from _batches(reports(), _REPORT)

    return _streamed(rows).mapInArrow(run, _REPORT)
