"""Conversation memory as keyed state: the last turns of every session, forgotten once the session has been idle."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from staylytics import constants as C

_TURN = "said_at long, turn long, role string, text string"
MEMORY = f"session_id long, seen long, recency int, {_TURN}"


class RecentTurns(StatefulProcessor):
    """State of a session: at most ``max_turns`` turns and how many have been seen; its timer runs out when it is idle.

    A session that gets turns hands out its memory, newest first, as it would be read ``read_delay`` seconds after the newest
    turn. A session that has been idle for ``ttl`` seconds of event time hands out one row without a turn.
    """

    def __init__(self, max_turns: int, ttl: int, read_delay: int) -> None:
        self.max_turns, self.ttl, self.read_delay = max_turns, ttl, read_delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.turns = handle.getListState("turns", _TURN)
        self.seen = handle.getValueState("seen", "seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.seen.get()[0] if self.seen.exists() else 0
        arrived = 0

        def counted():
            nonlocal arrived
            for r in rows:
                arrived += 1
                yield (r["said_at"], r["turn"], r["role"], r["text"])

        order = lambda t: (t[0], t[1] is not None, t[1] or 0)
        newest = heapq.nlargest(self.max_turns, chain((tuple(t) for t in self.turns.get()), counted()), key=order)
        oldest = newest[0][0] + self.read_delay - self.ttl
        live = [t for t in newest if t[0] >= oldest]
        self.turns.put(live)
        self.seen.update((seen + arrived,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((newest[0][0] + self.ttl) * 1000)
        for recency, (said_at, turn, role, text) in enumerate(live, 1):
            yield Row(session_id=key[0], seen=seen + arrived, recency=recency, said_at=said_at, turn=turn, role=role, text=text)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        seen = self.seen.get()[0]
        self.turns.clear()
        self.seen.clear()
        yield Row(session_id=key[0], seen=seen, recency=None, said_at=None, turn=None, role=None, text=None)

    def close(self) -> None:
        pass


def remembered(turns: DataFrame, max_turns: int = C.MEMORY_TURNS, ttl: int = C.MEMORY_TTL_SECONDS, read_delay: int = 60, delay: str = "10 minutes") -> DataFrame:
    """Stream of memory states (``MEMORY``) from a stream of session_id, turn, role, text and said_at (seconds).

    Turns more than ``delay`` behind the newest of all are late and ignored. Start it with ``sinks.disk_state``.
    """
    timed = turns.withColumn("ts", F.timestamp_seconds("said_at")).withWatermark("ts", delay)
    return timed.groupBy("session_id").transformWithState(
        RecentTurns(max_turns, ttl, read_delay), outputStructType=MEMORY, outputMode="append", timeMode="eventTime"
    )


def last_memory(states: DataFrame) -> DataFrame:
    """Per session the memory handed out last, and whether the session has expired since."""
    newest = states.groupBy("session_id").agg(F.max("seen").alias("seen"), F.max_by("recency", F.struct("seen", F.col("recency").isNull())).isNull().alias("expired"))
    return states.where("recency IS NOT NULL").join(newest, ["session_id", "seen"])
