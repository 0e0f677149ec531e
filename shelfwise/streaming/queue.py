"""A work queue as a stream of actions: one state for each unit, claims that go stale by timer.

Actions are INGEST, CLAIM, COMPLETE, FAIL, BLOCK and REQUEUE. A unit is ingested
once, whatever is sent again. Only a pending or retried unit can be claimed, only
a claimed one completed, failed or blocked, only a blocked one requeued; any
other action changes nothing and says so. A claim older than `minutes` goes back
to RETRY: by timer when the watermark passes it, or before the unit's next
action, so that results do not depend on how rows fall into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "status string, attempts int, claimed long, reason string, steps long"
RESULT = "unit string, step long, micros long, action string, status string, attempts int, changed boolean, reason string"
STALE = "STALE_CLAIM_RECOVERED"


def after(state: tuple | None, action: str, at, reason: str | None, retries: int) -> tuple | None:
    """The state (status, attempts, microsecond of the claim, reason) after an action, or None where it changes nothing."""
    if state is None:
        return ("PENDING", 0, None, None) if action == "INGEST" else None
    status, attempts, _, _ = state
    if action == "CLAIM" and status in ("PENDING", "RETRY"):
        return "CLAIMED", attempts, at, None
    if status == "CLAIMED":
        if action == "COMPLETE":
            return "COMPLETED", attempts, None, None
        if action == "FAIL":
            return "RETRY" if attempts + 1 <= retries else "FAILED", attempts + 1, None, reason
        if action == "BLOCK":
            return "BLOCKED", attempts, None, reason
    if action == "REQUEUE" and status == "BLOCKED":
        return "RETRY", attempts, None, reason
    return None


class Queue(StatefulProcessor):
    def __init__(self, minutes: int, retries: int):
        self.minutes, self.retries = minutes, retries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.unit = handle.getValueState("unit", STATE)

    def load(self) -> tuple[tuple | None, int]:
        """The state, without a unit of its own before it is ingested, and the number of transitions so far."""
        if not self.unit.exists():
            return None, 0
        *state, steps = self.unit.get()
        return (None if state[0] is None else tuple(state)), steps

    def due(self, state: tuple) -> int:
        return state[2] + self.minutes * 60_000_000

    def timers(self, state: tuple | None) -> None:
        """One timer at most: the claim's end."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if state is not None and state[0] == "CLAIMED":
            self.handle.registerTimer(self.due(state) // 1000 + 1)

    def row(self, key, step: int, at, action: str, state: tuple | None, changed: bool) -> Row:
        status, attempts, _, reason = state if state is not None else (None, None, None, None)
        return Row(unit=key[0], step=step, micros=at, action=action, status=status, attempts=attempts, changed=changed, reason=reason)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state, step = self.load()
        for own in sorted(rows, key=lambda r: (r["micros"], r["seq"])):
            if state is not None and state[0] == "CLAIMED" and own["micros"] > self.due(state):
                at, state, step = self.due(state), ("RETRY", state[1], None, STALE), step + 1
                yield self.row(key, step, at, "EXPIRE", state, True)
            new = after(state, own["action"], own["micros"], own["reason"], self.retries)
            state, step = state if new is None else new, step + 1
            yield self.row(key, step, own["micros"], own["action"], state, new is not None)
        self.unit.update((*(state or (None, None, None, None)), step))
        self.timers(state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, step = self.load()
        if state is not None and state[0] == "CLAIMED":
            at, state = self.due(state), ("RETRY", state[1], None, STALE)
            self.unit.update((*state, step + 1))
            yield self.row(key, step + 1, at, "EXPIRE", state, True)


def transitions(actions: DataFrame, minutes: int = 15, retries: int = 3, delay: str = "0 seconds") -> DataFrame:
    """unit, step, at, action, status, attempts, changed, reason: a row for each action and each claim that went stale; steps number a unit's rows.

    actions: a stream of unit, at, seq, action, reason. Rows later than the
    delay are still taken, as state is kept by unit and not by window.
    """
    watched = actions.select(F.col("unit").cast("string"), "at", F.unix_micros("at").alias("micros"), F.col("seq").cast("long"), "action", "reason").withWatermark("at", delay)
    moved = watched.groupBy("unit").transformWithState(Queue(minutes, retries), RESULT, "Append", "EventTime")
    return moved.select("unit", "step", F.timestamp_micros("micros").alias("at"), "action", "status", "attempts", "changed", "reason")


def latest_states(log: DataFrame) -> DataFrame:
    """(unit, status, attempts, reason) after the last transition of each ingested unit."""
    return log.where("changed").groupBy("unit").agg(F.max_by(F.struct("status", "attempts", "reason"), "step").alias("s")).select("unit", "s.*")
