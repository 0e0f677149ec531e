"""Incremental forms on Structured Streaming: extensions beside the batch engine."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATENESS = "2 days"


def daily_presence(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """(window, sku, events): each SKU's events per day; rows later than the watermark are dropped."""
    day = F.window("ts", "1 day")
    return events.withWatermark("ts", lateness).groupBy(day, "sku").agg(F.count(F.lit(1)).alias("events"))


def rolling_counts(events: DataFrame, span: str = "7 days", step: str = "1 day", lateness: str = LATENESS) -> DataFrame:
    """Sliding calendar windows of event counts by type."""
    return events.withWatermark("ts", lateness).groupBy(F.window("ts", span, step), "event_type").agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes", lateness: str = LATENESS) -> DataFrame:
    return events.withWatermark("ts", lateness).groupBy(F.session_window("ts", gap), "sku").agg(F.count(F.lit(1)).alias("n"))


def once_per_key(rows: DataFrame, key: str, lateness: str = LATENESS) -> DataFrame:
    """Each event key once within the watermark."""
    return rows.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key])


def lifecycle_stream(cells: DataFrame, threshold: int = 3) -> DataFrame:
    """(sku, day, classification) from a stream of (sku, day, present), days of a SKU in order.

    State per SKU: last day, whether seen, absences. The last day again is a
    replay and gives no row; a day before it is LATE, says so in a row of its
    own and changes nothing, as the days after it are decided.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, seen, gone = state.get if state.exists else ("", False, 0)
        rows = pd.concat(list(batches)).sort_values("day")
        out = []
        for day, present in zip(rows["day"].tolist(), rows["present"].tolist()):
            if day <= last:
                if day < last:
                    out.append((key[0], day, "LATE"))
                continue
            last = day
            if present:
                kind = "NEW" if not seen else "REAPPEARED" if gone else "ACTIVE"
                seen, gone = True, 0
            elif not seen or gone >= threshold:
                kind = "ABSENT"
            else:
                gone += 1
                kind = "OFFLINE" if gone == threshold else "MISSING_FIRST" if gone == 1 else "MISSING_CONTINUED"
            out.append((key[0], day, kind))
        state.update((last, seen, gone))
        yield pd.DataFrame(out, columns=["sku", "day", "classification"])

    return cells.groupBy("sku").applyInPandasWithState(step, "sku string, day string, classification string", "last string, seen boolean, gone int", "append", GroupStateTimeout.NoTimeout)


def committed_sink(table):
    """A foreachBatch function that appends each micro-batch once, by its number; it writes the batch's rows only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if table.log().where(F.col("run_id") == f"batch-{batch_id}").limit(1).count():
            return
        head = table.head()
        table.commit(batch, f"batch-{batch_id}", head.commit_id if head else None, append=True)

    return write
