"""Visits as a stream: events wait until the watermark has passed them, then pair in the order of time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import visits as batch

OUT = "phone string, station string, enter bigint, leave bigint, time bigint, flag int, reason string"
STATE = "times array<bigint>, flags array<int>, entered bigint"
NONE = -(1 << 62)


def paired(entered: int, waiting: list[tuple[int, int]]) -> tuple[int, list[tuple]]:
    """(time of the open enter event or NONE, rows) after events in order of time, flag: rows are (enter, leave, time, flag, reason)."""
    rows = []
    for time, flag in waiting:
        if flag == batch.ENTER:
            if entered != NONE:
                rows.append((None, None, entered, batch.ENTER, "no leave"))
            entered = time
        elif entered == NONE:
            rows.append((None, None, time, batch.LEAVE, "no enter"))
        else:
            rows.append((entered, time, None, None, None))
            entered = NONE
    return entered, rows


def visit_stream(lines: DataFrame, delay: str = "1 hour", longest: int = 7 * 86_400) -> DataFrame:
    """phone, station, enter, leave of visits, or time, flag, reason of events without a partner, given out when the watermark has passed them.

    An enter event waits ``longest`` seconds for its leave event. Lines that arrive after the watermark has passed their time are not read. Otherwise the rows are those
    of ``visits`` and ``unmatched`` over all lines, whatever the batches.
    """
    rows = batch.events(lines).withWatermark("time", delay).select("phone", "station", "time", F.unix_millis("time").alias("millis"), "flag")

    def work(key: tuple, groups: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, flags, entered = state.get if state.exists else ([], [], NONE)
        waiting = list(zip(times, flags))
        if not state.hasTimedOut:
            for group in groups:
                waiting += zip(group["millis"].tolist(), group["flag"].tolist())
        passed = state.getCurrentWatermarkMs()
        waiting.sort()
        ready = [e for e in waiting if e[0] <= passed]
        waiting = waiting[len(ready) :]
        entered, found = paired(entered, ready)
        if entered != NONE and not waiting and passed >= entered + longest * 1000:
            found.append((None, None, entered, batch.ENTER, "no leave"))
            entered = NONE
        if waiting or entered != NONE:
            state.update(([t for t, _ in waiting], [f for _, f in waiting], entered))
            state.setTimeoutTimestamp(max(passed + 1, waiting[0][0] if waiting else entered + longest * 1000))
        elif state.exists:
            state.remove()
        if found:
            out = pd.DataFrame([(*key, *r) for r in found], columns=[c.split()[0] for c in OUT.split(", ")])
            yield out.astype({"enter": "Int64", "leave": "Int64", "time": "Int64", "flag": "Int32"})

    found = rows.groupBy("phone", "station").applyInPandasWithState(work, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    as_time = {c: F.timestamp_millis(c) for c in ("enter", "leave", "time")}
    return found.withColumns(as_time)
