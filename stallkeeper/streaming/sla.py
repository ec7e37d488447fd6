"""Service limits of running jobs, from the events of their log, as a stateful stream.

The run of a day appends an event for every start and end of a job's attempt.  The stream keeps for each (run, job) when it first started and
how often; an end gives its row.  A job whose end is missing raises its alert by an event-time timer, once when it passes the warning limit and once
when it passes the critical one, while it is still running: time is what the other events say.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.pipeline import ALERT_FAILED, ALERT_LATE, SLA_CRITICAL, SLA_WARNING

ROW = "run string, job_name string, status string, attempts int, duration_seconds long, sla_level string, alert_message string"
STATE = "started long, attempts int, raised int"
NOW = {"availableNow": True}


def sla_rows(events: DataFrame, warning: int = SLA_WARNING, critical: int = SLA_CRITICAL, late: str = "1 minute") -> DataFrame:
    """One row for each ended attempt and for each limit that a running job passes."""

    def level(seconds: int) -> tuple[str, str | None]:
        return ("CRITICAL", ALERT_LATE) if seconds > critical else ("WARNING", ALERT_LATE) if seconds > warning else ("OK", None)

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        started, attempts, raised = state.get if state.exists else (None, 0, 0)
        rows, ended = [], False
        if state.hasTimedOut:
            passed = [x for x in (warning, critical) if (started + x) * 1000 < state.getCurrentWatermarkMs()]
            for limit in passed[raised:]:
                rows.append((*key, "RUNNING", attempts, limit, "WARNING" if limit == warning else "CRITICAL", ALERT_LATE))
            raised = len(passed)
        events = [e for batch in batches for e in batch[["at", "event"]].itertuples(index=False)]
        for at, event in sorted(events, key=lambda e: (e.at, e.event != "START")):
            second = int(at.timestamp())
            if event == "START":
                started, attempts, ended = second if started is None else started, attempts + 1, False
            elif started is not None:
                seconds = second - started
                rows.append((*key, event, attempts, seconds, *(("FAILED", ALERT_FAILED) if event == "FAILED" else level(seconds))))
                ended = event == "SUCCESS"
        if ended:
            if state.exists:
                state.remove()
        elif started is not None:
            state.update((started, attempts, raised))
            if raised < 2:
                due = (started + (warning, critical)[raised]) * 1000 + 1
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ROW.split(", ")])

    keyed = events.select("run", "job_name", "event", "at").withWatermark("at", late).groupBy("run", "job_name")
    return keyed.applyInPandasWithState(follow, ROW, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def sla_stream(events: DataFrame, target: str, checkpoint: str, trigger: dict = NOW, **limits) -> StreamingQuery:
    return (
        sla_rows(events, **limits).writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
