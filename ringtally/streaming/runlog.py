"""The run log: one row per finished run or reported stream, appended as it happens."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener

from ringtally.schema import RUN_STATUSES
from ringtally.sources.store import Store

# Name under which the archive stream counts the rows it refuses.
REFUSED = "refused"

COLUMNS = (
    "pipeline_name string, pipeline_type string, status string, records_processed bigint,"
    " records_failed bigint, processing_time_seconds int, error_message string,"
    " started_at timestamp, completed_at timestamp"
)


def log_run(
    store: Store,
    name: str,
    kind: str,
    status: str,
    processed: int,
    failed: int,
    seconds: int,
    error: str | None,
    started: datetime,
) -> None:
    if status not in RUN_STATUSES:
        raise ValueError(f"unknown status {status!r}")
    done = None if status in ("running", "pending") else datetime.now(timezone.utc)
    row = (name, kind, status, processed, failed, seconds, error, started, done)
    frame = store.spark.createDataFrame([row], COLUMNS)
    store.load("pipeline_monitoring", frame, load_id=uuid.uuid4().hex)


@dataclass
class Totals:
    started: datetime
    processed: int = 0
    failed: int = 0
    milliseconds: int = 0


class StreamTotals(StreamingQueryListener):
    """Adds up the report of every batch; Spark itself keeps only the latest hundred. Failed are
    the refused rows, counted in the same pass that archives them, and for metrics the rows that
    came when their window was closed. To be added before streams start:
    ``spark.streams.addListener(totals)``."""

    def __init__(self):
        self._runs: dict[str, Totals] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        refused = report.observedMetrics.get(REFUSED)
        with self._changed:
            run = self._runs.setdefault(str(report.runId), Totals(_time(report.timestamp)))
            run.processed += report.numInputRows
            run.failed += refused.failed if refused else 0
            run.failed += sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
            run.milliseconds += report.durationMs.get("triggerExecution", 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def of(self, query, patience: float = 30.0) -> Totals:
        """Totals of a query; reports of one that has ended may still be on their way."""
        run = str(query.runId)
        with self._changed:
            if not query.isActive:
                self._changed.wait_for(lambda: run in self._ended, patience)
            return self._runs.get(run) or Totals(datetime.now(timezone.utc))


def _recent(query) -> Totals:
    batches = query.recentProgress
    return Totals(
        _time(batches[0]["timestamp"]) if batches else datetime.now(timezone.utc),
        sum(int(b["numInputRows"]) for b in batches),
        failed=sum(int(s["numRowsDroppedByWatermark"]) for b in batches for s in b["stateOperators"]),
        milliseconds=sum(int(b["durationMs"].get("triggerExecution", 0)) for b in batches),
    )


def log_stream(store: Store, query, totals: StreamTotals | None = None) -> None:
    """Log a streaming query. Without ``totals`` only its latest hundred batches are known, and
    of failed rows only the late ones."""
    run = totals.of(query) if totals else _recent(query)
    failure = query.exception()
    log_run(
        store,
        name=query.name or str(query.id),
        kind="streaming",
        status="failed" if failure else "running" if query.isActive else "completed",
        processed=run.processed,
        failed=run.failed,
        seconds=run.milliseconds // 1000,
        error=str(failure) if failure else None,
        started=run.started,
    )


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00"))
