"""The daily job: check, roll up, verify, summarise, drop old days, log the run."""

from __future__ import annotations

import time
from datetime import date as Date
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ringtally.operators.events import drop_repeats
from ringtally.operators.rollups import between_days, daily_stats, hourly_partials, hourly_stats
from ringtally.operators.rollups import daily_stats_extended
from ringtally.plans.quality import require_quality, require_results
from ringtally.plans.reports import Tables, batch_summary
from ringtally.plans.windows import compact_day, load_hourly_users, stored_metrics
from ringtally.sources.store import Store, _days
from ringtally.streaming.runlog import log_run


def stored_tables(store: Store) -> Tables:
    return Tables(
        raw_events=store.read("raw_events"),
        anomalies=store.read("anomalies"),
        daily_stats=store.read("daily_stats"),
        hourly_stats=store.read("hourly_stats"),
        real_time_metrics=stored_metrics(store),
    )


def newest_time(store: Store):
    """The latest event time, from the newest day that has one: the present moment (``as_of``)
    for reports on stored tables. Days are folder names; older days are not opened."""
    for day in reversed(store.days("raw_events")):
        newest = store.read_days("raw_events", day, day).agg(F.max("timestamp")).first()[0]
        if newest is not None:
            return newest
    return None


def run_rollups(
    store: Store,
    first: Date,
    last: Date | None = None,
    extended: bool = False,
    remove_empty: bool = False,
) -> None:
    """Replace the rollups of some days. The events are read once: both tables are built from
    the hourly partials, which are kept (on disk if need be) between the two writes and
    computed again from the events if an executor is lost. Counting users needs the events
    themselves, so ``extended`` reads them a second time. An event delivered twice counts once.

    Rollups outlive their events: a day without raw events keeps its rollup. ``remove_empty``
    removes it where the day is not older than the oldest raw day, that is, where its events
    were taken away and did not expire."""
    last = last or first
    events = drop_repeats(between_days(store.read_days("raw_events", first, last), first, last))
    partials = hourly_partials(events).persist(StorageLevel.MEMORY_AND_DISK)
    # A few thousand rows a day: one file per day, many days side by side.
    tasks = min((last - first).days + 1, store.spark.sparkContext.defaultParallelism)
    try:
        store.load("hourly_stats", hourly_stats(partials), layout="repartition", tasks=tasks)
        store.load("daily_stats", daily_stats(partials), layout="repartition", tasks=tasks)
        if extended:
            rows = daily_stats_extended(events, partials)
            store.load("daily_stats_extended", rows, layout="repartition", tasks=tasks)
            load_hourly_users(store, first, last)
    finally:
        partials.unpersist()
    present = store.days("raw_events") if remove_empty else []
    if not present:
        return
    # A day whose events are gone has no rows to replace its old rollup with.
    gone = [d for d in _days(first, last) if d > present[0] and d not in set(present)]
    for table in ("daily_stats", "hourly_stats", "daily_stats_extended", "hourly_users"):
        store.drop_days(table, [d for d in gone if d in set(store.days(table))])


def run_daily(
    store: Store,
    day: Date,
    as_of=None,
    keep_days: int | dict[str, int] | None = None,
    least_events: int = 100,
    extended: bool = False,
    compact: bool = False,
) -> dict:
    """One day from gate to clean-up; the first failure is logged and raised.

    ``keep_days`` is for raw events, or a number for each table that expires. ``compact``
    rewrites the day's many small loads: only for days that no stream writes to any more."""
    started, clock = datetime.now(timezone.utc), time.monotonic()
    status, error, checked = "completed", None, {}
    try:
        tables = Tables(raw_events=store.read("raw_events"))
        checked = require_quality(tables, as_of or day, least_events)
        run_rollups(store, day, extended=extended)
        tables.daily_stats = store.read("daily_stats")
        tables.hourly_stats = store.read("hourly_stats")
        require_results(tables)
        summary = batch_summary(tables).first().asDict()
        if compact:
            summary["compacted"] = compact_day(store, day)
        if keep_days is not None:
            limits = keep_days if isinstance(keep_days, dict) else {"raw_events": keep_days}
            expired = {t: store.expire(t, day, n) for t, n in limits.items()}
            summary["expired"] = expired
            summary["expired_days"] = expired.get("raw_events", [])
        return summary
    except Exception as failure:
        status, error = "failed", str(failure)
        raise
    finally:
        log_run(
            store,
            name="daily_rollups",
            kind="batch",
            status=status,
            processed=checked.get("total_events", 0),
            failed=0,
            seconds=int(time.monotonic() - clock),
            error=error,
            started=started,
        )
