"""Sinks for micro-batches. A failed write fails the query: the batch is then tried again
from its checkpoint, and the table replaces what the first try left behind."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.functions.columns import wire_time

from ringtally.operators.anomalies import find_anomalies
from ringtally.operators.events import (
    drop_repeats,
    exact_amounts,
    new_events,
    original_text,
    split_by_rules,
    validate,
)
from ringtally.operators.rollups import daily_partials
from ringtally.schema import WATERMARK, Limits
from ringtally.sources import jdbc
from ringtally.sources.store import Store

Sink = Callable[[DataFrame, int], None]

# The time of a batch's first try, taken in the streaming plan, where every try has the same.
SEEN_AT = "seen_at"

# What the archive takes all the same: events without a time, below no day.
FORGIVEN = ("timestamp_missing",)

# Beyond so many different hours in a batch, whole days are compared.
MOST_HOURS = 48


def load_id(batch: DataFrame, batch_id: int) -> str:
    """The same for every try of a batch; a new checkpoint has a new query id."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def table_sink(store: Store, table: str, keyed: bool = False) -> Sink:
    """``keyed`` tables are replaced by their own key (the window); others by load."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if keyed:
            store.load(table, batch, layout="repartition")
        else:
            store.load(table, batch, load_id(batch, batch_id), layout=None)

    return write


def state_sink(store: Store) -> Sink:
    """Window states of a streaming query, kept beside those of other queries: a window that a
    new checkpoint emits again in part adds to what is stored. States without a window (totals
    so far) replace the ones their query stored before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept, and first read as a whole: each further pass would update the state once more.
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            timed = F.col("window_start").isNotNull()
            found = {r.timed for r in kept.select(timed.alias("timed")).distinct().collect()}
            piece = load_id(batch, batch_id)
            query = piece.rpartition("-")[0]
            rows = kept.withColumns({"query_id": F.lit(query), "batch_id": F.lit(batch_id)})
            if True in found:
                store.load("window_states", rows.filter(timed), piece, layout="repartition")
            if False in found:
                store.load("window_states", rows.filter(~timed), query, layout="repartition")
        finally:
            kept.unpersist()

    return write


def stored_before(store: Store, table: str, hours: list[datetime | None], piece: str) -> DataFrame | None:
    """What other loads have stored of these hours (None: events without a time); None where
    there is nothing. The load's own rows do not count: it may be tried again. Events keep their
    time when they are delivered again, so only day folders of the batch are listed, and of
    their files only row groups of its hours are read."""
    present = {*store.days(table), *([None] if store.has_day(table, None) else [])}
    days = {hour and hour.date() for hour in hours} & present
    if not days:
        return None
    rows = store.read_parts(table, list(days)).filter(F.col("load_id") != piece)
    if len(hours) <= MOST_HOURS:
        in_hours = F.col("timestamp").isNull() if None in hours else F.lit(False)
        for start in filter(None, hours):
            end = start + timedelta(hours=1)
            in_hours = in_hours | ((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
        rows = rows.filter(in_hours)
    return rows


@dataclass
class Contents:
    """What the archive asks of a batch before it stores it, in one pass."""

    n: int
    n_ids: int
    hours: list[datetime | None]
    newest: datetime | None


def contents(good: DataFrame) -> Contents:
    hour = F.struct(F.date_trunc("hour", "timestamp").alias("at"))  # a set leaves out bare NULLs
    row = good.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("event_id").alias("n_ids"),
        F.collect_set(hour).alias("hours"),
        F.max("timestamp").alias("newest"),
    ).first()
    return Contents(row.n, row.n_ids, [h.at for h in row.hours], row.newest)


def fresh_events(store: Store, good: DataFrame, found: Contents, piece: str) -> DataFrame | None:
    """The events of a batch that are to be stored, each once; None where these are all. Most
    batches hold no repeats and nothing that is stored, and are not joined with anything."""
    stored = stored_before(store, "raw_events", found.hours, piece)
    if stored is not None and stored.join(good.select("event_id"), "event_id", "left_semi").isEmpty():
        stored = None
    if found.n == found.n_ids and stored is None:
        return None
    once = drop_repeats(good) if found.n > found.n_ids else good
    return once if stored is None else new_events(once, stored)


def watermark_before(
    store: Store, query: str, batch_id: int, newest: datetime | None
) -> datetime | None:
    """The newest event time of the batches before this one, less the watermark's delay, as
    streaming queries have it; None for the first. Notes the newest time of this batch: two rows
    per query and day are kept, so a batch that is tried again finds the same."""
    rows = store.read("stream_clock").filter((F.col("load_id") == query) & (F.col("batch_id") < batch_id))
    last = rows.orderBy(F.desc("batch_id")).first()
    known = [t for t in (last and last.newest, newest) if t is not None]
    clock = [(batch_id, max(known, default=None))] + ([(last.batch_id, last.newest)] if last else [])
    frame = store.spark.createDataFrame(clock, "batch_id bigint, newest timestamp")
    store.load("stream_clock", frame.coalesce(1), query, layout=None)
    if not last or last.newest is None:
        return None
    amount, unit = WATERMARK.split()
    return last.newest - timedelta(**{unit.rstrip("s") + "s": int(amount)})


def late_events(events: DataFrame, closed: datetime, windows: dict[str, str]) -> DataFrame:
    """Events of windows that end before ``closed``, with the windows they missed (name of the
    metric and start) as ``broken_rules``."""

    def missed(name: str, size: str) -> Column:
        window = F.window("timestamp", size)
        text = F.concat(F.lit(f"late_for_{name}@"), wire_time(window["start"]))
        return F.when(window["end"] <= F.lit(closed), text)

    # One window expression per projection: the analyzer allows no more.
    for name, size in windows.items():
        events = events.withColumn(f"missed_{name}", missed(name, size))
    names = [f"missed_{name}" for name in windows]
    reasons = F.concat_ws(",", *names)
    return events.withColumn("broken_rules", reasons).filter("broken_rules <> ''").drop(*names)


def archive_sink(
    store: Store,
    limits: Limits = Limits(),
    states: tuple[Callable[[DataFrame], DataFrame], ...] = (),
    windows: dict[str, str] | None = None,
) -> Sink:
    """Raw events, quarantine, anomalies and totals from one read of the source. The batch
    (decoded, not yet validated) is kept while the tables are written, so messages are fetched
    and decoded once. Events without a readable time are archived too, below no day.

    An event is stored once: of repeats within the batch the earliest is taken, and events that
    another load has stored are left out, whether they are delivered again in a later batch or
    to a new checkpoint. Totals by day, and the window ``states`` of the given metrics, are those
    of the events this load adds, so they stay right under repeats, late events and restarts.

    ``windows`` are names and window sizes of metric queries that drop late events: events that
    come when such a window is closed are archived, and go to quarantine as well."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        fresh = None
        try:
            if kept.isEmpty():
                return
            piece = load_id(batch, batch_id)
            good, refused = split_by_rules(kept, FORGIVEN)
            found = contents(good)
            fresh = fresh_events(store, good, found, piece)
            # Limits are tested on the values as they came: none is too large to be reported.
            if fresh is None:
                added, tested = good, validate(kept)
            else:
                added = fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
                tested = fresh.unionByName(validate(refused.drop("broken_rules")))
            seen_at = F.col(SEEN_AT) if SEEN_AT in kept.columns else None
            strange = find_anomalies(tested, limits, seen_at, with_event=True)
            strange, _ = split_by_rules(strange, table="anomalies")
            exact = exact_amounts(added)
            store.load("raw_events", exact, piece, layout=None)
            if windows:
                closed = watermark_before(store, piece.rpartition("-")[0], batch_id, found.newest)
                if closed is not None:
                    refused = refused.unionByName(late_events(added, closed, windows))
            refused = refused.withColumns(
                {
                    "event_data": original_text(refused),
                    "created_at": F.current_timestamp() if seen_at is None else seen_at,
                }
            )
            store.load("quarantined_events", refused, piece, layout=None)
            store.load("anomalies", strange, piece, layout=None)
            store.load("usage_totals", daily_partials(exact), piece, layout="repartition")
            if states:
                rows = reduce(DataFrame.unionByName, [state(exact) for state in states])
                rows = rows.withColumns({"query_id": F.lit(piece), "batch_id": F.lit(batch_id)})
                store.load("window_states", rows, piece, layout="repartition")
        finally:
            kept.unpersist()
            if fresh is not None:
                fresh.unpersist()

    return write


def alert_sink(store: Store) -> Sink:
    """Busy subscribers in update mode: a subscriber's window comes again with every batch that
    adds to it, and is stored the first time. What is stored was detected on the day its window
    began or later, so only those days are read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first = kept.agg(F.min(F.to_date(F.element_at(F.split("event_id", "@"), -1))).alias("day")).first()
            if first.day is None:
                return
            piece = load_id(batch, batch_id)
            days = [d for d in store.days("anomalies") if d >= first.day]
            stored = store.read_parts("anomalies", days).filter(
                (F.col("anomaly_type") == "high_frequency") & (F.col("load_id") != piece)
            )
            store.load("anomalies", new_events(kept, stored), piece, layout=None)
        finally:
            kept.unpersist()

    return write


def jdbc_sink(options: dict[str, str], mode: str = "append", prepare=None) -> Sink:
    """Rows into a database table. Empty batches are skipped without opening connections.
    A retried batch is appended again: the target's primary key must refuse repeats."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = (batch if prepare is None else prepare(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not kept.isEmpty():
                jdbc.append(kept, options, mode)
        finally:
            kept.unpersist()

    return write
