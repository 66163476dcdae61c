"""Streaming queries over decoded events, and how they are started and awaited."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringtally.operators.anomalies import frequency_anomalies, frequent_subscribers
from ringtally.operators.events import (
    decode,
    drop_repeats_in_windows,
    exact_amounts,
    is_refused,
    split_by_rules,
    table_rules,
    with_event_time,
)
from ringtally.operators.metrics import (
    conditional_states,
    cumulative_states,
    event_type_states,
    metrics_of_states,
    regional_states,
    user_states,
)
from ringtally.schema import WATERMARK, Limits
from ringtally.session import scratch_path
from ringtally.sources.store import Store
from ringtally.streaming.runlog import REFUSED
from ringtally.streaming.sinks import (
    FORGIVEN,
    SEEN_AT,
    Sink,
    alert_sink,
    archive_sink,
    state_sink,
    table_sink,
)

# Time between micro-batches. Every archive batch makes files in its own folder, so a busy
# source is better served by minutes.
ARCHIVE_EVERY = "5 seconds"
METRICS_EVERY = "10 seconds"

# What a metric query stores, its output mode, and the size of its windows.
METRICS = {
    "metrics_5min": (event_type_states, "append", "5 minutes"),
    "metrics_10min": (regional_states, "append", "10 minutes"),
    "metrics_conditional": (conditional_states, "append", "5 minutes"),
    "metrics_users": (user_states, "append", "5 minutes"),
    "metrics_cumulative": (cumulative_states, "complete", None),
}
DEFAULT_STREAMS = ("archive", "metrics_5min", "metrics_10min")


def decoded_events(messages: DataFrame, unreadable_time: str = "keep") -> DataFrame:
    """Messages to events, not yet validated. A stream and a batch give the same rows."""
    return with_event_time(decode(messages, keep_text=True), unreadable_time)


def start(
    frame: DataFrame,
    sink: Sink,
    name: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start one query; ``every`` left out means: take what is there and stop."""
    writer = (
        frame.writeStream.queryName(name)
        .foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint}/{name}")
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_streams(
    events: DataFrame,
    store: Store,
    checkpoint: str,
    streams: tuple[str, ...] = DEFAULT_STREAMS,
    limits: Limits = Limits(),
    continuous: bool = True,
    validated: bool = True,
    archive_every: str = ARCHIVE_EVERY,
    metrics_every: str = METRICS_EVERY,
    metrics_sink: Sink | None = None,
    burst_slide: str | None = "1 minute",
    from_archive: bool = False,
    early_alerts: bool = False,
) -> list[StreamingQuery]:
    """Fan one stream of decoded events out. Each query reads the source on its own and has
    its own checkpoint; raw events and anomalies share one. Metrics count what the raw table
    takes; ``validated=False`` lets them count every row, malformed ones in a group of NULLs,
    except amounts no table column can hold. Windows count an event once. Events that come when
    their window is closed are dropped; the run log has their number, and the archive puts those
    that are late by its own clock into quarantine, with the windows they missed.

    ``from_archive`` lets the archive compute the metrics of each load from the events it adds:
    the source is fetched and decoded once for all of them, an event counts once however often
    and however late it comes, and windows are visible while they are open. Late events are
    never dropped then.

    ``metrics_sink`` sends windows elsewhere than to the store, for instance to a database.
    ``high_frequency`` reports busy subscribers as anomalies, in windows that slide by
    ``burst_slide``; ``early_alerts`` reports them when the limit is crossed and not when the
    window closes."""
    forgiven = FORGIVEN
    if not validated:
        forgiven = tuple(r for r in table_rules() if not r.endswith("_out_of_range"))
        forgiven += ("field_unreadable",)
    within = tuple(n for n in streams if n in METRICS) if from_archive else ()
    if within and ("archive" not in streams or metrics_sink or not validated):
        raise ValueError("metrics of the archive need its stream, the store and valid events")
    queries = []
    for name in streams:
        if name in within:
            continue
        if name == "archive":
            # Totals so far are those the archive keeps by day.
            states = tuple(METRICS[n][0] for n in within if METRICS[n][1] == "append")
            closing = {n: METRICS[n][2] for n in streams if n in METRICS and n not in within}
            sink = archive_sink(store, limits, states, {n: size for n, size in closing.items() if size})
            mode, every = "append", archive_every
            failed = F.count(F.when(is_refused(events, FORGIVEN), 1)).alias("failed")
            frame = events.withColumn(SEEN_AT, F.current_timestamp()).observe(REFUSED, failed)
        elif name == "high_frequency":
            counted = split_by_rules(events, FORGIVEN)[0]
            busy = frequent_subscribers(counted, limits, slide=burst_slide)
            frame, every = frequency_anomalies(busy, limits), metrics_every
            mode = "update" if early_alerts else "append"
            sink = alert_sink(store) if early_alerts else table_sink(store, "anomalies")
        else:
            metric, mode, size = METRICS[name]
            counted = exact_amounts(split_by_rules(events, forgiven)[0])
            if mode == "append":
                timed = counted.withWatermark("timestamp", WATERMARK)
                once = drop_repeats_in_windows(timed, size, all_named=validated)  # others are refused
                frame = metric(once, watermark=None)
            else:  # no other state may come before totals so far
                frame = metric(counted)
            every, sink = metrics_every, state_sink(store)
            if metrics_sink:
                sink = _finished(metrics_sink)
        queries.append(start(frame, sink, name, checkpoint, mode, every if continuous else None))
    return queries


def _finished(sink: Sink) -> Sink:
    """For sinks elsewhere: windows as metrics, not as states."""

    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp()
        rows = batch.withColumns({"query_id": F.lit(""), "batch_id": F.lit(batch_id), "created_at": now})
        sink(metrics_of_states(rows), batch_id)

    return write


def await_all(queries: list[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait until every query has ended; if one fails, stop the others and raise its error.
    Other queries of the session are left alone."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def drain(spark: SparkSession, frame: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what its source holds now and read the result back from files:
    nothing passes through the driver."""
    folder = scratch_path(spark, "drain")
    output = f"{folder}/rows"
    if mode == "append":
        query = (
            frame.writeStream.format("parquet")
            .option("path", output)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    else:

        def replace(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(output)

        query = start(frame, replace, "drain", folder, mode)
    query.awaitTermination()
    return spark.read.schema(frame.schema).parquet(output)
