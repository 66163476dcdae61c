"""Rule-based anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.operators.events import MONEY, event_json
from ringtally.functions.columns import wire_time
from ringtally.operators.metrics import by_window, in_panes, with_bounds
from ringtally.schema import WATERMARK, Limits

ANOMALY_COLUMNS = ("event_id", "msisdn", "anomaly_type", "anomaly_reason", "severity", "detected_at")


def is_anomalous(limits: Limits) -> Column:
    """Each limit applies to its own kind of event."""
    kind = F.col("event_type")
    return (
        ((kind == "call") & (F.col("duration_seconds") > limits.call_seconds))
        | ((kind == "data_session") & (F.col("data_mb") > limits.session_mb))
        | ((kind == "balance_recharge") & (F.col("amount") > limits.recharge_amount))
    )


def label(limits: Limits) -> tuple[Column, Column]:
    """Type and reason. They look at the measures only, in this order, whatever the kind of
    event: a long data session is labelled by its duration."""
    long_call = F.col("duration_seconds") > limits.call_seconds
    large_session = F.col("data_mb") > limits.session_mb
    large_recharge = F.col("amount") > limits.recharge_amount
    kind = (
        F.when(long_call, "excessive_call_duration")
        .when(large_session, "excessive_data_usage")
        .when(large_recharge, "excessive_recharge")
        .otherwise("unknown")
    )

    def text(before: str, value: str, after: str) -> Column:
        shown = F.col(value).cast("string")
        if value != "duration_seconds":  # as money, where it fits
            shown = F.coalesce(F.col(value).try_cast(MONEY).cast("string"), shown)
        return F.concat(F.lit(before), shown, F.lit(after))

    reason = (
        F.when(long_call, text("Call duration: ", "duration_seconds", " seconds"))
        .when(large_session, text("Data usage: ", "data_mb", " MB"))
        .when(large_recharge, text("Recharge amount: ", "amount", " tenge"))
        .otherwise("Unknown anomaly")
    )
    return kind, reason


def find_anomalies(
    events: DataFrame,
    limits: Limits = Limits(),
    detected_at: Column | None = None,
    with_event: bool = False,
) -> DataFrame:
    """Events over a limit, labelled. Narrow: no shuffle, one row at a time.

    ``detected_at`` is the processing time unless given; ``with_event`` adds the event itself
    as JSON in ``event_data``.
    """
    kind, reason = label(limits)
    columns = {
        "anomaly_type": kind,
        "anomaly_reason": reason,
        "severity": F.lit("high"),
        "detected_at": F.current_timestamp() if detected_at is None else detected_at,
    }
    found = events.filter(is_anomalous(limits))
    if with_event:
        columns["event_data"] = event_json(nulls=False)
    chosen = [*ANOMALY_COLUMNS, *(["event_data"] if with_event else [])]
    return found.select(
        *[columns[name].alias(name) if name in columns else F.col(name) for name in chosen]
    )


def frequent_subscribers(
    events: DataFrame,
    limits: Limits = Limits(),
    watermark: str = WATERMARK,
    slide: str | None = None,
) -> DataFrame:
    """Subscribers with more than the allowed number of events in a window. Counts are
    combined before the shuffle, so a very busy subscriber is one row per map task.

    ``slide`` finds bursts over the border of two windows, once for each window they fill. A
    batch counts panes of one slide first and copies only those.
    """
    size, n = limits.rate_window, F.count(F.lit(1)).alias("count_events")
    if events.isStreaming:
        events = events.withWatermark("timestamp", watermark)
    if in_panes(events, size, slide):
        events = by_window(events, slide, ["msisdn"]).agg(n)
        events = events.withColumnRenamed("window_start", "timestamp")
        n = F.sum("count_events").alias("count_events")
    counts = by_window(events, size, ["msisdn"], slide).agg(n)
    frequent = counts.filter(F.col("count_events") > limits.events_per_window)
    return with_bounds(frequent, limits.rate_window).select(
        "window_start", "window_end", "msisdn", "count_events"
    )


def frequency_anomalies(
    frequent: DataFrame, limits: Limits = Limits(), detected_at: Column | None = None
) -> DataFrame:
    """Frequent subscribers in the layout of ``anomalies``. No single event is meant, so the
    subscriber and the start of the window stand for the event's id."""
    reason = F.concat(F.col("count_events").cast("string"), F.lit(f" events in {limits.rate_window}"))
    return frequent.filter(F.col("msisdn").isNotNull()).select(
        F.concat_ws("@", "msisdn", wire_time(F.col("window_start"))).alias("event_id"),
        "msisdn",
        F.lit("high_frequency").alias("anomaly_type"),
        reason.alias("anomaly_reason"),
        F.lit("high").alias("severity"),
        (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
    )


def anomaly_rate(raw_events: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Anomalies in percent of raw events; NULL when there are none."""
    n_events = raw_events.agg(F.count(F.lit(1))).scalar()
    return anomalies.agg(F.count(F.lit(1)).alias("n_anomalies")).select(
        F.try_divide(F.col("n_anomalies") * F.lit(100.0), n_events).alias("anomaly_rate_percent")
    )
