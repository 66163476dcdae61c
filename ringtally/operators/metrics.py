"""Event-time window metrics, on a batch or a stream.

All metrics share the layout of ``real_time_metrics``; what a metric does not measure is a
typed NULL. Rows without an event time belong to no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ringtally.functions.columns import mb_to_gb
from ringtally.functions.measures import (
    count_where,
    mean,
    merged_partials,
    merged_users,
    or_zero,
    usage_partials,
    user_estimate,
    user_sketch,
)
from ringtally.operators.events import OF_WINDOW
from ringtally.schema import WATERMARK

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(interval: str) -> int | None:
    """None for what is not one whole number of a unit of fixed length."""
    amount, _, unit = interval.strip().partition(" ")
    unit = UNIT_SECONDS.get(unit.strip().rstrip("s"))
    return int(amount) * unit if amount.isdigit() and unit else None


def in_panes(events: DataFrame, size: str, slide: str | None) -> bool:
    """Whether sliding windows can be added up from panes of one slide: in a batch, where
    windows hold a whole number of panes."""
    if slide is None or events.isStreaming:
        return False
    whole, pane = _seconds(size), _seconds(slide)
    return bool(whole and pane) and whole % pane == 0


def _watermarked(events: DataFrame, watermark: str | None) -> DataFrame:
    """``watermark=None`` is for a stream that already carries one (after drop_repeats)."""
    if events.isStreaming and watermark:
        return events.withWatermark("timestamp", watermark)
    return events


def by_window(events: DataFrame, size: str, keys: list[str], slide: str | None = None) -> GroupedData:
    """Group by event-time window and key. A stream needs the whole window as the key, for
    the watermark to close it; a batch groups tumbling windows by their start alone, which
    makes a shorter key to hash and shuffle."""
    if OF_WINDOW in events.columns:
        return events.groupBy(F.col(OF_WINDOW).alias("window"), *keys)
    window = F.window("timestamp", size, slide)
    if slide is None and not events.isStreaming:
        return events.groupBy(window["start"].alias("window_start"), *keys)
    return events.groupBy(window, *keys)


def with_bounds(grouped: DataFrame, size: str) -> DataFrame:
    """Columns ``window_start`` and ``window_end``, whichever way windows were grouped."""
    if "window" in grouped.columns:
        return grouped.withColumns(
            {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
        ).drop("window")
    return grouped.withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {size}"))


def window_partials(
    events: DataFrame,
    size: str,
    keys: list[str],
    slide: str | None = None,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """Usage partials per window and key.

    A sliding window covers each event several times. In a batch the events are first summed
    into panes of one slide, and only the panes are copied into the windows they belong to.
    """
    events = _watermarked(events, watermark)
    if not in_panes(events, size, slide):
        return with_bounds(by_window(events, size, keys, slide).agg(*usage_partials()), size)
    panes = by_window(events, slide, keys).agg(*usage_partials())
    panes = panes.withColumnRenamed("window_start", "timestamp")
    return with_bounds(by_window(panes, size, keys, slide).agg(*merged_partials()), size)


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _metric_rows(partials: DataFrame, tag: str, **measures: Column) -> DataFrame:
    """Project to the metrics layout."""

    def key(name: str) -> Column:
        return F.col(name) if name in partials.columns else _null("string")

    return partials.select(
        "window_start",
        "window_end",
        F.lit(tag).alias("metric_type"),
        key("region").alias("region"),
        key("event_type").alias("event_type"),
        key("event_subtype").alias("event_subtype"),
        F.col("n_events").alias("count_events"),
        measures.get("duration", _null("bigint")).alias("total_duration_seconds"),
        measures["data_gb"].alias("total_data_gb"),
        measures["amount"].alias("total_amount"),
        measures.get("avg_duration", _null("double")).alias("avg_duration_seconds"),
        measures.get("avg_data", _null("double")).alias("avg_data_mb"),
        *measures.get("extra", ()),
    )


def _totals() -> dict[str, Column]:
    return {
        "duration": or_zero(F.col("sum_duration")),
        "data_gb": mb_to_gb(or_zero(F.col("sum_data"))),
        "amount": or_zero(F.col("sum_amount")),
    }


def _averages() -> dict[str, Column]:
    return {
        "avg_duration": mean(F.col("sum_duration"), F.col("n_duration")),
        "avg_data": mean(F.col("sum_data"), F.col("n_data")),
    }


def event_type_metrics(
    events: DataFrame,
    size: str = "5 minutes",
    slide: str | None = None,
    watermark: str | None = WATERMARK,
    tag: str = "event_type_5min",
) -> DataFrame:
    """Counts, totals and averages by type and subtype."""
    partials = window_partials(events, size, ["event_type", "event_subtype"], slide, watermark)
    return _metric_rows(partials, tag, **_totals(), **_averages())


def regional_metrics(
    events: DataFrame,
    size: str = "10 minutes",
    slide: str | None = None,
    watermark: str | None = WATERMARK,
    tag: str = "regional_10min",
) -> DataFrame:
    """Counts and totals by region and type."""
    partials = window_partials(events, size, ["region", "event_type"], slide, watermark)
    return _metric_rows(partials, tag, **_totals())


def conditional_metrics(
    events: DataFrame,
    size: str = "5 minutes",
    slide: str | None = None,
    watermark: str | None = WATERMARK,
    tag: str = "5min",
    call_counts: bool = False,
) -> DataFrame:
    """Session data and recharge totals by type and region; ``call_counts`` adds incoming and
    outgoing calls and messages. ``avg_data_mb`` is per event of the group."""
    kind, direction = F.col("event_type"), F.col("event_subtype")
    is_call = F.coalesce(kind == "call", F.lit(False))

    def only(of_kind: str, value: str) -> Column:
        return F.sum(F.when(kind == of_kind, F.coalesce(value, F.lit(0))).otherwise(0))

    def calls(way: str) -> Column:
        return F.sum(F.when(is_call, F.when(direction == way, 1).otherwise(0)))

    groups = by_window(_watermarked(events, watermark), size, ["event_type", "region"], slide)
    extra = {
        "incoming_calls": calls("incoming"),
        "outgoing_calls": calls("outgoing"),
        "sms_count": count_where(kind == "sms"),
    }
    sums = groups.agg(
        F.count(F.lit(1)).alias("n_events"),
        only("data_session", "data_mb").alias("session_mb"),
        only("balance_recharge", "amount").alias("recharged"),
        *[measure.alias(name) for name, measure in extra.items() if call_counts],
    )
    return _metric_rows(
        with_bounds(sums, size),
        tag,
        data_gb=mb_to_gb(F.col("session_mb")),
        amount=F.col("recharged"),
        avg_data=mean(F.col("session_mb"), F.col("n_events")),
        extra=[F.col(name) for name in extra if call_counts],
    )


def cumulative_metrics(
    events: DataFrame, as_of: Column | None = None, tag: str = "batch_metrics"
) -> DataFrame:
    """Totals so far by type and region, stamped with the time of computation. On a stream
    this needs the complete output mode: each result replaces the one before. The keys are a
    small fixed set, so the state that is kept for good stays small."""
    stamp = F.current_timestamp() if as_of is None else as_of
    partials = events.groupBy("event_type", "region").agg(*usage_partials())
    stamped = partials.withColumns({"window_start": stamp, "window_end": stamp})
    return _metric_rows(stamped, tag, **_totals(), **_averages())


# Window states: what the three metrics above are made of, kept as counts and sums. States of
# one window that several queries or loads have stored add up; averages are formed at reading.

STATE_KEYS = ("region", "event_type", "event_subtype")
PARTIALS = (
    "n_events", "n_duration", "sum_duration", "max_duration", "n_data", "sum_data", "max_data",
    "n_amount", "sum_amount",
)


def _states(partials: DataFrame, tag: str, form: str) -> DataFrame:
    def column(name: str, kind: str) -> Column:
        return F.col(name) if name in partials.columns else _null(kind)

    return partials.select(
        *[column(name, "timestamp").alias(name) for name in ("window_start", "window_end")],
        F.lit(tag).alias("metric_type"),
        F.lit(form).alias("form"),
        *[column(name, "string").alias(name) for name in STATE_KEYS],
        *PARTIALS,
        column("users", "binary").alias("users"),
    )


def event_type_states(
    events: DataFrame,
    size: str = "5 minutes",
    slide: str | None = None,
    watermark: str | None = WATERMARK,
    tag: str = "event_type_5min",
) -> DataFrame:
    keys = ["event_type", "event_subtype"]
    return _states(window_partials(events, size, keys, slide, watermark), tag, "usage")


def regional_states(
    events: DataFrame,
    size: str = "10 minutes",
    slide: str | None = None,
    watermark: str | None = WATERMARK,
    tag: str = "regional_10min",
) -> DataFrame:
    keys = ["region", "event_type"]
    return _states(window_partials(events, size, keys, slide, watermark), tag, "totals")


def conditional_states(
    events: DataFrame,
    size: str = "5 minutes",
    slide: str | None = None,
    watermark: str | None = WATERMARK,
    tag: str = "5min",
) -> DataFrame:
    keys = ["region", "event_type"]
    return _states(window_partials(events, size, keys, slide, watermark), tag, "conditional")


def cumulative_states(events: DataFrame, tag: str = "batch_metrics") -> DataFrame:
    """Totals so far; without a window."""
    partials = events.groupBy("event_type", "region").agg(*usage_partials())
    return _states(partials, tag, "usage")


def user_states(
    events: DataFrame,
    size: str = "5 minutes",
    watermark: str | None = WATERMARK,
    tag: str = "region_users_5min",
) -> DataFrame:
    """Events and a sketch of the subscribers by region. The sketch is a few kilobytes however
    many they are, and it is combined before the shuffle."""
    groups = by_window(_watermarked(events, watermark), size, ["region"])
    counted = groups.agg(*usage_partials(), user_sketch(F.col("msisdn")).alias("users"))
    return _states(with_bounds(counted, size), tag, "totals")


def merged_states(states: DataFrame) -> DataFrame:
    """One state per window and key: the last one of each query, added up."""
    keys = ["window_start", "window_end", "metric_type", "form", *STATE_KEYS]
    values = [*PARTIALS, "users", "created_at"]
    last = states.groupBy(*keys, "query_id").agg(
        F.max_by(F.struct(*values), F.col("batch_id")).alias("last")
    )
    return (
        last.select(*keys, "last.*")
        .groupBy(*keys)
        .agg(*merged_partials(), merged_users(F.col("users")).alias("users"), F.max("created_at").alias("created_at"))
    )


def metrics_of_states(states: DataFrame) -> DataFrame:
    """Stored states in the layout of ``real_time_metrics``, and ``unique_users`` where a metric
    has sketches of them. Totals so far are stamped with the time they were stored."""
    merged = merged_states(states)
    kind, form = F.col("event_type"), F.col("form")
    is_usage, is_conditional = form == "usage", form == "conditional"

    def only(of_kind: str, total: str) -> Column:
        return F.when(kind == of_kind, or_zero(F.col(total))).otherwise(0)

    data = F.when(is_conditional, only("data_session", "sum_data")).otherwise(or_zero(F.col("sum_data")))
    amount = F.when(is_conditional, only("balance_recharge", "sum_amount")).otherwise(or_zero(F.col("sum_amount")))
    avg_data = F.when(is_usage, mean(F.col("sum_data"), F.col("n_data"))).when(
        is_conditional, mean(data, F.col("n_events"))
    )
    return merged.select(
        *[F.coalesce(name, F.col("created_at")).alias(name) for name in ("window_start", "window_end")],
        "metric_type",
        *STATE_KEYS,
        F.col("n_events").alias("count_events"),
        F.when(~is_conditional, or_zero(F.col("sum_duration"))).alias("total_duration_seconds"),
        mb_to_gb(data).alias("total_data_gb"),
        amount.alias("total_amount"),
        F.when(is_usage, mean(F.col("sum_duration"), F.col("n_duration"))).alias("avg_duration_seconds"),
        avg_data.alias("avg_data_mb"),
        F.when(F.col("users").isNotNull(), user_estimate(F.col("users"))).alias("unique_users"),
        "created_at",
    )
