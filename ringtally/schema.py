"""Fixed names, types and limits of the usage-event model."""

from __future__ import annotations

from dataclasses import dataclass

# They decide which events are valid and how rows are labelled.
EVENT_TYPES = ("call", "sms", "data_session", "balance_recharge", "service_activation")
SEVERITIES = ("low", "medium", "high", "critical")
RUN_STATUSES = ("running", "completed", "failed", "pending")
WATERMARK = "1 minute"

# Expected share of each event type in percent (fixed values).
EXPECTED_MIX = {
    "data_session": 50,
    "call": 25,
    "sms": 15,
    "balance_recharge": 7,
    "service_activation": 3,
}

# Load weight by hour of day, both ends included, first match wins (fixed values).
HOUR_WEIGHTS = (((8, 10), 1.5), ((12, 14), 1.3), ((18, 22), 2.0), ((0, 6), 0.3))
NORMAL_HOUR_WEIGHT = 1.0


@dataclass(frozen=True)
class Limits:
    """Thresholds above which an event (or a subscriber's rate) is anomalous."""

    call_seconds: int = 14400
    session_mb: int = 5000
    recharge_amount: int = 50000
    events_per_window: int = 100
    rate_window: str = "5 minutes"


# JSON message body, as it arrives: the time is still text.
WIRE_EVENT = {
    "event_id": "string",
    "msisdn": "string",
    "event_type": "string",
    "event_subtype": "string",
    "duration_seconds": "int",
    "data_mb": "double",
    "amount": "double",
    "region": "string",
    "cell_tower_id": "int",
    "timestamp": "string",
}
EVENT_FIELDS = tuple(WIRE_EVENT)


@dataclass(frozen=True)
class Table:
    """Column types of a stored table, and the SQL that derives its partition columns."""

    columns: dict[str, str]
    partitions: dict[str, tuple[str, str]]

    @property
    def schema(self) -> str:
        types = dict(self.columns)
        types.update({name: kind for name, (kind, _) in self.partitions.items()})
        return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


# Partition expressions are SQL over the table's own columns. A `load_id` partition holds
# what one load wrote, so that repeating the load replaces its rows instead of adding more.
TABLES = {
    "raw_events": Table(
        columns={
            "event_id": "string",
            "msisdn": "string",
            "event_type": "string",
            "event_subtype": "string",
            "duration_seconds": "int",
            "data_mb": "decimal(10,2)",
            "amount": "decimal(10,2)",
            "region": "string",
            "cell_tower_id": "int",
            "timestamp": "timestamp",
            "created_at": "timestamp",
        },
        partitions={"event_date": ("date", "to_date(timestamp)"), "load_id": ("string", "load_id")},
    ),
    "real_time_metrics": Table(
        columns={
            "window_start": "timestamp",
            "window_end": "timestamp",
            "metric_type": "string",
            "region": "string",
            "event_type": "string",
            "event_subtype": "string",
            "count_events": "bigint",
            "total_duration_seconds": "bigint",
            "total_data_gb": "decimal(28,4)",
            "total_amount": "decimal(28,2)",
            "avg_duration_seconds": "decimal(10,2)",
            "avg_data_mb": "decimal(10,2)",
            "created_at": "timestamp",
        },
        # A window is emitted once, whole, so its bounds are the unit of replacement: windows
        # of another size that start together are others. Totals so far belong to no day.
        partitions={
            "window_date": (
                "date",
                "CASE WHEN metric_type <> 'batch_metrics' THEN to_date(window_start) END",
            ),
            "metric_type": ("string", "metric_type"),
            "window_key": (
                "string",
                "CASE WHEN metric_type = 'batch_metrics' THEN 'latest'"
                " ELSE concat(date_format(window_start, 'yyyyMMdd-HHmmss'), '-',"
                " CAST(unix_timestamp(window_end) - unix_timestamp(window_start) AS STRING)) END",
            ),
        },
    ),
    "anomalies": Table(
        columns={
            "event_id": "string",
            "msisdn": "string",
            "anomaly_type": "string",
            "anomaly_reason": "string",
            "severity": "string",
            "event_data": "string",
            "detected_at": "timestamp",
        },
        partitions={
            "detected_date": ("date", "to_date(detected_at)"),
            "load_id": ("string", "load_id"),
        },
    ),
    # What each streaming query counted and summed per window: parts that can be added up. A
    # window may have states of several queries (one per checkpoint); the last one of each counts.
    "window_states": Table(
        columns={
            "window_start": "timestamp",
            "window_end": "timestamp",
            "metric_type": "string",
            "form": "string",
            "region": "string",
            "event_type": "string",
            "event_subtype": "string",
            "n_events": "bigint",
            "n_duration": "bigint",
            "sum_duration": "bigint",
            "max_duration": "int",
            "n_data": "bigint",
            "sum_data": "decimal(38,2)",
            "max_data": "decimal(18,2)",
            "n_amount": "bigint",
            "sum_amount": "decimal(38,2)",
            "users": "binary",
            "query_id": "string",
            "batch_id": "bigint",
            "created_at": "timestamp",
        },
        partitions={
            "window_date": ("date", "to_date(window_start)"),
            "metric_type": ("string", "metric_type"),
            "load_id": ("string", "load_id"),
        },
    ),
    # Sums over the events that each load added to the raw table, by their day.
    "usage_totals": Table(
        columns={
            "event_date": "date",
            "region": "string",
            "event_type": "string",
            "n_events": "bigint",
            "n_duration": "bigint",
            "sum_duration": "bigint",
            "max_duration": "int",
            "n_data": "bigint",
            "sum_data": "decimal(38,2)",
            "max_data": "decimal(18,2)",
            "n_amount": "bigint",
            "sum_amount": "decimal(38,2)",
            "created_at": "timestamp",
        },
        partitions={"event_date": ("date", "event_date"), "load_id": ("string", "load_id")},
    ),
    # Subscribers as sketches: users of any range, region or type without the events.
    "hourly_users": Table(
        columns={
            "hour_timestamp": "timestamp",
            "region": "string",
            "event_type": "string",
            "n_events": "bigint",
            "users": "binary",
            "created_at": "timestamp",
        },
        partitions={"date": ("date", "to_date(hour_timestamp)")},
    ),
    # The newest event time an archive query had seen after its last batches.
    "stream_clock": Table(
        columns={"batch_id": "bigint", "newest": "timestamp", "created_at": "timestamp"},
        partitions={
            "created_date": ("date", "to_date(created_at)"),
            "load_id": ("string", "load_id"),
        },
    ),
    # Events the raw table cannot take, with the reasons.
    "quarantined_events": Table(
        columns={
            "event_id": "string",
            "msisdn": "string",
            "broken_rules": "string",
            "event_data": "string",
            "created_at": "timestamp",
        },
        partitions={
            "created_date": ("date", "to_date(created_at)"),
            "load_id": ("string", "load_id"),
        },
    ),
    "daily_stats": Table(
        columns={
            "date": "date",
            "region": "string",
            "event_type": "string",
            "total_events": "bigint",
            "total_calls": "bigint",
            "total_sms": "bigint",
            "total_data_sessions": "bigint",
            "total_call_duration": "bigint",
            "avg_call_duration": "decimal(10,2)",
            "max_call_duration": "int",
            "total_data_mb": "decimal(28,2)",
            "avg_data_mb": "decimal(10,2)",
            "max_data_mb": "decimal(10,2)",
            "total_revenue": "decimal(28,2)",
            "avg_transaction": "decimal(10,2)",
            "created_at": "timestamp",
        },
        partitions={"date": ("date", "date")},
    ),
    "daily_stats_extended": Table(
        columns={
            "processing_date": "date",
            "region": "string",
            "event_type": "string",
            "total_events": "bigint",
            "total_duration_hours": "decimal(15,2)",
            "total_data_tb": "decimal(15,6)",
            "total_recharge_amount": "decimal(18,2)",
            "avg_call_duration_minutes": "decimal(10,2)",
            "avg_data_per_user_mb": "decimal(10,2)",
            "unique_users": "bigint",
            "peak_hour": "int",
            "created_at": "timestamp",
        },
        partitions={"processing_date": ("date", "processing_date")},
    ),
    "hourly_stats": Table(
        columns={
            "hour_timestamp": "timestamp",
            "region": "string",
            "event_type": "string",
            "total_events": "bigint",
            "total_duration": "bigint",
            "avg_duration": "decimal(10,2)",
            "total_data_mb": "decimal(28,2)",
            "total_amount": "decimal(28,2)",
            "created_at": "timestamp",
        },
        partitions={"date": ("date", "to_date(hour_timestamp)")},
    ),
    "pipeline_monitoring": Table(
        columns={
            "pipeline_name": "string",
            "pipeline_type": "string",
            "status": "string",
            "records_processed": "bigint",
            "records_failed": "bigint",
            "processing_time_seconds": "int",
            "error_message": "string",
            "started_at": "timestamp",
            "completed_at": "timestamp",
            "created_at": "timestamp",
        },
        partitions={
            "started_date": ("date", "to_date(started_at)"),
            "load_id": ("string", "load_id"),
        },
    ),
}
