"""Named reports: each is one DataFrame over stored tables.

``as_of`` stands for the present moment. It is a literal (text, date or datetime), which is
folded into the scan's filters, or left out, which means the latest event of the table; that
maximum is a scalar subquery, and its result also reaches the scan's filters at run time.
Reports have only a lower time bound. Rankings end in a tiebreak, so they are repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.functions.columns import hour_weight, mb_to_gb
from ringtally.functions.measures import count_where, mean
from ringtally.schema import EXPECTED_MIX


@dataclass
class Tables:
    raw_events: DataFrame
    anomalies: DataFrame | None = None
    daily_stats: DataFrame | None = None
    hourly_stats: DataFrame | None = None
    real_time_metrics: DataFrame | None = None


def moment(events: DataFrame, as_of=None, back: str = "0 seconds", to_day: bool = False) -> Column:
    """``as_of`` minus ``back`` in the type of ``events.timestamp``; ``to_day`` cuts ``as_of``
    to midnight first."""
    kind = events.schema["timestamp"].dataType
    now = F.max("timestamp") if as_of is None else F.lit(str(as_of)).cast(kind)
    if to_day:
        now = F.date_trunc("day", now).cast(kind)
    at = now - F.expr(f"INTERVAL {back}")
    if as_of is not None:
        return at
    if "event_date" in events.columns:  # times are read in the newest day folder only
        newest = events.agg(F.max("event_date").alias("day")).scalar()
        events = events.filter(F.col("event_date") == newest)
    return events.agg(at.alias("at")).scalar()


def since(events: DataFrame, back: str, as_of=None, kind: str | None = None) -> DataFrame:
    """Rows (of one kind) not older than ``back``; day folders are pruned where the table has
    them. The present moment is that of the whole table, whatever the kind."""
    start = moment(events, as_of, back)
    recent = events.filter(F.col("timestamp") >= start)
    if "event_date" in events.columns:
        recent = recent.filter(F.col("event_date") >= start.cast("date"))
    return recent if kind is None else recent.filter(F.col("event_type") == kind)


def _kind_counts() -> list[Column]:
    kind = F.col("event_type")
    return [
        count_where(kind == "call").alias("calls"),
        count_where(kind == "sms").alias("sms"),
        count_where(kind == "data_session").alias("data_sessions"),
    ]


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _nulls_last(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def recent_counts(t: Tables, as_of=None) -> DataFrame:
    """Events of the last 5 minutes, by main type."""
    return since(t.raw_events, "5 minutes", as_of).agg(_n("events_last_5min"), *_kind_counts())


def recent_total(t: Tables, as_of=None) -> DataFrame:
    """Number of events in the last 5 minutes."""
    return since(t.raw_events, "5 minutes", as_of).agg(_n("events_last_5min"))


def region_users(t: Tables, as_of=None) -> DataFrame:
    """Events and distinct subscribers by region, last hour."""
    return (
        since(t.raw_events, "1 hour", as_of)
        .groupBy("region")
        .agg(_n("event_count"), F.count_distinct("msisdn").alias("unique_users"))
        .orderBy(F.desc("event_count"), *_nulls_last("region"))
    )


def anomaly_summary(t: Tables, as_of=None, back: str = "24 hours") -> DataFrame:
    """Anomalies of the last 24 hours by type, with the mean severity (high 3, medium 2,
    other 1). Only the day folders of that time are read."""
    grade = F.when(F.col("severity") == "high", 3).when(F.col("severity") == "medium", 2).otherwise(1)
    start = moment(t.raw_events, as_of, back)
    recent = t.anomalies.filter(F.col("detected_at") >= start)
    if "detected_date" in recent.columns:
        recent = recent.filter(F.col("detected_date") >= start.cast("date"))
    return (
        recent.groupBy("anomaly_type")
        .agg(_n("anomaly_count"), F.avg(grade).alias("avg_severity"))
        .orderBy(F.desc("anomaly_count"), "anomaly_type")
    )


def daily_summary(t: Tables, as_of=None, days: int = 7) -> DataFrame:
    """Daily totals over all regions and types, last 7 days."""
    start = moment(t.raw_events, as_of, f"{days} days", to_day=True).cast("date")
    sums = ["total_events", "total_calls", "total_sms", "total_data_sessions"]
    return (
        t.daily_stats.filter(F.col("date") >= start)
        .groupBy("date")
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.round(mb_to_gb(F.sum("total_data_mb")).cast("decimal(18,6)"), 2).alias("total_data_gb"),
        )
        .orderBy(F.desc("date"))
    )


def _row_count(name: str, frame: DataFrame, label: str = "metric", value: str = "value") -> DataFrame:
    return frame.agg(_n(value)).select(F.lit(name).alias(label), value)


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(t: Tables, as_of=None) -> DataFrame:
    """Rows of each table."""
    return _stacked(
        [
            _row_count("Raw Events", t.raw_events),
            _row_count("Daily Stats", t.daily_stats),
            _row_count("Hourly Stats", t.hourly_stats),
            _row_count("Anomalies", t.anomalies),
            _row_count("Real-time Metrics", t.real_time_metrics),
        ]
    )


def stream_table_counts(t: Tables, as_of=None) -> DataFrame:
    """Rows of the three tables the streams fill."""
    return _stacked(
        [
            _row_count("Raw Events", t.raw_events, "table_name", "count"),
            _row_count("Real-time Metrics", t.real_time_metrics, "table_name", "count"),
            _row_count("Anomalies", t.anomalies, "table_name", "count"),
        ]
    )


def peak_hours(t: Tables, as_of=None) -> DataFrame:
    """Events and distinct subscribers by hour of the present day."""
    events = t.raw_events
    start = moment(events, as_of, to_day=True)
    end = moment(events, as_of, "-1 days", to_day=True)
    today = events.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    if "event_date" in events.columns:
        today = today.filter(F.col("event_date") == start.cast("date"))
    return (
        today.groupBy(F.hour("timestamp").alias("hour"))
        .agg(_n("event_count"), F.count_distinct("msisdn").alias("unique_users"))
        .orderBy("hour")
    )


def top_regions_by_data(t: Tables, as_of=None, n: int = 10) -> DataFrame:
    """Regions with the most session data, last 24 hours."""
    return (
        since(t.raw_events, "24 hours", as_of, "data_session")
        .groupBy("region")
        .agg(_n("sessions"), F.sum("data_mb").alias("mb"), F.count("data_mb").alias("measured"))
        .select(
            "region",
            "sessions",
            F.round("mb", 2).alias("total_data_mb"),
            F.round(mean(F.col("mb"), F.col("measured")), 2).alias("avg_data_mb"),
        )
        .orderBy(F.desc_nulls_first("total_data_mb"), *_nulls_last("region"))
        .limit(n)
    )


def call_durations(t: Tables, as_of=None) -> DataFrame:
    """Mean and longest call in minutes, last 24 hours."""
    seconds = F.col("duration_seconds")
    return (
        since(t.raw_events, "24 hours", as_of, "call")
        .agg(
            F.sum(seconds).alias("total"),
            F.count(seconds).alias("measured"),
            F.max(seconds).alias("longest"),
            _n("total_calls"),
        )
        .select(
            F.round(_minutes(F.col("total"), F.col("measured")), 2).alias("avg_call_minutes"),
            F.round(_minutes(F.col("longest"), F.lit(1)), 2).alias("max_call_minutes"),
            "total_calls",
        )
    )


def _minutes(seconds: Column, n: Column) -> Column:
    """Exact decimal, so that rounding to cents sees true halves."""
    return F.try_divide(seconds.cast("decimal(20,0)"), (n * 60).cast("decimal(18,0)"))


def realtime_totals(t: Tables, as_of=None) -> DataFrame:
    """All events by main type, and those of the last 5 minutes. The whole history is read
    for the type alone; the recent part is a scan of its own, which skips the rest."""
    recent = since(t.raw_events, "5 minutes", as_of).agg(_n("n")).scalar()
    return t.raw_events.agg(_n("total"), *_kind_counts()).withColumn("last_5min", recent)


def anomaly_totals(t: Tables, as_of=None) -> DataFrame:
    """All anomalies, the severe ones, and those of the last hour."""
    start = moment(t.raw_events, as_of, "1 hour")
    return t.anomalies.agg(
        _n("total_anomalies"),
        count_where(F.col("severity") == "high").alias("high_severity"),
        count_where(F.col("detected_at") >= start).alias("last_hour"),
    )


def top_regions(t: Tables, as_of=None, n: int = 5) -> DataFrame:
    """Regions with the most events, last hour."""
    return (
        since(t.raw_events, "1 hour", as_of)
        .groupBy("region")
        .agg(_n("events"))
        .orderBy(F.desc("events"), *_nulls_last("region"))
        .limit(n)
    )


# Status marks of the health report (fixed values).
HEALTHY, UNHEALTHY = "✅", "⚠️"


def health(t: Tables, as_of=None, least_events: int = 1000) -> DataFrame:
    """Row counts with a status mark: more than 1000 raw events, any rollup rows."""
    parts = [
        ("Raw Events", t.raw_events, least_events),
        ("Daily Stats", t.daily_stats, 0),
        ("Hourly Stats", t.hourly_stats, 0),
    ]
    return _stacked(
        [
            _row_count(name, frame, "component", "count").withColumn(
                "status", F.when(F.col("count") > least, HEALTHY).otherwise(UNHEALTHY)
            )
            for name, frame, least in parts
        ]
    )


def latest_metrics(t: Tables, as_of=None, tag: str = "5min", n: int = 5) -> DataFrame:
    """Newest rows of one metric."""
    return (
        t.real_time_metrics.filter(F.col("metric_type") == tag)
        .orderBy(F.desc("window_start"), *_nulls_last("region", "event_type"))
        .select("window_start", "window_end", "region", "event_type", "count_events", "total_data_gb")
        .limit(n)
    )


def top_daily(t: Tables, as_of=None, n: int = 5) -> DataFrame:
    """Busiest day, region and type."""
    return (
        t.daily_stats.orderBy(F.desc("total_events"), *_nulls_last("date", "region", "event_type"))
        .select("date", "region", "event_type", "total_events", "total_call_duration", "total_data_mb")
        .limit(n)
    )


def batch_summary(t: Tables, as_of=None) -> DataFrame:
    """Sizes and freshness of raw events and rollups in one row."""

    def one(frame: DataFrame, value: Column) -> Column:
        return frame.agg(value).scalar()

    return t.raw_events.agg(_n("raw_events")).select(
        "raw_events",
        one(t.daily_stats, _n("n")).alias("daily_stats"),
        one(t.daily_stats, F.max("date").alias("d")).alias("latest_daily_date"),
        one(t.hourly_stats, _n("n")).alias("hourly_stats"),
        one(t.hourly_stats, F.max("hour_timestamp").alias("h")).alias("latest_hourly"),
    )


def event_mix(t: Tables, as_of=None) -> DataFrame:
    """Share of each event type in percent beside the expected share."""
    expected = F.lit(None).cast("int")
    for kind, share in EXPECTED_MIX.items():
        expected = F.when(F.col("event_type") == kind, share).otherwise(expected)
    total = t.raw_events.agg(_n("n")).scalar()
    counts = t.raw_events.groupBy("event_type").agg(_n("event_count"))
    return counts.select(
        "event_type",
        "event_count",
        F.round(
            (F.col("event_count") * 100).cast("decimal(20,0)") / total.cast("decimal(18,0)"), 2
        ).alias("share_percent"),
        expected.alias("expected_percent"),
    )


def hourly_load(t: Tables, as_of=None) -> DataFrame:
    """Events by hour of day beside the load weight expected for that hour."""
    return (
        t.raw_events.groupBy(F.hour("timestamp").alias("hour"))
        .agg(_n("event_count"), F.max(hour_weight(F.col("timestamp"))).alias("weight"))
    )
