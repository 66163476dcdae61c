"""Daily and hourly rollups.

Both come from usage partials by hour, region and type, at most a few thousand rows a day, so
one pass over the events yields both tables.
"""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.functions.columns import mb_to_gb
from ringtally.functions.measures import mean, merged_partials, or_zero, sum_where, usage_partials
from ringtally.operators.metrics import by_window

KEYS = ("region", "event_type")


def between_days(events: DataFrame, first: Date, last: Date) -> DataFrame:
    """Events of whole days, ends included, as a range on the bare column, so that it reaches
    the file scan; a stored table is also pruned to the day folders."""
    kind = events.schema["timestamp"].dataType
    start, end = (
        F.lit(str(d)).cast("date").cast(kind) for d in (first, last + timedelta(days=1))
    )
    chosen = events.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    if "event_date" in events.columns:
        chosen = chosen.filter(
            F.col("event_date").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
        )
    return chosen


def hourly_partials(events: DataFrame) -> DataFrame:
    """Hours are cut from the time itself (cheaper than through the calendar); the sessions
    this library prepares are in UTC. Events without a time are in no hour."""
    hours = by_window(events, "1 hour", list(KEYS)).agg(*usage_partials())
    return hours.withColumnRenamed("window_start", "hour_timestamp")


def daily_partials(events: DataFrame) -> DataFrame:
    """Counts and sums by day, region and type, to be added up over loads; events without a
    time are below no day."""
    return events.groupBy(F.to_date("timestamp").alias("event_date"), *KEYS).agg(*usage_partials())


def hourly_stats(partials: DataFrame) -> DataFrame:
    """From hourly partials: zero where nothing was measured, except the average."""
    return partials.select(
        "hour_timestamp",
        *KEYS,
        F.col("n_events").alias("total_events"),
        or_zero(F.col("sum_duration")).alias("total_duration"),
        mean(F.col("sum_duration"), F.col("n_duration")).alias("avg_duration"),
        or_zero(F.col("sum_data")).alias("total_data_mb"),
        or_zero(F.col("sum_amount")).alias("total_amount"),
    )


def daily_stats(partials: DataFrame) -> DataFrame:
    """From hourly partials: NULL where nothing was measured; durations are those of calls."""
    days = partials.groupBy(F.to_date("hour_timestamp").alias("date"), *KEYS).agg(*merged_partials())

    def events_of(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col("n_events")).otherwise(0)

    def of_calls(value: Column) -> Column:
        return F.when(F.col("event_type") == "call", value)

    return days.select(
        "date",
        *KEYS,
        F.col("n_events").alias("total_events"),
        events_of("call").alias("total_calls"),
        events_of("sms").alias("total_sms"),
        events_of("data_session").alias("total_data_sessions"),
        of_calls(F.col("sum_duration")).alias("total_call_duration"),
        of_calls(mean(F.col("sum_duration"), F.col("n_duration"))).alias("avg_call_duration"),
        of_calls(F.col("max_duration")).alias("max_call_duration"),
        F.col("sum_data").alias("total_data_mb"),
        mean(F.col("sum_data"), F.col("n_data")).alias("avg_data_mb"),
        F.col("max_data").alias("max_data_mb"),
        F.col("sum_amount").alias("total_revenue"),
        mean(F.col("sum_amount"), F.col("n_amount")).alias("avg_transaction"),
    )


def daily_stats_extended(events: DataFrame, partials: DataFrame) -> DataFrame:
    """Hours, terabytes, recharges, users and the busiest hour of each day.

    Users are counted exactly: Catalyst groups by user first, spreading a large region over
    all its users, and then counts. The busiest hour (the earliest of equals) needs only the
    hourly partials; both sides of the join are one row per day, region and type.
    """
    day = F.to_date("timestamp").alias("processing_date")
    totals = (
        events.filter(F.col("timestamp").isNotNull())
        .groupBy(day, *KEYS)
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.sum("duration_seconds").alias("sum_duration"),
            F.sum("data_mb").alias("sum_data"),
            sum_where(F.col("amount"), F.col("event_type") == "balance_recharge").alias("recharged"),
            sum_where(F.col("duration_seconds"), F.col("event_type") == "call").alias("call_seconds"),
            F.count(F.when(F.col("event_type") == "call", F.col("duration_seconds"))).alias("n_calls"),
            F.count_distinct("msisdn").alias("unique_users"),
        )
    )
    busiest = partials.groupBy(
        F.to_date("hour_timestamp").alias("peak_date"),
        F.col("region").alias("peak_region"),
        F.col("event_type").alias("peak_type"),
    ).agg(
        F.max_by(
            F.hour("hour_timestamp"), F.struct(F.col("n_events"), -F.hour("hour_timestamp"))
        ).alias("peak_hour")
    )
    joined = totals.join(
        busiest,
        (F.col("processing_date") == F.col("peak_date"))
        & F.col("region").eqNullSafe(F.col("peak_region"))
        & F.col("event_type").eqNullSafe(F.col("peak_type")),
    )
    return joined.select(
        "processing_date",
        *KEYS,
        "total_events",
        (or_zero(F.col("sum_duration")) / 3600).alias("total_duration_hours"),
        mb_to_gb(mb_to_gb(or_zero(F.col("sum_data")))).alias("total_data_tb"),
        or_zero(F.col("recharged")).alias("total_recharge_amount"),
        mean(F.col("call_seconds"), F.col("n_calls") * 60).alias("avg_call_duration_minutes"),
        mean(F.col("sum_data"), F.col("unique_users")).alias("avg_data_per_user_mb"),
        "unique_users",
        "peak_hour",
    )
