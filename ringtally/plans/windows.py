"""Stored window metrics, totals and users: parts of many loads, merged when they are read."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.functions.measures import merged_partials, merged_users, user_estimate, user_sketch
from ringtally.operators.conform import conform
from ringtally.operators.metrics import (
    _states,
    by_window,
    merged_states,
    metrics_of_states,
)
from ringtally.operators.rollups import KEYS, between_days
from ringtally.plans.reports import Tables, latest_metrics
from ringtally.sources.store import Store


def _finished(states: DataFrame) -> DataFrame:
    """Metrics with the partition column of the stored table, so that days can be chosen."""
    rows = metrics_of_states(states)
    day = F.when(F.col("metric_type") != "batch_metrics", F.to_date("window_start"))
    return conform(rows, "real_time_metrics").withColumn("window_date", day)


def stored_metrics(store: Store) -> DataFrame:
    """``real_time_metrics``: rows stored as they are, and the windows and totals whose parts
    streams have stored."""
    whole = store.read("real_time_metrics").drop("window_key")
    return whole.unionByName(_finished(store.read("window_states")))


def newest_metrics(store: Store, tag: str = "5min", n: int = 5) -> DataFrame:
    """The report ``latest_metrics`` over as few of the newest days as hold ``n`` rows. Days are
    folder names; older ones are not listed."""
    table = "window_states"
    chosen: list[Date] = []
    rows = store.read_parts(table, [])
    for day in reversed(store.days(table)):
        chosen.append(day)
        rows = store.read_parts(table, chosen).filter(F.col("metric_type") == tag)
        if merged_states(rows).limit(n).count() >= n:
            break
    return latest_metrics(Tables(raw_events=None, real_time_metrics=_finished(rows)), tag=tag, n=n)


def totals_so_far(store: Store, as_of=None) -> DataFrame:
    """Cumulative totals by type and region from the sums that the archive has stored by day. A
    new checkpoint goes on from them, and events delivered again are in them once."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    sums = store.read("usage_totals").groupBy(*KEYS).agg(*merged_partials())
    states = _states(sums, "batch_metrics", "usage").withColumns(
        {"query_id": F.lit(""), "batch_id": F.lit(0), "created_at": stamp}
    )
    return metrics_of_states(states)


def _added_up(sums: DataFrame) -> DataFrame:
    return sums.groupBy("event_date", *KEYS).agg(*merged_partials(), F.max("created_at").alias("created_at"))


def _one_query(states: DataFrame) -> DataFrame:
    return merged_states(states).withColumns({"query_id": F.lit("compacted"), "batch_id": F.lit(0).cast("long")})


def compact_day(store: Store, day: Date) -> list[str]:
    """Rewrite the many small loads of a closed day; returns the tables that had any. Raw events
    are sorted by subscriber, states and sums of the same window or day become one row."""
    ways = {
        "raw_events": {"by_subscriber": True},
        "anomalies": {},
        "quarantined_events": {},
        "window_states": {"merge": _one_query},
        "usage_totals": {"merge": _added_up},
    }
    return [table for table, way in ways.items() if store.compact(table, day, **way)]


# Distinct subscribers


def hourly_users(events: DataFrame) -> DataFrame:
    """A sketch of the subscribers of each hour, region and type."""
    hours = by_window(events, "1 hour", list(KEYS)).agg(
        F.count(F.lit(1)).alias("n_events"), user_sketch(F.col("msisdn")).alias("users")
    )
    return hours.withColumnRenamed("window_start", "hour_timestamp").select(
        "hour_timestamp", *KEYS, "n_events", "users"
    )


def load_hourly_users(store: Store, first: Date, last: Date | None = None) -> None:
    """Replace the sketches of some days."""
    last = last or first
    events = between_days(store.read_days("raw_events", first, last), first, last)
    store.load("hourly_users", hourly_users(events), layout="repartition")


def users_by(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """Events and estimated distinct subscribers by any of hour, region and type, from hourly
    sketches alone: subscribers seen in several hours or regions count once."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("n_events").alias("event_count"), merged_users(F.col("users")).alias("users")
    )
    return merged.withColumn("unique_users", user_estimate(F.col("users"))).drop("users")


def region_users_estimate(store: Store, first: Date, last: Date) -> DataFrame:
    """Events and estimated subscribers by region over whole days."""
    found = users_by(store.read_days("hourly_users", first, last), "region")
    return found.orderBy(F.desc("event_count"), F.col("region").asc_nulls_last())
