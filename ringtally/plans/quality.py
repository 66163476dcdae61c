"""Checks before and after the daily job. Each is a one-pass DataFrame; the ``require_``
forms fetch its few rows and raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtally.plans.reports import Tables, moment


class QualityError(Exception):
    """A check failed; the job must not go on."""


def quality_gate(t: Tables, as_of=None, least: int = 100, days: int = 7) -> DataFrame:
    """Events in all, and those that happened or were loaded in the last days. The total reads
    no column; the recent part skips files by the bounds of either time."""
    events = t.raw_events
    start = moment(events, as_of, f"{days} days", to_day=True)
    recent = F.col("timestamp") >= start
    if "created_at" in events.columns:
        recent = recent | (F.col("created_at") >= start)
    n = F.count(F.lit(1))
    return events.agg(n.alias("total_events")).select(
        "total_events",
        events.filter(recent).agg(n.alias("n")).scalar().alias("recent_events"),
        (F.col("total_events") >= least).alias("passed"),
    )


def verify_results(t: Tables) -> DataFrame:
    """Rows of both rollups; the daily one must have some."""

    def rows(name: str, frame: DataFrame, least: int) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") >= least).alias("passed")
        )

    return rows("daily_stats", t.daily_stats, 1).unionByName(rows("hourly_stats", t.hourly_stats, 0))


def retention_kept(t: Tables, as_of=None, keep_days: int = 14) -> DataFrame:
    """Events by day that dropping the days before ``as_of`` minus ``keep_days`` would keep."""
    start = moment(t.raw_events, as_of, f"{keep_days} days", to_day=True)
    kept = t.raw_events.filter(F.col("timestamp") >= start)
    if "event_date" in kept.columns:
        kept = kept.filter(F.col("event_date") >= start.cast("date"))
    return (
        kept.select("timestamp")
        .groupBy(F.to_date("timestamp").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def require_quality(t: Tables, as_of=None, least: int = 100) -> dict:
    row = quality_gate(t, as_of, least).first()
    if not row.passed:
        raise QualityError(f"only {row.total_events} events, at least {least} are needed")
    return row.asDict()


def require_results(t: Tables) -> dict:
    counts = {row.table_name: row.n_rows for row in verify_results(t).collect()}
    if counts["daily_stats"] == 0:
        raise QualityError("the daily rollup is empty")
    return counts
