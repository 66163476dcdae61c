import datetime as dt

import pytest

from ringtally.plans import reports
from ringtally.plans.daily import run_rollups, stored_tables
from ringtally.plans.reports import Tables
from ringtally.sources.jdbc import jdbc_options
from ringtally.sources.messages import kafka_sink_options, kafka_source_options
from ringtally.sources.store import Store
from tests.rows import at, event, frame


def plan(frame):
    return frame._jdf.queryExecution().toString()


def tables(spark, *rows):
    return Tables(raw_events=frame(spark, *rows))


def test_present_moment_is_given_or_the_latest_event(spark):
    t = tables(spark, event("a", time=at(0)), event("b", time=at(5)), event("c", time=at(6)))
    assert reports.recent_total(t).first()[0] == 2
    assert reports.recent_total(t, at(7)).first()[0] == 2
    assert reports.recent_total(t, "2024-03-10 12:10:00").first()[0] == 2
    assert reports.recent_total(t, at(60)).first()[0] == 0
    # Only a lower bound: what is later than the moment counts too.
    assert reports.recent_total(t, at(-60)).first()[0] == 3


def test_moment_does_not_depend_on_the_kind(spark):
    t = tables(
        spark,
        event("old", duration_seconds=60, time=at(-25 * 60)),
        event("new", duration_seconds=90, time=at(-1)),
        event("sms", kind="sms", time=at(0)),
    )
    row = reports.call_durations(t).first()
    assert row.total_calls == 1 and float(row.avg_call_minutes) == 1.5


def test_empty_tables_still_give_one_row(spark):
    t = tables(spark)
    assert reports.recent_counts(t).first().events_last_5min == 0
    row = reports.call_durations(t).first()
    assert row.avg_call_minutes is None and row.total_calls == 0
    assert reports.region_users(t).count() == 0
    assert reports.event_mix(t).count() == 0


def test_ranking_ties_end_in_the_region(spark):
    t = tables(spark, *[event(r or "none", region=r) for r in ("b", "a", None, "c")])
    assert [r.region for r in reports.top_regions(t, n=3).collect()] == ["a", "b", "c"]


def test_literal_moment_reaches_the_scan(spark, folder):
    store = Store(spark, folder + "/store").create()
    store.load("raw_events", frame(spark, event("a"), event("b", time=at(day=11))), "x")
    text = plan(reports.recent_total(stored_tables(store), "2024-03-11 12:02:00"))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][-1]
    assert "GreaterThanOrEqual(timestamp,2024-03-11" in pushed
    assert "PartitionFilters: [isnotnull(event_date" in text and "(event_date#" in text
    assert reports.recent_total(stored_tables(store), "2024-03-11 12:02:00").first()[0] == 1


def test_latest_moment_reaches_the_scan(spark, folder):
    store = Store(spark, folder + "/store").create()
    store.load("raw_events", frame(spark, event("a"), event("b", time=at(day=11))), "x")
    found = reports.region_users(stored_tables(store))
    assert [r.event_count for r in found.collect()] == [1]
    scans = [line for line in plan(found).splitlines() if "FileScan" in line]
    assert any("PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp,ScalarSubquery" in s for s in scans)
    assert any("PartitionFilters: [isnotnull(event_date" in s and "subquery" in s for s in scans)


def test_day_reports_on_stored_tables(spark, folder):
    store = Store(spark, folder + "/store").create()
    rows = [event(f"{d}{i}", time=at(i * 20, day=d)) for d in (2, 3, 10) for i in range(d)]
    store.load("raw_events", frame(spark, *rows), "x")
    run_rollups(store, dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    t = stored_tables(store)
    got = reports.daily_summary(t, "2024-03-10").collect()
    assert [(r.date.day, r.total_events, r.total_calls) for r in got] == [(10, 10, 10), (3, 3, 3)]
    assert [(r.hour, r.event_count) for r in reports.peak_hours(t, "2024-03-03 23:00:00").collect()] == [(12, 3)]
    summary = reports.batch_summary(t).first()
    assert summary.latest_daily_date == dt.date(2024, 3, 10) and summary.raw_events == 15
    assert [r.status for r in reports.health(t).collect()] == ["⚠️", "✅", "✅"]
    assert [r.status for r in reports.health(t, least_events=14).collect()][0] == "✅"


def test_broker_options():
    options = kafka_source_options("broker:9092", max_per_trigger=5, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "usage_events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
        "minPartitions": "64",
    }
    assert kafka_sink_options("broker:9092")["kafka.acks"] == "all"


def test_database_options():
    options = jdbc_options("jdbc:postgresql://db/x", "raw_events", "u", "p", connections=4)
    assert options["numPartitions"] == "4" and options["driver"] == "org.postgresql.Driver"


def test_scratch_folder_is_the_clusters(spark):
    from ringtally.session import scratch_path

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base + "/x-") and first != second


@pytest.mark.parametrize("name", ["health", "table_counts"])
def test_counts_read_no_columns(spark, folder, name):
    store = Store(spark, folder + "/store").create()
    store.load("raw_events", frame(spark, event("a")), "x")
    text = plan(getattr(reports, name)(stored_tables(store)))
    assert text.count("ReadSchema: struct<>") >= 3


def test_anomaly_grades(spark):
    t = tables(spark, event("x"))
    rows = [("a", "high"), ("a", "medium"), ("a", "low"), ("b", None)]
    t.anomalies = spark.createDataFrame(
        [(k, s, at(0)) for k, s in rows] + [("old", "high", at(-60 * 25))], "anomaly_type string, severity string, detected_at timestamp"
    )
    got = {r.anomaly_type: (r.anomaly_count, r.avg_severity) for r in reports.anomaly_summary(t, at(0)).collect()}
    assert got == {"a": (3, 2.0), "b": (1, 1.0)}
