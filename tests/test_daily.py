import datetime as dt

import pytest

from ringtally.plans.daily import run_daily, run_rollups, stored_tables
from ringtally.plans.quality import QualityError, quality_gate, require_results
from ringtally.sources.sample import usage_events
from ringtally.sources.store import Store
from tests.rows import at, event, frame

DAY = dt.date(2024, 3, 10)


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder + "/store").create()


def day_of(n, day=10):
    kinds = ("call", "sms", "data_session")
    return [
        event(f"{day}-{i}", kind=kinds[i % 3], duration_seconds=i, time=at(i, day=day)) for i in range(n)
    ]


def contents(store, table):
    return sorted(map(tuple, store.read(table).drop("created_at").collect()), key=repr)


def test_rollups_match_the_whole_table(spark, store):
    """Day by day, or all in one go: the same tables, also when run again."""
    events = usage_events(spark, "/root/testdata/sf0.001")
    store.load("raw_events", events, "sample")
    run_rollups(store, dt.date(2024, 1, 1), dt.date(2024, 1, 31), extended=True)
    names = ("daily_stats", "hourly_stats", "daily_stats_extended")
    whole = {t: contents(store, t) for t in names}
    assert len(whole["daily_stats"]) > 100
    for day in (dt.date(2024, 1, 3), dt.date(2024, 1, 4), dt.date(2024, 1, 3)):
        run_rollups(store, day, extended=True)
    assert {t: contents(store, t) for t in names} == whole


def test_rerun_replaces_only_its_day(spark, store):
    store.load("raw_events", frame(spark, *day_of(30), *day_of(30, 11)), "x")
    run_rollups(store, DAY, dt.date(2024, 3, 11))
    store.load("raw_events", frame(spark, event("late")), "late")
    run_rollups(store, DAY)
    sizes = {}
    for row in store.read("daily_stats").collect():
        sizes[row.date.day] = sizes.get(row.date.day, 0) + row.total_events
    assert sizes == {10: 31, 11: 30}


def test_rollup_of_a_day_without_events_is_removed_when_asked(spark, store):
    store.load("raw_events", frame(spark, *day_of(30, 9), *day_of(30), *day_of(30, 11)), "x")
    run_rollups(store, dt.date(2024, 3, 9), dt.date(2024, 3, 11))
    store.drop_days("raw_events", [DAY])
    run_rollups(store, DAY)
    assert [d.day for d in store.days("daily_stats")] == [9, 10, 11]
    run_rollups(store, DAY, remove_empty=True)
    assert {r.date.day for r in store.read("daily_stats").collect()} == {9, 11}
    assert [d.day for d in store.days("hourly_stats")] == [9, 11]


def test_rollups_outlive_their_events(spark, store):
    """Days expire; rolling a wider range up again keeps the only copy that is left."""
    store.load("raw_events", frame(spark, *day_of(30, 1), *day_of(30, 9), *day_of(100)), "x")
    run_rollups(store, dt.date(2024, 3, 1), DAY, extended=True)
    before = {t: contents(store, t) for t in ("daily_stats", "hourly_stats", "daily_stats_extended")}
    run_daily(store, DAY, keep_days=5)
    assert [d.day for d in store.days("raw_events")] == [9, 10]
    for flag in (False, True):
        run_rollups(store, dt.date(2024, 3, 1), DAY, extended=True, remove_empty=flag)
        assert {t: contents(store, t) for t in before} == before


def test_an_event_delivered_twice_counts_once(spark, store):
    store.load("raw_events", frame(spark, *day_of(30)), "x")
    run_rollups(store, DAY, extended=True)
    before = {t: contents(store, t) for t in ("daily_stats", "daily_stats_extended")}
    store.load("raw_events", frame(spark, *day_of(30)), "again")
    run_rollups(store, DAY, extended=True)
    assert {t: contents(store, t) for t in before} == before


def test_daily_job(spark, store):
    rows = day_of(90) + day_of(90, 9) + [event("old", time=at(day=1))]
    store.load("raw_events", frame(spark, *rows), "x")
    summary = run_daily(store, DAY, keep_days=5)
    assert summary["raw_events"] == 181 and summary["daily_stats"] == 3
    assert summary["latest_daily_date"] == DAY and summary["latest_hourly"] == at(60)
    assert [d.day for d in summary["expired_days"]] == [1]
    log = store.read("pipeline_monitoring").collect()
    assert [(r.pipeline_name, r.pipeline_type, r.status, r.records_processed) for r in log] == [
        ("daily_rollups", "batch", "completed", 181)
    ]


def test_daily_job_compacts_and_expires_tables(spark, store):
    for i, rows in enumerate((day_of(60), day_of(60, 1), [event("late")])):
        store.load("raw_events", frame(spark, *rows), f"load-{i}")
    run_rollups(store, dt.date(2024, 3, 1))
    summary = run_daily(store, DAY, keep_days={"raw_events": 5, "daily_stats": 30}, compact=True)
    assert summary["compacted"] == ["raw_events"] and summary["raw_events"] == 121
    assert [d.day for d in summary["expired"]["raw_events"]] == [1]
    assert [d.day for d in store.days("daily_stats")] == [1, 10]
    assert {r.load_id for r in store.read("raw_events").collect()} == {"compacted"}


def test_daily_job_stops_at_the_gate_and_logs_it(spark, store):
    store.load("raw_events", frame(spark, *day_of(99)), "x")
    with pytest.raises(QualityError, match="only 99 events"):
        run_daily(store, DAY)
    assert store.read("daily_stats").count() == 0
    row = store.read("pipeline_monitoring").first()
    assert row.status == "failed" and "99 events" in row.error_message


def test_no_rollup_rows_is_a_failure(spark, store):
    with pytest.raises(QualityError):
        require_results(stored_tables(store))


def test_gate_counts_recent_by_event_or_load_time(spark, store):
    rows = [event("new"), event("old", time=at(day=1))]
    store.load("raw_events", frame(spark, *rows), "x")
    # Loaded just now, so both are recent as of the event day, whatever their event time.
    gate = quality_gate(stored_tables(store), "2024-03-10").first()
    assert (gate.total_events, gate.recent_events, gate.passed) == (2, 2, False)
    # Without a load time only the event time counts.
    tables = stored_tables(store)
    tables.raw_events = tables.raw_events.drop("created_at")
    assert quality_gate(tables, "2024-03-10").first().recent_events == 1
