import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringtally.operators.metrics import cumulative_metrics, event_type_metrics
from ringtally.schema import TABLES
from ringtally.sources.store import Store
from tests.rows import at, event, frame

DAY = dt.date(2024, 3, 10)


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder + "/store").create()


def test_new_tables_are_empty(store):
    for table in TABLES:
        assert store.read(table).count() == 0


def test_repeating_a_load_changes_nothing(spark, store):
    first = frame(spark, event("a"), event("b", time=at(day=11)))
    store.load("raw_events", first, "load-1")
    store.load("raw_events", frame(spark, event("c")), "load-2")
    before = sorted(r.event_id for r in store.read("raw_events").collect())
    store.load("raw_events", first, "load-1")
    assert sorted(r.event_id for r in store.read("raw_events").collect()) == before == ["a", "b", "c"]


def test_load_id_is_required_where_the_table_has_one(spark, store):
    with pytest.raises(ValueError):
        store.load("raw_events", frame(spark, event("a")))
    with pytest.raises(ValueError):
        store.load("real_time_metrics", event_type_metrics(frame(spark, event("a"))), "x")


def test_window_rows_replace_their_own_window(spark, store):
    store.load("real_time_metrics", event_type_metrics(frame(spark, event("a"), event("b", time=at(5)))))
    store.load("real_time_metrics", event_type_metrics(frame(spark, event("a"), event("c"))))
    got = {r.window_start: r.count_events for r in store.read("real_time_metrics").collect()}
    assert got == {at(0): 2, at(5): 1}


def test_cumulative_rows_keep_only_the_latest(spark, store):
    for rows in ([event("a")], [event("a"), event("b")]):
        store.load("real_time_metrics", cumulative_metrics(frame(spark, *rows)))
    assert [r.count_events for r in store.read("real_time_metrics").collect()] == [2]


def test_days(spark, store):
    rows = [event("a"), event("b", time=at(day=11)), event("c", time=at(day=13)), event("n", time=None)]
    store.load("raw_events", frame(spark, *rows), "x")
    assert [d.day for d in store.days("raw_events")] == [10, 11, 13]
    got = store.read_days("raw_events", DAY, DAY + dt.timedelta(days=1))
    assert sorted(r.event_id for r in got.collect()) == ["a", "b"]
    assert store.read_days("raw_events", dt.date(2023, 1, 1), dt.date(2023, 1, 2)).count() == 0
    assert {r.event_id for r in store.read("raw_events").filter("event_date IS NULL").collect()} == {"n"}


def test_expiry_drops_whole_days(spark, store):
    rows = [event(f"d{d}", time=at(day=d)) for d in range(10, 20)] + [event("n", time=None)]
    store.load("raw_events", frame(spark, *rows), "x")
    gone = store.expire("raw_events", dt.date(2024, 3, 19), keep_days=3)
    assert [d.day for d in gone] == [10, 11, 12, 13, 14, 15]
    assert sorted(r.event_id for r in store.read("raw_events").collect()) == ["d16", "d17", "d18", "d19", "n"]


def test_one_large_day_is_written_as_several_files(spark, store):
    """All rows on one day: rebalancing splits them by size instead of using one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        many = spark.range(200_000).select(
            F.col("id").cast("string").alias("event_id"),
            F.lit("m").alias("msisdn"),
            F.lit("call").alias("event_type"),
            F.lit(at()).alias("timestamp"),
        )
        store.load("raw_events", many.repartition(8), "x")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    got = store.read("raw_events")
    assert got.count() == 200_000
    assert got.select(F.input_file_name().alias("f")).distinct().count() > 2


def test_every_table_expires_by_day(spark, store):
    for table in TABLES:
        assert store.expire(table, DAY, 3) == []
    windows = [event("a", time=at(day=1)), event("b", time=at(day=9))]
    store.load("real_time_metrics", event_type_metrics(frame(spark, *windows)))
    store.load("real_time_metrics", cumulative_metrics(frame(spark, *windows)))
    assert [d.day for d in store.expire("real_time_metrics", DAY, 3)] == [1]
    left = {(r.metric_type, r.window_date) for r in store.read("real_time_metrics").collect()}
    assert left == {("event_type_5min", dt.date(2024, 3, 9)), ("batch_metrics", None)}


def part_files(store, table, day):
    from pathlib import Path

    return list(Path(store.path(table)).glob(f"*={day}/**/*.parquet"))


def test_a_closed_day_of_many_loads_is_compacted(spark, store):
    for i in range(20):
        rows = frame(spark, event(f"a{i}"), event(f"b{i}", time=at(day=11)))
        store.load("raw_events", rows, f"load-{i}", layout=None)
    before = sorted(map(tuple, store.read("raw_events").drop("load_id").collect()), key=repr)
    assert len(part_files(store, "raw_events", DAY)) >= 20
    assert [store.compact("raw_events", DAY) for _ in range(2)] == [True, False]
    assert len(part_files(store, "raw_events", DAY)) == 1
    assert len(part_files(store, "raw_events", "2024-03-11")) >= 20
    assert sorted(map(tuple, store.read("raw_events").drop("load_id").collect()), key=repr) == before
    assert [d.day for d in store.days("raw_events")] == [10, 11]
    assert not store.compact("raw_events", dt.date(2024, 1, 1))
    with pytest.raises(ValueError):
        store.compact("daily_stats", DAY)


@pytest.mark.parametrize("step", range(9))
def test_a_compaction_that_was_cut_off(spark, store, monkeypatch, step):
    """It fails before one of its changes to files. Readers see every row once, before and after
    the next call, which finishes it."""
    for i in range(3):
        store.load("raw_events", frame(spark, event(f"a{i}")), f"load-{i}")
    calls = []

    def failing(name):
        method = getattr(Store, name)

        def step_of(self, *args):
            calls.append(name)
            if len(calls) == step + 1:
                raise RuntimeError("cut off")
            return method(self, *args)

        return step_of

    seen = lambda: sorted(r.event_id for r in store.read("raw_events").collect())
    with monkeypatch.context() as patched:
        for name in ("_note", "_load_folders", "_delete"):
            patched.setattr(Store, name, failing(name))
        try:
            store.compact("raw_events", DAY)
            assert len(calls) <= step
        except RuntimeError:
            pass
        assert seen() == ["a0", "a1", "a2"]
    store.load("raw_events", frame(spark, event("late")), "later")
    assert store.compact("raw_events", DAY) and seen() == ["a0", "a1", "a2", "late"]
    assert store._notes("raw_events") == {} and len({r.load_id for r in store.read("raw_events").collect()}) == 1
