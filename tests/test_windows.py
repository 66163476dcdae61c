"""Stored windows, totals and users over several loads, queries and checkpoints."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ringtally.operators import events as ev
from ringtally.operators.metrics import (
    conditional_metrics,
    conditional_states,
    cumulative_metrics,
    event_type_metrics,
    event_type_states,
    metrics_of_states,
    regional_metrics,
    regional_states,
)
from ringtally.plans import windows
from ringtally.schema import Limits
from ringtally.sources.sample import usage_events
from ringtally.sources.store import Store
from ringtally.streaming.jobs import await_all, drain, start, start_streams
from ringtally.streaming.sinks import archive_sink, state_sink
from ringtally.streaming.runlog import StreamTotals, log_stream
from tests.rows import at, event, frame
from tests.test_streams import FOLDER, Inbox, ids, wire

DAY = dt.date(2024, 3, 10)
MEASURES = [
    "metric_type", "window_start", "window_end", "region", "event_type", "event_subtype", "count_events",
    "total_duration_seconds", "total_data_gb", "total_amount", "avg_duration_seconds", "avg_data_mb",
]


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder + "/store").create()


@pytest.fixture
def inbox(folder):
    return Inbox(folder)


def run(spark, inbox, store, checkpoint, *names, **options):
    await_all(start_streams(inbox.stream(spark), store, checkpoint, names, continuous=False, **options))


def counts(metrics, tag="event_type_5min"):
    rows = metrics.filter(F.col("metric_type") == tag).collect()
    return {r.window_start: r.count_events for r in rows}


def shown(frame):
    from ringtally.operators.conform import conform

    return sorted(map(tuple, conform(frame, "real_time_metrics").select(*MEASURES).collect()), key=repr)


# Events are stored once


def test_an_event_delivered_again_is_stored_once(spark, store, inbox, folder):
    inbox.put(wire("a", at(0), duration_seconds=20000), wire("a", at(0), duration_seconds=20000), wire("b", at(1)))
    inbox.put(wire("a", at(0), duration_seconds=20000), wire("c", at(2)), wire("n", None), wire("n", None))
    inbox.put(wire("n", None), wire("d", at(60 * 30)), wire("b", at(1)))
    run(spark, inbox, store, folder + "/cp", "archive")
    assert ids(store.read("raw_events")) == ["a", "b", "c", "d", "n"]
    run(spark, inbox, store, folder + "/other", "archive")  # a new checkpoint reads all again
    assert ids(store.read("raw_events")) == ["a", "b", "c", "d", "n"]
    assert ids(store.read("anomalies")) == ["a"]


def test_batches_tried_again_after_any_table(spark, store, inbox, folder, monkeypatch):
    """The sink fails after each of its tables in turn; the last try leaves everything once."""
    inbox.put(wire("a", at(0), duration_seconds=20000), wire("b", at(1)), "not json")
    tables = ["raw_events", "quarantined_events", "anomalies", "usage_totals", "window_states"]
    load, left = Store.load, list(tables)

    def fails(self, table, *args, **options):
        load(self, table, *args, **options)
        if left and table == left[0]:
            left.pop(0)
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(Store, "load", fails)
    for _ in tables:
        with pytest.raises(Exception, match="lost after the write"):
            run(spark, inbox, store, folder + "/cp", "archive", "metrics_5min", from_archive=True)
    run(spark, inbox, store, folder + "/cp", "archive", "metrics_5min", from_archive=True)
    assert not left and ids(store.read("raw_events")) == ["a", "b"] and ids(store.read("anomalies")) == ["a"]
    assert counts(windows.stored_metrics(store)) == {at(0): 2}
    assert windows.totals_so_far(store).first().count_events == 2
    assert store.read("quarantined_events").count() == 1


def test_only_touched_days_and_hours_are_compared(spark, store):
    from ringtally.streaming.sinks import contents, stored_before

    for day in (9, 10, 11):
        store.load("raw_events", frame(spark, event("a", time=at(0, day)), event("b", time=at(300, day))), f"d{day}")

    def stored(batch, piece="own"):
        return stored_before(store, "raw_events", contents(batch).hours, piece)

    batch = frame(spark, event("x", time=at(5)))
    assert ids(stored(batch)) == ["a"] and ids(stored(batch, "d10")) == []
    assert {f.split("event_date=")[1][:10] for f in stored(batch).inputFiles()} == {"2024-03-10"}
    many = frame(spark, *[event(str(i), time=at(60 * i, 1)) for i in range(10 * 24)])
    assert ids(stored(many)) == ["a"] * 3 + ["b"] * 3
    store.load("raw_events", frame(spark, event("n", time=None)), "none")
    assert ids(stored(frame(spark, event("x", time=at(0)), event("y", time=None)))) == ["a", "n"]
    assert stored(frame(spark, event("x", time=at(0, 20)))) is None


def test_repeats_count_once_in_windows(spark, store, inbox, folder):
    inbox.put(wire("a", at(0)), wire("a", at(0)), wire("b", at(1)))
    inbox.put(wire("a", at(0)), wire("end", at(30)))
    inbox.put(wire("later", at(31)))
    run(spark, inbox, store, folder + "/cp", "metrics_5min")
    assert counts(windows.stored_metrics(store)) == {at(0): 2}


def test_each_id_is_held_once_and_read_once(spark, store, inbox, folder):
    """Two stateful steps, also where copies of one id are frequent."""
    inbox.put(*[wire("hot", at(0))] * 50, wire("a", at(1)), wire("hot", at(6)))
    inbox.put(wire("hot", at(0)), wire("b", at(1)), wire(None, at(1)))
    inbox.put(wire("end", at(30)))
    queries = start_streams(inbox.stream(spark), store, folder + "/cp", ("metrics_5min",), continuous=False)
    await_all(queries)
    batches = queries[0].recentProgress
    assert {len(b["stateOperators"]) for b in batches} == {2}
    assert sum(b["numInputRows"] for b in batches) == 56
    assert counts(windows.stored_metrics(store)) == {at(0): 3, at(5): 1}


@pytest.mark.parametrize("spread", [1, 16])
def test_rows_without_id_count_each(spark, inbox, spread):
    inbox.put(*[wire("a", at(0))] * 30, wire(None, at(0)), wire(None, at(0)))
    inbox.put(wire("a", at(0)), wire(None, at(0)), wire("end", at(30)))
    timed = ev.exact_amounts(inbox.stream(spark)).withWatermark("timestamp", "1 minute")
    once = ev.drop_repeats_in_windows(timed, "5 minutes", spread=spread)
    got = drain(spark, event_type_metrics(once, watermark=None))
    assert {r.window_start: r.count_events for r in got.collect()} == {at(0): 4}


def test_a_batch_of_states_is_computed_once(spark, store):
    passes = spark.sparkContext.accumulator(0)

    def seen(tag):
        passes.add(1)
        return tag

    rows = frame(spark, *[event(f"e{i}", time=at(5 * i)) for i in range(6)])
    states = event_type_states(rows).withColumn("metric_type", F.udf(seen)("metric_type"))
    state_sink(store)(states, 0)
    assert passes.value == 6
    assert counts(windows.stored_metrics(store)) == {at(5 * i): 1 for i in range(6)}


def test_late_events_are_counted_and_kept(spark, store, inbox, folder):
    """As Spark drops them: a batch closes windows, and the batches after it drop their rows."""
    inbox.put(wire("a", at(1)), wire("b", at(8)))  # watermark 12:07
    inbox.put(wire("c", at(8)))
    inbox.put(wire("late", at(2)), wire("late2", at(3)), wire("late2", at(3)), wire("kept", at(5.5)), wire("c", at(8)))
    inbox.put(wire("end", at(30)))
    inbox.put(wire("end2", at(31)))
    totals = StreamTotals()
    spark.streams.addListener(totals)
    try:
        queries = start_streams(inbox.stream(spark), store, folder + "/cp", ("archive", "metrics_5min"), continuous=False)
        await_all(queries)
        for query in queries:
            log_stream(store, query, totals)
    finally:
        spark.streams.removeListener(totals)
    assert counts(windows.stored_metrics(store)) == {at(0): 1, at(5): 3}
    log = {r.pipeline_name: r.records_failed for r in store.read("pipeline_monitoring").collect()}
    assert log == {"archive": 0, "metrics_5min": 3}  # each delivery of a late event
    late = {r.event_id: r.broken_rules for r in store.read("quarantined_events").collect()}
    assert late == {e: "late_for_metrics_5min@2024-03-10T12:00:00.000000Z" for e in ("late", "late2")}
    assert ids(store.read("raw_events")) == ["a", "b", "c", "end", "end2", "kept", "late", "late2"]
    assert store.read("stream_clock").count() == 2


# Windows add up


def test_a_new_checkpoint_adds_to_stored_windows(spark, store, folder):
    first, second = Inbox(folder), None
    first.put(wire("a", at(0), duration_seconds=10), wire("b", at(1), duration_seconds=20), wire("c", at(2)))
    first.put(wire("end", at(30)))
    first.put(wire("end2", at(31)))
    run(spark, first, store, folder + "/cp", "metrics_5min")
    assert counts(windows.stored_metrics(store)) == {at(0): 3}
    os.mkdir(folder + "/more")
    second = Inbox(folder + "/more")
    second.put(wire("late", at(3), duration_seconds=60))
    second.put(wire("end", at(30)))
    second.put(wire("end2", at(31)))
    run(spark, second, store, folder + "/cp2", "metrics_5min")
    row = windows.stored_metrics(store).filter(F.col("window_start") == at(0)).first()
    assert row.count_events == 4 and float(row.avg_duration_seconds) == 30 and row.total_duration_seconds == 90


def test_states_and_metrics_agree(spark):
    events = usage_events(spark, FOLDER)
    pairs = [(event_type_states, event_type_metrics), (regional_states, regional_metrics),
             (conditional_states, conditional_metrics)]
    for state, metric in pairs:
        parts = [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
        rows = [
            state(p).withColumns({"query_id": F.lit(f"q{i}"), "batch_id": F.lit(0), "created_at": F.current_timestamp()})
            for i, p in enumerate(parts)
        ]
        stale = rows[0].withColumns({"batch_id": F.lit(-1), "n_events": F.lit(10**6).cast("long")})
        merged = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(stale)
        assert shown(metrics_of_states(merged)) == shown(metric(events))


def test_metrics_from_the_archive(spark, store, inbox, folder):
    """One query for all; equal to a batch over the events, open windows, late events and
    repeats included; a new checkpoint that reads all again changes nothing."""
    inbox.put(wire("a", at(1), duration_seconds=10), wire("x", at(60), kind="data_session", data_mb=5.25))
    inbox.put(wire("late", at(2), duration_seconds=30), wire("a", at(1), duration_seconds=10), wire("n", None))
    inbox.put(wire("r", at(61), kind="balance_recharge", amount=10, region=None), wire("bad", at(1), kind="fax"))
    names = ("archive", "metrics_5min", "metrics_10min", "metrics_conditional", "metrics_users", "metrics_cumulative")
    for checkpoint in ("/cp", "/cp", "/new"):
        run(spark, inbox, store, folder + checkpoint, *names, from_archive=True)
        events = store.read("raw_events")
        assert ids(events) == ["a", "late", "n", "r", "x"]
        expected = event_type_metrics(events).unionByName(regional_metrics(events)).unionByName(conditional_metrics(events))
        got = windows.stored_metrics(store)
        assert shown(got.filter("metric_type <> 'region_users_5min'")) == shown(expected)
        columns = [c for c in MEASURES if not c.startswith("window")]
        stamp = F.lit("2030-01-01").cast("timestamp")
        total = windows.totals_so_far(store).select(*columns)
        from ringtally.operators.conform import conform

        expected = conform(cumulative_metrics(events, stamp), "real_time_metrics").select(*columns)
        got = conform(windows.totals_so_far(store), "real_time_metrics").select(*columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
        assert total.count() == 3
    with pytest.raises(ValueError):
        run(spark, inbox, store, folder + "/x", "metrics_5min", from_archive=True)


def test_totals_of_two_checkpoints_add_up(spark, store, folder):
    for name, n in (("one", 3), ("two", 2)):
        os.mkdir(f"{folder}/{name}")
        inbox = Inbox(f"{folder}/{name}")
        for i in range(n):
            inbox.put(wire(f"{name}{i}", at(i)))
        run(spark, inbox, store, f"{folder}/cp-{name}", "metrics_cumulative")
    rows = windows.stored_metrics(store).collect()
    assert [(r.metric_type, r.count_events) for r in rows] == [("batch_metrics", 5)]
    assert rows[0].window_start is not None and rows[0].window_date is None


def test_a_closed_day_is_merged(spark, store, inbox, folder):
    for i in range(4):
        inbox.put(wire(f"a{i}", at(i)), wire(f"b{i}", at(i + 5), msisdn=f"m{i}"))
    run(spark, inbox, store, folder + "/cp", "archive", "metrics_5min", "metrics_users", from_archive=True)
    before = shown(windows.stored_metrics(store))
    raw = sorted(map(tuple, store.read("raw_events").drop("load_id").collect()))
    assert "window_states" in windows.compact_day(store, DAY) and windows.compact_day(store, DAY) == []
    assert shown(windows.stored_metrics(store)) == before
    assert sorted(map(tuple, store.read("raw_events").drop("load_id").collect())) == raw
    assert store.read("window_states").count() == store.read("window_states").select("window_start", "metric_type").distinct().count()
    assert windows.totals_so_far(store).first().count_events == 8
    inbox.put(wire("late", at(0)), wire("a0", at(0)))
    run(spark, inbox, store, folder + "/cp", "archive", "metrics_5min", from_archive=True)
    assert counts(windows.stored_metrics(store)) == {at(0): 5, at(5): 4}


def test_newest_metrics_read_few_days(spark, store):
    for day in range(1, 8):
        states = conditional_states(frame(spark, event("a", time=at(0, day)), event("b", time=at(5, day))))
        rows = states.withColumns({"query_id": F.lit("q"), "batch_id": F.lit(0).cast("long")})
        store.load("window_states", rows, f"q-{day}")
    found = windows.newest_metrics(store, n=3)
    assert [r.window_start for r in found.collect()] == [at(5, 7), at(0, 7), at(5, 6)]
    assert {f.split("window_date=")[1][:10] for f in found.inputFiles()} == {"2024-03-07", "2024-03-06"}
    assert windows.newest_metrics(store, n=100).count() == 14


# Users


def test_user_sketches(spark, store):
    rows = [event(f"e{i}", time=at(i % 240), msisdn=f"u{i % 700}", region=("North", "South")[i % 2 - 1]) for i in range(3000)]
    store.load("raw_events", frame(spark, *rows, event("n", time=at(1), region=None)), "x")
    windows.load_hourly_users(store, DAY)
    found = {r.region: (r.event_count, r.unique_users) for r in windows.region_users_estimate(store, DAY, DAY).collect()}
    exact = store.read("raw_events").groupBy("region").agg(F.count("*").alias("n"), F.count_distinct("msisdn").alias("u"))
    for r in exact.collect():
        assert found[r.region][0] == r.n and abs(found[r.region][1] - r.u) <= 0.03 * r.u
    every = windows.users_by(store.read("hourly_users")).first()
    assert every.event_count == 3001 and abs(every.unique_users - 701) <= 21


def test_users_of_a_stream(spark, store, inbox, folder):
    inbox.put(*[wire(f"e{i}", at(1), msisdn=f"u{i % 7}") for i in range(40)])
    inbox.put(wire("end", at(30)))
    inbox.put(wire("end2", at(31)))
    run(spark, inbox, store, folder + "/cp", "metrics_users")
    row = metrics_of_states(store.read("window_states")).first()
    assert (row.metric_type, row.region, row.count_events, row.unique_users) == ("region_users_5min", "Almaty", 40, 7)


# Alerts


def test_an_alert_comes_before_the_window_closes(spark, store, inbox, folder):
    limits = Limits(events_per_window=3)
    options = dict(limits=limits, burst_slide=None, early_alerts=True)
    inbox.put(*[wire(f"a{i}", at(0.1)) for i in range(3)], wire("x", at(0.1), msisdn="calm"))
    run(spark, inbox, store, folder + "/cp", "high_frequency", **options)
    assert store.read("anomalies").count() == 0
    inbox.put(wire("a3", at(0.2)))  # the watermark is far before the end of the window
    run(spark, inbox, store, folder + "/cp", "high_frequency", **options)
    found = store.read("anomalies").collect()
    assert [(r.msisdn, r.anomaly_reason) for r in found] == [("7701234****", "4 events in 5 minutes")]
    inbox.put(wire("a4", at(0.3)), wire("end", at(30)))
    inbox.put(wire("a5", at(31)))
    run(spark, inbox, store, folder + "/cp", "high_frequency", **options)
    run(spark, inbox, store, folder + "/new", "high_frequency", **options)
    assert [r.anomaly_reason for r in store.read("anomalies").collect()] == ["4 events in 5 minutes"]


# Storage


def test_undated_rows_expire_with_their_load(spark, store):
    for name, stored in (("old", "2024-01-01"), ("new", "2024-03-09")):
        rows = frame(spark, event(name, time=None), event(name + "2", time=at(0)))
        store.load("raw_events", rows.withColumn("created_at", F.lit(stored).cast("timestamp")), name)
    store.expire("raw_events", DAY, 30)
    assert ids(store.read("raw_events")) == ["new", "new2", "old2"]


def test_a_subscriber_is_read_from_few_row_groups(spark, store):
    rows = spark.range(40_000).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.concat(F.lit("77"), F.col("id") % 2000).alias("msisdn"),
        F.lit("call").alias("event_type"), F.lit(None).cast("string").alias("event_subtype"),
        F.col("id").cast("int").alias("duration_seconds"), F.lit(None).cast("decimal(18,2)").alias("data_mb"),
        F.lit(None).cast("decimal(18,2)").alias("amount"), F.lit("R").alias("region"), F.lit(1).alias("cell_tower_id"),
        (F.lit(at(0)).cast("timestamp") + F.make_dt_interval(secs=F.col("id") / 10)).alias("timestamp"),
    )
    for i in range(3):
        store.load("raw_events", rows.filter(F.col("id") % 3 == i).repartition(4), f"l{i}")

    def rows_read(name, value):
        """Rows that come out of the scan: those of the row groups that are not skipped."""
        found = store.read_days("raw_events", DAY, DAY).filter(F.col(name) == value)
        found.collect()
        node = found._jdf.queryExecution().executedPlan()
        while not node.nodeName().startswith("Scan"):
            node = node.children().head()
        return node.metrics().apply("numOutputRows").value()

    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "20000")
    try:
        before = rows_read("msisdn", "77123")
        assert store.compact("raw_events", DAY, by_subscriber=True)
        after = rows_read("msisdn", "77123")
        by_id = rows_read("event_id", "e777")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert before == 40_000 and after <= before / 4 and by_id <= before / 2
    assert store.read("raw_events").filter("msisdn = '77123'").count() == 20
