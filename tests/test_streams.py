import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ringtally.operators import events as ev
from ringtally.operators.anomalies import find_anomalies, frequent_subscribers
from ringtally.operators.metrics import conditional_metrics, event_type_metrics
from ringtally.plans.windows import stored_metrics
from ringtally.schema import Limits
from ringtally.sources.messages import text_messages
from ringtally.sources.sample import wire_events
from ringtally.sources.store import Store
from ringtally.streaming.jobs import await_all, decoded_events, drain, start, start_streams
from ringtally.streaming.runlog import StreamTotals, log_stream
from ringtally.streaming.sinks import jdbc_sink
from tests.rows import at, event, frame

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder + "/store").create()


def wire(event_id, time, kind="call", **values):
    row = {
        "event_id": event_id, "msisdn": "7701234****", "event_type": kind, "event_subtype": None,
        "duration_seconds": None, "data_mb": None, "amount": None, "region": "Almaty",
        "cell_tower_id": 1000, "timestamp": time.isoformat() + "Z" if time else None, **values,
    }
    return json.dumps(row)


class Inbox:
    """A folder of message files that are picked up in the order they were written."""

    def __init__(self, folder):
        from pathlib import Path

        self.path = Path(folder) / "inbox"
        self.path.mkdir()
        self.n = 0

    def put(self, *lines):
        import os

        file = self.path / f"{self.n:04d}.txt"
        hidden = self.path / f".{self.n:04d}.tmp"
        hidden.write_text("\n".join(lines) + "\n")
        os.utime(hidden, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        hidden.rename(file)
        self.n += 1

    def stream(self, spark):
        return decoded_events(text_messages(spark, str(self.path), max_files=1))


@pytest.fixture
def inbox(folder):
    return Inbox(folder)


def ids(frame):
    return sorted(r.event_id for r in frame.collect())


def test_streams_and_batch_give_the_same_tables(spark, store, inbox, folder):
    # 30 days of events squeezed into under four hours, so that windows hold several events.
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    start_of_all = 1_704_067_200_000_000  # 2024-01-01
    squeezed = F.timestamp_micros(F.floor((micros - start_of_all) / 200) + start_of_all)
    sent = wire_events(spark, FOLDER).withColumn("timestamp", squeezed)
    messages = [r.value for r in ev.encode(sent).orderBy("timestamp").select("value").collect()]
    for i in range(0, len(messages), 400):
        inbox.put(*messages[i : i + 400])
    stream = inbox.stream(spark)
    names = ("archive", "metrics_5min", "metrics_10min", "metrics_conditional", "metrics_cumulative")
    await_all(start_streams(stream, store, folder + "/cp", names, continuous=False))

    valid = ev.drop_repeats(ev.validate(sent)).cache()
    assert ids(store.read("raw_events")) == ids(valid)
    assert ids(store.read("anomalies")) == ids(find_anomalies(valid))
    assert store.read("quarantined_events").count() == sent.count() - ev.validate(sent).count()
    got = stored_metrics(store).groupBy("metric_type").agg(F.sum("count_events").alias("n"))
    counts = {r.metric_type: r.n for r in got.collect()}
    total, last = valid.count(), valid.agg(F.max("timestamp")).first()[0]
    assert counts["batch_metrics"] == ev.validate(sent).count()  # no state may come before it
    for tag, minutes in (("event_type_5min", 5), ("regional_10min", 10), ("5min", 5)):
        # Every window that ended before the watermark is there, whole, and no other.
        closed = valid.filter(
            F.window("timestamp", f"{minutes} minutes")["end"] <= F.lit(last) - F.expr("INTERVAL 1 MINUTE")
        ).count()
        assert counts[tag] == closed < total
    valid.unpersist()


def test_restart_continues_without_repeats(spark, store, inbox, folder):
    names = ("archive", "metrics_5min")
    inbox.put(wire("a", at(0), duration_seconds=20000), wire("b", at(1)))
    await_all(start_streams(inbox.stream(spark), store, folder + "/cp", names, continuous=False))
    assert ids(store.read("raw_events")) == ["a", "b"]
    assert stored_metrics(store).count() == 0  # the window is still open
    for _ in range(2):
        await_all(start_streams(inbox.stream(spark), store, folder + "/cp", names, continuous=False))
    inbox.put(wire("c", at(7)))
    await_all(start_streams(inbox.stream(spark), store, folder + "/cp", names, continuous=False))
    assert ids(store.read("raw_events")) == ["a", "b", "c"]
    loads = {r.load_id.rpartition("-") for r in store.read("raw_events").collect()}
    assert {batch for _, _, batch in loads} == {"0", "1"}
    assert len({query for query, _, _ in loads}) == 1 and "None" not in str(loads)
    assert ids(store.read("anomalies")) == ["a"]
    assert [r.count_events for r in stored_metrics(store).collect()] == [2]


def test_a_batch_tried_again_is_not_doubled(spark, store, inbox, folder):
    """The sink fails after writing; the restart repeats the batch."""
    from ringtally.streaming.sinks import table_sink

    inbox.put(wire("a", at(0)), wire("b", at(1)))
    write = table_sink(store, "raw_events")
    failures = []

    def fails_once(batch, batch_id):
        write(batch, batch_id)
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after the write")

    def attempt():
        frame = ev.exact_amounts(ev.validate(inbox.stream(spark)))
        await_all([start(frame, fails_once, "retry", folder + "/cp")])

    with pytest.raises(Exception, match="lost after the write"):
        attempt()
    attempt()
    assert failures == [0] and ids(store.read("raw_events")) == ["a", "b"]


def test_late_rows(spark, inbox):
    """A row for a closed window is dropped; an older row for an open window is kept. The
    watermark of a batch closes windows in the next and drops rows from the one after."""
    inbox.put(wire("a", at(1)), wire("b", at(8)))  # watermark 12:07
    inbox.put(wire("c", at(8)))
    inbox.put(wire("late", at(2)), wire("kept", at(5.5)))
    inbox.put(wire("end", at(30)))
    got = drain(spark, event_type_metrics(ev.exact_amounts(inbox.stream(spark))))
    assert {r.window_start: r.count_events for r in got.collect()} == {at(0): 1, at(5): 3}


def test_sliding_stream(spark, inbox):
    inbox.put(wire("a", at(1)), wire("b", at(6)))
    inbox.put(wire("end", at(60)))
    got = drain(spark, event_type_metrics(ev.exact_amounts(inbox.stream(spark)), "10 minutes", "5 minutes"))
    assert {r.window_start: r.count_events for r in got.collect()} == {at(-5): 1, at(0): 2, at(5): 1}


@pytest.mark.parametrize("spread", [1, 16])
def test_repeats_across_batches_then_windows(spark, inbox, spread):
    inbox.put(*[wire("a", at(0))] * 200, wire("b", at(0.2)))
    inbox.put(*[wire("a", at(0.1))] * 50, wire("c", at(0.5)))
    inbox.put(wire("end", at(30)))
    once = ev.drop_repeats(ev.exact_amounts(inbox.stream(spark)), spread=spread)
    got = drain(spark, event_type_metrics(once, watermark=None))
    assert {r.window_start: r.count_events for r in got.collect()} == {at(0): 3}


def test_frequent_subscribers_stream(spark, inbox):
    inbox.put(*[wire(f"e{i}", at(i / 100)) for i in range(4)], wire("x", at(0), msisdn="calm"))
    inbox.put(wire("end", at(30)))
    got = drain(spark, frequent_subscribers(inbox.stream(spark), Limits(events_per_window=3)))
    assert [(r.msisdn, r.count_events) for r in got.collect()] == [("7701234****", 4)]


def test_rows_without_time_or_sense(spark, store, inbox, folder):
    inbox.put("not json", wire("no_time", None, duration_seconds=20000), wire("bad", at(0), kind="fax"))
    await_all(start_streams(inbox.stream(spark), store, folder + "/cp", ("archive",), continuous=False))
    assert ids(store.read("raw_events")) == ["no_time"] == ids(store.read("anomalies"))
    reasons = {r.event_id: r.broken_rules for r in store.read("quarantined_events").collect()}
    assert reasons["bad"] == "event_type_unknown" and "event_id_missing" in reasons[None]


def test_unvalidated_metrics_count_malformed_rows(spark, folder, inbox):
    inbox.put("not json", wire("a", at(0)))
    lenient = decoded_events(text_messages(spark, str(inbox.path)), unreadable_time="now")
    counted = conditional_metrics(ev.exact_amounts(lenient))
    got = drain(spark, counted)
    assert {r.event_type for r in got.collect()} == {"call"}  # the present window is still open


def test_failure_of_one_stream_stops_all(spark, store, inbox, folder):
    inbox.put(wire("a", at(0)))

    def broken(batch, batch_id):
        raise RuntimeError("sink is gone")

    good = start_streams(inbox.stream(spark), store, folder + "/cp", ("archive",))
    bad = start(ev.validate(inbox.stream(spark)), broken, "broken", folder + "/cp")
    with pytest.raises(Exception, match="sink is gone"):
        await_all([*good, bad])
    assert not any(q.isActive for q in [*good, bad])
    log_stream(store, bad)
    row = store.read("pipeline_monitoring").first()
    assert (row.pipeline_name, row.pipeline_type, row.status) == ("broken", "streaming", "failed")
    assert "sink is gone" in row.error_message


def test_run_log_of_a_finished_stream(spark, store, inbox, folder):
    inbox.put(wire("a", at(0)), wire("b", at(0)))
    queries = start_streams(inbox.stream(spark), store, folder + "/cp", ("archive",), continuous=False)
    await_all(queries)
    log_stream(store, queries[0])
    row = store.read("pipeline_monitoring").first()
    assert (row.status, row.records_processed, row.error_message) == ("completed", 2, None)
    assert row.started_at.year >= 2025 and row.completed_at >= row.started_at


def test_run_log_knows_batches_spark_has_forgotten(spark, store, inbox, folder):
    totals = StreamTotals()
    spark.streams.addListener(totals)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            inbox.put(wire(f"a{i}", at(i)), wire(f"b{i}", at(i), kind="fax"), "not json")
        queries = start_streams(inbox.stream(spark), store, folder + "/cp", ("archive",), continuous=False)
        await_all(queries)
        assert len(queries[0].recentProgress) <= 2
        log_stream(store, queries[0], totals)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(totals)
    row = store.read("pipeline_monitoring").first()
    assert (row.status, row.records_processed, row.records_failed) == ("completed", 15, 10)
    assert store.read("quarantined_events").count() == 10


def test_refused_messages_keep_their_text(spark, store, inbox, folder):
    sent = {
        "cut": wire("cut", at(0))[:40],
        "type": wire("type", at(0), duration_seconds="12 s", extra="more"),
        "time": wire("time", None, extra=1).replace('"timestamp": null', '"timestamp": "soon"'),
        "fax": wire("fax", at(0), kind="fax", extra=[1, 2]),
        "": "",
    }
    inbox.put(*sent.values(), wire("good", at(0), extra="ignored"), wire("no_time", None))
    names = ("archive", "metrics_5min")
    await_all(start_streams(inbox.stream(spark), store, folder + "/cp", names, continuous=False))
    assert ids(store.read("raw_events")) == ["good", "no_time"]
    refused = {r.event_data: r.broken_rules for r in store.read("quarantined_events").collect()}
    assert set(refused) == set(sent.values())
    assert refused[sent["type"]] == "field_unreadable"
    assert refused[sent["time"]] == "timestamp_missing,field_unreadable"
    assert refused[sent["fax"]] == "event_type_unknown"
    assert refused[sent["cut"]].endswith("field_unreadable")


def test_a_burst_over_a_window_border_becomes_an_anomaly(spark, store, inbox, folder):
    inbox.put(*[wire(f"e{i}", at(4.5 + i / 100)) for i in range(3)])
    inbox.put(*[wire(f"f{i}", at(5.1 + i / 100)) for i in range(3)], wire("x", at(5), msisdn="calm"))
    inbox.put(wire("end", at(60)))
    limits = Limits(events_per_window=5)
    for _ in range(2):
        stream = inbox.stream(spark)
        await_all(
            start_streams(stream, store, folder + "/cp", ("high_frequency",), limits, continuous=False)
        )
    found = store.read("anomalies").collect()
    assert sorted(r.event_id[-27:-11] for r in found) == [f"2024-03-10T12:0{m}" for m in (1, 2, 3, 4)]
    assert {(r.msisdn, r.anomaly_type, r.anomaly_reason, r.severity) for r in found} == {
        ("7701234****", "high_frequency", "6 events in 5 minutes", "high")
    }
    assert frequent_subscribers(ev.exact_amounts(stored(spark, inbox)), limits).count() == 0
    batch = frequent_subscribers(ev.exact_amounts(stored(spark, inbox)), limits, slide="1 minute")
    odd = frequent_subscribers(stored(spark, inbox), limits, slide="90 seconds")
    assert batch.count() == 4 and odd.count() > 0


def stored(spark, inbox):
    return decoded_events(spark.read.text(str(inbox.path)))


def test_metrics_can_go_elsewhere(spark, store, inbox, folder):
    seen = []
    inbox.put(wire("a", at(0)), wire("end", at(30)))
    inbox.put(wire("later", at(31)))
    queries = start_streams(
        inbox.stream(spark), store, folder + "/cp", ("metrics_5min",), continuous=False,
        metrics_sink=lambda batch, batch_id: seen.extend(r.count_events for r in batch.collect()),
    )
    await_all(queries)
    assert seen == [1] and stored_metrics(store).count() == 0


def test_database_sink_skips_empty_batches(spark, inbox, folder, monkeypatch):
    """No database here: the write itself is replaced."""
    from ringtally.sources import jdbc

    written = []
    monkeypatch.setattr(jdbc, "append", lambda df, options, mode: written.append((ids(df), mode)))
    inbox.put(wire("a", at(0), kind="fax"))
    inbox.put(wire("b", at(0)))
    frame = ev.validate(inbox.stream(spark))
    await_all([start(frame, jdbc_sink({"dbtable": "raw_events"}), "db", folder + "/cp")])
    assert written == [(["b"], "append")]


def test_processing_time_is_used_for_unreadable_times(spark, inbox):
    inbox.put(wire("a", None))
    lenient = decoded_events(text_messages(spark, str(inbox.path)), unreadable_time="now")
    row = drain(spark, lenient).first()
    assert abs(row.timestamp - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(hours=24)


def test_one_huge_event_does_not_stop_the_metrics(spark, store, inbox, folder):
    """It is refused by the table and reported; the others of its batch are counted."""
    names = ("archive", "metrics_5min")
    inbox.put(wire("a", at(0)), wire("huge", at(1), kind="data_session", data_mb=2e17))
    inbox.put(wire("end", at(30)))
    for _ in range(2):
        await_all(start_streams(inbox.stream(spark), store, folder + "/cp", names, continuous=False))
    assert ids(store.read("raw_events")) == ["a", "end"]
    assert ids(store.read("quarantined_events")) == ["huge"] == ids(store.read("anomalies"))
    assert [r.count_events for r in stored_metrics(store).collect()] == [1]


def test_windows_of_two_sizes_share_a_table(spark, store):
    rows = [event("a", time=at(0)), event("b", time=at(20))]
    for size in ("5 minutes", "1 hour"):
        store.load("real_time_metrics", event_type_metrics(frame(spark, *rows), size), layout="repartition")
    assert sorted(r.count_events for r in store.read("real_time_metrics").collect()) == [1, 1, 2]


def test_a_batch_tried_after_midnight_keeps_its_detection_time(spark, store):
    from ringtally.streaming.sinks import SEEN_AT, archive_sink

    seen = F.lit("2024-03-10 23:59:59").cast("timestamp").alias(SEEN_AT)
    batch = frame(spark, event("a", duration_seconds=20000)).select("*", seen)
    for _ in range(2):
        archive_sink(store)(batch, 7)
    assert [str(r.detected_date) for r in store.read("anomalies").collect()] == ["2024-03-10"]
