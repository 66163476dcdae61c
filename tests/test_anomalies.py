import json

from pyspark.sql import functions as F

from ringtally.operators.anomalies import anomaly_rate, find_anomalies, frequent_subscribers
from ringtally.operators.events import rule_counts, split_by_rules
from ringtally.operators.metrics import cumulative_metrics
from ringtally.schema import Limits
from tests.rows import at, event, frame


def test_limits_are_exclusive_and_bound_to_the_kind(spark):
    rows = [
        event("call_at", duration_seconds=14400),
        event("call_over", duration_seconds=14401),
        event("call_data", data_mb=9000),
        event("data_at", kind="data_session", data_mb=5000),
        event("data_over", kind="data_session", data_mb=5000.01),
        event("data_long", kind="data_session", duration_seconds=99999),
        event("recharge_at", kind="balance_recharge", amount=50000),
        event("recharge_over", kind="balance_recharge", amount=50000.01),
        event("sms_over", kind="sms", amount=60000, duration_seconds=20000),
    ]
    got = {r.event_id: r for r in find_anomalies(frame(spark, *rows)).collect()}
    assert set(got) == {"call_over", "data_over", "recharge_over"}
    assert got["call_over"].anomaly_reason == "Call duration: 14401 seconds"
    assert got["data_over"].anomaly_reason == "Data usage: 5000.01 MB"
    assert got["recharge_over"].anomaly_reason == "Recharge amount: 50000.01 tenge"
    assert {r.severity for r in got.values()} == {"high"}
    assert [r.anomaly_type for r in (got["call_over"], got["data_over"], got["recharge_over"])] == [
        "excessive_call_duration", "excessive_data_usage", "excessive_recharge",
    ]


def test_label_goes_by_duration_first(spark):
    row = find_anomalies(
        frame(spark, event("x", kind="data_session", duration_seconds=14401, data_mb=5001))
    ).first()
    assert row.anomaly_type == "excessive_call_duration"


def test_other_limits_and_event_copy(spark):
    rows = frame(spark, event("x", duration_seconds=61, time=at(1)))
    got = find_anomalies(rows, Limits(call_seconds=60), F.col("timestamp"), with_event=True).first()
    assert got.detected_at == at(1)
    copy = json.loads(got.event_data)
    assert copy["duration_seconds"] == 61 and copy["timestamp"] == "2024-03-10T12:01:00.000000Z"
    assert "amount" not in copy


def test_frequent_subscribers_over_the_limit(spark):
    def burst(who, n, start):
        return [event(f"{who}{i}", msisdn=who, time=at(start + i / 100)) for i in range(n)]

    rows = burst("busy", 101, 0) + burst("edge", 100, 0)
    rows += burst("split", 60, 0) + burst("split", 60, 5)  # 120 in all, but in two windows
    got = frequent_subscribers(frame(spark, *rows)).collect()
    assert [(r.msisdn, r.count_events, r.window_start, r.window_end) for r in got] == [
        ("busy", 101, at(0), at(5))
    ]


def test_rate_of_an_empty_table(spark):
    none = frame(spark)
    assert anomaly_rate(none, find_anomalies(none)).first()[0] is None
    some = frame(spark, event("x", duration_seconds=20000), event("y"), event("z"))
    assert abs(anomaly_rate(some, find_anomalies(some)).first()[0] - 100 / 3) < 1e-9


def test_cumulative_is_stamped_now(spark):
    row = cumulative_metrics(frame(spark, event("x", duration_seconds=10))).first()
    assert row.window_start == row.window_end and row.metric_type == "batch_metrics"
    assert row.total_duration_seconds == 10 and row.avg_data_mb is None


def test_table_refuses_unknown_severity_and_status(spark):
    found = find_anomalies(frame(spark, *[event(f"x{i}", duration_seconds=20000) for i in range(4)]))
    graded = found.withColumn(
        "severity", F.element_at(F.array(*map(F.lit, ("low", "critical", "grave", None))), F.substring("event_id", 2, 1).cast("int") + 1)
    )
    good, refused = split_by_rules(graded, table="anomalies")
    assert sorted(r.event_id for r in good.collect()) == ["x0", "x1"]
    assert {r.broken_rules for r in refused.collect()} == {"severity_unknown"}
    counts = {r.rule: r.n_rows for r in rule_counts(graded, "anomalies").collect()}
    assert counts["severity_unknown"] == 2 and counts["anomaly_type_missing"] == 0
    runs = spark.sql("SELECT explode(array('running', 'done', NULL)) AS status")
    assert rule_counts(runs, "pipeline_monitoring").first().n_rows == 2
