import datetime as dt
import json
import math
import hashlib

import pytest
from pyspark.sql import functions as F

from ringtally.functions.columns import WIRE_TIME_FORMAT, hour_weight, key_partition, mask_msisdn
from ringtally.operators import events as ev
from ringtally.operators.conform import conform
from tests.rows import at, event, frame

WIRE = {
    "event_id": "a1",
    "msisdn": "7771234****",
    "region": "Almaty",
    "cell_tower_id": 1523,
    "timestamp": "2025-11-09T10:30:15.123456Z",
    "event_type": "call",
    "event_subtype": "outgoing",
    "duration_seconds": 245,
    "data_mb": None,
    "amount": None,
}


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string").select(
        F.col("value").cast("binary").alias("value")
    )


def test_decode_reads_every_field(spark):
    row = ev.decode(messages(spark, json.dumps(WIRE))).first().asDict()
    assert row == WIRE


def test_decode_of_bad_input(spark):
    extra = {**WIRE, "event_id": "extra", "unknown_field": 1}
    missing = {"event_id": "missing"}
    wrong = {**WIRE, "event_id": "wrong", "duration_seconds": "long"}
    got = ev.decode(
        messages(spark, "not json", *(json.dumps(x) for x in (extra, missing, wrong)))
    ).collect()
    assert all(v is None for v in got[0])
    assert got[1].event_id == "extra" and got[1].duration_seconds == 245
    assert got[2].event_id == "missing" and got[2].msisdn is None
    assert got[3].event_id == "wrong" and got[3].duration_seconds is None and got[3].region == "Almaty"


def test_decode_keeps_broker_time(spark):
    sent = messages(spark, json.dumps(WIRE)).withColumn("timestamp", F.lit(at(0)))
    row = ev.decode(sent).first()
    assert row.kafka_timestamp == at(0) and row.timestamp == WIRE["timestamp"]


def test_text_is_parsed_once_per_message(spark):
    sent = messages(spark, json.dumps(WIRE))
    checked = ev.exact_amounts(ev.validate(ev.with_event_time(ev.decode(sent))))
    optimized = checked._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json") == 1


TIMES = [
    "2024-03-10T12:00:00Z",
    "2024-03-10T12:00:00.123Z",
    "2024-03-10T12:00:00.123456Z",
    "yesterday",
    None,
]


def timed(spark, **how):
    texts = spark.createDataFrame([(t,) for t in TIMES], "timestamp string")
    return [r.timestamp for r in ev.with_event_time(texts, **how).collect()]


def test_time_is_read_leniently(spark):
    base = dt.datetime(2024, 3, 10, 12)
    assert timed(spark) == [
        base, base.replace(microsecond=123000), base.replace(microsecond=123456), None, None,
    ]


def test_unreadable_time_policies(spark):
    assert len(timed(spark, unreadable="drop")) == 3
    now = timed(spark, unreadable="now")
    assert len(now) == 5 and now[3] is not None and now[3].year >= 2025
    with pytest.raises(ValueError):
        timed(spark, unreadable="maybe")


def test_strict_time_pattern(spark):
    """A pattern reads up to its number of fraction digits, and at least one."""
    micros = timed(spark, pattern=WIRE_TIME_FORMAT)
    assert [t is not None for t in micros] == [False, True, True, False, False]
    millis = timed(spark, pattern=WIRE_TIME_FORMAT.replace("SSSSSS", "SSS"))
    assert [t is not None for t in millis] == [False, True, False, False, False]


INVALID = {
    "no_msisdn": {"msisdn": None},
    "empty_msisdn": {"msisdn": ""},
    "unknown_type": {"kind": "fax"},
    "no_type": {"kind": None},
    "negative_duration": {"duration_seconds": -1},
    "negative_data": {"data_mb": -1},
    "negative_amount": {"amount": -1},
}


def test_validation(spark):
    good = [
        event("all_null"),
        event("zeros", duration_seconds=0, data_mb=0, amount=0),
        event("sms", kind="sms"),
    ]
    bad = [event(name, **values) for name, values in INVALID.items()]
    kept = ev.validate(frame(spark, *good, *bad)).collect()
    assert {r.event_id for r in kept} == {"all_null", "zeros", "sms"}


def test_quarantine_names_each_rule(spark):
    rows = [event(name, **values) for name, values in INVALID.items()]
    rows += [event("two", msisdn="", amount=-5), event("no_time", time=None), event(None)]
    rows += [event("huge", amount=10**8), event("largest", amount=99999999.99), event("fine")]
    good, refused = ev.split_by_rules(frame(spark, *rows))
    assert {r.event_id for r in good.collect()} == {"largest", "fine"}
    reasons = {r.event_id: r.broken_rules for r in refused.collect()}
    assert reasons["two"] == "msisdn_missing,amount_negative"
    assert reasons["no_time"] == "timestamp_missing"
    assert reasons["no_type"] == reasons["unknown_type"] == "event_type_unknown"
    assert reasons[None] == "event_id_missing"
    assert reasons["huge"] == "amount_out_of_range"
    counts = {r.rule: r.n_rows for r in ev.rule_counts(frame(spark, *rows)).collect()}
    assert counts["msisdn_missing"] == 3 and counts["amount_negative"] == 2
    assert counts["data_out_of_range"] == 0
    tolerated, _ = ev.split_by_rules(frame(spark, *rows), ("timestamp_missing",))
    assert "no_time" in {r.event_id for r in tolerated.collect()}


def test_amounts_no_decimal_can_hold(spark):
    values = [(1.005,), (math.nan,), (1e300,), (None,)]
    doubles = spark.createDataFrame(values, "data_mb double").withColumn("amount", F.col("data_mb"))
    got = [r.data_mb for r in ev.exact_amounts(doubles).collect()]
    assert str(got[0]) == "1.01" and got[1:] == [None, None, None]


def test_repeats_keep_the_earliest_copy(spark):
    rows = [event("a", time=at(5), region="late"), event("a", time=at(1), region="early")]
    rows += [event("b", time=at(2))] + [event("hot", time=at(i % 7)) for i in range(500)]
    got = ev.drop_repeats(frame(spark, *rows).repartition(4)).orderBy("event_id").collect()
    assert [(r.event_id, r.timestamp) for r in got] == [("a", at(1)), ("b", at(2)), ("hot", at(0))]
    assert got[0].region == "early"


def test_encode_and_decode_are_inverse(spark):
    original = frame(
        spark,
        event("a", duration_seconds=3, data_mb=1.5),
        event("b", kind="sms", region=None, time=at(0.01)),
    )
    sent = ev.encode(original)
    assert [r.key for r in sent.collect()] == ["7701234****"] * 2
    back = ev.exact_amounts(ev.with_event_time(ev.decode(sent)))
    assert back.collect() == original.collect()
    assert json.loads(sent.first().value)["amount"] is None


def test_mask(spark):
    got = frame(spark, event("a", msisdn="77012345678")).select(mask_msisdn(F.col("msisdn"))).first()
    assert got[0] == "7701234****"
    assert ev.mask_subscribers(frame(spark, event("a", msisdn="77012345678"))).first().msisdn == got[0]


def test_partition_of_a_key(spark):
    keys = [f"77{i:05d}****" for i in range(200)]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k", key_partition(F.col("k"), 8).alias("p")
    )
    assert all(r.p == int(hashlib.md5(r.k.encode()).hexdigest()[:8], 16) % 8 for r in got.collect())


def test_hour_weights(spark):
    hours = spark.range(24).select(
        F.col("id"), hour_weight(F.make_timestamp(*map(F.lit, (2024, 1, 1)), F.col("id").cast("int"), F.lit(59), F.lit(0))).alias("w")
    )
    got = {r.id: r.w for r in hours.collect()}
    assert [got[h] for h in (0, 6, 7, 8, 10, 11, 12, 14, 15, 17, 18, 22, 23)] == [
        0.3, 0.3, 1.0, 1.5, 1.5, 1.0, 1.3, 1.3, 1.0, 1.0, 2.0, 2.0, 1.0,
    ]


def test_conform_rounds_and_fills(spark):
    got = conform(frame(spark, event("a", data_mb=1.25)), "raw_events").first()
    assert str(got.data_mb) == "1.25" and got.created_at is not None
    metric = spark.sql("SELECT 1.00005D AS total_data_gb, 2.675D AS avg_data_mb")
    row = conform(metric, "real_time_metrics").first()
    assert str(row.total_data_gb) == "1.0001" and str(row.avg_data_mb) == "2.68" and row.region is None


def test_conform_refuses_what_does_not_fit(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        conform(frame(spark, event("a", amount=10**8)), "raw_events").collect()


def test_rows_without_id_are_no_copies(spark):
    rows = [event(None, duration_seconds=1), event(None, duration_seconds=2), event("a"), event("a")]
    assert ev.drop_repeats(frame(spark, *rows)).count() == 3


def test_removing_repeats_sorts_no_whole_table(spark, folder):
    """Also where the repeated ids are too many to send to every task."""
    rows = spark.range(4000).selectExpr("CAST(id % 3000 AS STRING) AS event_id", "id AS n")
    path = f"{folder}/events"
    rows.withColumn("timestamp", F.timestamp_seconds(F.col("n"))).write.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = ev.drop_repeats(spark.read.parquet(path))
        assert sorted(r.n for r in once.collect()) == list(range(3000))
        plan = once._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
