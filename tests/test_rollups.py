import datetime as dt
from decimal import Decimal

from ringtally.operators import rollups as ru
from ringtally.operators.conform import conform
from tests.rows import at, event, frame

DAY = dt.date(2024, 3, 10)


def test_daily_leaves_unmeasured_null(spark):
    rows = [
        event("a", duration_seconds=10),
        event("b", duration_seconds=25, time=at(120)),
        event("c"),
        event("d", kind="data_session", duration_seconds=99, data_mb=1.5),
        event("e", kind="sms"),
    ]
    got = {
        r.event_type: r
        for r in conform(ru.daily_stats(ru.hourly_partials(frame(spark, *rows))), "daily_stats").collect()
    }
    call, data, sms = got["call"], got["data_session"], got["sms"]
    assert (call.total_events, call.total_calls, call.total_sms) == (3, 3, 0)
    assert (call.total_call_duration, call.avg_call_duration, call.max_call_duration) == (35, Decimal("17.50"), 25)
    assert call.total_data_mb is None and call.total_revenue is None
    assert data.total_call_duration is None and data.avg_call_duration is None
    assert data.total_data_mb == Decimal("1.50") and data.total_data_sessions == 1
    assert sms.total_sms == 1 and sms.date == DAY


def test_hourly_counts_unmeasured_as_zero(spark):
    rows = [event("a", kind="sms", time=at(-0.001)), event("b", kind="sms", time=at(0))]
    got = ru.hourly_stats(ru.hourly_partials(frame(spark, *rows))).orderBy("hour_timestamp").collect()
    assert [r.hour_timestamp.hour for r in got] == [11, 12]
    assert got[0].total_duration == 0 and got[0].total_data_mb == 0 and got[0].avg_duration is None


def test_average_over_days_is_not_an_average_of_hours(spark):
    rows = [event(f"a{i}", duration_seconds=10) for i in range(9)]
    rows.append(event("b", duration_seconds=110, time=at(60)))
    got = ru.daily_stats(ru.hourly_partials(frame(spark, *rows))).first()
    assert got.avg_call_duration == 20.0


def test_exact_half_is_rounded_up(spark):
    rows = [event(f"a{i}", kind="data_session", data_mb=v) for i, v in enumerate((2.67, 2.68))]
    got = conform(ru.daily_stats(ru.hourly_partials(frame(spark, *rows))), "daily_stats").first()
    assert got.avg_data_mb == Decimal("2.68")


def test_days_are_cut_at_midnight(spark):
    rows = [event("a", time=at(-720)), event("b", time=at(719.99)), event("c", time=at(720)), event("d", time=None)]
    got = ru.between_days(frame(spark, *rows), DAY, DAY).collect()
    assert {r.event_id for r in got} == {"a", "b"}


def test_busiest_hour_is_the_earliest_of_equals(spark):
    rows = [event("a", time=at(60)), event("b", time=at(120)), event("c", time=at(180), msisdn="other")]
    rows += [event("d", region=None, time=at(0)), event("e", region=None, time=at(61)), event("f", region=None, time=at(62))]
    events = frame(spark, *rows)
    got = {
        r.region: r
        for r in conform(ru.daily_stats_extended(events, ru.hourly_partials(events)), "daily_stats_extended").collect()
    }
    assert got["Almaty"].peak_hour == 13 and got["Almaty"].unique_users == 2
    assert got[None].peak_hour == 13 and got[None].unique_users == 1


def test_extended_units(spark):
    rows = [event("a", duration_seconds=5400), event("b", duration_seconds=1800, msisdn="other")]
    rows += [event("c", kind="data_session", data_mb=1048576, duration_seconds=36)]
    events = frame(spark, *rows)
    got = {
        r.event_type: r
        for r in conform(ru.daily_stats_extended(events, ru.hourly_partials(events)), "daily_stats_extended").collect()
    }
    assert got["call"].total_duration_hours == Decimal("2.00")
    assert got["call"].avg_call_duration_minutes == Decimal("60.00")
    assert got["data_session"].total_data_tb == Decimal("1.000000")
    assert got["data_session"].total_duration_hours == Decimal("0.01")
    assert got["data_session"].avg_data_per_user_mb == Decimal("1048576.00")
    assert got["data_session"].avg_call_duration_minutes is None
