import datetime as dt
from collections import defaultdict

from ringtally.operators.metrics import conditional_metrics, event_type_metrics, regional_metrics
from tests.rows import at, event, frame


def test_nulls_count_as_zero_in_sums_but_not_in_averages(spark):
    rows = [event("a", duration_seconds=10), event("b"), event("c", duration_seconds=30)]
    got = event_type_metrics(frame(spark, *rows)).first()
    assert got.count_events == 3 and got.total_duration_seconds == 40
    assert got.avg_duration_seconds == 20.0
    assert got.total_data_gb == 0 and got.avg_data_mb is None and got.region is None


def test_window_bounds(spark):
    rows = [event("a", time=at(0)), event("b", time=at(4.999)), event("c", time=at(5)), event("d", time=None)]
    got = event_type_metrics(frame(spark, *rows)).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.count_events) for r in got] == [
        (at(0), at(5), 2), (at(5), at(10), 1),
    ]


def test_missing_region_is_its_own_group(spark):
    rows = [event("a", region=None), event("b", region=None, time=at(9)), event("c")]
    got = {r.region: r for r in regional_metrics(frame(spark, *rows)).collect()}
    assert got[None].count_events == 2 and got["Almaty"].count_events == 1
    assert got[None].metric_type == "regional_10min" and got[None].avg_duration_seconds is None


def test_conditional_measures(spark):
    rows = [
        event("a", event_subtype="incoming", data_mb=99, amount=99),
        event("b", event_subtype="outgoing"),
        event("c", event_subtype="outgoing"),
        event("d", kind="sms"),
        event("e", kind="data_session", data_mb=1024),
        event("f", kind="data_session"),
        event("g", kind="balance_recharge", amount=7.5),
    ]
    got = {r.event_type: r for r in conditional_metrics(frame(spark, *rows), call_counts=True).collect()}
    call, data = got["call"], got["data_session"]
    assert (call.incoming_calls, call.outgoing_calls, call.sms_count) == (1, 2, 0)
    assert call.total_data_gb == 0 and call.total_amount == 0
    assert data.total_data_gb == 1 and data.avg_data_mb == 512 and data.incoming_calls is None
    assert got["sms"].sms_count == 1 and got["balance_recharge"].total_amount == 7.5
    assert data.total_duration_seconds is None and data.avg_duration_seconds is None


def test_unvalidated_rows_form_a_group_of_nulls(spark):
    rows = [event("a", kind=None, region=None), event("b")]
    got = {r.event_type: r.count_events for r in conditional_metrics(frame(spark, *rows)).collect()}
    assert got == {None: 1, "call": 1}


def test_sliding_windows_against_brute_force(spark):
    rows = [
        event(f"e{i}", kind=("call", "sms")[i % 2], duration_seconds=i, time=at(i * 1.7)) for i in range(60)
    ]
    want = defaultdict(lambda: [0, 0])
    for row in rows:
        kind, seconds, time = row[2], row[4], row[9]
        for k in range(-20, 60):
            start = at(5 * k)
            if start <= time < start + dt.timedelta(minutes=15):
                want[start, kind][0] += 1
                want[start, kind][1] += seconds
    for size, slide in (("15 minutes", "5 minutes"),):
        got = event_type_metrics(frame(spark, *rows), size, slide).collect()
        assert {
            (r.window_start, r.event_type): [r.count_events, r.total_duration_seconds] for r in got
        } == dict(want)
        assert all(r.window_end - r.window_start == dt.timedelta(minutes=15) for r in got)


def test_slide_that_does_not_divide_the_size(spark):
    rows = [event(f"e{i}", time=at(i)) for i in range(20)]
    got = event_type_metrics(frame(spark, *rows), "7 minutes", "3 minutes").collect()
    # 7 is not a multiple of 3: each minute lies in two or three windows.
    assert sum(r.count_events for r in got) == sum(
        1 for i in range(20) for s in range(-9, 21, 1) if (at(s).minute + 60 * at(s).hour + 1440 * (at(s) - dt.datetime(1970, 1, 1)).days) % 3 == 0 and s <= i < s + 7
    )
