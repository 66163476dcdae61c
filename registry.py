"""Every operator as a query over the test tables.

Results are shown in plain types, so that two engines can be compared value by value:
decimals, and whole numbers that may be NULL, as doubles; dates as text; timestamps without
zone.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringtally.functions.columns import WIRE_TIME_FORMAT, mask_msisdn, wire_time
from ringtally.operators import anomalies as an
from ringtally.operators import events as ev
from ringtally.operators import metrics as mt
from ringtally.operators import rollups as ru
from ringtally.operators.conform import conform
from ringtally.plans import quality, reports, windows
from ringtally.schema import Limits
from ringtally.session import prepare, scratch_path
from ringtally.sources.sample import usage_events, usage_stream, wire_events, with_faults
from ringtally.sources.store import Store
from ringtally.streaming.jobs import await_all, decoded_events, drain, start_streams


NULLABLE_NUMBERS = (
    "duration_seconds",
    "total_duration_seconds",
    "total_call_duration",
    "max_call_duration",
    "incoming_calls",
    "outgoing_calls",
)


def plain(frame: DataFrame, *without: str) -> DataFrame:
    def shown(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType) or field.name in NULLABLE_NUMBERS:
            return f"CAST({name} AS DOUBLE) AS {name}"
        if isinstance(field.dataType, T.DateType):
            return f"CAST({name} AS STRING) AS {name}"
        if isinstance(field.dataType, T.TimestampType):
            return f"CAST({name} AS TIMESTAMP_NTZ) AS {name}"
        return name

    return frame.selectExpr(*[shown(f) for f in frame.schema.fields if f.name not in without])


def table_rows(frame: DataFrame, table: str) -> DataFrame:
    """In the types of the stored table; the load time differs from run to run."""
    return plain(conform(frame, table), "created_at")


class Derived:
    """The five tables, each derived from the events when a report asks for it. Time of
    detection is event time here, so that results do not depend on the clock."""

    def __init__(self, spark: SparkSession, folder: str):
        self.raw_events = usage_events(spark, folder)

    @cached_property
    def anomalies(self) -> DataFrame:
        return an.find_anomalies(self.raw_events, detected_at=F.col("timestamp"))

    @cached_property
    def daily_stats(self) -> DataFrame:
        return conform(ru.daily_stats(ru.hourly_partials(self.raw_events)), "daily_stats")

    @cached_property
    def hourly_stats(self) -> DataFrame:
        return conform(ru.hourly_stats(ru.hourly_partials(self.raw_events)), "hourly_stats")

    @cached_property
    def real_time_metrics(self) -> DataFrame:
        return conform(mt.conditional_metrics(self.raw_events), "real_time_metrics")


def _metrics(build):
    return lambda spark, folder: table_rows(build(usage_events(spark, folder)), "real_time_metrics")


def _report(build):
    return lambda spark, folder: plain(build(Derived(spark, folder)))


def conditional(spark, folder):
    metrics = mt.conditional_metrics(usage_events(spark, folder), call_counts=True)
    counts = ("incoming_calls", "outgoing_calls", "sms_count")
    columns = conform(metrics, "real_time_metrics").columns
    typed = metrics.withColumns(
        {"total_data_gb": F.col("total_data_gb").cast("decimal(15,4)"),
         "avg_data_mb": F.col("avg_data_mb").cast("decimal(10,2)")}
    )
    return plain(typed.select(*[c for c in columns if c != "created_at"], *counts), "avg_duration_seconds")


def cumulative(spark, folder):
    events = usage_events(spark, folder)
    rows = mt.cumulative_metrics(events, as_of=reports.moment(events))
    return table_rows(rows, "real_time_metrics")


def sliding(events):
    return mt.event_type_metrics(events, "10 minutes", "5 minutes", tag="event_type_10min_slide")


def hourly_windows(events):
    return mt.regional_metrics(events, "1 hour", tag="regional_1hour")


def validate(spark, folder):
    return plain(ev.validate(wire_events(spark, folder)))


def quarantine(spark, folder):
    _, refused = ev.split_by_rules(wire_events(spark, folder))
    return plain(refused.select("event_id", "broken_rules"))


def quarantine_counts(spark, folder):
    return ev.rule_counts(wire_events(spark, folder))


def quarantine_payload(spark, folder):
    """Messages cut off, with a field of the wrong type or with an unreadable time: refused
    with the text that came."""
    k, text = F.col("event_id").cast("long"), ev.event_json()
    value = (
        F.when(k % 71 == 0, F.substring(text, 1, 40))
        .when(k % 67 == 0, F.regexp_replace(text, '"cell_tower_id":[0-9]+', '"cell_tower_id":"north"'))
        .when(k % 61 == 0, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .otherwise(text)
    )
    events = decoded_events(wire_events(spark, folder).select(value.alias("value")))
    _, refused = ev.split_by_rules(events)
    return refused.select("event_id", "broken_rules", ev.original_text(refused).alias("event_data"))


def _time_texts(spark, folder):
    """Events with their time as text: some without fraction, some unreadable."""
    k, time = F.col("event_id").cast("long"), F.col("timestamp")
    text = (
        F.when(k % 11 == 0, F.lit("soon"))
        .when(k % 7 == 0, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(wire_time(time))
    )
    return usage_events(spark, folder).select("event_id", text.alias("timestamp"))


def strict_times(spark, folder):
    return plain(ev.with_event_time(_time_texts(spark, folder), pattern=WIRE_TIME_FORMAT))


def fallback_times(spark, folder):
    moment = F.lit("2030-01-01 00:00:00").cast("timestamp")
    return plain(ev.with_event_time(_time_texts(spark, folder), "now", fallback=moment))


def dedup_events(spark, folder):
    return plain(ev.drop_repeats(ev.validate(wire_events(spark, folder))))


def anomalies(spark, folder):
    return plain(an.find_anomalies(usage_events(spark, folder), detected_at=F.col("timestamp")))


def event_copy_json(spark, folder):
    found = an.find_anomalies(usage_events(spark, folder), with_event=True)
    return found.select("event_id", "event_data")


def high_frequency(spark, folder):
    """The test data has no busy subscribers, so the threshold is one event."""
    return plain(an.frequent_subscribers(usage_events(spark, folder), Limits(events_per_window=1)))


def high_frequency_sliding(spark, folder):
    """Windows of 5 minutes sliding by one, as rows of the anomalies table."""
    limits = Limits(events_per_window=1)
    busy = an.frequent_subscribers(usage_events(spark, folder), limits, slide="1 minute")
    return plain(an.frequency_anomalies(busy, limits, F.col("window_end")))


def anomaly_rate(spark, folder):
    tables = Derived(spark, folder)
    rate = an.anomaly_rate(tables.raw_events, tables.anomalies)
    return rate.select(F.round("anomaly_rate_percent", 6).alias("anomaly_rate_percent"))


def anomaly_summary(spark, folder):
    """Over 30 days, with severities that vary by event, one in four of them NULL."""
    tables = Derived(spark, folder)
    grade = F.get(F.array(F.lit("high"), F.lit("medium"), F.lit("low"), F.lit(None)),
                  (F.col("event_id").cast("long") % 4).cast("int"))
    tables.anomalies = tables.anomalies.withColumn("severity", grade)
    return plain(reports.anomaly_summary(tables, back="30 days"))


def daily_stats(spark, folder):
    return plain(Derived(spark, folder).daily_stats, "created_at")


def hourly_stats(spark, folder):
    return plain(Derived(spark, folder).hourly_stats, "created_at")


def daily_stats_extended(spark, folder):
    events = usage_events(spark, folder)
    rows = ru.daily_stats_extended(events, ru.hourly_partials(events))
    return table_rows(rows, "daily_stats_extended")


def conform_raw_events(spark, folder):
    return table_rows(ev.validate(wire_events(spark, folder)), "raw_events")


def keyed_json(spark, folder):
    return ev.encode(usage_events(spark, folder))


def decoded_json(spark, folder):
    """Publish, decode, parse and validate: the way of every message."""
    messages = ev.encode(wire_events(spark, folder))
    events = ev.with_event_time(ev.decode(messages))
    return plain(ev.exact_amounts(ev.validate(events)))


def masked_users(spark, folder):
    """Numbers from the user id, as they are before masking; events by masked number."""
    events = prepare(spark).read.parquet(f"{folder}/events.parquet")
    number = F.concat(F.lit("7"), F.lpad((F.col("user_id") * 7919).cast("string"), 10, "0"))
    return events.groupBy(mask_msisdn(number).alias("msisdn")).agg(F.count(F.lit(1)).alias("n_events"))


def subscriber_partitions(spark, folder):
    """Messages in each of 8 partitions keyed by subscriber."""
    numbered = ev.by_subscriber(usage_events(spark, folder), 8)
    return numbered.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("msisdn").alias("n_subscribers")
    )


def quality_gate(spark, folder):
    """As if each event had been loaded two days after it happened."""
    tables = Derived(spark, folder)
    loaded = (F.col("timestamp") + F.expr("INTERVAL 2 DAYS")).alias("created_at")
    tables.raw_events = tables.raw_events.select("*", loaded)
    return quality.quality_gate(tables)


def _stream(build, mode="append", table=None):
    def query(spark, folder):
        result = drain(spark, build(usage_stream(spark, folder)), mode)
        return table_rows(result, table) if table else plain(result)

    return query


def stream_cumulative(spark, folder):
    """Without the time of computation."""
    rows = drain(spark, mt.cumulative_metrics(usage_stream(spark, folder)), "complete")
    return table_rows(rows, "real_time_metrics").drop("window_start", "window_end")


def _archived(spark, folder, *metrics) -> Store:
    """Everything on the wire, delivered twice: the second time to a new checkpoint."""
    at = scratch_path(spark, "store")
    store = Store(spark, f"{at}/tables").create()
    for name in ("first", "again"):
        stream = with_faults(usage_stream(spark, folder))
        names = ("archive", *metrics)
        await_all(start_streams(stream, store, f"{at}/{name}", names, continuous=False, from_archive=True))
    return store


def stored_once(spark, folder):
    return table_rows(_archived(spark, folder).read("raw_events"), "raw_events")


def archive_windows(spark, folder):
    store = _archived(spark, folder, "metrics_5min", "metrics_10min")
    return table_rows(windows.stored_metrics(store), "real_time_metrics")


def stored_totals(spark, folder):
    """Without the time of computation."""
    rows = windows.totals_so_far(_archived(spark, folder))
    return table_rows(rows, "real_time_metrics").drop("window_start", "window_end")


def two_checkpoints(spark, folder):
    """Windows that two queries have counted in part."""
    at = scratch_path(spark, "store")
    store = Store(spark, f"{at}/tables").create()
    for half in (0, 1):
        stream = usage_stream(spark, folder).filter(F.col("event_id").cast("long") % 2 == half)
        await_all(start_streams(stream, store, f"{at}/{half}", ("metrics_5min",), continuous=False))
    return table_rows(windows.stored_metrics(store), "real_time_metrics")


def early_alerts(spark, folder):
    """Subscribers with more than one event in 5 minutes, open windows included, sent twice."""
    at = scratch_path(spark, "store")
    store = Store(spark, f"{at}/tables").create()
    options = dict(limits=Limits(events_per_window=1), burst_slide=None, early_alerts=True, continuous=False)
    for name in ("first", "again"):
        stream = usage_stream(spark, folder)
        await_all(start_streams(stream, store, f"{at}/{name}", ("high_frequency",), **options))
    return store.read("anomalies").select("event_id", "msisdn", "anomaly_type", "anomaly_reason", "severity")


def region_users_sketch(spark, folder):
    """Users by region from hourly sketches, and whether they are within 5 percent."""
    events = usage_events(spark, folder)
    exact = events.groupBy("region").agg(F.count_distinct("msisdn").alias("exact"))
    found = windows.users_by(windows.hourly_users(events), "region")
    off = F.abs(F.col("unique_users") - F.col("exact"))
    same = found["region"].eqNullSafe(exact["region"])
    return found.join(exact, same).select(
        found["region"], "event_count", (off <= F.col("exact") * 0.05).alias("close")
    )


REGISTERED = {
    # window metrics
    "metrics_5min": _metrics(mt.event_type_metrics),
    "metrics_10min_region": _metrics(mt.regional_metrics),
    "metrics_5min_conditional": conditional,
    "metrics_sliding": _metrics(sliding),
    "metrics_1hour_region": _metrics(hourly_windows),
    "cumulative_type_region": cumulative,
    # events
    "validate": validate,
    "quarantine": quarantine,
    "quarantine_counts": quarantine_counts,
    "quarantine_payload": quarantine_payload,
    "strict_times": strict_times,
    "fallback_times": fallback_times,
    "dedup_events": dedup_events,
    "conform_raw_events": conform_raw_events,
    "keyed_json": keyed_json,
    "decoded_json": decoded_json,
    "masked_users": masked_users,
    "subscriber_partitions": subscriber_partitions,
    # anomalies
    "anomalies": anomalies,
    "event_copy_json": event_copy_json,
    "anomaly_high_frequency": high_frequency,
    "anomaly_high_frequency_sliding": high_frequency_sliding,
    "anomaly_rate": anomaly_rate,
    # rollups
    "daily_stats": daily_stats,
    "hourly_stats": hourly_stats,
    "daily_stats_extended": daily_stats_extended,
    # reports
    "recent_counts": _report(reports.recent_counts),
    "recent_total": _report(reports.recent_total),
    "region_users": _report(reports.region_users),
    "anomaly_summary": anomaly_summary,
    "daily_summary_7d": _report(reports.daily_summary),
    "table_counts": _report(reports.table_counts),
    "stream_table_counts": _report(reports.stream_table_counts),
    "peak_hours": _report(reports.peak_hours),
    "top_regions_data": _report(reports.top_regions_by_data),
    "call_durations": _report(reports.call_durations),
    "realtime_totals": _report(reports.realtime_totals),
    "anomaly_totals": _report(reports.anomaly_totals),
    "top_regions": _report(reports.top_regions),
    "health": _report(reports.health),
    "latest_metrics": _report(reports.latest_metrics),
    "top_daily": _report(reports.top_daily),
    "batch_summary": _report(reports.batch_summary),
    "event_mix": _report(reports.event_mix),
    "hour_weight": _report(reports.hourly_load),
    # checks
    "quality_gate": quality_gate,
    "verify_results": _report(quality.verify_results),
    "retention_kept": _report(quality.retention_kept),
    # streams, run over what the source holds
    "stream_metrics_5min": _stream(mt.event_type_metrics, table="real_time_metrics"),
    "stream_metrics_10min": _stream(mt.regional_metrics, table="real_time_metrics"),
    "stream_metrics_conditional": _stream(mt.conditional_metrics, table="real_time_metrics"),
    "stream_high_frequency": _stream(
        lambda e: an.frequent_subscribers(e, Limits(events_per_window=1))
    ),
    "stream_cumulative": stream_cumulative,
    "stream_anomalies": _stream(lambda e: an.find_anomalies(e, detected_at=F.col("timestamp"))),
    "stored_once": stored_once,
    "archive_windows": archive_windows,
    "stored_totals": stored_totals,
    "two_checkpoints": two_checkpoints,
    "early_alerts": early_alerts,
    "region_users_sketch": region_users_sketch,
    "stream_dedup": _stream(lambda e: ev.drop_repeats(ev.validate(with_faults(e)))),
}


def _prepared(query):
    return lambda spark, folder: query(prepare(spark), folder)


QUERIES = {name: _prepared(query) for name, query in REGISTERED.items()}
