"""Time the headline queries; prints one JSON line.

``rollups_1m`` is the daily job's core on a stored table of about a million events (the test
events ten times over, loaded before the clock starts): read, roll up, write both tables.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

import registry
from ringtally.operators.events import encode
from ringtally.plans import reports
from ringtally.plans.daily import newest_time, run_rollups, stored_tables
from ringtally.session import build_session
from ringtally.sources.sample import usage_events
from ringtally.sources.messages import text_messages
from ringtally.sources.store import Store
from ringtally.streaming.jobs import await_all, decoded_events, start_streams

HEADLINE = [
    "metrics_5min",
    "metrics_10min_region",
    "metrics_5min_conditional",
    "metrics_sliding",
    "cumulative_type_region",
    "validate",
    "dedup_events",
    "decoded_json",
    "anomalies",
    "anomaly_high_frequency",
    "daily_stats",
    "hourly_stats",
    "daily_stats_extended",
    "recent_counts",
    "region_users",
    "top_regions_data",
    "table_counts",
    "stream_metrics_5min",
]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def stored_reports(store) -> dict[str, float]:
    """Reports on the stored tables, the present moment taken from the newest day once."""
    now = newest_time(store)
    tables = stored_tables(store)
    names = ["recent_counts", "region_users", "top_regions_by_data", "call_durations", "peak_hours"]
    times = {"newest_time": seconds(lambda: newest_time(store))}
    for name in names:
        report = getattr(reports, name)
        report(tables, as_of=now).collect()
        times[name] = min(seconds(lambda: report(tables, as_of=now).collect()) for _ in range(3))
    return times


def streams(spark, folder) -> dict[str, float]:
    """Archive and three metrics over JSON messages in 4 files: as queries of their own, each of
    which parses the messages, and from the archive; the archive alone, and sent again."""
    at = tempfile.mkdtemp(prefix="run-bench-")
    # 30 days squeezed into under four hours: a stream's batches touch few days.
    first, micros = 1_704_067_200_000_000, F.unix_micros(F.col("timestamp").cast("timestamp"))
    squeezed = F.timestamp_micros(F.floor((micros - first) / 200) + first)
    sent = usage_events(spark, folder).withColumn("timestamp", squeezed)
    encode(sent).select("value").repartition(4).write.text(f"{at}/messages")
    names = ("archive", "metrics_5min", "metrics_10min", "metrics_conditional")

    def run(name, streams, **options):
        store = Store(spark, f"{at}/{name}").create()
        for i in range(options.pop("times", 1)):
            events = decoded_events(text_messages(spark, f"{at}/messages", max_files=1))
            await_all(start_streams(events, store, f"{at}/cp-{name}-{i}", streams, continuous=False, **options))

    return {
        "archive_only": seconds(lambda: run("alone", names[:1])),
        "archive_delivered_twice": seconds(lambda: run("twice", names[:1], times=2)),
        "separate_queries": seconds(lambda: run("separate", names)),
        "from_archive": seconds(lambda: run("together", names, from_archive=True)),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        run(name)  # start-up of the JVM and compilation are not part of a query
        times[name] = min(seconds(lambda: run(name)) for _ in range(2))

    store = Store(spark, tempfile.mkdtemp(prefix="run-bench-")).create()
    copies = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("copy")
    events = usage_events(spark, folder).select("*", copies)
    many = events.withColumn("event_id", F.concat_ws("-", "event_id", "copy")).drop("copy")
    store.load("raw_events", many, "bench")
    days = store.days("raw_events")
    n_events = store.read("raw_events").count()
    times["rollups_1m"] = seconds(lambda: run_rollups(store, days[0], days[-1]))
    stored, stream_forms = stored_reports(store), streams(spark, folder)

    print(
        json.dumps(
            {
                "metric": "usage-event queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
                "stored_reports": stored,
                "streams": stream_forms,
                "rollup_events": n_events,
                "rollup_events_per_sec": round(n_events / times["rollups_1m"]),
                "at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
