"""Usage events derived from the generic ``events`` table of the test data.

Columns: event_id bigint, ts timestamp_ntz, user_id bigint, event_type, value, props.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringtally.sources.messages import file_stream

SOURCE_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _usage(events: DataFrame, time: str) -> DataFrame:
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "concat('77', lpad(CAST(user_id AS STRING), 5, '0'), '****') AS msisdn",
        "CASE event_type WHEN 'click' THEN 'call' WHEN 'view' THEN 'data_session'"
        " WHEN 'purchase' THEN 'balance_recharge' WHEN 'error' THEN 'sms'"
        " ELSE 'service_activation' END AS event_type",
        "CASE WHEN event_type IN ('click', 'error')"
        " THEN CASE WHEN event_id % 2 = 0 THEN 'incoming' ELSE 'outgoing' END"
        " WHEN event_type = 'signup' THEN concat('Service_', CAST(event_id % 5 AS STRING))"
        " END AS event_subtype",
        "CAST(CASE event_type WHEN 'click' THEN floor(value * 60) WHEN 'view' THEN floor(value * 10)"
        " END AS INT) AS duration_seconds",
        "CASE WHEN event_type = 'view'"
        " THEN CAST(CAST(value AS DECIMAL(10,2)) * 20 AS DECIMAL(18,2)) END AS data_mb",
        "CASE WHEN event_type = 'purchase'"
        " THEN CAST(CAST(value AS DECIMAL(10,2)) * 200 AS DECIMAL(18,2)) END AS amount",
        "CASE WHEN event_id % 101 <> 0"
        " THEN concat('Region_', lpad(CAST(user_id % 12 AS STRING), 2, '0')) END AS region",
        "CAST(1000 + event_id % 9000 AS INT) AS cell_tower_id",
        f"{time} AS timestamp",
    )


def usage_events(spark: SparkSession, folder: str) -> DataFrame:
    """The time stays as stored (without zone), so filters on it reach the Parquet scan."""
    return _usage(spark.read.schema(SOURCE_SCHEMA).parquet(f"{folder}/events.parquet"), "ts")


def usage_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as a stream. A watermark needs a zoned timestamp. The glob makes the
    source accept ``events.parquet`` as one file or as a folder of part files."""
    source = file_stream(spark, f"{folder}/[e]vents.parquet", SOURCE_SCHEMA)
    return _usage(source, "CAST(ts AS TIMESTAMP)")


def with_faults(usage: DataFrame) -> DataFrame:
    """Break one rule in some rows and repeat every 50th event: what arrives on the wire."""
    k = "CAST(event_id AS BIGINT)"

    def broken(every: int, value: str, name: str) -> str:
        return f"CASE WHEN {k} % {every} = 0 THEN {value} ELSE {name} END AS {name}"

    rows = usage.selectExpr(
        "event_id",
        broken(89, "''", "msisdn"),
        broken(83, "'unknown'", "event_type"),
        "event_subtype",
        broken(97, "-1", "duration_seconds"),
        broken(79, "CAST(-1 AS DECIMAL(18,2))", "data_mb"),
        broken(73, "CAST(-1 AS DECIMAL(18,2))", "amount"),
        "region",
        "cell_tower_id",
        "timestamp",
        f"explode(array_repeat(TRUE, IF({k} % 50 = 0, 2, 1))) AS copy",
    )
    return rows.drop("copy")


def wire_events(spark: SparkSession, folder: str) -> DataFrame:
    return with_faults(usage_events(spark, folder))
