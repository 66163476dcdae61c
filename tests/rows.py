"""Literal events for tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

SCHEMA = (
    "event_id string, msisdn string, event_type string, event_subtype string, duration_seconds int,"
    " data_mb decimal(18,2), amount decimal(18,2), region string, cell_tower_id int, timestamp timestamp"
)
NOON = dt.datetime(2024, 3, 10, 12, 0, 0)


def at(minutes: float = 0, day: int = 10) -> dt.datetime:
    return NOON.replace(day=day) + dt.timedelta(minutes=minutes)


def event(event_id="e1", kind="call", time=NOON, **values):
    row = {
        "event_id": event_id,
        "msisdn": "7701234****",
        "event_type": kind,
        "event_subtype": None,
        "duration_seconds": None,
        "data_mb": None,
        "amount": None,
        "region": "Almaty",
        "cell_tower_id": 1000,
        "timestamp": time,
        **values,
    }
    for name in ("data_mb", "amount"):
        if row[name] is not None:
            row[name] = Decimal(str(row[name]))
    return tuple(row.values())


def frame(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)
