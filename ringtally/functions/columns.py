"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringtally.schema import HOUR_WEIGHTS, NORMAL_HOUR_WEIGHT

# Event time as text, microseconds and a literal Z (fixed format).
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_time(text: Column, pattern: str | None = None) -> Column:
    """Text to timestamp, NULL where it does not parse. Without a pattern any ISO form with
    0 to 6 fraction digits is read; a pattern makes it strict."""
    if pattern is None:
        return F.try_to_timestamp(text)
    return F.try_to_timestamp(text, F.lit(pattern))


def wire_time(ts: Column) -> Column:
    return F.date_format(ts, WIRE_TIME_FORMAT)


def null_or_not_negative(value: Column) -> Column:
    return value.isNull() | (value >= 0)


def mask_msisdn(msisdn: Column) -> Column:
    """Keep the first seven characters of a subscriber number."""
    return F.concat(F.substring(msisdn, 1, 7), F.lit("****"))


def mb_to_gb(megabytes: Column) -> Column:
    return megabytes / F.lit(1024.0)


def hour_weight(ts: Column) -> Column:
    """Relative load expected at the hour of day of ``ts``."""
    hour = F.hour(ts)
    (first, weight), *rest = HOUR_WEIGHTS
    choice = F.when(hour.between(*first), F.lit(weight))
    for span, weight in rest:
        choice = choice.when(hour.between(*span), F.lit(weight))
    return choice.otherwise(F.lit(NORMAL_HOUR_WEIGHT))


def key_partition(key: Column, partitions: int) -> Column:
    """Partition number of a message key: the first 32 bits of its MD5, modulo the number of
    partitions. An expression, so that it costs no shuffle."""
    head = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(partitions)).cast("int")
