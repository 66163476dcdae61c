"""From message bytes to clean events. Every step is a narrow DataFrame -> DataFrame
expression, except removing repeats."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.functions.columns import (
    key_partition,
    mask_msisdn,
    null_or_not_negative,
    parse_time,
    wire_time,
)
from ringtally.schema import (
    EVENT_FIELDS,
    EVENT_TYPES,
    RUN_STATUSES,
    SEVERITIES,
    WATERMARK,
    WIRE_EVENT,
)

MONEY = "decimal(18,2)"

# Columns of decoded messages: the text as it came, and whether a part of it could not be read.
MESSAGE, MISREAD = "message", "misread"

# The window of an event, where repeats were removed within windows.
OF_WINDOW = "of_window"


def decode(messages: DataFrame, keep_text: bool = False) -> DataFrame:
    """Parse the JSON ``value`` column. Malformed text gives a row of NULLs. The broker's own
    ``timestamp`` column, where there is one, is kept as ``kafka_timestamp``. ``keep_text``
    adds the ``message`` as it came, and ``misread``: TRUE where the text is no JSON or a field
    has another type than expected (it reads as NULL). The parser itself reports both.

    The fields come out of a generator, not out of a struct column: the optimizer moves later
    filters below a projection and would parse the text again for every field they test.
    """
    fields, text = dict(WIRE_EVENT), F.col("value").cast("string")
    if keep_text:
        fields[MISREAD] = "string"
    body = F.from_json(
        text,
        ", ".join(f"`{n}` {t}" for n, t in fields.items()),
        {"columnNameOfCorruptRecord": MISREAD} if keep_text else {},
    )
    kept = [F.col(c).alias("kafka_timestamp") for c in ("timestamp",) if c in messages.columns]
    if not keep_text:
        return messages.select(F.inline(F.array(body)), *kept)
    events = messages.select(F.inline(F.array(body)), *kept, text.alias(MESSAGE))
    return events.withColumn(MISREAD, F.col(MISREAD).isNotNull())


def with_event_time(
    events: DataFrame,
    unreadable: str = "keep",
    pattern: str | None = None,
    fallback: Column | None = None,
) -> DataFrame:
    """Turn the text ``timestamp`` into a timestamp.

    ``unreadable``: ``keep`` leaves NULL (windows skip such rows), ``now`` puts the
    processing time (or ``fallback``), ``drop`` removes the row. Text that stays unread counts
    as ``misread``.
    """
    time = parse_time(F.col("timestamp"), pattern)
    if unreadable == "now":
        time = F.coalesce(time, F.current_timestamp() if fallback is None else fallback)
    elif unreadable not in ("keep", "drop"):
        raise ValueError(f"unreadable must be keep, now or drop, not {unreadable!r}")
    columns = {"timestamp": time}
    if MISREAD in events.columns:
        columns[MISREAD] = F.col(MISREAD) | (F.col("timestamp").isNotNull() & time.isNull())
    timed = events.withColumns(columns)
    return timed.filter(F.col("timestamp").isNotNull()) if unreadable == "drop" else timed


def is_valid() -> Column:
    """The stream's filter: known type, no negative measure, a subscriber."""
    return (
        F.col("event_type").isin(*EVENT_TYPES)
        & null_or_not_negative(F.col("duration_seconds"))
        & null_or_not_negative(F.col("data_mb"))
        & null_or_not_negative(F.col("amount"))
        & F.col("msisdn").isNotNull()
        & (F.col("msisdn") != "")
    )


def validate(events: DataFrame) -> DataFrame:
    return events.filter(is_valid())


def exact_amounts(events: DataFrame) -> DataFrame:
    """Megabytes and money as decimals, so that sums do not depend on the order of rows.
    What no decimal can hold becomes NULL; ``broken_rules`` reports it before this step."""
    return events.withColumns(
        {name: F.col(name).try_cast(MONEY) for name in ("data_mb", "amount")}
    )


def table_rules(table: str = "raw_events") -> dict[str, Column]:
    """What a table refuses, by rule. Every condition is TRUE or FALSE."""
    too_large = F.lit(10**8)  # DECIMAL(10,2) ends below this

    def outside(name: str, allowed: tuple[str, ...]) -> Column:
        return ~F.col(name).isin(*allowed) | F.col(name).isNull()

    rules = {
        "raw_events": lambda: {
            "event_id_missing": F.col("event_id").isNull(),
            "msisdn_missing": F.col("msisdn").isNull() | (F.col("msisdn") == ""),
            "event_type_unknown": outside("event_type", EVENT_TYPES),
            "timestamp_missing": F.col("timestamp").isNull(),
            "duration_negative": F.col("duration_seconds") < 0,
            "data_negative": F.col("data_mb") < 0,
            "amount_negative": F.col("amount") < 0,
            "data_out_of_range": F.col("data_mb") >= too_large,
            "amount_out_of_range": F.col("amount") >= too_large,
        },
        "anomalies": lambda: {
            "event_id_missing": F.col("event_id").isNull(),
            "anomaly_type_missing": F.col("anomaly_type").isNull(),
            "anomaly_reason_missing": F.col("anomaly_reason").isNull(),
            "severity_unknown": outside("severity", SEVERITIES),
        },
        "pipeline_monitoring": lambda: {"status_unknown": outside("status", RUN_STATUSES)},
    }[table]()
    return {name: F.coalesce(broken, F.lit(False)) for name, broken in rules.items()}


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks, joined by commas; empty for a good row."""
    return F.concat_ws(",", *[F.when(broken, name) for name, broken in rules.items()])


def _rules_for(rows: DataFrame, table: str) -> dict[str, Column]:
    """The table's rules, and for decoded messages that every field was read."""
    rules = table_rules(table)
    if table == "raw_events" and MISREAD in rows.columns:
        rules["field_unreadable"] = F.coalesce(F.col(MISREAD), F.lit(False))
    return rules


def is_refused(
    rows: DataFrame, tolerated: tuple[str, ...] = (), table: str = "raw_events"
) -> Column:
    """Whether a row breaks a rule that is not tolerated."""
    rules = _rules_for(rows, table)
    return reduce(or_, [broken for name, broken in rules.items() if name not in tolerated])


def split_by_rules(
    rows: DataFrame, tolerated: tuple[str, ...] = (), table: str = "raw_events"
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and refused rows with their ``broken_rules``. A row that breaks only
    tolerated rules is good."""
    refuse, reasons = is_refused(rows, tolerated, table), broken_rules(_rules_for(rows, table))
    return rows.filter(~refuse), rows.filter(refuse).withColumn("broken_rules", reasons)


def rule_counts(rows: DataFrame, table: str = "raw_events") -> DataFrame:
    """Rows breaking each rule, zeros included: one pass, one row, then turned on its side."""
    rules = _rules_for(rows, table)
    totals = rows.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return totals.unpivot([], list(rules), "rule", "n_rows")


def drop_repeats(events: DataFrame, watermark: str = WATERMARK, spread: int = 16) -> DataFrame:
    """Keep one row per ``event_id``, also where one id holds a large part of all rows. Rows
    without an id are no copies of each other: all stay.

    A batch keeps the copy with the earliest time; copies are combined before the shuffle, so
    an id moves at most once per map task.

    A stream forgets an id once the watermark has passed it, so its state stays bounded;
    repeats must arrive within the watermark delay of the first copy. It cannot combine before
    a shuffle, so copies are first thinned out in ``spread`` groups per id, picked at random,
    and what is left, at most ``spread`` rows per id, is thinned out again. ``spread=1`` saves
    the first step where no id has many copies.
    """
    if events.isStreaming:
        timed = events.withWatermark("timestamp", watermark)
        marked = timed.filter(F.col("event_id").isNotNull())
        if spread > 1:
            # A fixed seed: a task that is run again marks its rows the same way.
            group = F.floor(F.rand(seed=17) * spread).cast("int")
            marked = (
                marked.withColumn("copy_group", group)
                .dropDuplicatesWithinWatermark(["event_id", "copy_group"])
                .drop("copy_group")
            )
        once = marked.dropDuplicatesWithinWatermark(["event_id"])
        return once.unionByName(timed.filter(F.col("event_id").isNull()))
    # Hardly any id repeats: only ids are counted, and only the rows of repeated ones sorted. The
    # joins look the repeated ids up in a hash table, past which the other rows stream; a sort
    # would hold both sides of a task in memory.
    repeated = repeated_ids(events).hint("shuffle_hash")
    rest = ["timestamp"] + [c for c in events.columns if c not in ("event_id", "timestamp")]
    several = events.join(repeated, "event_id", "left_semi")
    first = several.groupBy("event_id").agg(F.min(F.struct(*rest)).alias("first"))
    once = first.select(
        *[F.col("event_id") if c == "event_id" else F.col(f"first.{c}") for c in events.columns]
    )
    return once.unionByName(events.join(repeated, "event_id", "left_anti").select(*events.columns))


def drop_repeats_in_windows(
    events: DataFrame, size: str, spread: int = 16, all_named: bool = False
) -> DataFrame:
    """A stream (that carries a watermark) with one row per ``event_id`` and window of ``size``,
    for metrics over such windows. Ids are kept until their window closes: repeats may come as
    late as the window takes rows, and a late row is dropped with its window, not before. Each
    dropped row counts in the query's progress. Adds the window, by which metrics group then;
    rows without a time are in none.

    One stateful step does it. Copies of an id that follow each other closely in a task are
    dealt out to ``spread`` groups of their own, so that no task gets all copies of a frequent
    id, and are left out afterwards; every id and window has a row outside of them.
    ``spread=1`` saves the look at the rows where no id has many copies.

    ``all_named`` tells that every row has an id: the source is then read once. Otherwise rows
    without an id are read from it by themselves."""
    # A stream has one column of event time: from here on it is the window.
    plain_time = (F.col("timestamp") + F.expr("INTERVAL 0 SECONDS")).alias("timestamp")
    rest = [plain_time if c == "timestamp" else F.col(c) for c in events.columns]
    timed = events.select(*rest, F.window("timestamp", size).alias(OF_WINDOW))
    named = timed if all_named else timed.filter(F.col("event_id").isNotNull())
    if spread > 1:
        # A fixed seed: a task that is run again marks its rows the same way.
        group = F.floor(F.rand(seed=17) * spread).cast("int")
        follows = _follows(F.col("event_id"), F.unix_micros(F.col(OF_WINDOW)["start"]))
        marked = named.withColumn("copy_group", F.when(follows, group))
        once = marked.dropDuplicates(["event_id", OF_WINDOW, "copy_group"]).filter(F.col("copy_group").isNull())
    else:
        once = named.dropDuplicates(["event_id", OF_WINDOW])
    once = once.select(*timed.columns)
    return once if all_named else once.unionByName(timed.filter(F.col("event_id").isNull()))


def _follows(*key: Column) -> Column:
    """Whether the rows that are handed over together (some thousands) hold the key before."""

    def repeats(*columns):  # an inner function: workers need not have this package
        import pandas as pd

        return pd.concat(columns, axis=1).duplicated()

    return F.pandas_udf(repeats, "boolean", F.PandasUDFType.SCALAR).asNondeterministic()(*key)


def repeated_ids(events: DataFrame) -> DataFrame:
    """Ids that several rows have; no other column is read."""
    named = events.filter(F.col("event_id").isNotNull())
    return named.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("event_id")


def new_events(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose ``event_id`` is not among ``stored``. The stored side, which may
    be long, is reduced to the ids of the batch before it is compared."""
    known = stored.select("event_id").join(batch.select("event_id"), "event_id", "left_semi")
    return batch.join(known.distinct(), "event_id", "left_anti").select(*batch.columns)


def mask_subscribers(events: DataFrame) -> DataFrame:
    return events.withColumn("msisdn", mask_msisdn(F.col("msisdn")))


def event_json(*, nulls: bool = True) -> Column:
    """The event as JSON text in wire form."""
    fields = [
        wire_time(F.col("timestamp")).alias("timestamp") if name == "timestamp" else F.col(name)
        for name in EVENT_FIELDS
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": str(not nulls).lower()})


def original_text(rows: DataFrame) -> Column:
    """The message as it came; for events that were no messages, their JSON."""
    return F.coalesce(F.col(MESSAGE), event_json()) if MESSAGE in rows.columns else event_json()


def encode(events: DataFrame) -> DataFrame:
    """Messages to publish: subscriber as key, JSON as value. The broker's client places a
    message by its key, which keeps a subscriber's events in order; no shuffle is needed."""
    return events.select(F.col("msisdn").alias("key"), event_json().alias("value"))


def by_subscriber(events: DataFrame, partitions: int) -> DataFrame:
    """Number the partition of each event by subscriber, without moving it."""
    return events.withColumn("partition", key_partition(F.col("msisdn"), partitions))
