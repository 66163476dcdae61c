"""Captures against dated URL lists.

A list adds and removes entries over time. An entry is a host, which also covers the hosts
below it. Dated changes become validity intervals per list and entry; a capture is judged by
the entries active on the day it was fetched.

Captures are reduced to their distinct hosts and days before they meet the entries, so a host
with a third of all captures is as many rows as it has days. Intervals and captures meet by
entry and month, so an entry with a long history is spread over its months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_DAY = "2024-01-01"
RESULTS = ("host", "n_active", "lists", "entry", "blocked")


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def intervals(changes: DataFrame) -> DataFrame:
    """``changes``: list, entry, day, active. Half-open intervals list, entry, start, end (NULL:
    still active). Of several changes on a day removal counts; a repeated state changes nothing."""
    daily = changes.where("entry IS NOT NULL AND day IS NOT NULL AND active IS NOT NULL")
    daily = daily.groupBy("list", "entry", "day").agg(F.min("active").alias("active"))
    order = Window.partitionBy("list", "entry").orderBy("day")
    turns = daily.withColumn("before", F.lag("active", 1, False).over(order)).where("active != before")
    spans = turns.withColumn("end", F.lead("day").over(order)).where("active")
    return spans.select("list", "entry", F.col("day").alias("start"), "end")


def entries_of(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def months(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """Every capture with ``host``, ``n_active`` (list entries active then that cover it),
    ``lists`` (their lists, sorted), ``entry`` (the most specific) and ``blocked``: active on
    any list but not on ``allow`` by an entry at least as specific as those that block.

    ``captures`` has url and fetched (a date) and keeps its other columns, except those named
    like a result, which the result replaces. A NULL url, one without a host, or a NULL date
    matches nothing and is not blocked. Captures may repeat.
    """
    # The captures' own columns are numbered on the way, so that no name meets another.
    kept = [c for c in captures.columns if c not in RESULTS]
    numbered = [F.col(f"`{c}`").alias(f"column_{i}") for i, c in enumerate(kept)]
    rows = captures.select(*numbered, host_of(F.col("url")).alias("host"), "fetched")
    seen = rows.where("host IS NOT NULL AND fetched IS NOT NULL").select("host", "fetched").distinct()
    keys = seen.select("*", F.explode(F.array_distinct(entries_of(F.col("host")))).alias("entry"))
    keys = keys.withColumn("month", months(F.col("fetched")))
    horizon = seen.agg(F.max("fetched").alias("last"), F.min("fetched").alias("first"))  # one row
    spans = intervals(changes).join(F.broadcast(horizon), F.col("start") <= F.col("last"))
    low = months(F.greatest("start", "first"))
    high = months(F.least(F.coalesce("end", "last"), "last"))
    spans = spans.where(F.col("end").isNull() | (F.col("end") > F.col("first")))
    spans = spans.select("list", "entry", "start", "end", F.explode(F.sequence(low, high)).alias("month"))
    active = keys.join(spans, ["entry", "month"]).where(
        (F.col("start") <= F.col("fetched")) & (F.col("end").isNull() | (F.col("fetched") < F.col("end")))
    )
    depth = F.length("entry")
    deny, allow = F.col("list") != "allow", F.col("list") == "allow"
    found = active.groupBy("host", "fetched").agg(
        F.count(F.lit(1)).alias("n_active"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),  # as many as there are lists
        F.max_by("entry", depth).alias("entry"),
        F.max(F.when(deny, depth)).alias("deny"),
        F.max(F.when(allow, depth)).alias("allow"),
    )
    blocked = F.col("deny").isNotNull() & (F.coalesce("allow", F.lit(0)) < F.col("deny"))
    found = found.select("host", "fetched", "n_active", "lists", "entry", blocked.alias("is_blocked"))
    return rows.join(found, ["host", "fetched"], "left").select(
        *[F.col(f"column_{i}").alias(c) for i, c in enumerate(kept)],
        "host",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        "entry",
        F.coalesce("is_blocked", F.lit(False)).alias("blocked"),
    )


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures of the year from FIRST_DAY, the day given by the page id."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod("page_id", F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def sample_changes(pages: DataFrame) -> DataFrame:
    """List histories for the domains that occur in ``pages``: drawn by MD5, each domain is on
    one of four lists (one of them ``allow``) or none, from some day on, for a number of days,
    and again half a year later."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    entries = hosts.select(F.explode(entries_of(F.col("host"))).alias("entry")).distinct()

    def drawn(at):
        return F.conv(F.substring(F.md5(F.col("entry").cast("binary")), at, 2), 16, 10).cast("int")

    names = F.array(*[F.lit(x) for x in ("adult", "malware", "spam", "allow")])
    start = drawn(3)
    listed = entries.select(
        "entry", F.element_at(names, drawn(1) % 4 + 1).alias("list"), start.alias("a"), (start + drawn(5)).alias("b")
    )
    turns = F.array(*[
        F.struct(F.col(c) + F.lit(shift), F.lit(on))
        for c, shift, on in (("a", 0, True), ("b", 0, False), ("a", 183, True), ("b", 183, False))
    ])
    turns = listed.select("list", "entry", F.explode(turns).alias("t"))
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("t.col1"))
    return turns.select("list", "entry", day.alias("day"), F.col("t.col2").alias("active"))
