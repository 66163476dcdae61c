"""Mix sources to target weights: capped water-filling, then seeded repetitions.

Targets share the words of all sources by weight. A source is clamped at ``epochs`` times its
words, and what it cannot take goes to the others by weight, until no source is above its
clamp. A source then takes all its documents as often as its target holds whole passes over
it, and one more time a seeded part of them that has about the remaining words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ringtally.llm.common import checkpointed, staged, words

EPOCHS = 3
BINS = 4096  # parts of the seeded order; only one part per source is sorted
WEIGHTS = (1, 2, 3)
RANK_TASKS = 16
BROADCAST_SOURCES = 50_000  # a row per source; beyond this many the join is left to Spark


def seeded(seed: int) -> Column:
    """A number from 0 to 2^32 - 1 per document id."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 in code point order, NULL last. The sources are sorted in ranges;
    each range starts after the rows of the ranges before it."""
    order = F.col("source").asc_nulls_last()
    sorted_ranges = sizes.repartitionByRange(RANK_TASKS, order).sortWithinPartitions(order)
    ranges = (
        checkpointed(sorted_ranges)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33))
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(  # one row per task
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    return ranges.join(F.broadcast(starts), "part").select(
        "source", "source_size", (F.col("start") + F.col("at")).alias("rank")
    )


def cyclic_weight(rank: Column, weights: tuple[int, ...] = WEIGHTS) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))


def water_level(sources: DataFrame, epochs: int = EPOCHS) -> float:
    """Words per unit of weight. Each round clamps the sources the level of the round before
    lifts above their limit; only sums over all sources reach the driver."""
    limit = F.col("source_size") * epochs
    level, clamped = 0.0, -1
    while True:
        full = limit < F.col("weight") * F.lit(level)
        sums = sources.agg(
            F.count_if(full).alias("clamped"),
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if sums["clamped"] == clamped or not sums["weight"]:
            return level
        clamped = sums["clamped"]
        level = float(sums["all"] - sums["taken"]) / float(sums["weight"])


def with_targets(sources: DataFrame, level: float, epochs: int = EPOCHS) -> DataFrame:
    limit = (F.col("source_size") * epochs).cast("double")
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def mix(
    docs: DataFrame,
    epochs: int = EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 7,
    carry: bool = False,
) -> DataFrame:
    """Every document with ``size`` (words), ``source_size``, ``target`` of its source and
    ``taken``, the words the mix takes of it, a multiple of its size.

    A NULL text has no words, a NULL source is a source of its own, after all others. The
    part taken once more is chosen by document id: the same for every run. A source ends
    within half a document of its target. Rows that repeat a document are documents of their
    own. An empty table, or one without words, takes nothing. With ``carry`` the result also
    has ``row``, the document with all its columns.
    """
    sized = staged(
        docs.select(
            "doc_id",
            "source",
            F.size(words(F.col("text"))).cast("long").alias("size"),
            seeded(seed).alias("u"),
            *([F.struct("*").alias("row")] if carry else []),
        ).withColumn("bin", F.shiftright("u", 20)),
        "mix-sized",
    )
    bins = staged(sized.groupBy("source", "bin").agg(F.sum("size").alias("words")), "mix-bins")
    sizes = bins.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = staged(
        ranked_sources(sizes).withColumn("weight", cyclic_weight(F.col("rank"), weights)),
        "mix-sources",
    )
    targets = with_targets(sources, water_level(sources, epochs), epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plans = targets.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long")).withColumn(
        "rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    )
    # The part of the seeded order in which the remaining words run out; at most BINS rows each.
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = bins.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    same = sums["source"].eqNullSafe(plans["source"])
    edges = (
        sums.join(plans, same)
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .select(sums["source"], F.col("bin").alias("edge"), (F.col("rest") - F.col("before")).alias("room"))
    )
    same = plans["source"].eqNullSafe(edges["source"])
    plans = plans.join(edges, same, "left").select(
        plans["source"].alias("of"), "source_size", "target", "whole",
        F.coalesce("edge", F.lit(BINS)).alias("edge"), F.coalesce("room", F.lit(0)).alias("room"),
    )
    if sources.count() <= BROADCAST_SOURCES:
        plans = F.broadcast(plans)
    planned = sized.join(plans, sized["source"].eqNullSafe(plans["of"]))
    passes = F.col("whole") * F.col("size")
    plain = planned.where("bin != edge").withColumn(
        "taken", passes + F.when(F.col("bin") < F.col("edge"), F.col("size")).otherwise(0)
    )
    order = Window.partitionBy("of").orderBy("u", "doc_id", "size")
    so_far = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = planned.where("bin = edge").withColumn("so_far", so_far).withColumn(
        "taken",
        passes + F.when(2 * F.col("so_far") - F.col("size") <= 2 * F.col("room"), F.col("size")).otherwise(0),
    )
    columns = ["doc_id", "size", "source_size", "target", "taken", *(["row"] if carry else [])]
    return plain.select(*columns).unionByName(last.select(*columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, in the columns of ``docs``."""
    taken = mix(docs, carry=True, **options).where("taken > 0")
    times = F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))
    return taken.select("row", times.alias("time")).select("row.*")
