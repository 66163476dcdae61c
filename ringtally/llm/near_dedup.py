"""Near-duplicate groups: circulant MinHash, banding, exact confirmation, components.

Documents with the same set of shingles are one node. Nodes share a bucket where a band of
their signatures agrees. Links are confirmed on full shingle sets:

1. every node of a bucket against the bucket's lowest node;
2. in buckets that still hold several components, the pairs across components: as pairs
   where the bucket has at most SMALL nodes; in larger ones every node outside the bucket's
   largest component against all others, in blocks of bounded size that one task intersects
   by counting, so that no pair leaves a task unless it joins two components.

So components are those of all links whose nodes share a band. With 32 bands of 4
coordinates two sets at the least similarity share none with a chance of 5 in a million.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtally.llm.circulant import band_keys, signature
from ringtally.llm.common import small_batches, staged
from ringtally.llm.components import components
from ringtally.llm.shingles import shingle_set

SIMILAR = 75  # percent
SMALL = 64
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1_000_000


def linked(n: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether sets that share ``n`` elements are similar enough."""
    return 100 * n >= SIMILAR * (size_a + size_b - n)


def described(texts: pd.Series) -> pd.DataFrame:
    """Size, fingerprint and band keys of each text's shingle set; NULLs where it is empty."""
    rows = []
    for text in texts:
        found = shingle_set(text)
        if len(found):
            name = blake2b(found.tobytes(), digest_size=16).hexdigest()
            rows.append((len(found), name, band_keys(signature(found))))
        else:
            rows.append((0, None, None))
    return pd.DataFrame(rows, columns=["n", "print", "bands"])


def similar(left: pd.Series, right: pd.Series) -> pd.Series:
    kept: dict[str, np.ndarray] = {}

    def of(text):
        if text not in kept:
            kept[text] = shingle_set(text)
        return kept[text]

    out = []
    for a, b in zip(left, right):
        x, y = of(a), of(b)
        fits = 100 * min(len(x), len(y)) >= SIMILAR * max(len(x), len(y))
        out.append(fits and bool(linked(len(np.intersect1d(x, y, True)), len(x), len(y))))
    return pd.Series(out)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").where(F.pandas_udf(similar, "boolean")("text_a", "text_b")).select("a", "b")


def join_across(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the nodes of one block pair that join two of its components. Shingles get
    numbers; a node's are marked, and the marks counted over all other nodes at once."""
    rows = rows.drop_duplicates("node").reset_index(drop=True)
    sets = [shingle_set(t) for t in rows["text"]]
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    numbers, at = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(numbers), bool)
    node, root = rows["node"].to_numpy(), rows["component"].to_numpy().copy()
    links = []
    for i in np.flatnonzero(rows["outside"].to_numpy()):
        mine = at[starts[i] : starts[i] + sizes[i]]
        marked[mine] = True
        shared = np.add.reduceat(marked[at], starts, dtype=np.int64)
        marked[mine] = False
        for j in np.flatnonzero(linked(shared, sizes[i], sizes) & (root != root[i])):
            if root[j] != root[i]:
                links.append((min(node[i], node[j]), max(node[i], node[j])))
                root[root == root[j]] = root[i]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def across_large(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links across components in large buckets. ``members``: bucket, node, component, n."""
    parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    mains = parts.groupBy("bucket").agg(
        F.max_by("component", "rows").alias("main"),
        F.max(F.struct("rows", "n")).alias("largest"),
        F.sum("rows").alias("rows"),
        F.sum("n").alias("n"),
    )

    def blocks(rows, n):
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(n / BLOCK_SHINGLES), F.lit(1)).cast("int")

    mains = mains.select(
        "bucket",
        "main",
        blocks(F.col("largest.rows"), F.col("largest.n")).alias("inner"),
        blocks(F.col("rows") - F.col("largest.rows"), F.col("n") - F.col("largest.n")).alias("outer"),
    )
    rows = members.join(mains, "bucket").withColumn("outside", F.col("component") != F.col("main"))
    salt = F.xxhash64("node", F.lit(1))
    block = F.pmod(salt, F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))).cast("int")
    rows = rows.withColumn("block", block)
    # A node outside meets every inner block and every outer one; an inner node every outer block.
    ids = [F.transform(F.sequence(F.lit(0), F.col("inner") - 1),
                       lambda i: F.struct(F.lit("in").alias("kind"), F.col("block").alias("x"), i.alias("y"))),
           F.transform(F.sequence(F.lit(0), F.col("outer") - 1),
                       lambda i: F.struct(F.lit("out").alias("kind"), F.least(F.col("block"), i).alias("x"),
                                          F.greatest(F.col("block"), i).alias("y"))),
           F.transform(F.sequence(F.lit(0), F.col("outer") - 1),
                       lambda i: F.struct(F.lit("in").alias("kind"), i.alias("x"), F.col("block").alias("y")))]
    tasks = F.when(F.col("outside"), F.concat(ids[0], ids[1])).otherwise(ids[2])
    tasks = rows.select("bucket", "node", "component", "outside", F.explode(tasks).alias("task"))
    return tasks.join(texts, "node").groupBy("bucket", "task").applyInPandas(join_across, "a long, b long")


def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Every node's component; a node without links is its own."""
    found = components(links).withColumnRenamed("node", "of")
    return nodes.join(found, F.col("node") == F.col("of"), "left").select(
        *nodes.columns, F.coalesce("component", "node").alias("component")
    )


def judged(docs: DataFrame) -> DataFrame:
    """What ``groups`` returns, with ``text_key`` (a digest of the text) and ``part`` (a number
    of the group; NULL without shingles)."""
    spark = docs.sparkSession
    small_batches(spark)
    key = F.md5(F.col("text").cast("binary"))
    described_by = F.pandas_udf(described, "n long, print string, bands array<bigint>")
    described_rows = staged(
        docs.select("doc_id", key.alias("text_key"), described_by("text").alias("s")).select("doc_id", "text_key", "s.*"),
        "dedup-described",
    )
    kinds = described_rows.where("n > 0").groupBy("print").agg(
        F.min(F.struct("doc_id", "text_key")).alias("any"),  # has a NULL id if one row has
        F.min("doc_id").alias("lowest"),
        F.first("n").alias("n"),
        F.first("bands").alias("bands"),
    )
    # Numbers are given once, when the table is written.
    nodes = staged(kinds.withColumn("node", F.monotonically_increasing_id()), "dedup-nodes")
    seats = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    counts = seats.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("lead"))
    shared = counts.where("size > 1").withColumn("bucket", F.xxhash64("band", "key"))
    members = staged(
        seats.join(shared, ["band", "key"]).select("bucket", "size", "lead", "node", "n"), "dedup-members"
    )
    wanted = members.select("node").distinct().join(nodes.select("node", "any"), "node")
    wanted = wanted.select("node", "any.doc_id", "any.text_key")
    source = docs.select("doc_id", key.alias("text_key"), "text")
    same = source["doc_id"].eqNullSafe(wanted["doc_id"]) & (source["text_key"] == wanted["text_key"])
    texts = staged(source.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "dedup-texts")
    # 1. against the bucket's lowest node
    stars = staged(
        members.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(),
        "dedup-stars",
    )
    first = staged(confirmed(stars, texts), "dedup-links")
    # 2. across components, in each set of nodes that is a bucket, once
    grouped = labelled(members.where("size > 2"), first)
    mixed = grouped.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    ).where("low != high")
    mixed = mixed.groupBy("members", "sum").agg(F.min("bucket").alias("bucket")).select("bucket", "members")
    grouped = staged(grouped.join(mixed, "bucket"), "dedup-mixed")
    seats = grouped.where(F.col("members") <= SMALL).groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct("node", "component"))).alias("all")  # at most SMALL
    )
    one = seats.select("all", F.posexplode("all").alias("i", "x"))
    two = one.select("x", F.explode(F.slice("all", F.col("i") + 2, F.lit(SMALL))).alias("y"))
    pairs = two.where("x.component != y.component").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    pairs = pairs.distinct().join(stars, ["a", "b"], "left_anti")
    large = grouped.where(F.col("members") > SMALL).select("bucket", "node", "component", "n")
    second = confirmed(pairs, texts).union(across_large(large, texts))
    links = staged(first.union(second), "dedup-all-links")
    # Components by their smallest document id.
    placed = staged(labelled(nodes.select("node", "print", "lowest"), links), "dedup-placed")
    ids = placed.groupBy("component").agg(F.min("lowest").alias("component_id"))
    placed = placed.join(ids, "component").select("print", "component", "component_id")
    rows = described_rows.select("doc_id", "text_key", "n", "print").join(placed, "print", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        "text_key",
        F.col("component").alias("part"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def groups(docs: DataFrame) -> DataFrame:
    """Every document with ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest document id reachable over links. Texts that are NULL,
    empty or without words have no shingles: they are linked with nothing and kept. Documents
    with equal sets are linked, however many; rows that repeat an id are judged alike. A NULL
    id never names a group unless the group has no other; such rows are kept only then.
    """
    return judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each group, in the columns of ``docs``: that with the group's id. Where
    several rows have that id (or where all ids are NULL), the one with the lowest digest of its
    text, and one of those that repeat it. Rows without shingles all stay.

    Documents meet the decisions by id and digest. They are shuffled once for that, whatever
    the size of either side, so that the cost of the stage grows with its input.
    """
    found = staged(judged(docs), "dedup-judged")
    named = found.where("kept AND part IS NOT NULL")
    best = named.groupBy("part").agg(F.min("text_key").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = staged(named.join(best, "part").select("doc_id", "text_key", "best").distinct(), "dedup-repeated")
    gone = found.where("NOT kept").select("doc_id", "text_key").union(
        repeated.where("text_key != best").select("doc_id", "text_key")
    )
    rows = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_key"), F.struct("*").alias("row"))

    def same(other):
        return rows["doc_id"].eqNullSafe(other["doc_id"]) & rows["text_key"].eqNullSafe(other["text_key"])

    rows = rows.join(gone.hint("merge"), same(gone), "left_anti")
    again = repeated.where("text_key = best").select("doc_id", "text_key")
    if again.isEmpty():
        return rows.select("row.*")
    once = rows.join(again, same(again), "left_anti")
    twice = rows.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text_key"])
    return once.union(twice).select("row.*")
