"""Shards of nearly equal bytes by a k-d tree over the documents' metadata.

A node that must hold several shards is cut in two along its widest metadata dimension (its
extent relative to the extent of all documents), at the point that divides its bytes in the
ratio of the shards on either side. The cut is a distributed weighted quantile: every round
sums the bytes of at most ``BINS`` equal bins per open node, and narrows each node's search
to the bin its quantile lies in. Equal coordinates are cut by document id.

The driver sees one row per bin of an open node (at most shards x BINS rows, whatever the
number of documents); documents are only read, binned and summed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.llm.common import literal_case, staged

BINS = 256  # bins of a node in one round
TOLERANCE = 0.002  # of a shard's target: a bin that holds less is not divided further
SLOT_CHUNKS = 256  # pieces in which a shard's rows are numbered side by side
OVERHEAD = 16  # bytes of a row besides its text


def text_number(text: Column) -> Column:
    """A number in the order of the first six bytes of a text; NULL comes first."""
    head = F.rpad(F.substring(F.hex(text), 1, 12), 12, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))


def number(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(-1.0))


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The dimensions of a document: where it comes from, language, length and id."""
    return {
        "at_source": text_number(docs["source"]),
        "at_lang": text_number(docs["lang"]),
        "at_length": number(F.octet_length(docs["text"])),
        "at_id": number(docs["doc_id"]),
    }


@dataclass
class Node:
    """``first`` to ``first + shards - 1`` are its shards; a cut node has two sides."""

    first: int
    shards: int
    dim: str = ""
    value: float = 0.0
    last_id: float = float("inf")
    sides: tuple["Node", "Node"] | None = None

    def where(self) -> Column:
        """The first shard of the leaf a row falls into."""
        if self.sides is None:
            return F.lit(self.first)
        x = F.col(self.dim)
        left = (x < self.value) | ((x == self.value) & (F.col("at_id") <= self.last_id))
        return F.when(left, self.sides[0].where()).otherwise(self.sides[1].where())

    def open_leaves(self) -> list["Node"]:
        if self.sides:
            return self.sides[0].open_leaves() + self.sides[1].open_leaves()
        return [self] if self.shards > 1 else []


@dataclass
class Search:
    """The range a node's cut is still sought in, and the bytes that lie before it."""

    node: Node
    goal: float
    low: float
    high: float
    before: float = 0.0
    tie: float | None = None  # the coordinate whose rows are cut by id
    done: bool = False


def _extents(rows: DataFrame, tree: Node, dims: list[str]) -> dict[int, dict]:
    found = rows.groupBy(tree.where().alias("node")).agg(
        F.sum("size").alias("bytes"),
        *[F.min(d).alias(f"{d}_low") for d in dims],
        *[F.max(d).alias(f"{d}_high") for d in dims],
    )
    return {row["node"]: row.asDict() for row in found.collect()}


def _narrow(search: Search, bins: list[dict], tolerance: float) -> None:
    """Settle on a cut, or on the bin to look into next."""
    at = search.before
    for i, b in enumerate(bins):
        after = at + b["bytes"]
        if after < search.goal and i + 1 < len(bins):
            at = after
            continue
        single = b["low"] == b["high"]
        if not single and b["bytes"] > tolerance:
            search.low, search.high, search.before = b["low"], b["high"], at
            return
        if single and b["bytes"] > tolerance and search.tie is None and search.node.dim != "at_id":
            search.tie, search.before = b["low"], at
            search.low = search.high = None
            return
        # The nearer end of this bin; below the first bin everything lies on the right.
        ends_here = after - search.goal <= search.goal - at
        point = b["high"] if ends_here else (bins[i - 1]["high"] if i else _below(b["low"]))
        if search.tie is None:
            search.node.value = point
        else:
            search.node.value, search.node.last_id = search.tie, point
        search.done = True
        return


def _below(x: float) -> float:
    return x - 1.0 if abs(x) < 2**52 else x * (1 - 1e-12)


def _cut_level(rows: DataFrame, tree: Node, dims: list[str], whole: dict, shard: float) -> None:
    """Cut every open leaf of the tree."""
    extents = _extents(rows, tree, dims)
    searches: dict[int, Search] = {}
    for node in tree.open_leaves():
        seen = extents.get(node.first)
        left = node.shards // 2
        if seen:
            def width(d):
                return (seen[f"{d}_high"] - seen[f"{d}_low"]) / ((whole[f"{d}_high"] - whole[f"{d}_low"]) or 1)

            node.dim = max(dims, key=width)
            low, high = seen[f"{node.dim}_low"], seen[f"{node.dim}_high"]
            searches[node.first] = Search(node, seen["bytes"] * left / node.shards, low, high)
        else:
            node.dim = dims[0]
    while open_ := {k: s for k, s in searches.items() if not s.done}:
        node = tree.where()
        x = F.lit(None).cast("double")
        inside = F.lit(False)
        for k, s in open_.items():
            axis = F.col(s.node.dim if s.tie is None else "at_id")
            x = F.when(node == k, axis).otherwise(x)
            if s.tie is not None:
                here = F.col(s.node.dim) == s.tie
                if s.low is not None:
                    here &= axis.between(s.low, s.high)
            else:
                here = axis.between(s.low, s.high)
            inside = F.when(node == k, here).otherwise(inside)
        ranges = {
            k: (s.low, s.high) if s.low is not None
            else (extents[k]["at_id_low"], extents[k]["at_id_high"])
            for k, s in open_.items()
        }
        low = literal_case(F.col("node"), {k: r[0] for k, r in ranges.items()}, "double")
        step = literal_case(
            F.col("node"), {k: ((r[1] - r[0]) / BINS) or 1.0 for k, r in ranges.items()}, "double"
        )
        bins = (
            rows.select(node.alias("node"), x.alias("x"), "size", inside.alias("inside"))
            .where("inside")
            .withColumn("bin", F.least(F.floor((F.col("x") - low) / step), F.lit(BINS - 1)))
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("bytes"), F.min("x").alias("low"), F.max("x").alias("high"))
        )
        by_node: dict[int, list[dict]] = {k: [] for k in open_}
        for row in bins.collect():
            by_node[row["node"]].append(row.asDict())
        for k, s in open_.items():
            _narrow(s, sorted(by_node[k], key=lambda b: b["bin"]), TOLERANCE * shard)
    for node in tree.open_leaves():
        left = node.shards // 2
        node.sides = (Node(node.first, left), Node(node.first + left, node.shards - left))


def build_tree(rows: DataFrame, dims: list[str], shards: int) -> Node:
    """``rows`` has ``size``, the dimensions, and ``at_id`` among them."""
    tree = Node(0, shards)
    whole = _extents(rows, tree, dims).get(0)
    while whole and tree.open_leaves():
        _cut_level(rows, tree, dims, whole, whole["bytes"] / shards)
    return tree


def numbered(rows: DataFrame) -> DataFrame:
    """A gapless ``slot`` within each shard. Rows are numbered in SLOT_CHUNKS pieces per
    shard, each after the rows of the pieces before it."""
    from pyspark.sql import Window

    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_CHUNKS)))
    sizes = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards x SLOT_CHUNKS rows.
    starts = sizes.select(
        "shard", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    order = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")
    at = rows.withColumn("at", F.row_number().over(order) - 1)
    slot = (F.col("start") + F.col("at")).cast("long").alias("slot")
    return at.join(F.broadcast(starts), ["shard", "chunk"]).select("*", slot).drop("chunk", "start", "at")


def kd_shards(docs: DataFrame, shards: int = 40, target_bytes: int | None = None) -> DataFrame:
    """Every document with its size, the CRC-32 of its text, shard and slot.

    ``target_bytes`` asks for as many shards as give leaves of that size; otherwise ``shards``.
    A NULL text has no bytes (size 16, CRC 0); NULL metadata comes before all values. An empty
    table gives no rows. Documents with equal metadata are divided by id; rows that repeat a
    document in every column stay in one shard. Other columns are ignored.
    """
    picked = docs.select("doc_id", "text", "lang", "source")
    text = F.coalesce("text", F.lit(""))
    rows = staged(
        picked.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            *[c.alias(name) for name, c in metadata(picked).items()],
        ),
        "kd-rows",
    )
    if target_bytes is not None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    dims = list(metadata(picked))
    tree = build_tree(rows, dims, shards)
    placed = rows.withColumn("shard", tree.where().cast("int")).drop(*dims)
    return numbered(placed)
