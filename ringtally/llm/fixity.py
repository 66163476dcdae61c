"""Merkle fixity audit of WARC replicas.

Records are hashed where they lie. Leaves of a file's tree are ranges of RANGE bytes of
offset, with the hashes of the records that begin there, in order; FANOUT ranges make the
next range, up to one root per file. Ranges are fixed by offset, so a lost record changes its
own range only. Two replicas are compared root by root; only below ranges that differ are
the next smaller ranges compared, and at last the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringtally.llm.common import staged

RANGE = 1 << 16
FANOUT = 16
PAGES_PER_FILE = 1000
CRLF = "\r\n"


def warc_records(pages: DataFrame) -> DataFrame:
    """Pages as response records: file, page_id, and the record's bytes. A NULL url or html is
    empty; a page without id goes to file -1."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <urn:page:"), name,
        F.lit(f">{CRLF}WARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit(f"{CRLF}Content-Length: "), F.octet_length(html).cast("string"), F.lit(CRLF * 2),
    )
    record = F.concat(F.encode(head, "UTF-8"), html, F.encode(F.lit(CRLF * 2), "UTF-8"))
    file = F.coalesce(F.floor(F.col("page_id") / PAGES_PER_FILE), F.lit(-1)).cast("long")
    return pages.select(file.alias("file"), "page_id", record.alias("record"))


def placed(records: DataFrame) -> DataFrame:
    """Offset, length and SHA-256 of every record; records lie in order of page id. Only
    hashes are sorted, not the records, and a file has a bounded number of them."""
    order = Window.partitionBy("file").orderBy("page_id", "sha256").rowsBetween(Window.unboundedPreceding, 0)
    short = records.select(
        "file", "page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256")
    )
    return short.withColumn("offset", F.sum("length").over(order) - F.col("length"))


def tree(records: DataFrame, top: int) -> DataFrame:
    """Nodes of every file's tree: level (0: leaves, ``top``: root), file, node, sha256."""
    same = records.groupBy("file", "offset", "sha256").agg(F.count(F.lit(1)).alias("n"))
    level = same.groupBy("file", F.floor(F.col("offset") / RANGE).alias("node")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "sha256", "n"))).alias("parts")  # a range's records
    )
    level = level.select("file", "node", F.sha2(F.to_json("parts"), 256).alias("sha256"))
    levels = [level.withColumn("level", F.lit(0))]
    for height in range(1, top + 1):
        level = level.groupBy("file", F.floor(F.col("node") / FANOUT).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("node", "sha256"))).alias("parts")  # at most FANOUT
        )
        level = level.select("file", F.col("up").alias("node"), F.sha2(F.to_json("parts"), 256).alias("sha256"))
        levels.append(level.withColumn("level", F.lit(height)))
    out = levels[0]
    for one in levels[1:]:
        out = out.unionByName(one)
    return out


def height(*replicas: DataFrame) -> int:
    """Levels above the leaves until one range spans the longest file."""
    last = max((r.agg(F.max("offset")).first()[0] or 0) for r in replicas)
    top, span = 0, RANGE
    while span <= last:
        top, span = top + 1, span * FANOUT
    return top


def _differing(a: DataFrame, b: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Rows of either side whose hash the other side has not, by key."""
    a = a.select(*keys, F.col("sha256").alias("a"), *[F.col(v).alias(f"{v}_a") for v in values])
    b = b.select(*keys, F.col("sha256").alias("b"), *[F.col(v).alias(f"{v}_b") for v in values])
    return a.join(b, keys, "full").where(~F.col("a").eqNullSafe(F.col("b")))


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """Damage of ``replica``, one row per offset: file, offset, page_id, length (of the
    original; of the replica where only it has a record there) and damage: ``changed``,
    ``missing`` or ``extra``.

    Both have file, offset, length, page_id, sha256 as ``placed`` gives. A file that one side
    lacks is damaged throughout; two empty sides give no rows. Records that share an offset
    are compared by their hashes together. NULL files and offsets take no part.
    """
    sides = [
        staged(side.where("file IS NOT NULL AND offset IS NOT NULL"), "fixity-records")
        for side in (original, replica)
    ]
    top = height(*sides)
    trees = [staged(tree(side, top), "fixity-tree") for side in sides]
    at = [t.where(F.col("level") == top) for t in trees]
    bad = _differing(*at, ["file", "node"]).select("file", "node")
    for level in range(top - 1, -1, -1):
        parents = bad.select("file", F.col("node").alias("up"))
        at = [
            t.where(F.col("level") == level)
            .withColumn("up", F.floor(F.col("node") / FANOUT))
            .join(parents, ["file", "up"], "left_semi")
            for t in trees
        ]
        bad = _differing(*at, ["file", "node"]).select("file", "node")
    leaves = staged(bad, "fixity-leaves")
    found = []
    for side in sides:
        near = side.withColumn("node", F.floor(F.col("offset") / RANGE)).join(leaves, ["file", "node"], "left_semi")
        found.append(
            near.groupBy("file", "offset").agg(
                F.sha2(F.array_join(F.sort_array(F.collect_list("sha256")), " "), 256).alias("sha256"),
                F.min("page_id").alias("page_id"),
                F.min("length").alias("length"),
            )
        )
    damage = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return _differing(*found, ["file", "offset"], "page_id", "length").select(
        "file",
        "offset",
        F.coalesce("page_id_a", "page_id_b").alias("page_id"),
        F.coalesce("length_a", "length_b").alias("length"),
        damage.alias("damage"),
    )


def damaged_copy(records: DataFrame) -> DataFrame:
    """A replica with known faults, drawn by MD5 of the page id: one record in 256 has another
    hash, one in 256 is gone, and one in 256 has a stray record behind its first byte."""
    draw = F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2)
    kept = records.where(F.coalesce(draw != "b1", F.lit(True))).withColumn(
        "sha256", F.when(draw == "a0", F.sha2(F.concat("sha256", F.lit("!")), 256)).otherwise(F.col("sha256"))
    )
    stray = records.where(draw == "c2").withColumn("offset", F.col("offset") + 1).withColumn("length", F.lit(1).cast("long"))
    return kept.unionByName(stray)
