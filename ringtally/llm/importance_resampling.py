"""Importance resampling towards a target distribution over hashed word features.

A feature is a word or two consecutive words, and its bucket is a CRC of its bytes. Documents
whose buckets are more frequent in the target than in the corpus weigh more; Gumbel noise by
document id turns the highest scores into a draw without replacement.

The vocabulary has a head and a tail. The head, a bounded number of words and pairs that are
frequent in the corpus, is broadcast: for a word the CRC state after it and a blank, from which
a pair is continued, and its bucket, for a pair its bucket. Features outside the head take the
CRC of their bytes. Both give the same buckets, so the head decides only on time, and bucket
totals are exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtally.llm.common import byte_bound, ranged, staged

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
# A feature belongs to the head if its share of all words reaches this, so the head has at most
# 40,000 words and as many pairs. It then has that share in some window of every partitioning,
# and windows report no others.
HEAD_SHARE = 2.5e-5
WINDOW = 400_000  # words

# Bytes of words in UTF-8 after A-Z became a-z: digits, letters, all beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _words(raw: bytes | None) -> list[bytes]:
    return WORD.findall(raw.lower()) if raw else []


def _frequent(batches: Iterator[pd.DataFrame], share: float) -> Iterator[pd.DataFrame]:
    """Words (``second`` is empty) and pairs that reach the head's share in a window of texts,
    and the number of all words (both are empty)."""
    words, pairs, n = Counter(), Counter(), 0

    def window():
        least = n * share
        rows = [(b"", b"", n)]
        rows += [(w, b"", k) for w, k in words.items() if k >= least]
        rows += [(*p, k) for p, k in pairs.items() if k >= least]
        return pd.DataFrame(rows, columns=["first", "second", "n"])

    for batch in batches:
        for raw in batch["text"]:
            found = _words(raw)
            words.update(found)
            pairs.update(zip(found, found[1:]))
            n += len(found)
            if n >= WINDOW:
                yield window()
                words, pairs, n = Counter(), Counter(), 0
    yield window()


class Head:
    """CRC states and buckets of frequent words, buckets of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.number = {w: i for i, w in enumerate(words)}
        self.word_bucket = np.array([zlib.crc32(w) % buckets for w in words] or [0], np.int64)
        self.state = [zlib.crc32(w + b" ") for w in words]
        known = [p for p in pairs if p[0] in self.number and p[1] in self.number]
        keys = np.array([self._key(self.number[a], self.number[b]) for a, b in known] or [-1], np.int64)
        found = np.array([zlib.crc32(a + b" " + b) % buckets for a, b in known] or [0], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_bucket = keys[order], found[order]

    @staticmethod
    def _key(first, second):
        return first << 32 | second

    def features(self, words: list[bytes]) -> np.ndarray:
        """Buckets of all words, then of all pairs."""
        n = len(words)
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, n)
        single = self.word_bucket[ids]
        for i in np.flatnonzero(ids < 0).tolist():
            single[i] = zlib.crc32(words[i]) % self.buckets
        first, second = ids[:-1], ids[1:]
        keys = np.where((first >= 0) & (second >= 0), self._key(first, second), -2)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        double, crc, state = self.pair_bucket[at], zlib.crc32, self.state
        tail = np.flatnonzero(self.pair_keys[at] != keys)
        double[tail] = [
            crc(words[i + 1], state[k] if k >= 0 else crc(words[i] + b" "))
            for i, k in zip(tail.tolist(), first[tail].tolist())
        ]
        double[tail] %= self.buckets
        return np.concatenate([single, double]) if n else single


def head(docs: DataFrame, buckets: int = BUCKETS, share: float = HEAD_SHARE) -> Head:
    """The frequent words and pairs of all documents; the share bounds their number."""
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    counts = staged(
        texts.mapInPandas(lambda b: _frequent(b, share), "first binary, second binary, n long")
        .groupBy("first", "second")
        .agg(F.sum("n").alias("n")),
        "resampling-head",
    )
    is_total = F.length("first") == 0
    total = counts.where(is_total).agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(~is_total & (F.col("n") >= total * share)).select("first", "second").collect()
    features = [(bytes(r["first"]), bytes(r["second"])) for r in frequent]
    return Head([a for a, b in features if not b], [f for f in features if f[1]], buckets)


def featured(docs: DataFrame, known: Head, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``n_features`` and ``features``, four bytes for
    the bucket of each."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    schema = docs.select(*keep).schema.add("n_words", "long").add("n_features", "long")

    def code(batches):
        coder = shared.value
        for batch in batches:
            found = [_words(raw) for raw in batch.pop("resampled_text")]
            coded = [coder.features(words) for words in found]
            batch["n_words"] = [len(words) for words in found]
            batch["n_features"] = [len(c) for c in coded]
            batch["features"] = [c.astype("<u4").tobytes() for c in coded]
            yield batch

    texts = docs.select(*keep, F.col("text").cast("binary").alias("resampled_text"))
    return texts.mapInPandas(code, schema.add("features", "binary"))


def bucket_totals(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """How many features each bucket holds; buckets without any are left out."""

    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch["features"]:
                sums += np.bincount(np.frombuffer(raw, "<u4"), minlength=buckets)
        filled = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": filled, "n": sums[filled]})

    counts = features.select("features").mapInPandas(count, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) by bucket, in doubles."""

    def counted(totals):
        out = np.zeros(buckets)
        for r in totals.collect():  # a row per bucket at most
            out[r["bucket"]] = r["n"]
        return out

    s, t = counted(corpus), counted(target)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(seed: int = SEED) -> Column:
    """Gumbel noise by document id, in thousandths, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(features: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """Adds ``weight``, the floored mean gain of a document's features (0 without any), and
    ``score``, the weight with noise."""
    shared = features.sparkSession.sparkContext.broadcast(gain)

    @F.pandas_udf("long")
    def weight(raws: pd.Series) -> pd.Series:
        table = shared.value
        sums = [(int(table[np.frombuffer(r, "<u4")].sum()), len(r) // 4) for r in raws]
        return pd.Series([total // n if n else 0 for total, n in sums], dtype="int64")

    found = features.withColumn("weight", weight("features")).drop("features")
    return found.withColumn("score", F.col("weight") + noise(seed))


def ranked(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds ``rank`` from 1 to the floor of ``percent`` of the documents with enough words; NULL
    for the others. Documents are sorted in ranges of scores, and each range is numbered on from
    the ranges before it, so no task sees more than its range."""
    eligible = F.col("n_words") >= least_words
    order = [
        eligible.desc(), F.col("score").desc(),
        F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(),
    ]
    rows = ranged(scores, order, "resampling-ranges")
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (  # a row per range
        rows.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(eligible).alias("eligible"))
        .select(
            "part",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
            F.floor(F.sum("eligible").over(every) * percent / 100).alias("draws"),
        )
    )
    rank = F.col("start") + F.col("at") + 1
    return (
        rows.join(F.broadcast(starts), "part")
        .withColumn("rank", F.when(eligible & (rank <= F.col("draws")), rank))
        .drop("part", "at", "start", "draws")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    head_share: float = HEAD_SHARE,
) -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``; other columns are not read.
    A NULL or empty text has no features and weighs 0. A NULL id gets the noise of an empty
    one and comes last among equal scores. Rows that repeat a document are documents of their
    own, with ranks of their own. Without documents the result is empty; without target texts
    all buckets count alike there.
    """
    byte_bound(docs.sparkSession)
    known = head(docs, buckets, head_share)
    features = staged(featured(docs, known, ["doc_id"]), "resampling-features")
    gain = gains(bucket_totals(features, buckets), bucket_totals(featured(target, known, []), buckets), buckets)
    return ranked(weighted(features, gain, seed), percent, least_words)


def resampled_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    drawn = resample(docs, target, **options).where("rank IS NOT NULL")
    ids = drawn.select(F.col("doc_id").alias("drawn_id")).distinct()
    same = docs["doc_id"].eqNullSafe(ids["drawn_id"])
    return docs.join(ids, same, "left_semi")
