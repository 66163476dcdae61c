"""Languages of a document as a mixture, by expectation-maximisation.

The model is one distribution of letter trigrams (hashed into BUCKETS) per language, counted
over all labelled training documents. A document's trigrams are taken as drawn from a mixture
of these. It starts with the likeliest single language; the language whose addition raises
the likelihood fastest is tried next, the proportions are found by EM, and it stays if the
log likelihood gains more than the penalty, PENALTY x log(trigrams) / 2. The document's
language is the one with the largest proportion, which is its score.

The model has languages x BUCKETS numbers, whatever the number of documents; counting adds up
in each task before the one shuffle. Driver and workers hold AT_ONCE languages at a time. With
more of them (say, a column of dirty values), blocks of AT_ONCE languages take turns to offer
each text its next language, and every text carries its mixture so far from pass to pass: the
same mixtures, at the price of blocks x rounds passes over the texts still open.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.llm.common import ranged, small_batches, staged

BUCKETS = 1 << 16
AT_ONCE = 256
SMOOTHING = 0.05
PENALTY = 6.0
ROUNDS = 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the trigrams around each letter of a text, other characters as space."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    points = np.where(is_letter, points, 32).astype(np.uint64)
    mixed = points[:-2] * np.uint64(0x9E3779B1) ^ points[1:-1] * np.uint64(0x85EBCA77C2B2AE63)
    mixed = (mixed ^ points[2:] * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x165667B19E3779F9)
    return (mixed >> np.uint64(48)).astype(np.int64)[is_letter[1:-1]]


@dataclass
class Growing:
    """A text's mixture while it grows: the languages so far with their shares and their chances
    of the text's trigrams, and the best language offered for the next step."""

    languages: list[str] = field(default_factory=list)
    shares: np.ndarray = field(default_factory=lambda: np.zeros(0))
    parts: np.ndarray | None = None  # distinct trigrams x languages
    mixed: np.ndarray | None = None  # chances by the mixture
    likelihood: float = 0.0
    offer: tuple[float, str, np.ndarray] | None = None
    done: bool = False

    def consider(self, languages: list[str], chance: np.ndarray, n: np.ndarray) -> None:
        """Offers the best of ``languages``: at first the likeliest, then the one that raises the
        likelihood fastest."""
        if self.languages:
            merit = (n / self.mixed) @ chance / n.sum()
            merit[[i for i, lang in enumerate(languages) if lang in self.languages]] = 0
        else:
            merit = n @ np.log(chance)
        at = int(merit.argmax())
        if self.offer is None or merit[at] > self.offer[0]:
            self.offer = (float(merit[at]), languages[at], chance[:, at].copy())

    def settle(self, n: np.ndarray) -> None:
        """Takes the offer, or ends if it does not gain more than the penalty."""
        if self.offer is None:
            self.done = True
            return
        (merit, language, column), self.offer = self.offer, None
        if not self.languages:
            self.languages, self.shares, self.likelihood = [language], np.ones(1), merit
            self.parts, self.mixed = column[:, None], column
            return
        total = n.sum()
        self.done = merit <= 1
        if self.done:
            return
        parts = np.column_stack([self.parts, column])
        shares = np.append(self.shares * 0.9, 0.1)
        for _ in range(ROUNDS):
            weighted = parts * shares
            shares = (n / weighted.sum(axis=1)) @ weighted / total
        mixed = parts @ shares
        likelihood = float(n @ np.log(mixed))
        self.done = likelihood - self.likelihood <= PENALTY * np.log(total) / 2
        if not self.done:
            self.languages = [*self.languages, language]
            self.shares, self.parts, self.mixed, self.likelihood = shares, parts, mixed, likelihood

    def found(self) -> tuple[str, float, str]:
        """Leading language, its share, and the mixture as text."""
        mix = sorted(zip(self.languages, self.shares.tolist()), key=lambda x: (-x[1], x[0]))
        first = mix[0] if mix else (UNKNOWN, 0.0)
        return first[0], min(1.0, first[1]), " ".join(f"{k}:{v:.4f}" for k, v in mix)


@dataclass
class Model:
    languages: list[str]
    chances: np.ndarray  # buckets x languages

    def mixture(self, text: str | None) -> Growing:
        """The languages found; none for a text without letters."""
        growing = Growing()
        grams = trigrams(text)
        if len(grams) and self.languages:
            seen, n = np.unique(grams, return_counts=True)
            chance = self.chances[seen]
            while not growing.done and len(growing.languages) < len(self.languages):
                growing.consider(self.languages, chance, n)
                growing.settle(n)
        return growing


def in_training() -> Column:
    """CRC-32 of the document id, as text, modulo 5; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def counts(docs: DataFrame) -> DataFrame:
    """Trigram counts per language and bucket. Each task adds up its own rows first."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def flush():
            for lang, n in sums.items():
                bucket = np.flatnonzero(n)
                yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": n[bucket]})
            sums.clear()

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                if lang not in sums and len(sums) >= 64:
                    yield from flush()
                n = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for text in texts:
                    n += np.bincount(trigrams(text), minlength=BUCKETS)
        yield from flush()

    found = docs.select("lang", "text").mapInPandas(add, "lang string, bucket long, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def model(rows: DataFrame) -> Model:
    """The languages of ``rows`` (lang, bucket, n), AT_ONCE of them at most."""
    rows = rows.toPandas()
    languages = sorted(rows["lang"].unique())
    table = np.zeros((BUCKETS, len(languages)))
    where = {lang: i for i, lang in enumerate(languages)}
    table[rows["bucket"].to_numpy(int), rows["lang"].map(where).to_numpy(int)] = rows["n"]
    table += SMOOTHING
    return Model(languages, table / table.sum(axis=0))


def blocks(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` by blocks of AT_ONCE languages at most, in order of the languages. The driver
    sees a row per block."""
    named = ranged(rows.select("lang").distinct(), [F.col("lang")], "languages")
    named = named.select("lang", "part", F.floor(F.col("at") / AT_ONCE).alias("block"))
    for part, block in sorted(map(tuple, named.select("part", "block").distinct().collect())):
        inside = named.where((F.col("part") == part) & (F.col("block") == block))
        yield rows.join(inside.select("lang"), "lang", "left_semi")


FOUND = "lang_pred string, score double, mixture string"


def identify(docs: DataFrame, known: Model) -> DataFrame:
    """Adds ``found``: lang_pred, score and the mixture as text. Only the text decides."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = [shared.value.mixture(text).found() for text in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "mixture"])

    return docs.withColumn("found", find("text"))


def identify_by_blocks(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """What ``identify`` returns, with one block of languages in memory at a time."""
    parts = list(blocks(rows))
    columns, settled = docs.columns, []
    open_docs = docs.withColumn("state", F.lit(None).cast("binary"))
    while True:
        for i, part in enumerate(parts):
            step = advanced(open_docs, model(part), last=i == len(parts) - 1)
            open_docs = staged(step, "languages-open")
        ended = open_docs.where("found IS NOT NULL").select(*columns, "found")
        settled.append(ended)
        open_docs = open_docs.where("found IS NULL").drop("found")
        if open_docs.isEmpty():
            break
    out = settled[0]
    for one in settled[1:]:
        out = out.unionByName(one)
    return out


def advanced(docs: DataFrame, known: Model, last: bool) -> DataFrame:
    """Every text's ``state`` after the offers of a block; the last block of a round settles,
    and mixtures that ended get ``found``."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf(f"state binary, found struct<{FOUND.replace(' ', ':').replace(',:', ',')}>")
    def advance(texts: pd.Series, states: pd.Series) -> pd.DataFrame:
        out = []
        for text, state in zip(texts, states):
            growing = Growing() if state is None else pickle.loads(state)
            grams = trigrams(text)
            seen, n = np.unique(grams, return_counts=True)
            if len(grams):
                growing.consider(shared.value.languages, shared.value.chances[seen], n)
            if last:
                growing.settle(n)
            found = dict(zip(("lang_pred", "score", "mixture"), growing.found())) if growing.done else None
            out.append((pickle.dumps(growing), found))
        return pd.DataFrame(out, columns=["state", "found"])

    others = [c for c in docs.columns if c != "state"]
    step = docs.withColumn("step", advance("text", "state"))
    return step.select(*others, "step.state", *(["step.found"] if last else []))


def languages(docs: DataFrame) -> DataFrame:
    """Every document with ``held_out`` and its prediction, learned from the documents that
    are not held out. A language without any letter in its training texts is not learned. A
    NULL text, or one without a letter, is ``und`` with score 0, as is
    everything if nothing could be learned. A NULL id is neither held out nor learned from.
    Repeated rows are predicted alike. ``row`` is the document with all its columns."""
    small_batches(docs.sparkSession)
    fold = in_training()
    learned = docs.where(fold != 0).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = staged(counts(learned.select("lang", "text")), "language-counts")
    rows = docs.select("text", F.struct("*").alias("row"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    few = sums.select("lang").distinct().count() <= AT_ONCE
    found = identify(rows, model(sums)) if few else identify_by_blocks(rows, sums)
    return found.select("row", "held_out", "found.*")


def identified_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents with a language that makes up at least ``least`` of them, in the columns of
    ``docs``; others are rejected."""
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    return languages(docs).where(kept).select("row.*")
