"""Quality rules whose cutoffs are certified on labelled documents.

Every rule rejects documents whose rate (say, symbols per word) is above a cutoff. For each
stratum (language) the rules are tested together, along PATH: it starts with the most lenient
cutoff of every rule in turn, then come the next ones. A step passes if, were the chance that
the rules so far reject a good document above ``risk``, so few rejections among the labelled
good ones would be less probable than the stratum's share of ``delta`` (an exact binomial
tail). Testing ends at the first failure, so the order, which is fixed, needs no correction;
only the strata share ``delta``. Any cutoffs no stricter than the last step reject less than it
does, so of these each rule takes the one that separates bad from good best; a rule that
rejects no more bad than good documents, or that testing did not reach, is off in that stratum.
With probability 1 - ``delta`` no stratum rejects more than ``risk`` of its good documents
beyond the base rules.

Trials have to be independent, so a trial is a distinct text of a stratum and not a row: copies
of one labelled text prove as much as the text alone. A text that rows label both good and bad
is a trial of either kind, so its rejection counts against the rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ringtally.llm.common import staged, words

RISK = 0.02
DELTA = 0.05
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words in repeated windows


@dataclass(frozen=True)
class Rule:
    """Rejects where ``part / of`` is above a cutoff; cutoffs from lenient to strict."""

    name: str
    part: str
    of: str
    cutoffs: tuple[float, ...]

    def rate(self) -> Column:
        return F.when(F.col(self.of) > 0, F.col(self.part) / F.col(self.of)).otherwise(0.0)


RULES = (
    Rule("symbols", "n_symbols", "n_words", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1)),
    Rule("dup_lines", "n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
    Rule("repeats", "n_repeat_words", "n_words", (0.28, 0.26, 0.24, 0.22, 0.2)),
    Rule("echoes", "n_echo_words", "n_words", (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
)
PATH = tuple((r, i) for i in range(max(len(r.cutoffs) for r in RULES)) for r in RULES if i < len(r.cutoffs))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echo_words")


def counted(docs: DataFrame, *keep: Column) -> DataFrame:
    """The counts of every whole text, beside the columns ``keep``.

    Repeated windows: each window of eight words is hashed (64 bits), windows are sorted by
    hash where a text has any twice, and the words they cover are summed from left to right,
    so a text takes n log n steps at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [f"k{i}" for i in range(len(keep))]
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        *[k.alias(n) for k, n in zip(keep, kept)],
        words(F.col("text")).alias("w"),
        lines.alias("lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    step = step.select(
        *kept,
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("h"),
    )
    n_windows = F.size("h") - (WINDOW - 1)
    windows = F.when(
        n_windows > 0,
        F.transform(
            F.sequence(F.lit(0), n_windows - 1),
            lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    echoes = F.when(
        F.size("h") > 1,
        F.size(
            F.filter(
                F.sequence(F.lit(1), F.size("h") - 1),
                lambda i: F.get(F.col("h"), i) == F.get(F.col("h"), i - 1),
            )
        ),
    ).otherwise(0)
    plain = [c for c in COUNTS if c not in ("n_repeat_words", "n_echo_words")]
    step = step.select(
        *kept, *plain, echoes.cast("long").alias("n_echo_words"), windows.alias("windows")
    )
    pairs = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    plain = [*plain, "n_echo_words"]
    step = step.select(*kept, *plain, pairs.alias("pairs"))

    def twin(x: Column, k: Column) -> Column:
        beside = [F.get(F.col("pairs"), k + d)["h"] == x["h"] for d in (-1, 1)]
        return F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False))

    found = F.transform(F.filter("pairs", twin), lambda x: x["i"])
    step = step.select(*kept, *plain, F.sort_array(found).alias("found"))

    def cover(state: Column, i: Column) -> Column:
        end = i + WINDOW
        return F.struct(
            (state["n"] + end - F.greatest(i, state["end"])).cast("long").alias("n"),
            end.cast("int").alias("end"),
        )

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("found", start, cover, lambda state: state["n"])
    return step.select(
        *kept,
        *plain,
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with chance p; 1 where k is at or above the mean, where no
    test passes. Terms follow from one another, as logarithms."""
    first = n * F.log(F.lit(1 - p))

    def add(state: Column, i: Column) -> Column:
        log = state["log"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"))

    start = F.struct(first.alias("log"), F.exp(first).alias("sum"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k < n * p, F.aggregate(steps, start, add, lambda s: s["sum"])).otherwise(1.0)


def certified(scores: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: its cutoff by rule (NULL: the rule is off there). ``scores`` has
    ``doc_id``, ``stratum``, ``text_key`` (a digest of the text) and the counts; ``labels`` has
    ``doc_id`` and ``quality`` (1 good, 0 bad, others unused). A document labelled both ways
    counts as bad."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held_out = scores.where(~base_failed()).join(known, "doc_id")
    # Counts follow from the text, so any row of a text will do.
    held_out = held_out.drop("doc_id").dropDuplicates(["stratum", "text_key", "quality"])
    tests = [(r, i, r.cutoffs[i]) for r, i in PATH]
    # The first step of the path that rejects the document.
    first = F.least(*[F.when(r.rate() > c, F.lit(place)) for place, (r, _, c) in enumerate(tests)])
    held_out = held_out.withColumn("first", first)
    good = F.col("quality") == 1
    sums = held_out.groupBy("stratum").agg(
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("bad"),
        *[F.count_if(good & (F.col("first") <= place)).alias(f"lost_{place}") for place in range(len(tests))],
        *[F.count_if(good & (r.rate() > c)).alias(f"good_{r.name}_{i}") for r, i, c in tests],
        *[F.count_if(~good & (r.rate() > c)).alias(f"bad_{r.name}_{i}") for r, i, c in tests],
    )
    sums = staged(sums, "quality-sums")
    share = delta / max(1, sums.count())
    rows = sums.select(
        "stratum",
        "good",
        "bad",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(place).alias("step"),
                        F.col(f"lost_{place}").alias("lost"),
                        F.lit(c).alias("cutoff"),
                        F.col(f"good_{r.name}_{i}").alias("good_lost"),
                        F.col(f"bad_{r.name}_{i}").alias("bad_lost"),
                    )
                    for place, (r, i, c) in enumerate(tests)
                ]
            )
        ),
    )
    passed = binomial_tail(F.col("lost"), F.col("good"), risk) <= share
    # As many rows per window as the path has steps.
    so_far = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    gain = F.col("bad_lost") / F.greatest("bad", F.lit(1)) - F.col("good_lost") / F.greatest("good", F.lit(1))
    return (
        rows.withColumn("passed", passed)
        .withColumn("passed", F.min("passed").over(so_far))
        .withColumn("gain", gain)
        .where("passed AND gain > 0")
        .groupBy("stratum")
        .agg(
            *[
                F.max_by(
                    F.when(F.col("rule") == r.name, F.col("cutoff")),
                    F.when(F.col("rule") == r.name, F.struct("gain", -F.col("step"))),
                ).alias(f"cutoff_{r.name}")
                for r in RULES
            ]
        )
    )


def judged(docs: DataFrame, labels: DataFrame, carry: bool = False, **options) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``.

    A NULL text has no words and fails the base rules, as an empty one does. A NULL language
    is a stratum of its own. Documents may repeat; each row is judged. Without labels (or
    too few) no rule beyond the base rules rejects. With ``carry`` the result also has
    ``row``, the document with all its columns.
    """
    key = F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    keep = [F.col("doc_id"), F.col("lang"), key, *([F.struct("*")] if carry else [])]
    names = ["doc_id", "stratum", "text_key", *(["row"] if carry else [])]
    scores = counted(docs, *keep).withColumnsRenamed({f"k{i}": n for i, n in enumerate(names)})
    scores = staged(scores, "quality-scores")
    cutoffs = certified(scores.drop("row"), labels, **options).withColumnRenamed("stratum", "of")
    joined = scores.join(cutoffs, scores["stratum"].eqNullSafe(cutoffs["of"]), "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected |= F.coalesce(rule.rate() > F.col(f"cutoff_{rule.name}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~rejected
    ).drop("of", "text_key")


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents the rules keep, in the columns of ``docs``."""
    return judged(docs, labels, carry=True, **options).where("kept").select("row.*")
