"""Groups of spelling variants: words one inserted, deleted or replaced code point apart.

Search schemes over a bidirectional FM-index. An error leaves one half of a word untouched, so
one scheme matches the left half exactly and goes on to the right, the other matches the right
half exactly and goes on to the left, both allowing one error in the other half. Each starts at
the delimiter before or after the word, so it moves one way only: the left-going scheme through
the index of the delimited vocabulary, the right-going one through the index of its mirror
image. States are intervals of suffix ranks; a state that has taken both delimiters holds one
suffix, whose rank is the number of the word.

The vocabulary is dealt out by (length of the exact half, that half). A word of m code points
can be near words of m - 1 to m + 1, whose halves have two different lengths, so it goes to two
places for each scheme, and a searched word to the one place of its own half. Places are packed
into blocks of about BLOCK letters; a place that would exceed that is split, and its searched
words visit all its parts. A block builds its index and searches for all its words at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtally.llm.common import byte_bound, staged

LEAST_LENGTH, LEAST_COUNT = 5, 3
FORM_RATIO = 2  # a form is at least so many times as frequent
BLOCK = 100_000  # letters of an index
STATES = 1 << 20  # rows of an index looked at in one step

RUN = re.compile("[a-zÀ-ÿ]+")


def _spelled(run: str, doc_id: str, every: int) -> str:
    """The run, less one code point where the checksum of document and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def _counts(batches: Iterator[pd.DataFrame], every: int, least_length: int) -> Iterator[pd.DataFrame]:
    words: Counter = Counter()

    def found():
        return pd.DataFrame({"word": pd.Series(list(words), dtype=object), "n": list(words.values())})

    for batch in batches:
        for doc_id, raw in zip(batch["doc_id"], batch["text"]):
            runs = Counter(RUN.findall(raw.lower().decode("utf-8", "replace"))) if raw else {}
            for run, n in runs.items():
                word = _spelled(run, doc_id, every)
                if len(word) >= least_length:
                    words[word] += n
            if len(words) >= 500_000:
                yield found()
                words.clear()
    yield found()


def vocabulary(
    docs: DataFrame, every: int = 97, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word`` and its occurrences ``n`` over all documents. One in ``every`` pairs of document
    and run of letters loses a code point; A-Z are lower-cased."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )
    parts = texts.mapInPandas(lambda b: _counts(b, every, least_length), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class SuffixRanks:
    """FM-index of sorted, distinct words, each after a delimiter (0) that sorts before letters.

    ``step`` maps an interval of suffix ranks to that of the suffixes one code to the left.
    """

    def __init__(self, words: list[str]):
        self.n = len(words)
        points = np.frombuffer("".join("\0" + w for w in words).encode("utf-32-le"), "<u4")
        self.letters = np.unique(points)
        text = np.searchsorted(self.letters, points)
        order = self._sorted_suffixes(text)
        bwt = text[order - 1]  # the code before each suffix; the text is read as a ring
        self.size = len(text)
        # Sorted by code and rank, so that the place of (code, rank) is the rank one code to the left.
        self.places = np.sort(bwt * self.size + np.arange(self.size))
        self.bwt = bwt
        self.left = np.empty(self.size, np.int64)
        self.left[np.argsort(bwt, kind="stable")] = np.arange(self.size)

    def _sorted_suffixes(self, text: np.ndarray) -> np.ndarray:
        """Prefix doubling. Delimiters rank as the words they start, so that equal endings are
        in the order of what follows and ranks are final after the longest word."""
        starts = text == 0
        rank = text + self.n
        rank[starts] = np.arange(self.n)
        step, size = 1, len(text)
        while True:
            key = rank * (size + self.n + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            ahead = key[order]
            distinct = np.concatenate([[0], np.cumsum(ahead[1:] != ahead[:-1])])
            rank = np.empty(size, np.int64)
            rank[order] = distinct
            if distinct[-1] == size - 1:
                return order
            step *= 2

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words one after another, -1 for letters unknown here, and their starts."""
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        found = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        codes = np.where(self.letters[found] == points, found, -1)
        return codes, np.concatenate([[0], np.cumsum(lengths)])

    def step(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = code * self.size
        return np.searchsorted(self.places, base + low), np.searchsorted(self.places, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray):
        """All letters to the left of intervals: which interval, letter, interval one to the left."""
        width = high - low
        of = np.repeat(np.arange(len(low)), width)
        at = np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width) + low[of]
        key, first, n = np.unique(of * len(self.letters) + self.bwt[at], return_index=True, return_counts=True)
        start = self.left[at[first]]
        letter = key % len(self.letters)
        inner = letter > 0
        return (key // len(self.letters))[inner], letter[inner], start[inner], (start + n)[inner]


def _halves(words: list[str], exact: np.ndarray, index: SuffixRanks) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (searched word, number of a word in the index) that differ by one error before the
    last ``exact`` code points of the searched word."""
    codes, starts = index.codes(words)
    found: list[np.ndarray] = []

    def take(q, left, low, high):
        """Take the next code of the searched words; states without suffixes end."""
        code = codes[starts[q] + left - 1]
        ok = code >= 0
        q, left = q[ok], left[ok] - 1
        low, high = index.step(code[ok], low[ok], high[ok])
        ok = low < high
        return q[ok], left[ok], low[ok], high[ok]

    def spawn(q, left, low, high):
        """States one error further on."""
        of, letter, start, end = index.branches(low, high)
        rest = left[of]
        inserted = q[of], rest, start, end
        other = (rest > 0) & (letter != codes[starts[q[of]] + rest - 1])
        replaced = q[of][other], rest[other] - 1, start[other], end[other]
        some = left > 0
        deleted = q[some], left[some] - 1, low[some], high[some]
        return [inserted, replaced, deleted]

    def merged(states):
        return tuple(np.concatenate(x) for x in zip(*states))

    # States without an error, and states after it; all go one code on in each round.
    clean = np.arange(len(words)), np.diff(starts), np.zeros(len(words), np.int64), np.full(len(words), index.n)
    erred = tuple(x[:0] for x in clean)
    while len(clean[0]) or len(erred[0]):
        q, left, low, high = erred
        done = left == 0
        first, after = index.step(np.zeros(done.sum(), np.int64), low[done], high[done])
        hit = first < after
        found.append(np.stack([q[done][hit], first[hit]], 1))
        states = [take(*(x[~done] for x in erred))]
        q, left, low, high = clean
        matched = starts[q + 1] - starts[q] - left
        ready = np.flatnonzero(matched >= exact[q])
        for part in _parts(ready, (high - low)[ready]):
            states += spawn(*(x[part] for x in clean))
        erred = merged(states)
        clean = take(*(x[left > 0] for x in clean))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    keys = np.unique(pairs[:, 0] * index.n + pairs[:, 1])
    return keys // index.n, keys % index.n


def _parts(rows: np.ndarray, widths: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of rows whose widths add up to about STATES."""
    if len(rows):
        cut = np.flatnonzero(np.diff(np.cumsum(widths) // STATES)) + 1
        yield from np.split(rows, cut)


def search_block(block: pd.DataFrame) -> pd.DataFrame:
    """For the searched words of a block: how many words of the block are near them by the
    block's scheme, and the most frequent of those."""
    columns = ["word", "n_near", "best_n", "best"]
    to_right = bool(block["to_right"].iloc[0])
    queries = sorted(set(block["word"][block["searched"]]))
    stored = block[~block["searched"]].drop_duplicates("word")
    if not queries or not len(stored):
        return pd.DataFrame([], columns=columns)
    turned = (lambda w: w[::-1]) if to_right else (lambda w: w)
    names = sorted(stored["word"])
    n_of = dict(zip(stored["word"], stored["n"]))
    keys = sorted((turned(w), i) for i, w in enumerate(names))
    index = SuffixRanks([k for k, _ in keys])
    number = np.array([i for _, i in keys])
    lengths = np.array([len(w) for w in queries])
    halves = lengths // 2
    of, rank = _halves([turned(w) for w in queries], halves if to_right else lengths - halves, index)
    of, near = of, number[rank]
    if not to_right and len(of):  # equal left halves are the other scheme's
        fresh = [not names[v].startswith(queries[q][: len(queries[q]) // 2]) for q, v in zip(of.tolist(), near.tolist())]
        of, near = of[fresh], near[fresh]
    if not len(of):
        return pd.DataFrame([], columns=columns)
    n = np.array([n_of[w] for w in names])[near]
    order = np.lexsort((near, -n, of))
    of, near, n = of[order], near[order], n[order]
    query, first, count = np.unique(of, return_index=True, return_counts=True)
    return pd.DataFrame(
        {
            "word": pd.Series([queries[q] for q in query.tolist()], dtype=object),
            "n_near": count,
            "best_n": n[first],
            "best": pd.Series([names[v] for v in near[first].tolist()], dtype=object),
        }
    )


def _places(vocabulary: DataFrame) -> DataFrame:
    """Rows of words to store and words to search, by scheme and exact half."""
    size = F.length("word")
    left = F.expr("length(word) div 2")

    def halves(m):
        return F.floor(m / 2).cast("int")

    def place(to_right, half):
        """``half`` is the length of the left half; the right half is what the length leaves."""
        return F.struct(F.lit(to_right).alias("to_right"), half.alias("half"))

    def stored(to_right, m):
        half = halves(m)
        return place(to_right, half if to_right else m.cast("int") - half)

    spots = [stored(True, size + d) for d in (-1, 0, 1)] + [stored(False, size + d) for d in (-1, 0, 1)]
    own = [place(True, left.cast("int")), place(False, (size - left).cast("int"))]
    every = vocabulary.select(
        "word", "n", F.explode(F.array_distinct(F.array(*spots))).alias("spot"), F.lit(False).alias("searched")
    ).unionByName(
        vocabulary.select("word", "n", F.explode(F.array(*own)).alias("spot"), F.lit(True).alias("searched"))
    )
    text = F.when(F.col("spot.to_right"), F.expr("left(word, spot.half)")).otherwise(F.expr("right(word, spot.half)"))
    return every.select(
        "word", "n", "searched", F.col("spot.to_right").alias("to_right"),
        F.xxhash64("spot.to_right", "spot.half", text).alias("place"),
    )


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """Searched words with the number of words near them (``n_near``) and the most frequent of
    those; a word has a row for each part that holds any."""
    places = staged(_places(vocabulary), "variants-places")
    stored = places.where("NOT searched").select("place", F.length("word").alias("size"))
    sizes = stored.groupBy("place").agg(F.sum("size").alias("size"))
    large = sizes.where(F.col("size") > block).select(
        "place", F.ceil(F.col("size") / block).cast("int").alias("split")
    )
    bins = max(1, -(-(stored.agg(F.sum("size")).first()[0] or 0) // block))
    parts = places.join(large, "place", "left").withColumn("split", F.coalesce("split", F.lit(1)))
    # A split place becomes a grid: stored words know their column, searched words their row.
    mine = F.pmod(F.xxhash64("word", F.lit(1)), F.col("split")).cast("int")
    grid = parts.withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0, split - 1)")))
    column = F.when(F.col("searched"), F.col("other")).otherwise(F.col("mine"))
    row = F.when(F.col("searched"), F.col("mine")).otherwise(F.col("other"))
    bin_of = F.when(F.col("split") == 1, F.pmod("place", F.lit(bins))).otherwise(F.col("place"))
    blocks = grid.select("word", "n", "searched", "to_right", bin_of.alias("bin"), column.alias("c"), row.alias("r"), "split")
    return blocks.groupBy("to_right", "bin", "c", "r", F.col("split") > 1).applyInPandas(
        search_block, "word string, n_near long, best_n long, best string"
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``, the end of the chain of forms. A form is at least twice as frequent, so
    chains are short; each pass doubles the steps taken and is written."""
    links = staged(forms.where("form IS NOT NULL").select("word", F.col("form").alias("to")), "variants-links")
    while True:
        ahead = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        stepped = staged(
            links.join(ahead, "to", "left").select(
                "word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")
            ),
            "variants-roots",
        )
        links = stepped.select("word", "to")
        if stepped.where("moved").isEmpty():
            break
    roots = links.select("word", F.col("to").alias("root"))
    return forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, every: int = 97, block: int = BLOCK) -> DataFrame:
    """Every word of the vocabulary: ``word``, ``form`` (its most frequent near word, ties to the
    smallest, if at least twice as frequent), ``root``, ``n``, ``n_near``, ``form_n``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A NULL text has no words,
    a NULL id counts as an empty one, rows that repeat count again. Without words of enough
    letters and occurrences the result is empty.
    """
    byte_bound(docs.sparkSession)
    words = staged(vocabulary(docs, every), "variants-vocabulary")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<n:long,word:string>").alias("best"))
    near = near_words(words, block).select(
        "word", F.lit(None).cast("long").alias("n"), "n_near",
        F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")).alias("best"),
    )
    merged = none.unionByName(near).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    is_form = -F.col("best.n") >= FORM_RATIO * F.col("n")
    forms = staged(
        merged.select(
            "word", F.when(is_form, F.col("best.word")).alias("form"), "n", "n_near",
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "variants-forms",
    )
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
