"""Byte-level BPE: texts to token ids and back.

A text is split by the tokenizer's pattern; distinct pieces are merged together in padded
matrices of pieces of similar length. In each round every row finds its leftmost pair of
lowest rank, merges it, and closes the gap; rows without a pair left leave the matrix. Pairs
are looked up in an open-addressing hash table of (left id, right id). Everything is local to
a batch of documents: nothing is shuffled. A worker keeps the ids of the pieces it has seen,
up to KEPT_PIECES, and forgets the less used half beyond; that changes its speed, never an id.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtally.llm.common import small_batches

KEPT_PIECES = 300_000
CELLS = 1 << 20  # of one matrix
LONG = 256  # longer pieces are merged with a queue of pairs instead of a matrix row
NONE = np.int32(2**31 - 1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) to the id of their merge, by hashing with linear probing."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32)
        slots = self._slot(keys)
        while len(keys):  # those that find their slot free settle, the others move on
            free = self.keys[slots] == -1
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            settle = free & first
            self.keys[slots[settle]], self.values[slots[settle]] = keys[settle], values[settle]
            keys, values, slots = keys[~settle], values[~settle], (slots[~settle] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where a pair does not merge (negative ids never do)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[open_]
        slots = self._slot(keys)
        flat = out.ravel()
        while len(open_):
            held = self.keys[slots]
            hit = held == keys
            flat[open_[hit]] = self.values[slots[hit]]
            on = ~hit & (held != -1)
            open_, keys, slots = open_[on], keys[on], (slots[on] + 1) & self.mask
        return flat.reshape(out.shape)


class Vocabulary:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.split = regex.compile(pattern).findall
        self.byte_id = np.full(256, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte_id[token[0]] = rank
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pairs, self.table = pairs, PairTable(pairs)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, np.int32), 0
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        self.uses = np.zeros(1 << 12, np.int64)

    def keep_hot(self) -> None:
        """Forget the half of the known pieces that was used least."""
        n = len(self.known)
        hot = np.sort(np.argpartition(-self.uses[:n], n // 2)[: n // 2])
        pieces = list(self.known)
        ids, ends = ragged(self.ids, self.start[hot], self.length[hot])
        lengths, uses = self.length[hot], self.uses[hot]
        self.forget()
        self._add([pieces[i] for i in hot.tolist()], ids, lengths)
        self.uses[: len(hot)] = uses

    def _add(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """New pieces with their ids, one after another; arrays grow by doubling."""
        at, end = len(self.known), len(self.known) + len(pieces)
        self.known.update(zip(pieces, range(at, end)))
        for name, least in (("start", end), ("length", end), ("uses", end), ("ids", self.n_ids + len(ids))):
            held = getattr(self, name)
            if len(held) < least:
                grown = np.zeros(max(2 * len(held), least), held.dtype)
                grown[: len(held)] = held
                setattr(self, name, grown)
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.start[at:end] = self.n_ids + np.cumsum(lengths) - lengths
        self.length[at:end] = lengths
        self.n_ids += len(ids)

    def learn(self, pieces: list[str]) -> None:
        """Merge pieces not seen before."""
        raw = [p.encode() for p in pieces]
        sizes = np.array([len(r) for r in raw])
        merged: list[np.ndarray | None] = [None] * len(raw)
        wide = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
        for width in np.unique(wide):
            rows = np.flatnonzero(wide == width)
            if width > LONG:
                for r in rows:
                    merged[r] = merge_long(self.byte_id[np.frombuffer(raw[r], np.uint8)], self.pairs)
                continue
            for part in np.array_split(rows, -(-len(rows) * width // CELLS)):
                padded = b"".join(raw[r].ljust(width, b"\0") for r in part)
                ids = self.byte_id[np.frombuffer(padded, np.uint8)].reshape(len(part), width)
                ids[np.arange(width) >= sizes[part][:, None]] = -1
                for r, row in zip(part, merge_rows(ids, self.table)):
                    merged[r] = row
        lengths = np.array([len(m) for m in merged], np.int64)
        self._add(pieces, np.concatenate(merged), lengths)

    def encode(self, texts: list[str | None]) -> pa.Array:
        """One list of ids per text; NULL is encoded as the empty text."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > KEPT_PIECES:
            self.keep_hot()
        counts = np.array([len(p) for p in split], np.int64)
        flat = list(chain.from_iterable(split))
        codes = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        missed = np.flatnonzero(codes < 0)
        if len(missed):
            unknown = [flat[i] for i in missed.tolist()]
            self.learn(list(dict.fromkeys(unknown)))
            codes[missed] = np.fromiter(map(self.known.__getitem__, unknown), np.int64, len(unknown))
        n = len(self.known)
        self.uses[:n] += np.bincount(codes, minlength=n)
        values, ends = ragged(self.ids, self.start[codes], self.length[codes])
        piece_ends = np.concatenate([[0], np.cumsum(counts)])
        offsets = np.concatenate([[0], ends])[piece_ends]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; NULL gives no bytes."""
        offsets = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(False))])
        flat = ids.flatten().to_numpy(False)
        values, ends = ragged(self.token_bytes, self.token_start[flat], self.token_length[flat])
        at = np.concatenate([[0], ends])[offsets].astype(np.int32)
        return pa.Array.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(values.tobytes())]
        )


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of ``values`` one after the other, and the end of each."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return values[:0], ends
    at = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
    return values[at], ends


def merge_rows(ids: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """Rows of ids (negative: padding) to their merged ids."""
    out: list[np.ndarray] = [None] * len(ids)
    where = np.arange(len(ids))
    ranks = table.find(ids[:, :-1], ids[:, 1:])
    while True:
        best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), int)
        lowest = ranks[np.arange(len(ids)), best] if ranks.shape[1] else np.full(len(ids), NONE)
        done = lowest == NONE
        for r in np.flatnonzero(done):
            out[where[r]] = ids[r][ids[r] >= 0]
        if done.all():
            return out
        go = ~done
        ids, ranks, where, best, lowest = ids[go], ranks[go], where[go], best[go], lowest[go]
        rows = np.arange(len(ids))
        columns = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, columns + (columns > best[:, None]), axis=1)
        ids[rows, best] = lowest
        columns = columns[:-1]
        ranks = np.take_along_axis(ranks, columns + (columns >= best[:, None]), axis=1)
        if not ranks.shape[1]:
            continue
        for beside in (best - 1, best):  # the pairs the new id is part of
            fit = (beside >= 0) & (beside < ranks.shape[1])
            r, c = rows[fit], beside[fit]
            ranks[r, c] = table.find(ids[r, c], ids[r, c + 1])


def merge_long(ids: np.ndarray, pairs: dict[tuple[int, int], int]) -> np.ndarray:
    """The same for one long piece, with a queue of (rank, place): n log n steps."""
    token = ids.tolist()
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(pairs[p], i) for i, p in enumerate(zip(token, token[1:])) if p in pairs]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i] if token[i] >= 0 else n
        if j >= n or pairs.get((token[i], token[j])) != rank:
            continue
        token[i], token[j] = rank, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            if (found := pairs.get((rank, token[after[j]]))) is not None:
                heapq.heappush(queue, (found, i))
        if before[i] >= 0 and (found := pairs.get((token[before[i]], rank))) is not None:
            heapq.heappush(queue, (found, before[i]))
    return np.array([t for t in token if t >= 0], np.int32)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read once per worker."""
    return Vocabulary(path, pattern)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids of each text, as an array; NULL and empty texts have none. ``path`` is a rank
    file every executor has (one line per token: base64 of its bytes, and its rank)."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return vocabulary(path, pattern).encode(texts.to_pylist())

    return ids(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes token ids stand for."""

    @F.arrow_udf("binary")
    def raw(lists: pa.Array) -> pa.Array:
        return vocabulary(path, pattern).decode(lists)

    return raw(ids)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every document's ``ids`` and the bytes ``decoded`` from them, after its own columns
    (as struct ``row``). Documents may repeat or be NULL; an empty table gives none. One call
    returns both: Spark would chain a call of ``decode`` to a second ``encode`` of the text."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def there_and_back(texts: pa.Array) -> pa.Array:
        known = vocabulary(path, pattern)
        ids = known.encode(texts.to_pylist())
        return pa.StructArray.from_arrays([ids, known.decode(ids)], ["ids", "decoded"])

    coded = docs.select(F.struct("*").alias("row"), there_and_back(docs["text"]).alias("coded"))
    return coded.select("row", "coded.ids", "coded.decoded")


def digests(tokens: DataFrame) -> DataFrame:
    """Count of ids, SHA-256 of the ids as text and of the decoded bytes, per document."""
    return tokens.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
