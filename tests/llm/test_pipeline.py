"""The whole pipeline against a direct computation of every stage in plain Python."""

import base64
import hashlib
import math
from collections import Counter, defaultdict

import tiktoken

import corpus_pipeline
from ringtally.llm.queries import tokenizer
from tests.llm.test_documents import CLASHING, brute_groups, near_copies, prose, repeated_words, split

NORTH, SOUTH = "abcdefgh", "mnopqrst"


def passes_rules(text):
    """The base rules; without labels no other rule is certified."""
    w = split(text)
    return len(w) >= 20 and 100 * repeated_words(w) <= 30 * len(w)


def taken_times(rows):
    """How often each document (id, text, source) is taken: water-filling, whole passes, and
    the seeded part of one pass more."""
    by = defaultdict(list)
    for row in rows:
        by[row[2]].append((int(hashlib.md5(f"7|{row[0]}".encode()).hexdigest()[:8], 16), row[0], len(split(row[1]))))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(x[2] for x in by[s]) for s in names}
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if 3 * sizes[s] < level * weight[s]}
        if more == full:
            break
        full = more
    times = {}
    for s in names:
        target = 3 * sizes[s] if s in full else level * weight[s]
        whole = math.floor(target / sizes[s])
        rest = math.floor(target - whole * sizes[s] + 0.5)
        so_far = 0
        for _, doc_id, size in sorted(by[s]):
            so_far += size
            times[doc_id] = whole + (2 * so_far - size <= 2 * rest)
    return times


def test_pipeline_against_direct_computation(spark, documents, tmp_path):
    texts = [prose(i, 25 + i, (NORTH, SOUTH)[i % 2]) for i in range(60)]  # two clear languages
    texts += near_copies(12) + [texts[4], texts[4].upper(), texts[7] + " mm"]
    texts += [None, "", "too short", "aa bb cc dd " * 12, " ".join(str(i) for i in range(40))]
    rows = [(i, t, ("so" if i % 2 and i < 60 else "no"), ("a", "a", "a", "b", None)[i % 5]) for i, t in enumerate(texts)]
    documents(*rows, more=CLASHING).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    good = [r for r in rows if passes_rules(r[1])]
    named = [r for r in good if any(c.isalpha() for c in r[1])]  # a text of digits has no language
    groups = brute_groups([r[:2] for r in named])
    once = [(r[0], r[1], r[3]) for r in named if groups[r[0]][1] == r[0]]
    assert len(rows) - len(good) == 4 and len(good) - len(named) == 1 and len(once) < len(named) - 3
    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    times = taken_times(once)
    for doc_id, text, _ in once:
        want[doc_id, tuple(library.encode_ordinary(text))] += times[doc_id]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in got)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == +want
