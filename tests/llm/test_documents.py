"""Operators over documents against direct computations on small inputs."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from ringtally.llm import byte_bpe, kd_sharding, language_mixture, mixing, near_dedup, quality_rules
from ringtally.llm.queries import tokenizer

CLASHING = "size taken shard slot row node text_key n_words kept stratum found ids component u bin"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n, letters="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture
def mixed(documents):
    rows = [(i, prose(i % 30, 5 + i % 40), ("en", "de", None)[i % 3], f"s{i % 4}" if i % 5 else None) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \t "), (None, "no id at all"), (103, prose(9, 9000)), rows[7]]
    return documents(*rows, more=CLASHING)


def test_shards_hold_even_bytes(mixed):
    rows = kd_sharding.kd_shards(mixed.where("doc_id != 103"), 5).collect()
    assert len(rows) == mixed.count() - 2  # the long one, and the NULL id the filter drops
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    assert set(sums) == set(range(5))
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r.size for r in rows)
    for s in sums:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_shards_keep_every_row(mixed):
    rows = kd_sharding.kd_shards(mixed, target_bytes=3000).collect()
    assert len(rows) == mixed.count()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))


def test_mix_meets_targets(mixed):
    rows = mixing.mix(mixed).collect()
    assert len(rows) == mixed.count()
    source = {r.doc_id: r.source for r in mixed.collect()}
    by = {}
    for r in rows:
        by.setdefault((source[r.doc_id], r.target), []).append(r)
    total = sum(r.size for r in rows)
    names = sorted({s for s in source.values() if s is not None}) + [None]
    sizes = {s: sum(r.size for r in rows if source[r.doc_id] == s) for s in names}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if 3 * sizes[s] < level * weight[s]}
        if more == full:
            break
        full = more
    for (s, target), part in by.items():
        assert target == pytest.approx(3 * sizes[s] if s in full else level * weight[s])
        assert abs(sum(r.taken for r in part) - target) <= max(r.size for r in part)
        assert all(r.taken % r.size == 0 if r.size else r.taken == 0 for r in part)
        assert all(r.taken <= 3 * r.size for r in part)
    again = mixing.mixed_documents(mixed)
    assert again.columns == mixed.columns
    assert again.count() == sum(r.taken // r.size for r in rows if r.size)


def repeated_words(w):
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    return len({j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)})


def test_counts_of_quality_rules(spark, documents):
    line = prose(1, 12)
    texts = [None, "", "a", line, f"{line}\n{line}\n \n \nx", "b " * 40, f"{line} # $x %|<>", f"é ü {line} " * 3]
    docs = documents(*enumerate(texts), (3, line), more=CLASHING)
    labels = spark.createDataFrame([(3, 1, 0), (None, None, 0)], "doc_id long, quality int, toxic int")
    for r in quality_rules.judged(docs, labels).collect():
        w, lines = split(texts[r.doc_id]), [x for x in (texts[r.doc_id] or "").split("\n") if split(x)]
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", texts[r.doc_id] or ""))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated_words(w)
        failed = len(w) < 20 or 100 * r.n_repeat_words > 30 * len(w)
        assert (r.base_failed, r.kept) == (failed, not failed)


def test_cutoffs_are_certified(spark, documents):
    good = [(i, prose(i, 30)) for i in range(1500)]
    bad = [(5000 + i, prose(i, 30).replace(" ", " # ")) for i in range(60)]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad[:40]]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.kept for r in quality_rules.judged(documents(*good, *bad), labels).collect()}
    assert all(rows[i] for i, _ in good) and not any(rows[i] for i, _ in bad)
    few = labels.where("doc_id > 1450")  # 49 good ones certify nothing
    rows = {r.doc_id: r.kept for r in quality_rules.judged(documents(*good, *bad), few).collect()}
    assert all(rows.values())


def test_languages_with_few_labels_are_certified(spark, documents):
    langs = ("de", "en", "es", "fr")
    good = [(1000 * k + i, prose(1000 * k + i, 30), lang) for k, lang in enumerate(langs) for i in range(310)]
    bad = [(9000 + 100 * k + i, prose(i, 30).replace(" ", " # "), lang) for k, lang in enumerate(langs) for i in range(30)]
    labels = [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.kept for r in quality_rules.judged(documents(*good, *bad), labels).collect()}
    assert all(rows[r[0]] for r in good) and not any(rows[r[0]] for r in bad)


def test_rules_share_one_risk(spark, documents):
    """Each rule alone may reject 14 of 1500 good documents, both together may not."""
    odd = [(i, prose(i, 30).replace(" ", " #### ")) for i in range(14)]
    odd += [(i, " ".join(f"{w} " * 6 for w in prose(i, 30).split()).strip()) for i in range(14, 28)]
    good = odd + [(i, prose(i, 30)) for i in range(28, 1500)]
    bad = [(5000 + i, t) for i, (_, t) in enumerate(odd * 10)]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality_rules.judged(documents(*good, *bad), labels).collect()
    assert 0 < sum(not r.kept and r.doc_id < 5000 for r in rows) <= 14


def test_copies_are_one_trial(spark, documents):
    """250 good labels on copies of 5 texts certify nothing; 250 on distinct texts do."""
    bad = [(5000 + i, prose(i, 30).replace(" ", " # ")) for i in range(30)]
    for texts, certifies in ((5, False), (250, True)):
        good = [(i, prose(i % texts, 30)) for i in range(250)]
        labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad]
        labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        rows = quality_rules.judged(documents(*good, *bad, more=CLASHING), labels).collect()
        assert [r.kept for r in rows if r.doc_id >= 5000] == [not certifies] * 30
        assert all(r.kept for r in rows if r.doc_id < 5000)


def test_sql_of_quality_rules(spark, tmp_path):
    """The rows, every rule's decision included, are those of the SQL on given tables."""
    import duckdb

    from ringtally.llm import queries, sql

    folder = "/root/testdata/sf0.001"
    got = queries.op8_quality_rules(spark, folder)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    want = con.execute(sql.OP8)
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_binomial_tail(spark):
    from math import comb

    from pyspark.sql import functions as F

    cases = [(0, 100, 0.05), (2, 100, 0.05), (4, 100, 0.05), (5, 100, 0.05), (3, 40000, 0.01)]
    for k, n, p in cases:
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0
        frame = spark.sql(f"SELECT {k}L AS k, {n}L AS n")
        got = frame.select(quality_rules.binomial_tail(F.col("k"), F.col("n"), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9, abs=1e-300)


def brute_groups(rows):
    sets = []
    for _, text in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in split(text)]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n) and root[i] != root[j]:
                old = root[i]
                root = [root[j] if r == old else r for r in root]
    low = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    return {rows[i][0]: (len(sets[i]), low[root[i]]) for i in range(len(rows))}


def near_copies(n, seed=3):
    rng = random.Random(seed)
    base = prose(1000, 120).split()
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_groups_of_near_copies(documents):
    texts = [None, "", " ", "one two", "One  TWO", "Ä b c d e f", "ä b c d e f", *[prose(i, 60) for i in range(20)], *near_copies(150)]
    rows = list(enumerate(texts, 10))
    want = brute_groups(rows)
    got = near_dedup.groups(documents(*rows, more=CLASHING)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_buckets_by_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    rows = list(enumerate(near_copies(120, seed=8)))
    got = near_dedup.groups(documents(*rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows)


def test_one_document_of_a_group_stays(documents):
    docs = documents((1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (3, None), (4, ""), more=CLASHING)
    left = near_dedup.distinct_documents(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_ids_that_repeat_or_lack_cost_no_group(documents):
    one, two, three = prose(1, 30), prose(2, 30), prose(3, 30)
    docs = documents(
        (5, one), (9, one), (3, two), (5, two + " x"), (None, one), (None, three), (None, three), (None, None), (None, None)
    )
    left = [(r.doc_id, r.text) for r in near_dedup.distinct_documents(docs).collect()]
    key = lambda x: (x[0] or 0, x[1] or "")
    assert sorted(left, key=key) == sorted([(5, one), (3, two), (None, three), (None, None), (None, None)], key=key)


TEXTS = [
    None, "", " ", "Hello world", "don't  stop\n\n ok", "äöü ß 漢字 🙂🙂 é", "aaaa" * 50, "1234567 89 ###!!",
    prose(4, 3000), "x" * 3000, "ab" * 900 + "\t\n  \r\n end ", "<|endoftext|>", "   wide",
]


def test_ids_are_those_of_the_library(documents):
    import base64

    import tiktoken

    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = documents(*enumerate(TEXTS), (0, None), more=CLASHING)
    for r in byte_bpe.round_trip(docs, path, pattern).collect():
        text = r.row.text or ""
        assert r.ids == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_texts_are_encoded_once(spark, documents, tmp_path):
    """The bytes come from the ids the caller gets, not from a second encoding of the text."""
    import pstats

    coded = byte_bpe.round_trip(documents(*enumerate(TEXTS)).coalesce(1), *tokenizer())
    spark.profile.clear(type="perf")
    spark.conf.set("spark.sql.pyspark.udf.profiler", "perf")
    try:
        assert len(byte_bpe.digests(coded).collect()) == len(TEXTS)
    finally:
        spark.conf.unset("spark.sql.pyspark.udf.profiler")
    spark.profile.dump(str(tmp_path), type="perf")
    calls = Counter()
    for profile in tmp_path.glob("*.pstats"):
        for (file, _, name), (_, n, *_) in pstats.Stats(str(profile)).stats.items():
            if file.endswith("byte_bpe.py"):
                calls[name] += n
    assert calls["encode"] == calls["decode"] == 1


def test_long_pieces_merge_like_rows():
    import numpy as np

    path, pattern = tokenizer()
    known = byte_bpe.vocabulary(path, pattern)
    for word in ("thethethe", "aaaaaaaaaaaaaaaaa", "internationalization", "zzqxzzqx"):
        ids = known.byte_id[np.frombuffer(word.encode(), np.uint8)]
        assert byte_bpe.merge_long(ids, known.pairs).tolist() == byte_bpe.merge_rows(ids[None], known.table)[0].tolist()


def test_languages(documents):
    north, south = "abcdefgh", "mnopqrst"
    rows = [(i, prose(i, 50, (north, south)[i % 2]), ("no", "so")[i % 2]) for i in range(200)]
    both = prose(901, 60, north) + " " + prose(902, 40, south)
    rows += [(901, both, None), (902, None, "no"), (903, "123 !?", "so"), (904, "", None), (None, prose(5, 50, south), "so")]
    got = {r.row.doc_id: r for r in language_mixture.languages(documents(*rows, more=CLASHING)).collect()}
    for i, _, lang in rows[:200]:
        assert got[i].lang_pred == lang and got[i].score > 0.9
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert got[901].lang_pred == "no" and 0.5 < got[901].score < 0.7 and "so:" in got[901].mixture
    assert {got[i].lang_pred for i in (902, 903, 904)} == {"und"}
    assert got[None].held_out is False and got[None].lang_pred == "so"


def direct_mixture(text, counts):
    """The same method with plain dictionaries: trigram counts per language in, shares out."""
    grams = Counter(language_mixture.trigrams(text).tolist())
    total = sum(grams.values())

    def chance(lang, g):
        return (counts[lang][g] + 0.05) / (sum(counts[lang].values()) + 0.05 * 65536)

    def likelihood(shares):
        return sum(n * math.log(sum(p * chance(k, g) for k, p in shares.items())) for g, n in grams.items())

    shares = {max(sorted(counts), key=lambda k: likelihood({k: 1.0})): 1.0}
    while len(shares) < len(counts):
        def slope(k):
            return sum(n * chance(k, g) / sum(p * chance(x, g) for x, p in shares.items()) for g, n in grams.items()) / total

        new = max((k for k in sorted(counts) if k not in shares), key=slope)
        if slope(new) <= 1:
            break
        trial = {**{k: 0.9 * p for k, p in shares.items()}, new: 0.1}
        for _ in range(20):
            sums = dict.fromkeys(trial, 0.0)
            for g, n in grams.items():
                parts = {k: p * chance(k, g) for k, p in trial.items()}
                for k in parts:
                    sums[k] += n * parts[k] / sum(parts.values())
            trial = {k: v / total for k, v in sums.items()}
        if likelihood(trial) - likelihood(shares) <= 6 * math.log(total) / 2:
            break
        shares = trial
    return shares


@pytest.mark.parametrize("at_once", [256, 2])
def test_mixtures_against_direct_computation(documents, monkeypatch, at_once):
    """Languages that share letters; all at once and in blocks of two."""
    monkeypatch.setattr(language_mixture, "AT_ONCE", at_once)
    alphabets = {"a": "abcdefgh", "b": "efghijkl", "c": "ghijmnop", "d": "abcxyz", "e": "éüab"}
    rows = [(i, prose(i, 40, letters), lang) for j, (lang, letters) in enumerate(alphabets.items()) for i in range(20 * j, 20 * j + 20)]
    mixed = [" ".join(prose(7 * i + j, 8 + 9 * (i % 3 + j), alphabets[k]) for j, k in enumerate(ks)) for i, ks in
             enumerate(("ab", "bc", "abc", "de", "ace", "abcde", "e", "d", "ca"))]
    rows += [(1000 + i, t, None) for i, t in enumerate(mixed)] + [(1100, None, "a"), (1101, "12", "b"), (1000, mixed[0], None)]
    counts = {k: Counter() for k in alphabets}
    for i, text, lang in rows:
        if lang and text and zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(language_mixture.trigrams(text).tolist())
    got = language_mixture.languages(documents(*rows, more=CLASHING)).collect()
    assert Counter(r.row.doc_id for r in got) == Counter(r[0] for r in rows)
    assert len({len(r.mixture.split()) for r in got}) > 3
    for r in got:
        want = direct_mixture(r.row.text, counts) if len(language_mixture.trigrams(r.row.text)) else {}
        have = dict(x.split(":") for x in r.mixture.split())
        assert set(have) == set(want)
        assert all(float(have[k]) == pytest.approx(want[k], abs=1e-4) for k in want)
        first = max(want, key=want.get) if want else "und"
        assert (r.lang_pred, r.score) == (first, pytest.approx(want.get(first, 0.0)))


def test_nothing_to_learn_from(documents):
    rows = language_mixture.languages(documents((1, "abc", None), (2, "def", None))).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 2


def test_empty_tables(spark, documents):
    none = documents((1, "x")).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path, pattern = tokenizer()
    assert kd_sharding.kd_shards(none, 4).count() == 0
    assert mixing.mix(none).count() == 0
    assert quality_rules.judged(none, labels).count() == 0
    assert near_dedup.groups(none).count() == 0
    assert byte_bpe.digests(byte_bpe.round_trip(none, path, pattern)).count() == 0
    assert language_mixture.languages(none).count() == 0


def test_forgetting_pieces_changes_no_id(monkeypatch):
    import tiktoken

    path, pattern = tokenizer()
    small = byte_bpe.Vocabulary(path, pattern)
    texts = [prose(i, 60, "abcdefgé") + " the end of it" for i in range(60)] + ["", None]
    tokens = {bytes(small.token_bytes[s : s + n]): i for i, (s, n) in enumerate(zip(small.token_start, small.token_length)) if n}
    exact = tiktoken.Encoding("exact", pat_str=pattern, mergeable_ranks=tokens, special_tokens={})
    monkeypatch.setattr(byte_bpe, "KEPT_PIECES", 100)
    for i in range(0, len(texts), 7):
        got = small.encode(texts[i : i + 7]).to_pylist()
        assert got == [exact.encode_ordinary(t or "") for t in texts[i : i + 7]]
        assert len(small.known) < 1000
    assert small.known[" the"] < 100 and small.uses[small.known[" the"]] > 30  # used often, so it stayed
