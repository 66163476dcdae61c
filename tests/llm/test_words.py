"""Spelling variants, importance resampling and sanitisation against direct computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ringtally.llm import importance_resampling, sanitisation, spelling_variants

CLASHING = "word n key digest whole row spans at part features weight rank entity m"


# Spelling variants


def vocabulary(rows, every=97, least=3):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, every=97):
    counts = vocabulary(rows, every)
    near = {w: [v for v in counts if one_error(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return out


def typed(seed, n):
    """Texts over few roots with errors, so that chains of forms occur."""
    rng = random.Random(seed)
    letters = "abé×ÿ"
    roots = ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(12)]
    out = []
    for _ in range(n):
        w = rng.choices(roots, [2.0**-i for i in range(12)])[0]
        for _ in range(rng.choice([0, 0, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
        out.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
    return " ".join(out)


@pytest.mark.parametrize("block", [100_000, 60])
def test_variants(documents, block):
    rows = [(i, typed(i % 9, 150)) for i in range(12)]
    rows += [(90, None), (91, ""), (92, "12 .. !"), (None, typed(3, 80)), (93, "q" * 700 + " " + "q" * 699), rows[1]]
    rows += [(94, "q" * 700), (95, "q" * 700 + " " + "q" * 699 + " " + "q" * 699)]
    found = spelling_variants.variants(documents(*rows, more=CLASHING), every=5, block=block).collect()
    expected = variants(rows, every=5)
    assert len(expected) > 100
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert any(r.form and r.form != r.root for r in found)


def test_one_place_holds_all_words(documents):
    """Words with the same beginning: one place is split into a grid of blocks."""
    rng = random.Random(4)
    words = ["prefix" + "".join(rng.choices("abc", k=rng.randint(4, 6))) for _ in range(400)]
    rows = [(i, " ".join(words)) for i in range(3)]
    found = spelling_variants.variants(documents(*rows), every=10**9, block=500).collect()
    assert {tuple(r) for r in found} == variants(rows, every=10**9)


def test_variants_of_nothing(documents):
    assert spelling_variants.variants(documents((1, None), (2, "ab cd"))).count() == 0
    assert spelling_variants.variants(documents((1, "x")).limit(0)).count() == 0


def test_search_by_suffix_ranks():
    """Every word is found under each of its single errors, on both sides."""
    import pandas as pd

    words = sorted({"banana", "bananas", "bandana", "panama", "ananas", "banane", "abana"})
    rows = [(w, 1, s, r) for w in words for s in (True, False) for r in (True, False)]
    block = pd.DataFrame(rows, columns=["word", "n", "searched", "to_right"])
    near = Counter()
    for _, part in block.groupby("to_right"):
        for r in spelling_variants.search_block(part).itertuples():
            near[r.word] += r.n_near
    assert near == Counter({w: sum(one_error(w, v) for v in words) for w in words if any(one_error(w, v) for v in words)})


# Importance resampling


def resampled(rows, target, buckets=10_000, percent=25, least=20, seed=7):
    def words(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    def coded(text):
        w = words(text)
        grams = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        return len(w), [zlib.crc32(g.encode()) % buckets for g in grams]

    docs = [(d, *coded(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, c in docs:
        s.update(c)
    for text in target:
        t.update(coded(text)[1])
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(float((t[b] + 1) * (S + buckets)) / float((s[b] + 1) * (T + buckets))))

    scored = []
    for d, n, c in docs:
        weight = sum(map(gain, c)) // len(c) if c else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((d, n, len(c), weight, weight + noise))
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    drawn = able[: percent * len(able) // 100]
    out = Counter((d, f, w, score, i + 1) for i, (d, _, f, w, score) in enumerate(drawn))
    rest = Counter(r for r in scored) - Counter(drawn)
    return out + Counter({(d, f, w, score, None): k for (d, _, f, w, score), k in rest.items()})


def sentence(seed, n, letters="abcdé"):
    rng = random.Random(seed)
    return ", ".join("".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(n)).title()


def resampling_rows():
    rows = [(i, sentence(i % 25, 5 + 3 * (i % 25))) for i in range(60)]
    return rows + [(70, None), (71, ""), (72, " ?! "), (None, sentence(5, 40)), (73, sentence(8, 20_000)), rows[30], rows[30]]


@pytest.mark.parametrize("share", [1e-5, 0.01, 2.0])
def test_resampling(documents, share):
    """The same rows with all features in the head, with some, and with none."""
    rows = resampling_rows()
    target = [(1, sentence(3, 200)), (2, None), (3, "")]
    docs, texts = documents(*rows, more=CLASHING), documents(*target, more=CLASHING)
    found = importance_resampling.resample(docs, texts, head_share=share)
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect())
    assert got == resampled(rows, [t for _, t in target])


def test_resampled_documents_are_whole(documents):
    rows = resampling_rows()
    drawn = importance_resampling.resampled_documents(documents(*rows, more="kept"), documents((1, "a b")))
    expected = {r[0] for r in resampled(rows, ["a b"]) if r[4] is not None}
    assert drawn.columns[-1] == "kept" and {r["doc_id"] for r in drawn.collect()} == expected


def test_resampling_without_rows(documents):
    some, none = documents((1, sentence(1, 30)), (2, sentence(2, 30))), documents((1, "x")).limit(0)
    assert importance_resampling.resample(none, some).count() == 0
    found = importance_resampling.resample(some, none).collect()
    assert Counter(
        (r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found
    ) == resampled([(1, sentence(1, 30)), (2, sentence(2, 30))], [])


def test_target_text_is_preferred(documents):
    rows = [(i, sentence(i, 60, "abc" if i % 2 else "xyz")) for i in range(200)]
    found = importance_resampling.resample(documents(*rows), documents((1, sentence(999, 3000, "abc"))), seed=3)
    drawn = [r["doc_id"] % 2 for r in found.collect() if r["rank"]]
    assert len(drawn) == 50 and sum(drawn) >= 40


# Sanitisation

# The patterns of the contract as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    found = {}
    for kind, pattern in PLAIN.items():
        ascii_only = re.finditer(pattern, text, re.ASCII)
        found[kind] = [(m.start(), m.end(), m.group()) for m in ascii_only if holds(kind, m.group())]
    return found


def disclosing(rows, support, disclosure):
    """Term -> whether its class is safe, by counting over all rows."""
    def terms(text):
        return re.findall(r"[^\W\d_]{4,}", text.lower())

    def classed(some):
        return set(some) | {t[:3] + "*" for t in some}

    n_term, n_entity, both, texts = Counter(), Counter(), Counter(), {}
    for _, text in rows:
        text = text or ""
        n_term.update(classed(terms(text)))
        entities, pairs = set(), set()
        for kind, pattern in PLAIN.items():
            spans = [
                m for m in re.finditer(pattern, text) if kind != "card" or 16 <= len(re.sub("[^0-9]", "", m.group())) <= 19
            ]
            cuts = [0, *[x for m in spans for x in m.span()], len(text)]
            pieces = [re.sub(PLAIN["email"], " ", text[a:b]) for a, b in zip(cuts[::2], cuts[1::2])]
            for i, m in enumerate(spans):
                if holds(kind, m.group()):
                    value = re.sub("[^0-9]", "", m.group()) if kind in ("card", "phone") else m.group().lower()
                    entities.add((kind, value))
                    for t in classed(terms(pieces[i])[-8:] + terms(pieces[i + 1])[:8]):
                        pairs.add(((kind, value), t))
        n_entity.update(entities)
        both.update(pairs)
        for p in pairs:
            texts.setdefault(p, set()).add(text)
    n = len(rows)

    def share(e, t):
        if len(texts.get((e, t), ())) < support or n_entity[e] == n:
            return -math.inf
        return math.log(n * both[e, t] / (n_entity[e] * n_term[t])) / math.log(n / n_entity[e])

    found = {}
    for e, t in both:
        if not t.endswith("*") and share(e, t) >= disclosure:
            found[t] = found.get(t, True) and share(e, t[:3] + "*") < disclosure
    return found


def all_spans(rows, support=3, disclosure=0.9):
    terms = disclosing(rows, support, disclosure)
    out = []
    for doc_id, text in rows:
        base = plain_spans(text or "")
        taken = [s for kind in base.values() for s in kind]
        more = [
            (m.start(), m.end())
            for m in re.finditer(r"[^\W\d_]{4,}", text or "")
            if m.group().lower() in terms and not any(a < m.end() and m.start() < b for a, b, _ in taken)
        ]
        listed = [f"{k}:{a}:{b}" for k, spans in base.items() for a, b, _ in spans]
        out.append((doc_id, *[len(s) for s in base.values()], len(more), ",".join(listed),
                    ",".join(listed + [f"term:{a}:{b}" for a, b in more])))
    return Counter(out)


def noisy(seed, n):
    rng = random.Random(seed)
    parts = ["a@b.c", "a@b", "@", "x.y%z@m-1.co.uk", ".", "_", "-", " ", " ", "1", "22", "255", "256", "0010", "é", "名",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+", "(", ")", "3.4.5.6", "\n", "Word", "q"]
    return "".join(rng.choices(parts, k=n))


def people():
    rng = random.Random(11)
    filler = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(60)]
    rows = []
    for i in range(120):
        body = " ".join(rng.choices(filler, k=30))
        if i % 12 == 0:
            body += f" Zorbanax Quillé writes from zq@corp{i % 2}.example.org often " + " ".join(rng.choices(filler, k=9))
        if i % 12 == 1:
            body += f" ring Marvolo or Martha at +49 30 {1234567} now " + " ".join(rng.choices(filler, k=9))
        if i % 12 in (2, 3):
            body += " Marble Marvin marvel martial stands " + " ".join(rng.choices(filler, k=9))
        rows.append((i, body))
    return rows + [(500, "Zorbanax alone, and QUILLÉ."), (501, rows[0][1]), rows[0], (None, rows[1][1])]


def private_rows(docs, **options):
    found = sanitisation.private(docs, **options).select(
        "row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term", "base", "spans"
    )
    return Counter(tuple(r) for r in found.collect())


def test_base_spans(documents):
    rows = [(i, noisy(i, 5 + i)) for i in range(400)]
    rows += [
        (900, None), (901, ""), (902, "300.1.2.3.4 1.2.3.4.5.6.7.8"), (903, "a@b.com_x@c.org x@y.z@w.v"),
        (904, "4111111111111111 41111111111111111111 4111 1111 1111 1111-"), (905, "é名 ip 1.2.3.4, é"), rows[7],
        (906, "+1 234 567 8 . +1()()() +123456789012345678"), (907, "12 4111 1111 1111 1111"), (908, "1 -2.3.4.5"),
    ]
    assert private_rows(documents(*rows, more=CLASHING)) == all_spans(rows)


def test_long_texts_take_time_in_proportion(documents):
    rows = [(1, "a" * 400_000), (2, "1" * 400_000), (3, "1.2.3.4 " * 20_000), (4, "a@" * 100_000 + "b."*50_000),
            (5, "+1" + "." * 400_000), (6, "1 " * 200_000), (7, "a." * 200_000)]
    found = {r[0]: r for r in private_rows(documents(*rows))}
    assert found[3][2] == 20_000 and found[3][-1].endswith("ip:159992:159999")
    assert found[2][-1] == found[5][-1] == found[6][-1] == found[7][-1] == ""


def test_terms_that_disclose(documents):
    rows = people()
    expected = all_spans(rows)
    assert disclosing(rows, 3, 0.9) and set(disclosing(rows, 3, 0.9).values()) == {True, False}
    assert private_rows(documents(*rows)) == expected
    alone = next(r for r in expected if r[0] == 500)
    assert alone[-1] == "term:0:8,term:20:26"  # no personal data there, but its terms give it away


def test_copies_are_one_text_as_evidence(documents):
    filler = [(i, f"plain words number{i} nothing else") for i in range(40)]
    copies = [(100 + i, "Unusual surroundings of me@home.net here") for i in range(5)]
    assert all(r[5] == 0 for r in private_rows(documents(*filler, *copies)))


def test_sanitised_texts(documents):
    rows = people() + [(600, None), (601, "é名 x@y.zz, 4111 1111 1111 1111 and +4111 1111 1111 1111, 1.2.3.4!"), (602, "clean")]
    made = sanitisation.sanitised(documents(*rows, more=CLASHING))
    assert made.columns == documents(*rows, more=CLASHING).columns
    texts = {r["doc_id"]: r["text"] for r in made.collect()}
    assert texts[600] is None and texts[602] == "clean"
    assert texts[601].startswith("é名 [EMAIL], [CARD] and ") and texts[601].endswith("[IP]!")
    assert "1111" not in texts[601]
    assert texts[500] == "[TERM] alone, and [TERM]."
    assert "[PHONE]" in texts[1] and "Mar…" in texts[1] and "Marvolo" not in texts[1]
    assert "Marble Marvin" in texts[2]


def test_sanitising_nothing(documents):
    none = documents((1, "x")).limit(0)
    assert sanitisation.private(none).count() == 0 and sanitisation.sanitised(none).count() == 0


def test_sql_of_sanitisation():
    """The SQL twin agrees where terms are found, too."""
    import duckdb

    from ringtally.llm.sql import OP13

    rows = people() + [(i + 1000, noisy(i, 40)) for i in range(40)] + [(2000, None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = Counter((a, b, c, d, e, s) for a, b, c, d, e, _, s in con.execute(OP13).fetchall())
    expected = all_spans(rows)
    assert got == Counter({(r[0], *r[1:5], r[7]): n for r, n in expected.items()})
    assert any(r[5] for r in expected)
