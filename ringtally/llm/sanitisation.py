"""Information-theoretic sanitisation: personal data, and the terms that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers, by pattern. Each distinct
value is a protected entity. Terms are words of four letters or more. How strongly a term reveals
an entity is estimated over all documents: the pointwise mutual information of the two, as a
share of the entity's own information,

    log(N n(e, t) / (n(e) n(t))) / log(N / n(e)),

with n(t) the documents that hold the term, n(e) those that hold the entity and n(e, t) those
that have the term within CONTEXT terms of the entity. A term whose share reaches DISCLOSURE for
some entity, in SUPPORT different texts at least, is a span wherever it occurs. It is generalised
to its first letters if that class of words stays below DISCLOSURE for all those entities, and
removed otherwise.

Texts stay in the JVM. Matches and the pieces between them come from one pattern, so positions
are running sums over a document's matches, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtally.llm.common import staged

CONTEXT = 8  # terms on each side, up to the neighbouring match
SUPPORT = 3
DISCLOSURE = 0.9
CLASS_LETTERS = 3

# Leftmost matches of the plain patterns. Possessive parts and the conditions in front keep the
# time in proportion to the text: a run of characters is tried from its start only, or from the
# end of the match before it. A card is a whole run of 16 to 19 digits.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}{4,}+"
KINDS = ["email", "ip", "card", "phone", "term"]
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def _all(text: Column, pattern: str | Column) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total, i):
        d = F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.floor(d / 10).cast("int") + d % 10

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: Column, match: Column) -> Column:
    n = F.length(_digits(match))
    return (
        F.when(kind == "ip", match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
        .when(kind == "card", _luhn(_digits(match)))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(True)
    )


def _keyed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """Text, its digest, and a key of document id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select(
        F.md5(named.cast("binary")).alias("key"), F.md5(text.cast("binary")).alias("digest"),
        text.alias("whole"), *more,
    )


def _placed(found: DataFrame) -> DataFrame:
    """Matches with their positions in code points and bytes, from the rows (key, digest, kind,
    matches, pieces). Rows that repeat a document are counted and placed once."""
    around = F.arrays_zip(
        F.slice("pieces", F.lit(1), F.size("matches")).alias("before"),
        F.col("matches").alias("match"),
        F.slice("pieces", F.lit(2), F.size("matches")).alias("after"),
    )

    def terms(piece):
        return _all(F.lower(F.regexp_replace(piece, EMAIL, " ")), TERM)

    before, after = terms(F.col("m.before")), terms(F.col("m.after"))
    near = F.concat(
        F.slice(before, F.greatest(F.size(before) - CONTEXT, F.lit(0)) + 1, F.lit(CONTEXT)),
        F.slice(after, F.lit(1), F.lit(CONTEXT)),
    )
    is_base = F.col("kind") != "term"
    each = found.select("key", "digest", "kind", F.posexplode(around).alias("at", "m")).select(
        "key", "digest", "kind", "at", F.col("m.match").alias("match"),
        F.length("m.before").alias("gap"), F.octet_length("m.before").alias("byte_gap"),
        F.when(is_base, F.array_distinct(near)).alias("near"),
    )
    once = (
        each.repartition("key", "kind")
        .groupBy("key", "kind", "at")
        .agg(F.count(F.lit(1)).alias("rows"), F.first(F.struct("digest", "match", "gap", "byte_gap", "near")).alias("m"))
        .select("key", "kind", "at", "rows", "m.*")
    )
    order = Window.partitionBy("key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    size, width = F.length("match"), F.octet_length("match")
    end, byte_end = F.sum(F.col("gap") + size).over(order), F.sum(F.col("byte_gap") + width).over(order)
    return once.select(
        "key", "digest", "kind", "rows", "match", "near", end.alias("end"), byte_end.alias("byte_end")
    ).select(
        "*", (F.col("end") - size).alias("start"), (F.col("byte_end") - width).alias("byte_start")
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """Spans of the base kinds with their ``entity`` (kind and value) and the terms ``near``."""
    each = [
        F.struct(F.lit(kind).alias("kind"), _all(F.col("whole"), pattern).alias("matches"))
        for kind, pattern in PATTERNS.items()
    ]
    pattern = F.element_at(F.create_map(*[F.lit(x) for pair in PATTERNS.items() for x in pair]), F.col("kind"))
    found = (
        _keyed(docs).select("*", F.explode(F.array(*each)).alias("m"))
        .where(F.size("m.matches") > 0)
        .select("key", "digest", "whole", "m.*")
    )
    placed = _placed(found.withColumn("pieces", F.split("whole", pattern, -1)).drop("whole"))
    value = F.when(F.col("kind").isin("card", "phone"), _digits(F.col("match"))).otherwise(F.lower("match"))
    return placed.where(_holds(F.col("kind"), F.col("match"))).withColumn(
        "entity", F.concat("kind", F.lit(":"), value)
    ).drop("match")


def _class(term: Column) -> Column:
    return F.concat(F.substring(term, 1, CLASS_LETTERS), F.lit("*"))


def _with_classes(terms: Column) -> Column:
    return F.array_distinct(F.concat(terms, F.transform(terms, _class)))


def disclosing_terms(
    docs: DataFrame, spans: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE
) -> DataFrame:
    """``term`` and ``safe_class``, whether its class of words reveals no more than allowed."""
    met = (
        spans.select("entity", "key", "digest", "rows", F.explode(_with_classes(F.col("near"))).alias("term"))
        .groupBy("entity", "term", "key", "digest")
        .agg(F.max("rows").alias("rows"))
        .groupBy("entity", "term", "digest")
        .agg(F.sum("rows").alias("rows"))
        .groupBy("entity", "term")
        .agg(F.sum("rows").alias("n_both"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= support)
    )
    of_entity = (
        spans.groupBy("entity", "key").agg(F.max("rows").alias("rows"))
        .groupBy("entity").agg(F.sum("rows").alias("n_entity"))
    )
    text_terms = _with_classes(F.array_distinct(_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), TERM)))
    of_term = docs.select(F.explode(text_terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n = F.lit(float(docs.count()))
    share = F.log(n * F.col("n_both") / (F.col("n_entity").cast("double") * F.col("n_term"))) / F.log(n / F.col("n_entity"))
    scored = staged(
        met.join(of_entity, "entity").where(F.col("n_entity") < n).join(of_term, "term")
        .select("entity", "term", share.alias("share")),
        "sanitisation-shares",
    )
    is_class = F.col("term").endswith("*")
    words = scored.where(~is_class & (F.col("share") >= disclosure)).withColumn("class", _class(F.col("term")))
    classes = scored.where(is_class).select(
        "entity", F.col("term").alias("class"), F.col("share").alias("class_share")
    )
    return words.join(classes, ["entity", "class"]).groupBy("term").agg(
        (F.max("class_share") < disclosure).alias("safe_class")
    )


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Where the terms occur, with the ``mark`` that takes their place."""
    surfaces = _keyed(docs).select("key", F.explode(F.array_distinct(_all(F.col("whole"), TERM))).alias("surface"))
    # Written, so that its size is known: texts only move to meet it where it is large.
    held = staged(
        surfaces.withColumn("term", F.lower("surface")).join(terms, "term")
        .groupBy(F.col("key").alias("held_key"))
        .agg(F.array_join(F.array_sort(F.collect_set("surface")), "|").alias("any")),
        "sanitisation-held",
    )
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.col("any"), F.lit(r")(?!\p{L})"))
    found = _keyed(docs).join(held, F.col("key") == F.col("held_key")).select(
        "key", "digest", F.lit("term").alias("kind"),
        _all(F.col("whole"), pattern).alias("matches"), F.split("whole", pattern, -1).alias("pieces"),
    )
    general = F.concat(F.substring("match", 1, CLASS_LETTERS), F.lit("…"))
    return (
        _placed(found).withColumn("term", F.lower("match")).join(terms, "term")
        .select("key", "kind", "start", "end", "byte_start", "byte_end",
                F.when(F.col("safe_class"), general).otherwise("[TERM]").alias("mark"))
    )


def document_spans(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """For each ``key`` with any, its ``spans``, sorted by kind and start: number of the kind,
    start and end in code points and bytes, mark. Terms that overlap a base span are not spans."""
    base = staged(base_spans(docs), "sanitisation-base")
    terms = staged(disclosing_terms(docs, base, support, disclosure), "sanitisation-terms")
    mark = F.lit(None).cast("string")
    for kind, text in MARKS.items():
        mark = F.when(F.col("kind") == kind, text).otherwise(mark)
    columns = ["key", "kind", "start", "end", "byte_start", "byte_end", "mark"]
    every = base.withColumn("mark", mark).select(*columns).unionByName(term_spans(docs, terms).select(*columns))
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(number.alias("kind"), "start", "end", "byte_start", "byte_end", "mark")
    term = KINDS.index("term") + 1

    def apart(spans):
        fixed = F.filter(spans, lambda s: s["kind"] < term)
        free = F.filter(spans, lambda s: (s["kind"] == term) & ~F.exists(
            fixed, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.concat(fixed, free)

    return staged(
        every.groupBy("key").agg(apart(F.sort_array(F.collect_list(span))).alias("spans")), "sanitisation-spans"
    )


def _with_spans(docs: DataFrame, spans: DataFrame, columns: list[str]) -> DataFrame:
    """``row``, the named columns of every document, with ``whole``, its text, and its spans, an
    empty array if none."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    none = F.array().cast(spans.schema["spans"].dataType)
    same = F.col("key") == F.col("span_key")
    found = _keyed(docs, row).join(spans.withColumnRenamed("key", "span_key"), same, "left")
    return found.select("row", "whole", F.coalesce("spans", none).alias("spans"))


def private(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """For every document ``row``, its columns ``keep``, with ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_term``,
    ``base`` (kind:start:end of all base spans, by kind and start) and ``spans`` (of all spans).

    ``docs`` has ``doc_id`` and ``text``. A NULL text is empty and has no spans. Rows that repeat
    id and text have the same spans; copies under other ids are documents of their own, but one
    text as evidence. Without documents the result is empty.
    """
    found = _with_spans(docs, document_spans(docs, **options), list(keep))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def of(k):
        return F.filter("spans", lambda s: s["kind"] == k)

    return found.select(
        "row",
        *[F.size(of(i + 1)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        listed(F.filter("spans", lambda s: s["kind"] < len(KINDS))).alias("base"),
        listed(F.col("spans")).alias("spans"),
    )


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """The documents, in their columns, with marks in ``text`` in place of spans. Spans that
    overlap are replaced together, by the mark of the first."""
    found = _with_spans(docs, document_spans(docs, **options), docs.columns)
    first = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["byte_start"].alias("a"), (-s["byte_end"]).alias("z"), s["mark"].alias("mark"))))

    # One pass from left to right; its state is the end of the last span and the list of parts.
    def part(state, s):
        end = -s["z"]
        fresh = F.array(F.struct(state["end"].alias("a"), s["a"].alias("z"), s["mark"].alias("mark")))
        return F.struct(
            F.greatest(state["end"], end).alias("end"),
            F.when(s["a"] >= state["end"], F.concat(state["parts"], fresh)).otherwise(state["parts"]).alias("parts"),
        )

    zero = F.struct(
        F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<a:bigint,z:bigint,mark:string>>").alias("parts")
    )
    raw = F.col("whole").cast("binary")
    state = F.aggregate(first, zero, part)

    def cut(a, n):
        return F.decode(F.substring(raw, a.cast("int") + 1, n.cast("int")), "UTF-8")

    texts = F.transform("parts", lambda p: F.concat(cut(p["a"], p["z"] - p["a"]), p["mark"]))
    tail = cut(F.col("last"), F.octet_length("whole") - F.col("last"))
    changed = F.concat(F.array_join(texts, ""), tail)
    rows = found.withColumn("state", state).select(
        "row", "whole", F.col("state.parts").alias("parts"), F.col("state.end").alias("last")
    )
    columns = [
        F.when(F.size("parts") > 0, changed).otherwise(F.col("row.text")).alias(c) if c == "text" else F.col(f"row.`{c}`")
        for c in docs.columns
    ]
    return rows.select(*columns)
