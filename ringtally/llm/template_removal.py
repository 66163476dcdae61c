"""Main text of pages, without what a site repeats.

Every element subtree of a page is hashed; Spark counts, per host, the distinct pages (by hash of
the whole page) each hash occurs on, so that copies of a page are no evidence. Only on hosts with
fewer than LEAST_PAGES distinct pages do rows count, and only for blocks without prose. A subtree
that occurs on at least LEAST_PAGES pages, and on as many as the square root of its host's pages, is
a template and is deleted, unless all that goes were half of a page's text or more (then prose stays), or it is
or holds a paragraph, heading, list or table of the main part. Menus, headers, footers, sidebars,
notices, adverts, forms and comments are also known by tag, role or class, since small hosts
repeat too little to show them; in the main part only by the class or role of a block, never of a
heading or paragraph or by an id, and ambiguous classes only where the block recurs on the host.

Subtrees meet the templates under host and hash, and a page gets those that are on it, so the
number of a host's templates has no bound; counting is combined in the tasks, so a large host is
spread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtally.llm.common import small_batches, staged
from ringtally.llm.html_tree import INLINE, RAW, Tree, parse

LEAST_PAGES = 5

CHROME_TAGS = RAW | frozenset(
    "head nav header footer aside form template svg math object audio video canvas button select"
    " dialog menu input".split()
)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice notices alert popup modal overlay sidebar nav navbar navigation menu"
    " breadcrumb breadcrumbs header footer masthead comment comments disqus reply replies respond"
    " share sharing social related recommended newsletter subscribe subscription signup login search"
    " pagination pager toolbar widget widgets".split()
)
# In the main part these classes go only where the block recurs on the host as well.
AMBIGUOUS = frozenset(
    "banner promotion notice notices alert popup modal overlay navigation menu header footer masthead comment"
    " reply replies respond share sharing social related recommended subscription signup login search"
    " toolbar widget widgets".split()
)
CLEAR_WORDS = CHROME_WORDS - AMBIGUOUS
NAMED_IN_MAIN = frozenset("div aside section ul form".split())
MAIN_TAGS = frozenset(("article", "main"))
PROSE = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th figure figcaption"
    " article main body html #page".split()
)
WORD = re.compile(r"[A-Za-z]+")


def is_chrome(tree: Tree, i: int, in_main: bool) -> bool:
    tag = tree.tags[i]
    if tag == "header" and in_main:
        return False  # an article's own header has its title
    if tag in CHROME_TAGS:
        return True
    if not tree.attributes[i] or tag in ("html", "body", "#page"):
        return False
    named = tree.named(i)
    if "hidden" in named or named.get("aria-hidden") == "true":
        return True
    if in_main and tag not in NAMED_IN_MAIN:
        return False
    role = named.get("role", "").lower()
    if role in CHROME_ROLES:
        return True
    if (tag in MAIN_TAGS or role == "main") and "comment" not in named.get("class", ""):
        return False
    if in_main:
        return not CLEAR_WORDS.isdisjoint(class_words(named))
    return not CHROME_WORDS.isdisjoint([*class_words(named), *WORD.findall(named.get("id", "").lower())])


def class_words(named: dict[str, str]) -> list[str]:
    return WORD.findall(named.get("class", "").lower())


def is_ambiguous(tree: Tree, i: int) -> bool:
    """A block of the main part that is chrome if it recurs."""
    if tree.tags[i] not in NAMED_IN_MAIN or not tree.attributes[i]:
        return False
    return not AMBIGUOUS.isdisjoint(class_words(tree.named(i)))


def main_parts(tree: Tree) -> list[bool]:
    """Elements that are, or are inside, an article, a main tag or an element with that role."""
    out: list[bool] = []
    for i, (tag, parent) in enumerate(zip(tree.tags, tree.parents)):
        role = tree.attributes[i] and tree.named(i).get("role", "").lower()
        out.append(tag in MAIN_TAGS or role == "main" or (parent >= 0 and out[parent]))
    return out


def prose_parts(tree: Tree) -> list[bool]:
    """Elements that are, or hold, a paragraph, heading, list or table."""
    out = [tag in PROSE for tag in tree.tags]
    for i in range(len(out) - 1, 0, -1):
        if out[i]:
            out[tree.parents[i]] = True
    return out


def candidates(tree: Tree, in_main: list[bool], prose: list[bool]) -> list[bool]:
    """Elements that may be deleted as templates; prose of the main part is only in
    a block whose class says so."""
    return [
        tag not in INLINE and tag not in ("body", "html", "#page")
        and not (in_main[i] and prose[i] and not is_ambiguous(tree, i))
        for i, tag in enumerate(tree.tags)
    ]


def subtree_hashes(page: str | None) -> list[tuple[int, bool]]:
    """Distinct hashes of a page's subtrees that may be templates, and whether they hold prose."""
    if not page:
        return []
    tree = parse(page)
    prose = prose_parts(tree)
    able = candidates(tree, main_parts(tree), prose)
    has_text = {i for i, text in tree.events if text and not text.isspace()}
    for i in range(len(tree.tags) - 1, 0, -1):
        if i in has_text:
            has_text.add(tree.parents[i])
    hashes = tree.hashes()
    return list({(int.from_bytes(hashes[i], "big", signed=True), prose[i]) for i in has_text if able[i]})


def main_text(page: str | None, templates: set[int]) -> str:
    """Blocks of the main text in page order."""
    if not page:
        return ""
    tree = parse(page)
    n = len(tree.tags)
    prose, hashes = prose_parts(tree), tree.hashes()
    main = main_parts(tree)
    able = candidates(tree, main, prose)
    dropped, in_main = [False] * n, [False] * n
    for i in range(n):
        parent = tree.parents[i]
        above = parent >= 0 and in_main[parent]
        dropped[i] = (parent >= 0 and dropped[parent]) or is_chrome(tree, i, above)
        in_main[i] = not dropped[i] and main[i]
    has_main = any(in_main)
    kept = [not d and (m or not has_main) for d, m in zip(dropped, in_main)]
    if templates:
        size = [0] * n
        for i, text in tree.events:
            if text and kept[i]:
                size[i] += len(text.strip())
        for i in range(n - 1, 0, -1):
            size[tree.parents[i]] += size[i]
        known = [
            able[i] and 2 * size[i] < size[0] and int.from_bytes(hashes[i], "big", signed=True) in templates
            for i in range(n)
        ]
        # All that goes is less than half of the text; else prose stays, and if need be everything.
        for spared in (lambda i: False, lambda i: prose[i], lambda i: True):
            gone, total = [False] * n, 0
            for i in range(n):
                above = tree.parents[i] >= 0 and gone[tree.parents[i]]
                gone[i] = above or (known[i] and not spared(i))
                total += size[i] if gone[i] and not above else 0
            if 2 * total < size[0] or not total:
                break
        kept = [k and not g for k, g in zip(kept, gone)]
    blocks, now = [], []
    for i, text in [*tree.events, (0, None)]:
        if text is None:
            if now and (block := " ".join("".join(now).split())):
                blocks.append(block)
            now = []
        elif kept[i]:
            now.append(text)
    return "\n\n".join(blocks)


def templates_by_page(pages: DataFrame) -> DataFrame:
    """``host``, ``body`` and the hashes of the templates on such a page. Rows without a host
    have none."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [subtree_hashes(p) for p in batch["html"]]
            rows = pd.DataFrame({"host": batch["host"], "body": batch["body"], "found": found})
            rows = rows.explode("found").dropna()
            rows["hash"], rows["prose"] = [f[0] for f in rows["found"]], [f[1] for f in rows["found"]]
            yield rows[["host", "body", "hash", "prose"]]

    known = pages.select("host", "body", "html").where("host IS NOT NULL")
    seen = known.mapInPandas(hashed, "host string, body long, hash long, prose boolean")
    seen = seen.groupBy("host", "body", "hash", "prose").agg(F.count(F.lit(1)).alias("n"))
    seen = staged(seen, "template-subtrees")
    counts = seen.groupBy("host", "hash", "prose").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("pages"))
    sizes = known.groupBy("host", "body").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("host").agg(F.sum("n").alias("all_rows"), F.count(F.lit(1)).alias("all"))
    # Where a host has little but copies, its rows tell what is no prose.
    by_rows = (F.col("all") < LEAST_PAGES) & ~F.col("prose")
    n, of = [F.when(by_rows, F.col(a)).otherwise(F.col(b)) for a, b in (("rows", "pages"), ("all_rows", "all"))]
    often = counts.join(sizes, "host").where((n >= LEAST_PAGES) & (n >= F.sqrt(of)))
    found = seen.join(often.select("host", "hash", "prose"), ["host", "hash", "prose"], "left_semi")
    return found.groupBy("host", "body").agg(F.collect_list("hash").alias("templates"))  # at most a page's elements


def extract(pages: DataFrame) -> DataFrame:
    """Every page with ``host`` and its main ``text``, beside ``page_id`` and ``url``.

    A NULL or empty page, or one without main text, has the empty text. A NULL url, or one
    without a host, belongs to no site: nothing is deleted there but what tags and classes
    tell. Rows that repeat a page are returned as often as they occur. Tags left
    open or never opened are mended as browsers do; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select("page_id", "url", "html", F.when(host != "", host).alias("host"), F.xxhash64("html").alias("body"))
    found = templates_by_page(rows).withColumnsRenamed({"host": "of", "body": "like"})

    def texts(htmls: pd.Series, lists: pd.Series) -> pd.Series:
        known = [set() if t is None else set(t.tolist()) for t in lists]
        return pd.Series([main_text(page, t) for page, t in zip(htmls, known)], dtype=object)

    joined = rows.join(found, (F.col("host") == F.col("of")) & (F.col("body") == F.col("like")), "left")
    text = F.pandas_udf(texts, "string")(F.col("html"), F.col("templates"))
    return joined.select("page_id", "url", "host", text.alias("text"))
