"""Main text of pages by deduced templates.

Tokens are tags and whole text nodes, told apart by the path of open elements above them. Tokens that occur equally
often on every page of a host form an equivalence class. Classes found on most pages of a host, which hold a tag of
its skeleton, are its template, nested by their paths; text nodes in them are boilerplate, and what remains are the
slots. Slots below elements whose name, class or role says what they are (menus, notices, comments, ...), and slots whose
text is links on the whole host, go; what lies in an article comes before what lies outside, unless that is more.
"""

from __future__ import annotations

import html
import json
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import arrow_step, saved, tuned, values

# A class is a template's where it is on at least half of the host's pages; text nodes where the host has that many.
LEAST_SHARE = 0.5
LEAST_PAGES = 10
# A slot is a menu where links make up this share of its text on the host.
LINK_SHARE = 0.8

# Elements that never hold main text, whose content is no markup, that stand within a line, that have no end.
DROPPED = frozenset(
    "head nav footer aside form script style noscript template button select textarea iframe svg canvas object dialog menu "
    "title audio video map datalist".split()
)
RAW = frozenset("script style title textarea iframe noscript xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations pagination pager toolbar search contentinfo complementary hidden".split()
)
# Names of one word or of several are whole names: every word of them, numbers aside, must be such a word.
MAIN_WORDS = frozenset("main content article body text".split())
HEADER_NAMES = frozenset("header site-header page-header".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Element:
    __slots__ = ("name", "path", "number", "dropped", "told", "holds", "main", "link")

    def __init__(self, name, path, number, dropped, told, main, link):
        self.name, self.path, self.number = name, path, number
        # told: this and the elements above whose class, id or role says that they go; holds: has an article or main.
        self.dropped, self.told, self.holds, self.main, self.link = dropped, told, False, main, link


def _number(path: str) -> int:
    """A signed 64-bit hash of a token."""
    x = xxhash.xxh64_intdigest(path)
    return x - (1 << 64) if x >> 63 else x


_facts: dict[tuple, tuple] = {}


def _words(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(name) if not w.isdigit()]


def _described(name: str, attributes: str) -> tuple[str, bool, bool, bool, bool, bool]:
    """(label, dropped, told, main, header, header by name) of an element: dropped by what it is, told to go by its class, id or role."""
    known = _facts.get((name, attributes))
    if known is None:
        found = {}
        for key, *given in _ATTRIBUTE.findall(attributes):
            found.setdefault(key.lower(), html.unescape("".join(given)))
        names = [n for k in ("class", "id", "role", "itemprop") for n in found.get(k, "").split()]
        parts = [_words(n) for n in names]
        style = found.get("style", "").replace(" ", "").lower()
        unseen = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
        dropped = name in DROPPED or unseen
        told = any(p and DROPPED_WORDS.issuperset(p) for p in parts) and name not in ("html", "body", "main")
        main = name in ("article", "main") or any(
            p and MAIN_WORDS.issuperset(p) and ("main" in p or "".join(p) == "articlebody") for p in parts
        )
        label = name + "".join(f".{c}" for c in sorted(found.get("class", "").split()))
        if len(_facts) > 50_000:
            _facts.clear()
        called = name not in ("html", "body", "main") and any(n.lower() in HEADER_NAMES for n in names)
        known = _facts[name, attributes] = (label, dropped, told, main, name == "header", called)
    return known


def read_page(page: str) -> tuple[list[tuple[str, int]], list[tuple]]:
    """(tags, blocks) of a page.

    tags: (path, number) of every opened element. blocks: (text, slot path, token number, dropped, main, link characters),
    a block being what stands between two block elements' ends or starts, its white space made one. An element that is only
    told to go by a name stays where the page's article or main is in it and no other is left.
    """
    tags: list[tuple[str, int]] = []
    blocks: list[tuple] = []
    root = Element("", "", 0, False, (), False, False)
    stack, parts, links = [root], [], 0

    def text(raw: str) -> None:
        nonlocal links
        if raw:
            plain = html.unescape(raw) if "&" in raw else raw
            parts.append(plain)
            if stack[-1].link:
                links += len(plain)

    def block() -> None:
        nonlocal links
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                at = next(e for e in reversed(stack) if e.name not in INLINE)
                blocks.append((joined, at.path, _number(at.path + "\0" + joined), at.dropped, at.main, links, at.told))
            parts.clear()
        links = 0

    def pop(until: int) -> None:
        if any(e.name not in INLINE for e in stack[until:]):
            block()
        del stack[until:]

    place, end = 0, len(page)
    while place < end:
        found = _TOKEN.search(page, place)
        if not found:
            text(page[place:])
            break
        text(page[place : found.start()])
        place = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        name = name.lower()
        if found[1] or found[4]:
            if name == "p" and not any(e.name == "p" for e in stack):
                block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    pop(i)
                    break
            continue
        attributes = found[3] if found[2] else found[6]
        if name == "br":
            parts.append("\n")
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    pop(i)
                    break
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            alike = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}.get(name, (name,))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in alike:
                    pop(i)
                    break
                if stack[i].name in ("ul", "ol", "dl", "table", "select"):
                    break
        if name not in INLINE:
            block()
        label, dropped, told, main, header, called = _described(name, attributes)
        above = stack[-1]
        within = above.main or main
        path = f"{above.path}/{label}"
        # A page's header is not an article's.
        dropped = above.dropped or dropped or header and not above.main
        told = told or called and not above.main
        number = _number(path)
        tags.append((path, number))
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, place)
            place = close.end() if close else end
            continue
        element = Element(name, path, number, dropped, above.told, within, above.link or name == "a")
        if told:
            element.told = (*above.told, element)
        if main and not dropped:
            for e in element.told:
                e.holds = True
        stack.append(element)
    block()
    left = any(main and not dropped and not told for _, _, _, dropped, main, _, told in blocks)
    return tags, [(*b[:3], b[3] or any(left or not e.holds for e in b[6]), *b[4:6]) for b in blocks]


def host_of(url: Column) -> Column:
    """A URL's host in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, path, tag, pages, high, low, chars, links): each token of each host, with the sums of both halves of a
    hash of (page, times it occurs there): tokens with equal pages and sums share their occurrence vector.

    Takes (host, page, html). Tasks send one row for each token that they have seen on a host.
    """

    def step(batches):
        seen: dict[tuple, list] = {}

        def flushed():
            keys = list(seen)
            rows = list(seen.values())
            seen.clear()
            return {
                "host": [k[0] for k in keys], "token": [k[1] for k in keys],
                **{n: [r[i] for r in rows] for i, n in enumerate(("path", "tag", "pages", "high", "low", "chars", "links"))},
            }

        for batch in batches:
            for host, page, text in zip(values(batch, "host"), values(batch, "page"), values(batch, "html")):
                tags, blocks = read_page(text or "")
                here: dict[int, list] = {0: ["", True, 1, 0, 0]}
                for path, number in tags:
                    here.setdefault(number, [path, True, 0, 0, 0])[2] += 1
                for _, path, number, *_ in blocks:
                    here.setdefault(number, [path, False, 0, 0, 0])[2] += 1
                for words, path, number, _, _, links in blocks:
                    slot = here.get(_number(path))
                    if slot:
                        slot[3] += len(words)
                        slot[4] += min(links, len(words))
                for number, (path, tag, times, chars, links) in here.items():
                    x = xxhash.xxh64_intdigest(f"{page} {times}")
                    row = seen.get((host, number))
                    if row is None:
                        row = seen[host, number] = [path, tag, 0, 0, 0, 0, 0]
                    row[2] += 1
                    row[3] += x >> 32
                    row[4] += x & 0xFFFFFFFF
                    row[5] += chars
                    row[6] += links
            if len(seen) > 100_000:
                yield flushed()
        yield flushed()

    schema = "host string, token long, path string, tag boolean, pages long, high long, low long, chars long, links long"
    parts = arrow_step(pages, step, schema)
    sums = [F.sum(n).alias(n) for n in ("pages", "high", "low", "chars", "links")]
    return parts.groupBy("host", "token").agg(F.min("path").alias("path"), F.bool_or("tag").alias("tag"), *sums)


def templates(pages: DataFrame) -> DataFrame:
    """(host, n_pages, boilerplate array of text tokens, menus array of slot paths' tokens, template JSON) of every host.

    A host's tokens on at least half of its pages are no more than twice a page's, so one task can nest them.
    """
    tokens = saved(occurrences(pages), "occurrences")
    # Written, so that its size is known: where it is broadcast, rare tokens go before anything is dealt out by host.
    totals = saved(tokens.where("token = 0").select("host", F.col("pages").alias("n_pages")), "hosts")
    often = tokens.where("token <> 0").join(totals, "host").where(F.col("pages") >= LEAST_SHARE * F.col("n_pages"))
    fields = pa.schema(
        [("host", pa.string()), ("n_pages", pa.int64()), ("boilerplate", pa.list_(pa.int64())), ("menus", pa.list_(pa.int64())), ("template", pa.string())]
    )

    def nest(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        n_pages = rows[0]["n_pages"]
        classes: dict[tuple, list] = {}
        for r in rows:
            classes.setdefault((r["pages"], r["high"], r["low"]), []).append(r)
        # A valid class holds a tag; text nodes count only where the host is large enough to tell.
        valid = [c for c in classes.values() if any(r["tag"] for r in c)]
        fixed = [r["token"] for c in valid for r in c if not r["tag"] and n_pages >= LEAST_PAGES]
        menus = [r["token"] for r in rows if r["tag"] and r["chars"] and r["links"] >= LINK_SHARE * r["chars"] and n_pages >= LEAST_PAGES]
        valid.sort(key=lambda c: (-c[0]["pages"], min(r["path"] for r in c)))
        tops = [min((r["path"] for r in c if r["tag"]), key=lambda p: (p.count("/"), p)) for c in valid]
        told = []
        for i, c in enumerate(valid):
            inside = [j for j in range(i) if tops[i].startswith(tops[j] + "/")]
            told.append({"pages": c[0]["pages"], "top": tops[i], "tokens": len(c), "in": max(inside, key=lambda j: len(tops[j]), default=None)})
        return pa.table(
            {"host": [rows[0]["host"]], "n_pages": [n_pages], "boilerplate": [sorted(fixed)], "menus": [sorted(menus)], "template": [json.dumps(told)]},
            schema=fields,
        )

    return often.groupBy("host").applyInArrow(
        nest, "host string, n_pages long, boilerplate array<long>, menus array<long>, template string"
    )


def main_text(page: str, boilerplate: frozenset, menus: frozenset) -> str:
    """The blocks of a page that its template leaves and no role excludes, joined by an empty line.

    The template decides everywhere. Of the blocks it leaves, those in an article or main stand alone unless there is more text
    outside: then the article is a teaser, and all are kept. A page whose article is nothing but the template's (a copy of the
    host's other pages) keeps its article.
    """
    _, blocks = read_page(page)
    inside = [b for b in blocks if b[4] and not b[3]]
    kept = []
    for block in blocks:
        text, path, number, dropped, main, links = block
        if dropped or number in boilerplate or _number(path) in menus or not main and links >= LINK_SHARE * len(text):
            continue
        kept.append(block)
    within = [b for b in kept if b[4]]
    if inside and sum(len(b[0]) for b in within) >= sum(len(b[0]) for b in kept if not b[4]):
        kept = within or inside
    return "\n\n".join(b[0] for b in kept)


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, url, text) of every row.

    Null and empty pages have an empty text. Pages without a readable URL share the empty host. Equal rows get equal
    texts and count as often as they come; other columns are not read; an empty table gives an empty result.
    """
    tuned(pages.sparkSession)
    source = pages.select(
        F.col(id_column).cast("long").alias("page"), F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"), host_of(F.col(url_column).cast("string")).alias("host"),
    )
    # Written first: the planner knows its size and sends it to all tasks only where it is small; else both sides are
    # shuffled as plain scans, and AQE splits a hot host.
    known = saved(templates(source.select("host", "page", "html")), "templates").select("host", "boilerplate", "menus")

    def step(batches):
        none: list = []
        for batch in batches:
            fixed = [frozenset(x or none) for x in values(batch, "boilerplate")]
            menus = [frozenset(x or none) for x in values(batch, "menus")]
            yield {
                "page": values(batch, "page"), "url": values(batch, "url"),
                "text": [main_text(t or "", a, b) for t, a, b in zip(values(batch, "html"), fixed, menus)],
            }

    joined = source.join(known, "host", "left").select("page", "url", "html", "boilerplate", "menus")
    found = arrow_step(joined, step, "page long, url string, text string")
    return found.withColumnsRenamed({"page": id_column, "url": url_column})
