"""Operator 9, main text of web pages by removing what a site repeats.

Every element's subtree is hashed; Spark counts on how many different pages of its host each hash stands,
and a subtree on ``LEAST`` of them, more on a host of over forty pages and ``MANY`` on one of any size, is template and goes.
List items and table cells recur as data, so they must stand on ``SHARE`` of a host's pages.
Pages of equal main text are copies of one page and count once. What holds an article is never template.
Text blocks inside an article never count as template: a sentence may recur without being one.
A host of few pages shows no repetition, so elements that by their name, role or class are
menus, headers, footers, sidebars, notices, adverts, forms or comments go as well. Names never take
a page's only article or main element, be it on that element or around it. A form around a page's only article, or around its
menus, is the frame of the page and no form. Where a page would be left without any text, forms with paragraphs stand, and
what holds or is an article.
"""

from __future__ import annotations

import re
import zlib
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import per_slice, saved

SHARE, LEAST = 0.5, 4
#: What must recur is a tenth of a host's different pages, but never more than so many.
TENTH, MANY = 0.1, 100
ITEMS = frozenset("li dt dd tr td th".split())
#: Largest hosts whose pages are dealt over several tasks, and how many pages a task then has.
LARGE, PART_PAGES = 1_000, 1_000

# Fixed lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
#: Start tags that end an open element of the named kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
#: An implied end never reaches beyond these.
SCOPE = frozenset("table ul ol dl article main section body html div blockquote td th".split())
#: Never template, nor is what holds an article or main element.
KEPT = frozenset("body html article main".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tr td th tbody thead figure figcaption".split())
DROPPED = frozenset("head script style noscript template iframe title nav footer aside form button select textarea menu dialog "
                    "svg object canvas noembed noframes xmp math audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr menu modal nav navbar navigation newsletter notice notices popup promo promotion related replies "
    "share sharing sidebar social sponsor sponsored subscribe widget".split())

#: Names of what readers write, also of an article, and where it may stand.
COMMENTS = frozenset("comment comments commentform commentlist commentsection replies reply reviews".split())
READERS = frozenset("article blog customer entry post public reader readers story user users visitor visitors".split())
#: What a form around a page has inside, and what one that is all of a page has.
FRAME, PROSE = frozenset(["nav"]), frozenset("p h1 h2 h3 h4 h5 h6".split())

#: A mark may stand behind one of these, as in site-footer.
PLACES = frozenset("bottom global main page primary secondary site top".split())
#: Behind a mark these tell of a state or layout of the page (nav-open, sidebar-left), not what the element is.
STATES = frozenset(
    "active bottom closed collapsed disabled enabled expanded fixed free hidden inactive layout left none off on open opened "
    "present right shown sticky top visible".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[-_:]+")
_SPACE = re.compile(r"\s+")
#: In the text as it is: lower-cased, some letters take more places.
_RAW_ENDS = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}


class Element:
    __slots__ = ("tag", "inside", "dropped", "parts", "first", "marks", "holds")

    def __init__(self, tag: str, inside: bool, dropped: bool, marks: str, first: int):
        self.tag, self.inside, self.dropped, self.marks, self.first = tag, inside, dropped, marks, first
        self.parts: list[str] = []
        self.holds = tag in KEPT  # whether it is or has an article or main element


def _is_mark(name: str, is_id: bool, marks: frozenset[str] = MARKS | COMMENTS) -> bool:
    """Whether a whole class name or id is a mark, begins with one (sidebar-inner), is one with its place (site-footer) or
    one of what readers write (user-reviews)."""
    head, *rest = [w for w in _PART.split(name) if w] or [""]
    head = head.rstrip("0123456789")
    if not rest:
        return head in marks
    if head in READERS:
        return rest[0] in COMMENTS and rest[-1] not in STATES
    if head in PLACES:
        return len(rest) == 1 and rest[0] in marks
    return head in marks and (is_id or rest[-1] not in STATES)


def _is_aside(tag: str, attrs: str, inside: bool) -> tuple[bool, bool, str]:
    """Whether an element is no main text by its tag or role, whether by its names, and what its hash says of its attributes."""
    if tag == "form":
        return False, True, ""
    if tag in DROPPED or tag == "header" and not inside:
        return True, False, ""
    if not attrs or tag in ("html", "body"):
        return False, False, ""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)}
    marks = COMMENTS if tag == "article" else frozenset() if tag in KEPT else MARKS | COMMENTS
    named = bool(marks) and (any(_is_mark(c, False, marks) for c in found.get("class", "").split()) or _is_mark(found.get("id", ""), True, marks))
    return found.get("role") in ROLES, named, f"{found.get('class', '')}|{found.get('id', '')}"


def parse(html: str, template: frozenset[int] = frozenset(), hashes: list | None = None, lifted: frozenset[int] = frozenset()) -> str:
    """The main text of a page; ``hashes`` gets the hashes of subtrees that may be template.

    Blocks are kept with whether they stand inside an article or main element; if any does, only
    those count. A subtree whose hash is in ``template`` is taken out once its end is seen. Where all
    articles stand in forms or elements dropped by name, or a form is the frame of the page, the page is parsed again with these ``lifted``.
    If there is no text at all, so are forms with paragraphs, dropped elements that hold an article, and articles of comments.
    """
    named: dict[int, Element] = {}  # elements dropped by name and forms, by where their tag ends
    others: dict[int, Element] = {}  # elements dropped by tag or role
    around: set[int] = set()  # of the first kind, those that hold an article or main element
    frames: set[int] = set()  # forms around the page
    last: set[int] = set()  # what is lifted only if there would be no text
    free = False  # whether there is text in an article outside of them
    gone = False  # whether a template had text
    blocks: list[tuple[bool, str]] = []
    text: list[str] = []
    stack = [Element("", False, False, "", 0)]

    def flush() -> None:
        nonlocal free
        if text:
            if joined := _SPACE.sub(" ", unescape("".join(text))).strip():
                free |= stack[-1].inside
                blocks.append((stack[-1].inside, joined))
            text.clear()

    def close(element: Element) -> None:
        nonlocal gone
        if element.inside and element.tag in TEXT_BLOCKS or element.tag not in BLOCK:
            digest = f"<{element.tag}{element.marks}>" + "".join(element.parts)
        else:
            flush()
            # The last bit tells items from others.
            value = (xxhash.xxh3_64_intdigest(f"{element.tag}|{element.marks}|{''.join(element.parts)}") - (1 << 63)) & ~1 | (element.tag in ITEMS)
            if hashes is not None and not element.holds:
                hashes.append(value)
            if value in template and not element.holds:
                gone |= len(blocks) > element.first
                del blocks[element.first:]
            digest = f"#{value}"
        stack[-1].holds |= element.holds
        stack[-1].parts.append(digest)

    def end(tag: str) -> None:
        if any(e.tag == tag for e in stack):
            while (element := stack.pop()).tag != tag:
                close(element)
            if tag in BLOCK:
                stack.append(element)
                flush()
                stack.pop()
            close(element)

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        piece = html[at:m.start()] if m else html[at:]
        if piece:
            top = stack[-1]
            top.parts.append(piece.strip())
            if not top.dropped:
                text.append(piece)
        if not m:
            break
        at = m.end()
        if not (tag := m[2]):
            continue
        tag = tag.lower()
        if m[1]:
            end(tag)
            continue
        if tag == "br":
            text.append(" ")
        if tag in BLOCK:
            flush()
            kinds = ENDS.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p" or stack[k].tag in kinds:
                    end(stack[k].tag)
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        inside = stack[-1].inside or tag in ("article", "main")
        aside, by_name, marks = _is_aside(tag, m[3], stack[-1].inside)
        by_name &= at not in lifted
        aside &= at not in lifted
        if named and (tag in FRAME or tag in PROSE):
            (frames if tag in FRAME else last).update(k for k, e in named.items() if e.tag == "form" and e in stack)
        if inside and not stack[-1].inside:
            # An article of comments is none that its surroundings could be lifted for.
            (last if by_name else around).update(k for k, e in named.items() if e in stack)
            last.update(k for k, e in others.items() if e in stack)
            if by_name:
                last.add(at)
        stack.append(Element(tag, inside, stack[-1].dropped or aside or by_name, marks, len(blocks)))
        if by_name:
            named[at] = stack[-1]
        elif aside and tag not in RAW:
            others[at] = stack[-1]
        if tag in RAW:
            end_tag = _RAW_ENDS[tag].search(html, at)
            over = end_tag.start() if end_tag else n
            stack[-1].parts.append(html[at:over])
            at = over
    while len(stack) > 1:
        flush()
        close(stack.pop())
    flush()
    lift = (around if not free else set()) | frames or (last | around if not blocks and not gone else set())
    if lift - lifted:
        if hashes is not None:
            hashes.clear()
        return parse(html, template, hashes, lifted | lift)
    main = any(inside for inside, _ in blocks)
    return "\n".join(b for inside, b in blocks if inside or not main)


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def subtree_counts(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, hash, n): on how many different pages of its host each subtree hash stands, if on ``least`` at least; without
    a hash, how many different pages the host has. Pages of equal main text, before templates go, are one page.

    Copies go first, dealt by host, hash and page, then tasks count: a host with a third of all pages arrives as one row
    a task and hash.
    """
    def run(rows: dict) -> dict:
        out: dict[str, list] = {"host": [], "hash": [], "page": []}
        seen = set()
        for url, html in zip(rows["url"], rows["html"], strict=True):
            page = xxhash.xxh3_64_intdigest(parse(html, hashes=(own := [])).encode("utf-8", "surrogatepass")) - (1 << 63)
            name = host(url)
            for value in {*own, None}:  # the null row counts the page itself
                if (name, value, page) not in seen:
                    seen.add((name, value, page))
                    for column, x in zip(out.values(), (name, value, page), strict=True):
                        column.append(x)
        return out

    once = per_slice(_pages(pages), "host string, hash long, page long", run).distinct()
    counted = once.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    return saved(counted.where(F.col("hash").isNull() | (F.col("n") >= least)), "subtree-counts")


def templates(counts: DataFrame, share: float = SHARE, many: int = MANY) -> DataFrame:
    """(host, template): the subtree hashes that recur across a host's different pages, packed as 64-bit numbers.

    At most ``1 / many`` of a large host's subtrees, or ten times those of a page.
    """
    def pack(rows: dict) -> dict:
        return {"host": rows["host"], "template": [np.array(t, np.int64).tobytes() for t in rows["template"]]}

    total = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    least = F.when(F.col("hash").bitwiseAND(1) == 1, share * F.col("pages")).otherwise(F.least(F.lit(float(many)), TENTH * F.col("pages")))
    found = counts.where("hash is not null").join(total, "host").where(F.col("n") >= least)
    return per_slice(found.groupBy("host").agg(F.collect_list("hash").alias("template")), "host string, template binary", pack)


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))


def extract(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, repeated rows included.

    A null or empty page has an empty text; a page whose url names no host shares the host "".
    Other columns of ``pages`` are ignored. Pages meet their host's template compressed; those of the ``LARGE`` largest hosts
    are dealt over as many parts as they have thousands of pages, each with a copy of the template.
    """
    spark = pages.sparkSession
    counts = subtree_counts(pages, least)
    named = per_slice(pages.select("url"), "host string", lambda r: {"host": [host(u) for u in r["url"]]})
    largest = named.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "host").limit(LARGE).collect()
    parts = {r.host: -(-r.n // PART_PAGES) for r in largest if r.n > PART_PAGES}

    def pack(rows: dict) -> dict:
        press = zstandard.ZstdCompressor(level=3)
        hosts = [host(u) for u in rows["url"]]
        packed = [press.compress(h.encode("utf-8", "surrogatepass")) for h in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "host": hosts, "packed": packed,
                "part": [zlib.crc32(f"{i} {len(p)}".encode()) % parts.get(h, 1) for i, h, p in zip(rows["page_id"], hosts, packed, strict=True)]}

    def run(rows: dict) -> dict:
        press = zstandard.ZstdDecompressor()
        known = {t: frozenset(np.frombuffer(t or b"", np.int64).tolist()) for t in set(rows["template"])}
        new = [parse(press.decompress(p).decode("utf-8", "surrogatepass"), known[t])
               for p, t in zip(rows["packed"], rows["template"], strict=True)]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": new, "n_chars": [len(t) for t in new]}

    key = pages.schema["page_id"].dataType.simpleString()
    hosted = per_slice(_pages(pages), f"page_id {key}, url string, host string, packed binary, part int", pack)
    # At most LARGE rows.
    split = F.broadcast(spark.createDataFrame(sorted(parts.items()), "host string, parts int"))
    found = (templates(counts, share).join(split, "host", "left")
             .select("host", "template", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")))
    return per_slice(hosted.join(found, ["host", "part"], "left").select("page_id", "url", "packed", "template"),
                     f"page_id {key}, url string, text string, n_chars long", run)
