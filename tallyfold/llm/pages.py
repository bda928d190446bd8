"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score positive and tags negative; the weights are log-odds of standing inside or outside
the main text, counted on labelled pages (pages that mark it with exactly one article or main element). One linear scan finds the
contiguous region of the highest total. If the region lies in an article or main element, it is widened to that element. Parts that
are something else by their element or by the words of their class, id or role (menus, sidebars, adverts, notices, forms, comments
and so on) are left out and count like one tag.

Null pages are empty; so are pages without words outside such parts. Broken pages (open elements, stray tags, open comments) are read
as far as they go. Repeated rows and repeated or null page_ids are read one by one. Without labelled pages the weights are fixed
ones. An empty table gives an empty result. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import only

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|([^<]++|<)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Fixed names of HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img".split())
OTHER_PARTS = frozenset("head nav aside footer form button select dialog menu template object svg canvas audio video map fieldset datalist option".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table select menu".split())
#: Tags that stand in running text; unknown ones of them weigh little.
TEXT_TAGS = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 br hr blockquote pre figcaption".split())
#: Elements with a weight of their own; all others share one.
KNOWN = RAW | VOID | INLINE | OTHER_PARTS | CLOSES_P | TEXT_TAGS | LISTS | frozenset("html body div span li dt dd tr td th tbody thead tfoot caption summary label legend math svg".split())
OTHER_TAG = "other tag"
CONTAINERS = ("article", "main")
#: Words of a class, id or role that tell other parts of a page.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo complementary cookie cookies copyright "
    "dialog disclaimer disqus discussion donate footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall "
    "popup promo promotion recommended related replies reply respond respondents search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud "
    "teaser toolbar tooltip topbar widget widgets".split())
#: Of these, those that tell an article or main element that is not the page's own.
CONTAINER_HINTS = frozenset("ad advert advertisement comment comments promo recommended related replies reply respond sidebar sponsored teaser widget".split())
#: Words beside "header" in the header of a text.
TEXT_HEADER = frozenset("article entry post content story".split())
#: Labelled pages that weights are counted on, at most.
SAMPLE_PAGES = 3_000
LEAST, MOST = -8.0, 2.0
BOUNDARY = -1_000.0
FIXED_WEIGHTS = {"word": 1.0, "link word": 0.1}

Token = tuple[str, int, str]


def other_part(name: str, attributes: str, in_container: bool) -> bool:
    """Is the element something else than main text?"""
    if name in OTHER_PARTS or (name == "header" and not in_container):
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
        if key in ("class", "id", "role"):
            said = {w.lower() for w in HINT_WORD.findall(value)}
            if said & (CONTAINER_HINTS if name in CONTAINERS else HINTS) or ("header" in said and not in_container and not said & TEXT_HEADER):
                return True
    return False


def tokens(page: str) -> list[Token]:
    """kind (word, tag, part, open or close of a container), weight name or count of words, text.

    ("text", words, text), ("link", words, text), ("tag", 0, name), ("part", 0, ""), ("open", 0, name), ("close", 0, name)."""
    out: list[Token] = []
    stack: list[str] = []
    skip = -1  # the height of the stack at the part that is left out
    links = containers = 0
    at, end, last = 0, len(page), page.rfind(">")
    # heights of the open elements by name, of those that are not inline, and of lists: no search goes through the stack
    opened: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []
    lists: list[int] = []

    def pop_to(height: int) -> None:
        nonlocal skip, links, containers
        while len(stack) > height:
            name = stack.pop()
            opened[name].pop()
            if name not in INLINE:
                blocks.pop()
            if name in LISTS:
                lists.pop()
            if skip == len(stack):
                skip = -1
                out.append(("part", 0, ""))
            elif skip < 0:
                links -= name == "a"
                if name in CONTAINERS:
                    containers -= 1
                    out.append(("close", 0, name))

    while at < end:
        if at > last:  # no tag ends any more
            out.append(("link" if links else "text", len(page[at:].split()), page[at:])) if skip < 0 else None
            break
        m = TOKEN.match(page, at)
        at = m.end()
        if m[7] is not None:
            if skip < 0 and (n := len(m[7].split())):
                out.append(("link" if links else "text", n, m[7]))
            elif skip < 0:
                out.append(("text", 0, m[7]))
            continue
        name = m[2] or m[5]
        if name is None:  # a comment or declaration
            continue
        name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if opened[name]:
                height = opened[name][-1]
                # inline elements don't close blocks, and nothing in a part closes what is around it but blocks
                if not (name in INLINE and blocks and blocks[-1] >= height):
                    pop_to(height)
            if skip < 0:
                out.append(("tag", 0, "/" + name))
            continue
        if name in CLOSES_P and opened["p"]:
            height = opened["p"][-1]
            if blocks[-1] <= height:  # only inline elements are open in it
                pop_to(height)
        for sibling in SIBLINGS.get(name, ()):
            if opened[sibling]:
                height = opened[sibling][-1]
                if not (lists and lists[-1] > height):
                    pop_to(height)
        if name in RAW:
            close = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            if close:
                at = page.find(">", close.end() - 1)
                at = end if at < 0 else at + 1
            else:
                at = end
            continue
        if name in VOID or attributes.endswith("/") and name in ("svg", "path", "use"):
            if skip < 0:
                out.append(("tag", 0, name))
            continue
        if skip < 0 and other_part(name, attributes, containers > 0):
            skip = len(stack)
            out.append(("part", 0, ""))
        elif skip < 0:
            out.append(("tag", 0, name))
            links += name == "a"
            if name in CONTAINERS:
                containers += 1
                out.append(("open", 0, name))
        opened[name].append(len(stack))
        if name not in INLINE:
            blocks.append(len(stack))
        if name in LISTS:
            lists.append(len(stack))
        stack.append(name)
    pop_to(0)
    return out


def region(found: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """The slice of the highest total; of equals the first and longest."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    word, link, part, unknown = weights["word"], weights["link word"], weights.get("part", -4.0), weights.get(OTHER_TAG, -2.0)
    get = weights.get
    for i, (kind, n, text) in enumerate(found):
        if kind == "text":
            total += word * n
        elif kind == "link":
            total += link * n
        elif kind == "tag":
            total += get(text, -0.1 if text.strip("/") in TEXT_TAGS else unknown)
        elif kind == "part":
            total += part
        else:
            total += BOUNDARY
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def widened(found: list[Token], start: int, stop: int) -> tuple[int, int]:
    """The innermost article or main element around the region, or the region."""
    opened: list[tuple[str, int]] = []
    for i, (kind, _, name) in enumerate(found):
        if kind == "open":
            opened.append((name, i))
        elif kind == "close" and opened:
            _, a = opened.pop()
            if a < start and i >= stop:
                return a, i
    return start, stop


def text_of(found: list[Token]) -> str:
    """Text of the tokens, block by block."""
    blocks, run = [], []
    for kind, _, text in found:
        if kind in ("text", "link"):
            run.append(html.unescape(text))
        elif kind != "tag" or text.strip("/") not in INLINE:
            blocks.append("".join(run))
            run = []
    blocks.append("".join(run))
    return " ".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def main_text(page: str, weights: dict[str, float]) -> str:
    found = tokens(page)
    start, stop = region(found, weights)
    if stop == start:
        return ""
    start, stop = widened(found, start, stop)
    return text_of(found[start:stop])


def label_counts(page: str) -> Counter | None:
    """(weight name, inside) counts of a page with one container; None for others."""
    found = tokens(page)
    opens = [i for i, t in enumerate(found) if t[0] == "open"]
    if len(opens) != 1:
        return None
    a = opens[0]
    b = next((i for i, t in enumerate(found) if t[0] == "close"), len(found))
    out: Counter = Counter()
    for i, (kind, n, text) in enumerate(found):
        name = {"text": "word", "link": "link word", "tag": text if text.strip("/") in KNOWN else OTHER_TAG, "part": "part"}.get(kind)
        if name and text.strip("/") not in CONTAINERS:
            out[name, a < i < b] += n if kind in ("text", "link") else 1
    return out


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of each name, kept positive for words and negative for tags."""
    inside = sum(n for (_, x), n in counts.items() if x)
    outside = sum(n for (_, x), n in counts.items() if not x)
    if not inside:
        return dict(FIXED_WEIGHTS)
    out = dict(FIXED_WEIGHTS)
    for name in {k for k, _ in counts}:
        odds = math.log((counts.get((name, True), 0) + 1) / (inside + 2)) - math.log((counts.get((name, False), 0) + 1) / (outside + 2))
        out[name] = min(MOST, max(0.1, odds)) if name in FIXED_WEIGHTS else max(LEAST, min(-0.1, odds))
    out["word"] = max(out["word"], 0.5)
    return out


def fitted(pages: DataFrame, rows: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from at most ``rows`` pages, those of the smallest hashes of page_id; counted by Spark, one row per name."""
    chosen = only(pages, "page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(rows).withColumnRenamed("page_id", "chosen_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                total.update(label_counts(page or "") or {})
        yield pa.record_batch([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], ["name", "inside", "n"])

    sample = only(pages, "page_id", "html").join(F.broadcast(chosen), F.col("page_id").eqNullSafe(F.col("chosen_id"))).select("html")  # at most SAMPLE_PAGES ids
    counted = sample.mapInArrow(run, "name string, inside boolean, n long").groupBy("name", "inside").agg(F.sum("n").alias("n"))  # names are those of KNOWN
    return weights_of({(r.name, r.inside): r.n for r in counted.collect()})


def extracted(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars; a row per row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", weights) for p in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    types = dict(pages.dtypes)
    return only(pages, "page_id", "url", "html").mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
