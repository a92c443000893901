"""HTML extraction by the maximum-scoring subsequence.

A page is a sequence of words and tags. Each token has a weight, learned from labelled pages as the log ratio of how
likely it is inside the main text and outside; words mostly score positive, tags and words in links negative. One
linear scan finds the contiguous region with the highest total (the first of equal ones).

Labelled pages are those that mark their own main text with exactly one ``article`` or ``main`` element (of nested ones the
innermost counts, if it is the only one there); the weights are per class of token, so a bounded sample of pages is enough (``max_pages``, smallest hashes of their ids). At prediction
words outside the only such element of a page score -1, and inside it nothing scores below 0: links and other text weigh at
least INSIDE of a word, tags 0, so the region holds all of its text. A page without the mark goes by the weights alone.

The region is widened to whole blocks, and elements that never hold main text are left out wherever they are:
menus, headers of the page, footers, sidebars, notices, adverts, forms, scripts, styles and comments, by element name, role,
class or id. Inside an article or main element ids say nothing, and a class counts only if each part of its name does: there
``alert-levels`` or ``side-effects`` are what the article is about. Math, the texts of drawings and the content of objects are part of the text around them. An element without an end
tag ends with the block around it, or, in math and drawings, at the next tag of HTML; only what HTML reads as raw text goes on
to the end of the page. References are decoded, white space inside a block becomes one space, blocks are joined in page order
by one \\n. NULL or empty html gives an empty text. Repeated rows are extracted alike; other columns are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import others

#: Element names by role (fixed values of HTML).
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul caption title head option select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content HTML reads as text up to their end tag.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements of other vocabularies, where a tag may close itself, and the start tags of HTML that end them.
FOREIGN = frozenset("svg math".split())
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
                       "ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Elements of other vocabularies that hold HTML.
HOLDS_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
#: Content of math and svg that is not shown.
NOT_SHOWN = frozenset("annotation annotation-xml desc metadata defs symbol".split())
MARKS = frozenset(("article", "main"))
NEVER = frozenset("nav footer aside form button select input option menu dialog head fieldset audio video map template canvas".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that a start tag of the key closes when they are open in the same block (fixed values of HTML).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: Words in class or id that name something other than main text (fixed values).
NOT_MAIN = re.compile(
    r"(?:^|(?<=[\s_-]))(ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|comment|comments|"
    r"commentlist|disqus|respond|replies|reply|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|pagination|pager|footer|foot|"
    r"header|masthead|sidebar|side|aside|rail|widget|related|recommended|cookie|cookies|consent|gdpr|notice|alert|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|toolbar|form|search|skip|hidden|copyright|legal|"
    r"disclaimer|tags|tagcloud|toc)(?=$|[\s_-]|\d)", re.IGNORECASE)
#: Those that name no menu, header, footer, sidebar, notice, advert, form or comment: inside an article they leave nothing out.
OUTSIDE_ONLY = frozenset("related recommended share sharing social skip copyright legal disclaimer tags tagcloud toc".split())
#: Parts of a class name that only say that it holds something (fixed values).
HOLDERS = frozenset("block box container content list wrap wrapper".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|([^<]+|<)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=\"'<>/]+)")


def _attributes(text: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_other(name: str, attributes: dict[str, str], in_main: bool) -> bool:
    """Whether an element never holds main text. A header inside an article is the article's own."""
    if name in NEVER or (name == "header" and not in_main):
        return True
    if attributes.get("role", "").strip().lower() in ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    if name in ("html", "body", "article", "main"):
        return False
    if not in_main:
        return any(NOT_MAIN.search(attributes.get(a, "")) for a in ("class", "id"))
    return any(_names_other(c) for c in attributes.get("class", "").lower().split())


def _names_other(name: str) -> bool:
    """Whether a class name, in lower case, names nothing but other text."""
    parts = {part.rstrip("0123456789") for part in re.split(r"[_-]+", name)} - HOLDERS - {""}
    return bool(parts) and all(NOT_MAIN.fullmatch(part) and part not in OUTSIDE_ONLY for part in parts)


Token = tuple[str, str, int, bool, bool]


def tokens(page: str) -> tuple[list[Token], bool]:
    """Tokens of a page, ``(kind, text, block number, marked, other)``, and whether the page marks exactly one region.

    kind: the class the weights are for, ``word``, ``link`` (a word in a link) or ``<name``. marked: inside the only article or
    main element that holds no other one; in any of them, if there are several. other: inside an element that never holds main
    text; marks there do not count. Linear in the length of the page, however its tags are nested.
    """
    out: list[tuple[str, str, int, int, bool]] = []  # with the number of the innermost mark, 0 outside
    open_tags: list[list] = []  # name, other, mark (0: none), still open
    # Places in open_tags: of each name, of blocks, of elements that decide the vocabulary.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    deciding: list[int] = []
    marks: list[int] = [0]  # open marks, innermost last
    holding: set[int] = set()  # marks with marks inside
    n_marks = depth_marked = 0
    block, at, links, other = 0, 0, 0, 0

    def end(entry: list) -> None:
        nonlocal links, other, depth_marked
        name, is_other, mark, _ = entry
        places[name].pop()
        entry[3] = False
        links -= name == "a"
        other -= is_other
        depth_marked -= name in MARKS
        if mark:
            marks.pop()  # marks are blocks, which close in turn

    def close(depth: int) -> None:
        while len(open_tags) > depth:
            entry = open_tags.pop()
            if entry[3]:
                end(entry)
            if blocks and blocks[-1] == len(open_tags):
                blocks.pop()
            if deciding and deciding[-1] == len(open_tags):
                deciding.pop()

    def vocabulary() -> int | None:
        """Place of the open math or svg element that the next tag belongs to; None in HTML."""
        while deciding and not open_tags[deciding[-1]][3]:
            deciding.pop()
        return deciding[-1] if deciding and open_tags[deciding[-1]][0] in FOREIGN else None

    while at < len(page):
        m = _TOKEN.match(page, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        if m[4] is not None:
            text = m[4]
            if text == "<":
                out.append(("text", "<", block, marks[-1], other > 0))
                continue
            out.append(("link" if links else "word", text, block, marks[-1], other > 0))
            continue
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            block += name in BLOCKS
            out.append((f"</{name}", "", block, marks[-1], other > 0))
            if places.get(name):
                depth = places[name][-1]
                if name in BLOCKS or not (blocks and blocks[-1] >= depth):
                    close(depth)
                else:  # an inline end tag does not end the blocks opened since
                    end(open_tags[depth])
            continue
        closed = (m[3] or "").rstrip().endswith("/")
        inner = vocabulary()
        if inner is not None and name in BREAKS_OUT:
            close(inner)
            inner = None
        if name in BLOCKS and inner is None:
            block += 1
            around = open_tags[blocks[-1]][0] if blocks else None
            if around == "p" or around in CLOSES.get(name, ()):  # a block ends an open paragraph
                close(blocks[-1])
        attributes = _attributes(m[3]) if m[3] else {}
        is_other = _is_other(name, attributes, depth_marked > 0) or (inner is not None and name in NOT_SHOWN)
        mark = 0
        if name in MARKS and not (other or is_other):
            n_marks += 1
            mark = n_marks
            if marks[-1]:
                holding.add(marks[-1])
        out.append((f"<{name}", "", block, marks[-1], other > 0 or is_other))
        if name in RAW and inner is None:
            found = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = found.end() if found else len(page)
            continue
        if name in VOID or closed:
            continue
        places.setdefault(name, []).append(len(open_tags))
        if name in BLOCKS:
            blocks.append(len(open_tags))
        if name in FOREIGN or name in HOLDS_HTML:
            deciding.append(len(open_tags))
        open_tags.append([name, is_other, mark, True])
        links += name == "a"
        other += is_other
        depth_marked += name in MARKS
        if mark:
            marks.append(mark)
    innermost = set(range(1, n_marks + 1)) - holding
    chosen = innermost if len(innermost) == 1 else range(1, n_marks + 1)
    return [(kind, text, n, mark in chosen, is_other) for kind, text, n, mark, is_other in out], len(innermost) == 1


def _pieces(kind: str, text: str) -> int:
    return len(text.split()) if kind in ("word", "link", "text") else 1


def count_tokens(page: str) -> dict[str, list[int]] | None:
    """``{kind: [inside, outside]}`` of a page with exactly one marked region; None for any other page."""
    found, one_mark = tokens(page)
    if not one_mark:
        return None
    out: dict[str, list[int]] = {}
    for kind, text, _, marked, other in found:
        n = _pieces(kind, text)
        if n:
            out.setdefault(kind, [0, 0])[not (marked and not other)] += n
    return out


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Weight by kind: the log ratio of its smoothed shares inside and outside, held to [-4, 4]; tags to
    [-1, -0.05], as a page may use inside its text what labelled pages use outside."""
    inside = sum(a for a, _ in counts.values()) + 1.0
    outside = sum(b for _, b in counts.values()) + 1.0
    out = {}
    for kind, (a, b) in counts.items():
        w = max(-4.0, min(4.0, math.log((a + 0.5) / inside) - math.log((b + 0.5) / outside)))
        out[kind] = max(w, 0.2) if kind == "word" else min(max(w, -1.0), -0.05) if kind.startswith("<") else max(w, -0.3)
    return out


#: Weights where no labelled page is found: words for, tags and links against.
DEFAULT_WEIGHTS = {"word": 1.0, "link": -0.3, "text": 0.0}
UNKNOWN_TAG = -0.5
#: Share of a word's weight that a piece of any kind has at least inside the only marked element.
INSIDE = 0.05


def best_region(scores: list[float]) -> tuple[int, int]:
    """Half-open bounds of the contiguous region with the highest sum, by one scan; empty if no score is above 0."""
    best = total = 0.0
    start = low = high = 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, low, high = total, start, i + 1
    return low, high


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The main text of a page."""
    if not page:
        return ""
    found, one_mark = tokens(page)
    least = INSIDE * max(weights.get("word", 0.0), 0.2)
    scores = []
    for kind, text, _, marked, other in found:
        if other:
            scores.append(0.0)  # left out in any case: neither ends a region nor adds to it
        elif kind in ("word", "link", "text"):
            n = len(text.split())
            if one_mark:
                scores.append(n * max(weights.get(kind, 0.0), least) if marked else -float(n))
            else:
                scores.append(n * weights.get(kind, 0.0))
        elif one_mark and marked:
            scores.append(0.0)
        else:
            scores.append(weights.get(kind, UNKNOWN_TAG))
    low, high = best_region(scores)
    if low == high:
        return ""
    # Widen to the whole blocks at both ends, and to a heading right before the region.
    first, last = found[low][2], found[high - 1][2]
    while low > 0 and found[low - 1][2] == first:
        low -= 1
    while high < len(found) and found[high][2] == last:
        high += 1
    at = low
    while at > 0 and found[at - 1][0][:1] == "<":
        at -= 1
    if at > 0 and not found[at - 1][4]:
        head = at - 1
        while head > 0 and found[head - 1][2] == found[at - 1][2]:
            head -= 1
        if found[head][0][1:] in HEADINGS:
            low = head
    blocks: list[list[str]] = []
    current = None
    for kind, text, block, _, other in found[low:high]:
        if block != current:
            blocks.append([])
            current = block
        if other:
            continue
        if kind in ("word", "link", "text"):
            blocks[-1].append(text)
        elif kind in ("<br", "</br"):
            blocks[-1].append(" ")
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def learn_weights(pages: DataFrame, max_pages: int = 2000) -> dict[str, float]:
    """Weights by kind of token, from a bounded sample of the pages that mark their main text."""
    marks = pages.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("page_id")
    ids = marks.distinct().orderBy(F.xxhash64(F.lit("html"), F.col("page_id"))).limit(max_pages)
    chosen = pages.select("page_id", "html").join(F.broadcast(ids), "page_id")  # at most max_pages ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(kind, a, b) for page in batch["html"] for kind, (a, b) in (count_tokens(page) or {}).items()]
            yield pd.DataFrame(rows, columns=["kind", "inside", "outside"])

    counted = chosen.mapInPandas(run, "kind string, inside long, outside long").groupBy("kind").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    frequent = counted.filter(F.col("kind").isin(*[f"{e}{n}" for e in ("<", "</") for n in BLOCKS | VOID | NEVER
                                                    | frozenset(("a", "b", "i", "em", "strong", "span", "u", "code", "sup", "sub"))],
                                                 "word", "link", "text")).collect()
    counts = {r["kind"]: (r["inside"], r["outside"]) for r in frequent}
    return weights_from(counts) if counts.get("word", (0, 0))[0] else dict(DEFAULT_WEIGHTS)


def extract(pages: DataFrame, weights: dict[str, float], column: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole html, in place of a ``column`` of theirs (not html)."""
    pages = pages.select(*others(pages, column))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{column: [main_text(p, weights) for p in batch["html"]]})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.mapInPandas(run, f"{schema}, `{column}` string")
