"""Main text of web pages by tree scoring.

A page is read into a tree (tags, their implied ends, no scripts or comments).
What names itself as no part of the article goes first: elements such as menus,
footers, sidebars and forms, and elements whose role, class or id says menu,
advert, notice, reader comments and the like.  Then every paragraph passes points
to its ancestors: one, one for each comma, one for each 100 characters (three at
most); its parent gets all of them, the next ancestors ever smaller parts.  The
points of an element are discounted by its link density (the share of its
characters inside links).  The best element is the container; inside an
``article`` that whole article is.  Siblings are kept if they have a fifth of its
points, its class, or are paragraphs of prose, and headings before kept ones.

All blocks of the kept elements are returned: character references decoded, white
space inside a block turned into one blank, blocks joined by one blank in page
order.  Nothing is cut off, however short or long.

Pages are independent of each other, so the job is one pass over the table
without a shuffle.  Reading is linear in the page's size, also for broken markup
(missing ends, unclosed quotes, pages cut off in the middle).

Defined results: a null or empty page has the empty text, and so has a page
without any text outside dropped elements; repeated rows give equal rows; all
other columns are kept, ``text`` takes another name where that is taken; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .chunks import by_bytes
from .tables import fresh, read

# Fixed values of the markup language: elements without content, of raw text, that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select
    summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of the given kind, up to the elements that bound the search.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "option": (("option",), ("select",))}
#: Blocks that stand in paragraphs' place: their points go to the parent. Other blocks with text of their own get them.
PARAGRAPHS = frozenset("p li dd dt pre blockquote figcaption h1 h2 h3 h4 h5 h6 summary caption".split())

DROPPED = frozenset("""aside audio button canvas dialog fieldset footer form head iframe input label menu nav noembed noframes
    noscript object option script search select style svg template textarea title video xmp""".split())
ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status
    toolbar tooltip""".split())
READERS = re.compile(r"comments?(list|area|section|box|form|thread|er|ers)?|commentlists?|disqus\w*|respond|responses?|reactions?"
                     r"|repl(y|ies)|kommentare?|commentaires?|comentarios?")
OTHERS = re.compile(
    r"ads?|adv|adverts?|advertis\w+|adsense|ad(box|slot|banner|container|unit|wrapper)|adsby\w+|sponsor\w*|promo\w*|banners?"
    r"|(top|sub|main|site|foot|side|global)?nav(bar|igation|s)?|(top|sub|main|side)?menu(bar|s)?|breadcrumbs?|side_?bars?"
    r"|(site|page)?footers?|masthead|top_?bar|toolbar|skip(links?|nav)?|cookies?\w*|consent|gdpr|notices?|notifications?|alerts?"
    r"|popups?|popovers?|modals?|overlays?|share|sharing|share(bar|links|this)|social(media|bar|links|share|icons)?|related"
    r"|recommend(ed|ations?)|newsletters?|subscri(be|ption)|sign(up|in)|login|paywall|pagination|pager|search(box|form|bar)?"
    r"|copyright|outbrain|taboola|trending|feedback|announcements?|werbung|anzeigen?|hinweise?|publicite|publicidad|anuncios?|avisos?")
ARTICLE_WORDS = frozenset("article body content entry hentry main post story text".split())
QUALIFIERS = frozenset("has hide is no not show with without".split())
STATES = frozenset("open closed enabled disabled count off on".split())

_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.S)
# A quote opens a value only behind "="; possessive, so that nothing is read twice.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)>""")
_OTHER = re.compile(r"<[!?/][^>]*+>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SENTENCE = re.compile(r"[.!?…。！？](\s|$)")
_RIGHTS = re.compile(r"(©|\(c\)\s|copyright\b)", re.I)


def _label(attributes: str) -> tuple[str, dict]:
    """What the attributes say of an element ("readers", "other" or ""), and the attributes."""
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return "hidden", found
    if found.get("role", "").lower() in ROLES:
        return "other", found
    says, article = "", False
    for token in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(token)]
        if not words or words[0] in QUALIFIERS or words[-1] in STATES:
            continue
        article |= all(w in ARTICLE_WORDS for w in words)
        if any(READERS.fullmatch(w) for w in words):
            says = "readers"
        elif any(OTHERS.fullmatch(w) for w in words) or "header" in words and not ARTICLE_WORDS.intersection(words):
            says = says or "other"
    return ("" if article else says), found


class Page:
    """Elements in page order (each with its parent) and the texts between tags."""

    def __init__(self, html: str):
        self.parent, self.tag, self.says, self.look, self.linked = [-1], ["#page"], [""], [""], [False]
        self.texts: list[tuple[int, str] | None] = []    # None: a block begins or ends
        self.stack, self.open = [0], {}
        end = html.rfind(">") + 1
        at = 0
        while at < end:
            start = html.find("<", at, end)
            if start < 0:
                start = end
            if start > at:
                self._text(html[at:start])
            if start == end:
                break
            at = self._markup(html, start)
        rest = html[max(at, end):]
        cut = re.search(r"<[a-zA-Z/!?]", rest)
        self._text(rest[:cut.start()] if cut else rest)
        self.texts.append(None)

    def _text(self, raw: str) -> None:
        if raw:
            self.texts.append((self.stack[-1], unescape(raw) if "&" in raw else raw))

    def _markup(self, html: str, start: int) -> int:
        m = _TAG.match(html, start)
        if m is None:
            m = _COMMENT.match(html, start) or _OTHER.match(html, start)
            if m is None:
                self._text("<")
                return start + 1
            return m.end()
        name = m[2].lower()
        if m[1]:
            self._end(name)
            return m.end()
        self._start(name, m[3])
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(html, m.end())
            self._end(name)
            return close.end() if close else len(html)
        return m.end()

    def _close(self, to: int) -> None:
        """Close the open elements down to position ``to`` of the stack, that one included."""
        for node in self.stack[to:]:
            self.open[self.tag[node]] -= 1
        del self.stack[to:]

    def _start(self, name: str, attributes: str) -> None:
        block = name in BLOCKS
        if name == "br":
            self._text("\n")
        if block:
            self.texts.append(None)
            if self.open.get("p"):
                self._end_inside("p", ("table", "td", "th", "button", "object"))
        kinds, bounds = ENDS.get(name, ((), ()))
        if any(self.open.get(k) for k in kinds):
            for k in kinds:
                self._end_inside(k, bounds)
        if name in VOID:
            return
        says, found = _label(attributes) if "=" in attributes or "hidden" in attributes else ("", {})
        if name == "a" and self.open.get("a"):
            self._end("a")
        up = self.stack[-1]
        self.parent.append(up)
        self.tag.append("article" if found.get("itemprop") == "articleBody" or found.get("role") == "article" else name)
        self.says.append(says)
        self.look.append(found.get("class", ""))
        self.linked.append(self.linked[up] or name == "a")
        node = len(self.tag) - 1
        if not attributes.endswith("/") or name not in ("path", "use", "circle", "rect"):
            self.stack.append(node)
            self.open[self.tag[node]] = self.open.get(self.tag[node], 0) + 1

    def _end_inside(self, name: str, bounds) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[i]]
            if tag == name:
                self._close(i)
                return
            if tag in bounds:
                return

    def _end(self, name: str) -> None:
        if name in BLOCKS:
            self.texts.append(None)
        if name == "br":
            self._text("\n")
        if not self.open.get(name):
            if self.open.get("article") and name in ("div", "section", "main"):   # an article by its attributes
                name = "article"
            else:
                return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[i]]
            if tag == name:
                self._close(i)
                return
            if name not in BLOCKS and tag in BLOCKS:
                return                      # an inline end does not close blocks


def _sums(page: Page, own: list) -> list:
    """Sum over each element and all below it."""
    total = list(own)
    for i in range(len(total) - 1, 0, -1):
        total[page.parent[i]] += total[i]
    return total


def _dropped(page: Page) -> list[bool]:
    n = len(page.tag)
    chars = [0] * n
    holds = [0] * n
    for i in range(n):
        if page.tag[i] in ("article", "main") and page.says[i] != "readers":
            holds[i] = 1
    for t in page.texts:
        if t is not None:
            chars[t[0]] += len(t[1])
    # Scripts and the like count for no share of the text.
    for i in range(n):
        if page.tag[i] in RAW:
            chars[i] = 0
    chars, holds = _sums(page, chars), _sums(page, holds)
    out = [False] * n
    inside = [False] * n
    for i in range(1, n):
        up, tag, says = page.parent[i], page.tag[i], page.says[i]
        inside[i] = inside[up] or tag in ("article", "main")
        # What wraps an article, or nearly all of the page, is no side matter (forms and overlays around pages).
        wraps = holds[i] > 0 or (says != "readers" and chars[i] > 0.8 * chars[0])
        drop = says == "hidden"
        if tag in ("form", "fieldset"):
            drop |= not wraps
        elif tag in DROPPED:
            drop = True
        elif tag == "header":
            drop |= not inside[i] and not wraps
        if says == "readers" and tag not in ("html", "body", "main"):
            drop |= tag == "article" or not holds[i]
        elif says == "other" and tag not in ("html", "body", "main", "article"):
            drop |= not wraps
        out[i] = out[up] or drop
    return out


def _blocks(page: Page, dropped: list[bool]) -> list[tuple[int, str, int, int]]:
    """(element, text, characters in links, links) of each block with text, in page order."""
    block = [0] * len(page.tag)
    for i in range(1, len(block)):
        block[i] = i if page.tag[i] in BLOCKS else block[page.parent[i]]
    out, parts, where, linked, links, last = [], [], 0, 0, 0, -1
    for t in page.texts:
        if t is None:
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    out.append((where, text, min(linked, len(text)), links))
                parts, linked, links, last = [], 0, 0, -1
        elif not dropped[t[0]]:
            if not parts:
                where = block[t[0]]
            parts.append(t[1])
            if page.linked[t[0]]:
                linked += len(t[1].strip())
                links += t[0] != last
                last = t[0]
    return out


def _points(text: str) -> float:
    if len(text) < 25:
        return len(text) / 250
    return 1 + sum(map(text.count, ",，、،")) + min(len(text) / 100, 3)


def _kept(page: Page, blocks: list) -> set[int]:
    """The best container and its siblings that belong to it."""
    n = len(page.tag)
    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    said: list[list[str]] = [[] for _ in range(n)]
    for node, text, in_links, _ in blocks:
        chars[node] += len(text)
        linked[node] += in_links
        said[node].append(text)
        p = _points(text) * (1 - in_links / len(text))
        up, level = (page.parent[node] if page.tag[node] in PARAGRAPHS else node), 0
        while up > 0 and level < 6:
            points[up] += p / (1, 2, 6, 9, 12, 15)[level]
            up, level = page.parent[up], level + 1
    chars, linked = _sums(page, chars), _sums(page, linked)

    def density(i):
        return linked[i] / chars[i] if chars[i] else 0.0
    score = [(points[i] + (25 if page.tag[i] in ("article", "main") else 0)) * (1 - density(i)) if points[i] else 0.0
             for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i)) if any(score) else 0
    up = best
    while up > 0:
        if page.tag[up] == "article":
            best = up
        up = page.parent[up]
    up = page.parent[best]
    if best == 0 or page.tag[best] in ("html", "body"):
        return {best}
    near = [i for i in range(1, n) if page.parent[i] == up and chars[i]]
    kept = set()
    for i in near:
        prose = density(i) < 0.25 and not any(_RIGHTS.match(t) for t in said[i])
        if i == best or prose and score[i] >= max(1, 0.2 * score[best]):
            kept.add(i)
        elif prose and page.look[i] and page.look[i] == page.look[best]:
            kept.add(i)
        elif prose and page.tag[i] in PARAGRAPHS - HEADINGS and (chars[i] > 80 or any(map(_SENTENCE.search, said[i]))):
            kept.add(i)
    follows = False
    for i in reversed(near):            # headings before what is kept
        if page.tag[i] in HEADINGS and follows and density(i) < 0.25:
            kept.add(i)
        follows = i in kept
    return kept


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = Page(html)
    blocks = _blocks(page, _dropped(page))
    if not blocks:
        return ""
    kept = _kept(page, blocks)
    n = len(page.tag)
    chars, linked, links = [0] * n, [0] * n, [0] * n
    for node, text, in_links, count in blocks:
        chars[node] += len(text)
        linked[node] += in_links
        links[node] += count
    chars, linked, links = _sums(page, chars), _sums(page, linked), _sums(page, links)
    inside, article = [0 in kept] * n, [False] * n
    for i in range(1, n):
        up = page.parent[i]
        article[i] = article[up] or page.tag[i] == "article"
        inside[i] = inside[up] or i in kept
        # Outside articles, rows of short links are menus without a name.
        if not article[i] and i not in kept and links[i] > 2 and linked[i] > 0.8 * chars[i] and linked[i] < 40 * links[i]:
            inside[i] = False
    return " ".join(text for node, text, _, _ in blocks
                    if inside[node] and (article[node] or len(text) > 300 or not _RIGHTS.match(text)))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the column ``text`` in place of ``html``."""
    name, = fresh(pages.drop(html), "text")
    kept = [f for f in pages.schema.fields if f.name != html]
    names = [f.name for f in kept] + [name]

    def run(batches):
        for b in by_bytes(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([main_text(x) for x in b.column(0).to_pylist()], pa.string())], names)
    return pages.select(html, *[f"`{f.name}`" for f in kept]).mapInArrow(run, StructType(kept).add(name, StringType()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
