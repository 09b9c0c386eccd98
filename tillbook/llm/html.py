"""Main-text extraction from web pages by tree scoring.

A page becomes a tree of its elements. Parts that are never article text (menus, forms, scripts, adverts,
comments and the like, by element, role or class) are left out. Every paragraph earns points for its
length and its commas, less its share of link text, and passes them on to its ancestors, the nearest most.
The container with the most points, less its own share of link text, is kept, with those siblings that
score or read like it; if it lies in an <article> or <main>, or in a container named like an article, the
nearest of these is kept in its place. All its blocks are returned, short ones too.

A name is judged with the other names of its element: an <article> is left out only if one of its classes means
nothing but a part beside the article ("comment", "cookie-notice") and none names the article, and a container that is
named like the article only by its id. Names in which such a word is one among others ("sidebar-right",
"site-notice") leave other containers out, unless the page has by far its most points in them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from tillbook.llm.common import fields, map_text

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)                                           # comment
      | <[!?][^>]*(?:>|\Z)                                          # declaration
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)                      # tag, up to its attributes
    """,
    re.S | re.X,
)
_STOP = re.compile("[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}
_ATTRIBUTE = re.compile(r"""([^\s/=][^\s/=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'][^\s]*+))?+""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody tfoot thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset("html body main article section div td center blockquote".split())
#: Elements that never hold article text.
NEVER = frozenset(
    "head nav footer aside form button select dialog menu script style noscript template iframe object embed svg "
    "canvas audio video textarea title xmp map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
#: Words in a class or an id that mark a part beside the article.
ASIDE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup sidebar sidenav widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments commentlist disqus respond reply replies share sharing social related recommended "
    "recommendations pagination pager toolbar copyright login search skip".split()
)
#: Words that mark the article itself; in one name, they outweigh others before them (but not after: "main-menu").
ARTICLE_WORDS = frozenset("article body content entry main post story text".split())
#: A start tag of the first kind ends an open element of the second, unless a third lies between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: Words after which a name tells what an element has, not what it is.
_HAVING = frozenset("with has have no without is".split())
#: Words by which a name tells that an element is the article, whatever its other names.
OWN_WORDS = frozenset("article content entry main post story".split())
#: Words that add nothing to the word of a part beside the article ("comment-list", "widget-area").
FILL_WORDS = frozenset("area bar block box container group holder inner item items links list outer panel section wrap wrapper".split())
#: Readers' comments, in whatever name.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())

#: Readings of a page: by all names; by those that name a part clearly; by none.
ALL_NAMES, CLEAR_NAMES, NO_NAMES = 2, 1, 0
#: The second reading takes the place of the first if its container has so many times its points.
MORE_POINTS = 3.0

LEAST_PARAGRAPH = 25
LEAST_SIBLING = 80
SIBLING_SHARE = 0.2
CLASS_POINTS = 25.0


def _attributes(text: str) -> dict[str, str]:
    """Values by name in lower case; of a name that repeats, the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    """Whether an element with these attributes is not shown."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    style = {}
    for declaration in attributes.get("style", "").lower().split(";"):
        name, _, value = declaration.partition(":")
        style[name.strip()] = value.partition("!")[0].strip()
    return style.get("display") == "none" or style.get("visibility") == "hidden"


class Page:
    """The elements of a page in the order of their start; ``parent`` points back."""

    def __init__(self, source: str, names: int) -> None:
        self.names = names
        self.doubtful = False  # a part was left out for a name that need not mean it
        self.points = 0.0
        self.tags, self.parents, self.dropped, self.bonus = ["html"], [-1], [False], [0.0]
        self.parts: list[tuple[int, str]] = []  # (element, text) in page order; an empty text is white space
        self._stack = [0]
        self._open = Counter()
        self._astray: set[int] = set()  # quotes from which no end of a tag is reached
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = _MARKUP.search(source, at)
            if not found:
                self._text(source[at:])
                return
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            tag = (found["tag"] or "").lower()
            if not tag:
                continue
            stop = self._tag_end(source, at)
            attributes = source[at:stop] if stop >= 0 else ""
            if stop < 0:  # quotes that do not close, or a cut page
                stop = source.find(">", at)
            at = stop + 1 if stop >= 0 else end
            if found["end"]:
                self._close(tag)
                continue
            self._start(tag, attributes)
            if tag in _RAW_END and not attributes.endswith("/"):
                stop = _RAW_END[tag].search(source, at)
                at = stop.start() if stop else end

    def _tag_end(self, source: str, at: int) -> int:
        """Where the > of a tag is, outside quotes of any length; -1 if there is none.

        No quote is passed twice in vain, so that a page takes linear time.
        """
        passed = []
        while found := _STOP.search(source, at):
            quote = found.start()
            if found[0] == ">":
                return quote
            if quote in self._astray:
                break
            passed.append(quote)
            at = source.find(found[0], quote + 1) + 1
            if not at:
                break
        self._astray.update(passed)
        return -1

    def _text(self, text: str) -> None:
        element = self._stack[-1]
        if not self.dropped[element]:
            self.parts.append((element, html.unescape(text)))

    def _pop(self) -> None:
        self._open[self.tags[self._stack.pop()]] -= 1

    def _pop_through(self, closing: set[str], bounds: set[str] | frozenset[str]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in closing:
                while len(self._stack) > depth:
                    self._pop()
                return
            if tag in bounds:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                self.parts.append((self._stack[-1], "" if tag == "wbr" else " "))
            return
        if tag in BLOCK and self._open["p"]:
            self._pop_through({"p"}, BLOCK | {"td", "th"})
        if tag in _CLOSES:
            closing, bounds = _CLOSES[tag]
            if any(self._open[t] for t in closing):
                self._pop_through(closing, bounds)
        parent = self._stack[-1]
        dropped, bonus = self._judge(tag, attributes, parent)
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(dropped)
        self.bonus.append(bonus)
        if attributes.endswith("/") and tag not in BLOCK:
            return
        self._stack.append(len(self.tags) - 1)
        self._open[tag] += 1

    def _close(self, tag: str) -> None:
        if self._open[tag] > 0:
            self._pop_through({tag}, frozenset())

    def _judge(self, tag: str, attributes: str, parent: int) -> tuple[bool, float]:
        """Whether the element is left out, and its points for being named like an article."""
        if self.dropped[parent] or tag in NEVER:
            return True, 0.0
        titled = self._open["article"] or self._open["main"]
        if tag == "header" and not titled:
            return True, 0.0
        bonus = CLASS_POINTS if tag in ("article", "main") else 0.0
        if self.tags[parent] == "header" and tag not in HEADING and tag not in ("div", "hgroup"):
            return True, 0.0  # of the header of an article, its headings stay
        if not attributes:
            return False, bonus
        named = _attributes(attributes)
        if _hidden(named):
            return True, 0.0
        if not self.names:
            return False, bonus
        article = own = pure = clear = loose = pure_id = False
        for name in ("class", "id", "role"):
            value = named.get(name, "")
            if name == "role" and value.strip().lower() in ROLES:
                return True, 0.0
            for one in value.split():
                words = [w.lower() for w in _PARTS.findall(one)]
                article |= not ARTICLE_WORDS.isdisjoint(words)
                if not _HAVING.isdisjoint(words) or ASIDE_WORDS.isdisjoint(words):
                    own |= not OWN_WORDS.isdisjoint(words)
                elif ARTICLE_WORDS.isdisjoint(words) or words[-1] in ASIDE_WORDS:
                    bare = ASIDE_WORDS.union(FILL_WORDS, ARTICLE_WORDS).issuperset(words)
                    pure |= bare
                    pure_id |= bare and name == "id"
                    clear |= bare or not COMMENT_WORDS.isdisjoint(words)
                    loose = True
        if loose and tag not in ("html", "body", "main") and not (tag in HEADING and titled):
            # An <article>, or what is named like one, has words of its subjects and its layout in its names too.
            if tag == "article":
                aside = pure and not own
            else:
                aside = pure_id if own else clear or self.names == ALL_NAMES
                self.doubtful |= aside and not own and not clear
            if aside:
                return True, 0.0
        return False, bonus + (CLASS_POINTS if article and tag in CONTAINER else 0.0)

    def _article_of(self, best: int) -> int:
        """The nearest <article> or <main> around a container, else the nearest one named like an article, else itself.

        Points of paragraphs outgrow the fixed ones for an article: without this, a long article would lose
        what the same layout keeps when it is short.
        """
        named, at = -1, best
        while at > 0:
            if self.tags[at] in ("article", "main"):
                return at
            if named < 0 and self.bonus[at] and self.tags[at] not in ("html", "body"):
                named = at
            at = self.parents[at]
        return best if named < 0 else named

    def main_blocks(self) -> list[str]:
        """The blocks of the best container and of the siblings that go with it, in page order."""
        n = len(self.tags)
        block = list(range(n))  # the nearest block element
        link = [False] * n
        for i in range(1, n):
            tag = self.tags[i]
            if tag not in BLOCK and tag not in ("td", "th"):
                block[i] = block[self.parents[i]]
            link[i] = tag == "a" or link[self.parents[i]]
        own, own_link, commas = [0] * n, [0] * n, [0] * n
        last: list[str] = [""] * n
        for element, text in self.parts:
            text = " ".join(text.split())
            if text:
                b = block[element]
                own[b] += len(text)
                own_link[b] += len(text) * link[element]
                commas[b] += text.count(",") + text.count("，") + text.count("、")
                last[b] = text
        size, linked, score = own.copy(), own_link.copy(), [0.0] * n
        for i in range(n - 1, 0, -1):
            size[self.parents[i]] += size[i]
            linked[self.parents[i]] += linked[i]
        for i in range(n):
            if own[i] < LEAST_PARAGRAPH or self.tags[i] in HEADING:
                continue
            points = (1 + commas[i] + min(own[i] / 100, 3.0)) * (1 - own_link[i] / own[i])
            at, level = (i if self.tags[i] in CONTAINER else self.parents[i]), 1
            while at >= 0 and level < 7:
                score[at] += points / level
                at, level = self.parents[at], level + 1 if level < 2 else level + 2
        density = [linked[i] / size[i] if size[i] else 0.0 for i in range(n)]
        total = [(s + self.bonus[i]) * (1 - density[i]) if s else 0.0 for i, s in enumerate(score)]
        if not any(total):
            named = [i for i in range(n) if self.bonus[i] and size[i]]
            best = named[0] if named else 0
            self.points = self.bonus[best]
        else:
            best = self._article_of(max(range(n), key=lambda i: (total[i], -i)))
            self.points = max(total)
        kept = {best}
        floor = SIBLING_SHARE * total[best]
        for i in range(1, n) if best else ():
            if self.parents[i] != self.parents[best] or self.dropped[i] or i == best:
                continue
            ends = last[i].endswith((".", "!", "?", "…"))
            long = size[i] > LEAST_SIBLING and density[i] < 0.25
            heading = self.tags[i] in HEADING and i < best
            if (total[i] and total[i] >= floor) or heading or (self.tags[i] == "p" and (long or (ends and not linked[i] and size[i]))):
                kept.add(i)
        inside = [False] * n
        for i in range(n):
            inside[i] = i in kept or (i > 0 and inside[self.parents[i]])
        blocks: list[str] = []
        run: list[str] = []
        now = previous = -1
        for element, text in self.parts:
            if not inside[element]:
                continue
            b = block[element]
            if self.tags[b] in ("td", "th"):  # the cells of a row are one block
                if previous >= 0 and previous != b:
                    run.append(" ")
                previous, b = b, block[self.parents[b]]
            else:
                previous = -1
            if b != now and run:
                blocks.append(" ".join("".join(run).split()))
                run = []
            now = b
            run.append(text)
        blocks.append(" ".join("".join(run).split()))
        return [b for b in blocks if b]


def main_text(source: str | None) -> str:
    """The article of one page, one block per line."""
    if not source:
        return ""
    page = Page(source, ALL_NAMES)
    blocks = page.main_blocks()
    if page.doubtful:
        second = Page(source, CLEAR_NAMES)
        other = second.main_blocks()
        if other and (not blocks or second.points > MORE_POINTS * page.points):
            blocks = other
    return "\n".join(blocks or Page(source, NO_NAMES).main_blocks())


def extract_text(pages: DataFrame, *, source: str = "html", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all), text and n_chars (code points).

    One row per page. A null or empty page, or one without any article text, gives the empty text. Equally
    good containers: the first in the page. Pages that are cut off, or whose elements do not close, end
    with what there is. Input columns named like a result give way to it.
    """

    def start():
        def step(sources: pa.Array) -> list[pa.Array]:
            texts = [main_text(s) for s in sources.to_pylist()]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return step

    return map_text(pages, source, pages.columns if keep is None else keep, fields(text="string", n_chars="long"), start)
