"""Main text of web pages by tree scoring.

Every paragraph earns points for its length and its commas and passes them to the elements it stands
in, fewer the further up. Scores are discounted by the share of text inside links. The best container
is the article; siblings that score well or read like paragraphs belong to it too.
"""

import itertools
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.text import sliced

TEXT = "page_id long, url string, text string, n_chars long"

# Quantifiers are possessive and a tag ends before the next one, so broken tags cost no second pass.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^<>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
# Takes every attribute with its value, so nothing inside a name or a value counts as an attribute.
ATTRIBUTE = re.compile(r"([^\s\"'/>=][^\s/>=]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?")
NAMES = re.compile(r"[a-z]+")
COMMAS = re.compile("[,،、，]")

# Elements by what they do to a page's text.
RAW = frozenset("script style noscript template iframe object svg math canvas head title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr img picture source ruby rb rt rp".split()
)
PARAGRAPHS = frozenset("p li dd dt td th pre blockquote h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
APART = frozenset(
    "nav footer aside form button select option input dialog menu fieldset audio video map applet".split()
)
ALONE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
ALONE |= {"td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}}
LISTS |= {"th": {"tr", "table"}, "option": {"select"}}
CONTAINERS = frozenset("article main".split())
PAGES = frozenset("#root html body".split())
# Words in class, id or role that tell what a part of a page is for.
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos "
    "promotion promoted banner nav navbar navigation navigations menu menus breadcrumb breadcrumbs sidebar "
    "sidebars rail widget widgets footer foot header masthead topbar comment comments commentlist discussion "
    "disqus reply replies respond cookie cookies consent gdpr notice notices notification notifications alert "
    "alerts popup popups modal overlay newsletter subscribe subscription signup login paywall share shares "
    "sharing social related recommended recommendations recommendation outbrain taboola pagination pager "
    "toolbar skip skiplink contentinfo complementary search searchbox dialog hidden tooltip copyright "
    "disclaimer byline".split()
)
# Those of them that are never an article, however long their text is.
FOREIGN = frozenset(
    "ads advert adverts advertisement advertising adsense comment comments commentlist discussion disqus reply "
    "replies respond cookie cookies consent gdpr related recommended recommendations recommendation outbrain "
    "taboola sidebar sidebars".split()
)
# A class with one of these words tells how a part looks or what is around it, not what it is for.
STATES = frozenset(
    "no not non has with without overflow backface open opened closed collapse collapsed enabled disabled".split()
)
FOR = frozenset("article body content entry hentry main page post text blog story prose".split())

#: Characters from which a block counts as a paragraph to read, and those that make a part readable.
PARAGRAPH, READABLE = 25, 80
#: What counts of the score of a part whose names speak against it but that holds most of the page.
DOUBTED = 0.75


class Element:
    __slots__ = (
        "chars", "doubts", "index", "last", "linked", "names", "parent", "points", "share", "skipped", "tag", "weight"
    )

    def __init__(self, tag: str, parent: "Element | None", index: int):
        self.tag, self.parent, self.index, self.last = tag, parent, index, index
        self.names: frozenset[str] = frozenset()
        self.skipped = parent.skipped if parent else False
        self.doubts: frozenset[str] = frozenset()
        self.share = 1.0
        self.points = 0.0
        self.weight = 0.0
        self.chars = self.linked = 0


class Page:
    """Elements and text blocks of one page; tolerates whatever is open, unclosed or misplaced."""

    def __init__(self, html: str):
        self.root = Element("#root", None, 0)
        self.elements = [self.root]
        self.blocks: list[tuple[Element, str, int]] = []
        self.stack = [self.root]
        self.inline: list[str] = []
        self.parts: list[str] = []
        self.link_parts: list[str] = []
        self.links = 0
        self.unclosed: set[str] = set()
        self._read(html)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        match = TOKEN.match
        while at < size:
            token = match(html, at)
            at = token.end()
            text = token["text"]
            if text is not None:
                text = unescape(text) if "&" in text else text
                self.parts.append(text)
                if self.links:
                    self.link_parts.append(text)
                continue
            name = token["name"] or token["name2"]
            if name is None:
                continue
            name = name.lower()
            if token["close"] or token["close2"]:
                self._close(name)
            elif name in RAW:
                at = self._past(html, name, at)
            else:
                self._open(name, token["rest"] or token["rest2"] or "")
        self._flush()
        for element in self.stack:
            element.last = len(self.elements)

    def _past(self, html: str, name: str, at: int) -> int:
        """Where the text goes on behind an element whose content is no text of the page."""
        if name in self.unclosed:
            return at
        end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(html, at)
        if end:
            return end.end()
        self.unclosed.add(name)
        if name == "head":  # its end tag may be left out
            body = re.compile("<body(?=[\\s/>])", re.IGNORECASE).search(html, at)
            return body.start() if body else at
        return len(html) if name in ("script", "style", "textarea", "title") else at

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                linked = len(" ".join("".join(self.link_parts).split()))
                self.blocks.append((self.stack[-1], text, min(linked, len(text))))
            self.parts, self.link_parts = [], []

    def _open(self, name: str, rest: str) -> None:
        if name in ("br", "wbr", "img"):
            self.parts.append("\n" if name == "br" else "")
            return
        if name in INLINE:
            self.inline.append(name)
            self.links += name == "a"
            return
        self._flush()
        if name in VOID:
            return
        self._end_implied(name)
        self.inline, self.links = [], 0  # formatting does not reach into another block
        element = Element(name, self.stack[-1], len(self.elements))
        self._judge(element, rest)
        self.elements.append(element)
        if not rest.endswith("/"):
            self.stack.append(element)

    def _end_implied(self, name: str) -> None:
        """Close what a start tag ends without saying so."""
        if self.stack[-1].tag in ("p", *HEADINGS) and name != "#":
            self._pop(len(self.stack) - 1)
        if name in ALONE:
            for depth in range(len(self.stack) - 1, 0, -1):
                tag = self.stack[depth].tag
                if tag in LISTS[name]:
                    break
                if tag in ALONE[name]:
                    self._pop(depth)
                    break

    def _close(self, name: str) -> None:
        if name in INLINE:
            if name in self.inline:
                while self.inline.pop() != name:
                    pass
                self.links = self.inline.count("a")
            return
        self._flush()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == name:
                self._pop(depth)
                self.inline, self.links = [], 0
                break

    def _pop(self, depth: int) -> None:
        for element in self.stack[depth:]:
            element.last = len(self.elements)
        del self.stack[depth:]

    def _judge(self, element: Element, rest: str) -> None:
        inside = False
        if element.tag in APART or element.tag == "header":
            above = element.parent
            while above is not None and not inside:
                inside, above = above.tag in CONTAINERS, above.parent
        if element.tag in APART or (element.tag == "header" and not inside):
            element.skipped = True
        elif element.parent.tag == "header" and element.tag not in HEADINGS:
            element.skipped = True  # of an article's own header only the headings stay
        if element.tag in CONTAINERS:
            element.weight += 25
        if not rest.strip():
            return
        found: dict[str, str] = {}
        for key, value in ATTRIBUTE.findall(rest):
            found.setdefault(key.lower(), value.strip("\"'").lower())
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get(
            "style", ""
        ).replace(" ", ""):
            element.skipped = True
        given = [NAMES.findall(n) for k in ("class", "id", "role") for n in found.get(k, "").split()]
        element.names = frozenset(itertools.chain.from_iterable(given))
        names = frozenset(itertools.chain.from_iterable(n for n in given if STATES.isdisjoint(n)))
        if names & AGAINST and element.tag not in (*CONTAINERS, "body", "html", *HEADINGS):
            if names & FOR:
                element.weight -= 25
            else:
                element.doubts = names & AGAINST
        elif names & FOR:
            element.weight += 25

    def _drop_doubtful(self) -> None:
        """Skip elements whose names speak against them, unless one holds most of what the page has to read.

        Such an element only scores less. Comments and the like are an article only if there is nothing
        to read besides them.
        """
        if not any(e.doubts for e in self.elements):
            return
        known = [e.skipped for e in self.elements]
        for firm in (FOREIGN, frozenset()):
            out = list(known)
            for e in self.elements[1:]:
                out[e.index] = out[e.index] or out[e.parent.index] or bool(e.doubts & firm)
            points, chars = [0.0] * len(out), [0] * len(out)
            for element, text, linked in self.blocks:
                if len(text) >= PARAGRAPH and not out[element.index]:
                    points[element.index] += self.points(text, linked)
                    chars[element.index] += len(text) - linked
            for e in reversed(self.elements[1:]):
                points[e.parent.index] += points[e.index]
                chars[e.parent.index] += chars[e.index]
            if chars[0] >= READABLE or not firm:
                break
        for e in self.elements[1:]:
            e.skipped = known[e.index] or e.parent.skipped
            e.share = e.parent.share
            if e.doubts and not e.skipped:
                if not out[e.index] and 2 * points[e.index] > points[0] and chars[e.index] >= READABLE:
                    e.share = DOUBTED
                else:
                    e.skipped = True

    @staticmethod
    def points(text: str, linked: int) -> float:
        return (1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3)) * (1 - linked / len(text))

    def main_text(self) -> str:
        self._drop_doubtful()
        blocks = [block for block in self.blocks if not block[0].skipped]
        if not blocks:
            return ""
        for element, text, linked in blocks:
            element.chars += len(text)
            element.linked += linked
            points = self.points(text, linked)
            above = element.parent if element.tag in PARAGRAPHS and element.parent else element
            share = 1.0
            for level in range(1, 6):
                above.points += points * share
                above = above.parent
                if above is None:
                    break
                share = 1 / 2 if level == 1 else 1 / (3 * level)
        for element in reversed(self.elements[1:]):
            element.parent.chars += element.chars
            element.parent.linked += element.linked
        best = max(self.elements, key=lambda e: (self.score(e), e.index))
        kept = self._inside(self._with_siblings(best))
        dropped = self._inside(self._menus(best, blocks))
        return "\n".join(
            text for element, text, _ in blocks if kept[element.index] and not dropped[element.index]
        )

    def _menus(self, best: Element, blocks: list[tuple[Element, str, int]]) -> list[tuple[int, int]]:
        """Ranges of link lists that are not the article's.

        A container chosen as the article keeps all it holds. If that is the whole page, what stands
        between its paragraphs, or behind them under a heading, belongs to them, and other link lists do not.
        """
        linked = [
            (e.index, e.last)
            for e in self.elements
            if e.tag in ("ul", "ol", "dl", "table", "div", "section") and 2 * e.linked > e.chars
        ]
        if self.score(best) <= 0:
            return linked
        if best.tag not in PAGES:
            return [(first, last) for first, last in linked if last <= best.index or first >= best.last]
        read = [e.index for e, text, links in blocks if e.tag == "p" and len(text) >= PARAGRAPH and links < len(text)]
        if not read:
            return linked
        headed: set[int] = set()
        latest: dict[int, Element] = {}
        for e in self.elements[read[0] + 1 :]:
            before = latest.get(e.parent.index)
            if e.parent.index in headed or (before is not None and before.tag in HEADINGS):
                headed.add(e.index)
            latest[e.parent.index] = e
        return [
            (first, last)
            for first, last in linked
            if last <= read[0] or (first > read[-1] and first not in headed)
        ]

    def _inside(self, ranges: list[tuple[int, int]]) -> list[bool]:
        """For every element, whether it lies in any of the ranges."""
        edges = [0] * (len(self.elements) + 1)
        for first, last in ranges:
            edges[first] += 1
            edges[last] -= 1
        return [depth > 0 for depth in itertools.accumulate(edges)]

    @staticmethod
    def score(element: Element) -> float:
        if not element.points:
            return 0.0
        return (element.points + element.weight) * element.share * (1 - element.linked / max(1, element.chars))

    def _with_siblings(self, best: Element) -> list[tuple[int, int]]:
        """Ranges of the elements that make up the article, in page order."""
        if best.parent is None:
            return [(0, len(self.elements))]
        top = self.score(best)
        least = 0.2 * top
        unnamed = not best.weight and best.tag in ("div", "section")
        prose = [0] * len(self.elements)
        if unnamed:
            for element, text, _ in self.blocks:
                prose[element.index] += len(text) if element.tag in PARAGRAPHS else 0
            for element in reversed(self.elements[1:]):
                prose[element.parent.index] += prose[element.index]
        ranges = []
        for element in self.elements[best.parent.index + 1 : best.parent.last]:
            if element.parent is not best.parent or element.skipped:
                continue
            bonus = 0.2 * top if element.names and element.names == best.names else 0.0
            density = element.linked / max(1, element.chars)
            reads = element.tag in PARAGRAPHS and (
                (element.chars > 80 and density < 0.25) or (element.chars and not element.linked)
            )
            # Without names, parts of paragraphs beside the best one read on.
            more = unnamed and element.tag == best.tag and not element.names and density < 0.25
            reads = reads or (more and 2 * prose[element.index] > element.chars > 0)
            if element is best or (self.score(element) > 0 and self.score(element) + bonus >= least) or reads:
                ranges.append((element.index, element.last))
        return ranges


def main_text(html: str) -> str:
    return Page(html).main_text()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "html"):
        texts = [main_text(html or "") for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def page_texts(pages: DataFrame) -> DataFrame:
    """Main text of every page, and its number of characters.

    Null or empty html, and pages of nothing but menus, give an empty text. Null ids and addresses stay
    null, repeated rows each get a result, an empty table gives no rows, and further columns are
    ignored. No row is moved: the whole work is one pass over the scan.
    """
    columns = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return columns.mapInArrow(_texts, TEXT)
