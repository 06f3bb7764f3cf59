"""Main text of web pages by tag-path ratios.

Every text of a page stands on a path of tags from the root to it. Texts of one path are alike in purpose, so each page's
paths are judged as wholes:

1. Text length and punctuation are summed per path and divided by its number of texts: prose has long texts with much
   punctuation, menus short ones with none.
2. Both ratios are smoothed along the page with a Gaussian window, among texts of one container, so that a heading or a
   short paragraph shares its neighbours' ratios.
3. They are fused with the share of text outside links, and with what the path says by itself: elements and class names
   that stand for menus, headers, footers, sidebars, notices, adverts, forms or comments make it zero, and so does standing
   outside of ``article`` (else ``main``) where a page has one.
4. Containers whose fused value reaches a share of the best one are content; the rest goes.

Where a page marks its article, its parts are one container, so nothing of it is lost for being short.

Tags are read as browsers do, as far as paths need it: raw text elements, comments, quoted attributes, omitted end tags, end
tags without a start. An unclosed comment or script runs to the end of the page.

A page is worked on by itself, so nothing is shuffled and hot hosts or groups of copies make no difference; memory is about
ten times the longest page. Defined cases: a null or empty page, or one without content, has an empty text; ill-formed pages
never fail; equal rows get equal results; an empty table gives an empty table. Other columns pass through, also where names
differ only in case; those named like a result are replaced.
"""

from __future__ import annotations

import functools
import html as characters
import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.frames import mapped, pieces

#: A container is content from this share of the best container's value on.
SHARE = 0.3
#: Weights of a text's neighbours, by distance.
KERNEL = [math.exp(-k * k / 2) for k in range(3)]
SLICE = 4 << 20

# Fixed values of HTML: elements without end tag, with raw text, that begin a block, and that end others by their start.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table caption tbody td tfoot th thead tr ul noscript template".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES = {
    "li": (("li",), {"ul", "ol", "menu"}),
    "dt": (("dt", "dd"), {"dl"}),
    "dd": (("dt", "dd"), {"dl"}),
    "tr": (("tr",), {"table", "tbody", "thead", "tfoot"}),
    "td": (("td", "th"), {"tr", "table"}),
    "th": (("td", "th"), {"tr", "table"}),
    "option": (("option",), {"select", "datalist"}),
}
#: An end tag reaches no element outside of these, unless it is a table's own.
WALLS = frozenset("table td th caption".split())
TABLE = frozenset("table caption tbody thead tfoot tr td th".split())

#: Elements that make no container of their own: they hold the text of the one around them.
FLOW = HEADINGS | frozenset("p ul ol li dl dt dd blockquote pre figure figcaption table tbody thead tfoot tr td th".split())

OUTSIDE = frozenset(
    "nav footer aside form script style noscript template dialog menu button select textarea datalist iframe svg canvas "
    "audio video object search head xmp noembed noframes title".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert status menu menubar toolbar".split()
)
_OUTSIDE_NAME = re.compile(
    r"(?:ads?|advert\w*|adsby\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|notifications?|alerts?|popup|"
    r"modal|overlay|newsletter|subscri\w*|paywall|sidebars?|aside|menus?|nav|navbar|navigation|breadcrumbs?|footers?|foot|"
    r"masthead|topbar|toolbar|pagination|pager|login|signin|signup|search|searchbox|shar(?:e|ing)|social|related|"
    r"recommend\w*|widgets?|copyright|disqus|comments?|comment(?:list|form|box|area|section|thread)|repl(?:y|ies)|respond)"
)
_COMMENT_NAME = re.compile(r"(?:comments?|repl(?:y|ies)|ads?|advert\w*|sponsor\w*|promo\w*|related|recommend\w*|teasers?)")
_HEADER_NAME = re.compile(r"headers?")
#: Class names such as ``no-sidebar`` tell how a page is laid out, not what an element is.
_LAYOUT = frozenset(("with", "without", "has", "no", "layout", "is"))

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_PUNCTUATION = re.compile(r"[,.;:!?…、。，；：！？¿¡()\"'“”«»]")


def extract_text(pages: DataFrame, html: str = "html", share: float = SHARE) -> DataFrame:
    """All columns but the HTML, which gives way to ``text``: blocks in page order, joined by an empty line."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "html", SLICE):
            texts = [main_text(page, share) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("__row"), pa.array(texts, pa.string())], names=["__row", "text"])

    full = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    return mapped(pages, {"html": html}, [full], step, {"text": T.StringType()}, used_up=(html,))


def main_text(html: str, share: float = SHARE) -> str:
    page = Page()
    _parse(html, page)
    content = page.content(share)
    blocks: dict[int, list[str]] = {}
    for path, block, text in page.texts:
        if path in content:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(line for line in lines if line)


@dataclass
class Path:
    """A place in the tree of tag paths. ``container`` is the path of the element that its text is judged with."""

    tag: str
    container: int
    outside: str = ""  # why its text is none of the article's: "", "form", "header" or "other"
    article: int = -1  # the path of the article it belongs to
    main: int = -1
    linked: bool = False


@dataclass
class Page:
    paths: list[Path] = field(default_factory=lambda: [Path("", 0)])
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)
    texts: list[tuple[int, int, str]] = field(default_factory=list)

    def below(self, parent: int, tag: str, attributes: str) -> int:
        """The path one tag further down."""
        label, outside = _described(tag, attributes)
        number = self.numbers.get((parent, label))
        if number is None:
            number = self.numbers[parent, label] = len(self.paths)
            above = self.paths[parent]
            path = Path(tag, number if tag in BLOCK and tag not in FLOW else above.container)
            path.article, path.main, path.linked = above.article, above.main, above.linked or tag == "a"
            is_main = tag == "main" or outside == "main"
            if tag == "article" and path.article < 0:
                path.article = number
            if is_main and path.main < 0:
                path.main = number
            path.outside = above.outside
            if path.outside == "form" and (tag == "article" or is_main):
                path.outside = ""  # a form around the whole page
            if path.outside == "header" and tag in HEADINGS and path.article >= 0:
                path.outside = ""  # an article's own headline
            if not path.outside and outside != "main":
                path.outside = outside
            self.paths.append(path)
        return number

    def content(self, share: float) -> set[int]:
        """The paths whose text is content."""
        inside = [k for k, (path, _, text) in enumerate(self.texts) if not self.paths[path].outside and text.strip()]
        for mark in ("article", "main"):
            marked = [k for k in inside if getattr(self.paths[self.texts[k][0]], mark) >= 0]
            if marked:
                inside = marked
                break
        else:
            mark = "container"
        group = {path: getattr(self.paths[path], mark) for path in {self.texts[k][0] for k in inside}}
        value = self._values(inside, group)
        best = max(value.values(), default=0.0)
        return {path for path, own in group.items() if value[own] >= share * best}

    def _values(self, inside: list[int], group: dict[int, int]) -> dict[int, float]:
        """The fused value of each group of paths: the best of its paths' ones."""
        sums: dict[int, list[float]] = {}
        for k in inside:
            path, _, text = self.texts[k]
            total = sums.setdefault(path, [0, 0.0, 0.0])
            total[0] += 1
            total[1] += len(text.strip())
            total[2] += len(_PUNCTUATION.findall(text))
        ratios = {path: (chars / n, marks / n) for path, (n, chars, marks) in sums.items()}

        smoothed = {path: [0.0, 0.0] for path in sums}
        order = [self.texts[k][0] for k in inside]
        for k, path in enumerate(order):
            weight = chars = marks = 0.0
            for at in range(max(0, k - len(KERNEL) + 1), min(len(order), k + len(KERNEL))):
                if group[order[at]] == group[path]:
                    share = KERNEL[abs(at - k)]
                    weight += share
                    chars += share * ratios[order[at]][0]
                    marks += share * ratios[order[at]][1]
            smoothed[path][0] += chars / weight
            smoothed[path][1] += marks / weight

        text_of: dict[int, float] = {}
        prose_of: dict[int, float] = {}
        value: dict[int, float] = {}
        for path, (n, chars, _) in sums.items():
            own = group[path]
            text_of[own] = text_of.get(own, 0.0) + chars
            prose_of[own] = prose_of.get(own, 0.0) + (0 if self.paths[path].linked else chars)
            value[own] = max(value.get(own, 0.0), smoothed[path][0] / n * (1 + smoothed[path][1] / n))
        # The square root of a group's length stands for what a ratio does not know: one long notice is no article.
        return {own: fused * prose_of[own] / text_of[own] * math.sqrt(text_of[own]) for own, fused in value.items()}


class Stack:
    """The open elements and their paths."""

    def __init__(self) -> None:
        self.names = [""]
        self.paths = [0]
        self.open_names: Counter[str] = Counter()

    @property
    def path(self) -> int:
        return self.paths[-1]

    def open(self, name: str, path: int) -> None:
        self.names.append(name)
        self.paths.append(path)
        self.open_names[name] += 1

    def close(self, name: str) -> bool:
        """Close the innermost element of that name, and those inside it. Inline end tags do not reach out of a block."""
        if not self.open_names[name]:
            return False
        for k in range(len(self.names) - 1, 0, -1):
            if self.names[k] == name:
                self._cut(k)
                return True
            if (name not in BLOCK and self.names[k] in BLOCK) or (self.names[k] in WALLS and name not in TABLE):
                break
        return False

    def close_implied(self, name: str) -> None:
        """Close what a block's start ends: an open paragraph, and the item, cell or row before it."""
        ended, around = CLOSES.get(name, ((), ()))
        if any(self.open_names[other] for other in ended):
            self._close_first(ended, around)
        if self.open_names["p"]:
            self._close_first(("p",), BLOCK)

    def _close_first(self, ended: Collection[str], around: Collection[str]) -> None:
        for k in range(len(self.names) - 1, 0, -1):
            if self.names[k] in ended:
                return self._cut(k)
            if self.names[k] in around:
                return None

    def _cut(self, k: int) -> None:
        self.open_names.subtract(self.names[k:])
        del self.names[k:], self.paths[k:]


@functools.lru_cache(maxsize=4096)
def _described(tag: str, attributes: str) -> tuple[str, str]:
    """The element's label within paths, and whether it stands for something else than an article's text."""
    if tag in ("html", "body"):
        return tag, ""
    given = {name.lower(): a or b or c for name, a, b, c in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    names = given.get("class", "").split()
    role = given.get("role", "").lower()
    names += given.get("id", "").split()
    label = ".".join([tag, *sorted({re.sub(r"\d+", "", name) for name in names})])
    if tag == "article" or tag == "main" or role == "main":
        named = any(_is_named(name, _COMMENT_NAME) for name in names)
        return f"{label}/{role}{'/no' * named}", "other" if named else "main" if tag != "article" else ""
    if given.get("itemprop") == "articleBody":
        return f"{label}/body", "main"
    if tag in OUTSIDE:
        return label, "form" if tag == "form" else "other"
    if role in ROLES or any(_is_named(name, _OUTSIDE_NAME) for name in names):
        return f"{label}/no", "other"
    if tag == "header" or any(_is_named(name, _HEADER_NAME) for name in names) and tag not in HEADINGS:
        return f"{label}/header", "header"
    return label, ""


def _is_named(name: str, pattern: re.Pattern) -> bool:
    """Whether a part of a class name or id is one of the names."""
    parts = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
    return not _LAYOUT.intersection(parts) and any(pattern.fullmatch(part) for part in parts)


def _parse(html: str, page: Page) -> None:
    """Fill in the page's texts and their paths."""
    stack = Stack()
    block = 0
    begin, n = 0, len(html)
    tags = _TAG
    last = html.rfind(">")

    def add(end: int) -> None:
        if end > begin:
            page.texts.append((stack.path, block, characters.unescape(html[begin:end])))

    at = html.find("<")
    while 0 <= at < last:
        after = html[at + 1]
        if after in "!?" or (after == "/" and not html[at + 2 : at + 3].isalpha()):
            add(at)
            begin = _behind_comment(html, at)
            at = html.find("<", begin)
            continue
        if not (after == "/" or (after.isascii() and after.isalpha())):
            at = html.find("<", at + 1)
            continue
        tag = tags.match(html, at)
        if tag is None and tags is _TAG:
            tags = _BARE_TAG  # a quote never closes: from here on quotes do not count
            tag = tags.match(html, at)
        if tag is None:
            at = html.find("<", at + 1)
            continue
        add(at)
        begin = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if stack.close(name) or name == "p":
                block += name in BLOCK
        elif name == "br":
            page.texts.append((stack.path, block, " "))
        elif name in VOID:
            block += name == "hr"
        else:
            if name in BLOCK:
                block += 1
                stack.close_implied(name)
            path = page.below(stack.path, name, tag[3])
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, begin)
                begin = end.start() if end else n
            stack.open(name, path)
        at = html.find("<", begin)
    add(n)


def _behind_comment(html: str, at: int) -> int:
    """Where what follows a comment, doctype or the like begins."""
    if html.startswith("<!--", at):
        if html.startswith((">", "->"), at + 4):
            return html.index(">", at + 4) + 1
        end = _COMMENT_END.search(html, at + 4)
        return end.end() if end else len(html)
    return html.index(">", at) + 1
