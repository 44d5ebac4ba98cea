"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to the elements around them; an element's points are discounted by
the share of its text that lies in links. The best container is kept, with those of its siblings that score well.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import longs, map_batches, read, utf8

#: Quotes count after an equals sign, and only if they close; so a tag ends at some > or with the page, and nothing is
#: tried twice but one unclosed quote of each kind.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.S
)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup of the page's text.
RAW = frozenset("script style noscript template textarea title svg iframe object canvas audio video head xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of the article.
APART = frozenset("nav footer aside form button select menu dialog fieldset label option datalist".split())
CLOSED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"),
}
SCOPE = frozenset("table ul ol dl select body html article section div td th nav footer header aside main form".split())
#: Words in names (class, id, role) that mark what isn't the article: those that do so wherever a name begins with them, and
#: those that do so only in a name without other words than these and such of place and form.
STRONG = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs byline cookie cookies gdpr footer login masthead menu menus modal nav navbar navigation newsletter "
    "pager pagination popup promo promoted recommended related sidebar sharing signup sponsored subscribe subscription topbar widget".split()
)
UNLIKELY = STRONG | frozenset("consent disclaimer header foot notice notices notification overlay search share skip social sponsor tags toolbar alert aside".split())
FORM = frozenset(
    "site top bottom left right primary secondary global mobile desktop sticky fixed bar box block wrap wrapper container inner outer list item items link links button buttons icon icons "
    "section area panel row col column slot unit zone module message form group holder".split()
)
#: Words of reader comments: they go whatever else a name says.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
LIKELY = frozenset("article body content entry hentry main page post story text blog".split())
#: Elements of running text: a paragraph called header isn't one.
TEXT = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dt dd td th figcaption span em strong b i".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Share of all paragraphs' points that the container of the text has, if no element says that it is the article.
MOST = 0.75
PARAGRAPH = frozenset("p pre td blockquote li dd figcaption section div article main body".split())


class Node:
    __slots__ = ("tag", "words", "parent", "items", "points", "mass", "apart", "length", "linked", "commas")

    def __init__(self, tag: str, words: frozenset, parent: Node | None, apart: bool):
        self.tag, self.words, self.parent, self.apart = tag, words, parent, apart
        self.items: list[Node | str] = []
        self.points = self.mass = 0.0
        self.length = self.linked = self.commas = 0


def _names(attributes: str) -> list[str]:
    """Class names, id and role, and "hidden" where the element is."""
    if not attributes or attributes.isspace():
        return []
    found = []
    for m in _NAMED.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            found.append("hidden")
        elif name in ("class", "id", "role"):
            found += value.split()
    return found


def _words(names: list[str]) -> frozenset:
    return frozenset(w for name in names for w in re.split(r"[^a-z0-9]+", name))


def _unlikely(name: str, tag: str) -> bool:
    """Whether a name says that the element isn't the article's."""
    parts = [w for w in re.split(r"[^a-z0-9]+", name) if w and not w.isdigit()]
    if not parts or LIKELY.intersection(parts):
        return False
    if parts[0] in STRONG:
        return True
    if tag in TEXT:
        return len(parts) == 1 and parts[0] in UNLIKELY and parts[0] not in ("header", "foot")
    return not UNLIKELY.isdisjoint(parts) and all(w in UNLIKELY or w in FORM for w in parts)


def _apart(tag: str, names: list[str], words: frozenset, parent: Node, by_name: bool) -> bool:
    if parent.apart or tag in APART or "hidden" in words:
        return True
    if tag == "header":
        up: Node | None = parent
        while up and up.tag not in ("article", "main"):
            up = up.parent
        return up is None
    if not by_name or tag in ("body", "html", "main"):
        return False
    if words & COMMENTS and (tag != "article" or any(n in COMMENTS or n.startswith("comment-") for n in names)):
        return True
    return tag != "article" and not words & LIKELY and any(_unlikely(n, tag) for n in names)


def parse(page: str, by_name: bool = True) -> Node:
    """A tree of elements and texts, from markup that may be broken or cut off anywhere. What names tell to be no part of
    the article is set apart, unless they aren't asked."""
    root = Node("html", frozenset(), None, False)
    at, end, place, headless = root, len(page), 0, False
    while place < end:
        m = _TAG.search(page, place)
        if m is None:
            at.items.append(page[place:])
            break
        if m.start() > place:
            at.items.append(page[place : m.start()])
        place = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            up: Node | None = at
            while up and up.tag != tag and not (tag not in BLOCK and up.tag in BLOCK):
                up = up.parent
            if up and up.tag == tag and up.parent:
                at = up.parent
            continue
        if tag in RAW and not m[3].endswith("/"):
            if tag == "head" and headless:
                continue
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)|<body\b" if tag == "head" else rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, place)
            if tag == "head" and close is None:
                headless = True  # nor does any other one close
                continue
            place = (close.start() if close and close[0][:2] != "</" else close.end()) if close else end
            continue
        if tag in ("html", "body") and at.parent is None:
            root.words |= _words(_names(m[3]))
            continue
        if tag in BLOCK:
            while at.tag not in BLOCK and at.parent:
                at = at.parent  # inline elements left open end with the block
            if at.tag == "p" and at.parent:
                at = at.parent
        if tag in CLOSED_BY:
            up = at
            while up and up.tag not in CLOSED_BY[tag] and up.tag not in SCOPE:
                up = up.parent
            while up and up.tag in CLOSED_BY[tag] and up.parent:
                at = up = up.parent
        names = _names(m[3])
        words = _words(names)
        node = Node(tag, words, at, _apart(tag, names, words, at, by_name))
        at.items.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            at = node
    return root


def _measure(root: Node) -> list[Node]:
    """Lengths and commas of each element's own text and of all below it; the nodes in page order."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append(node)
        linked = linked or node.tag == "a"
        for x in node.items:
            if isinstance(x, str):
                n = len(x.strip())
                node.length += n
                node.commas += x.count(",") + x.count("、") + x.count("，")
                node.linked += n if linked else 0
        stack += [(x, linked) for x in reversed(node.items) if not isinstance(x, str) and not x.apart]
    for node in reversed(order):
        if node.parent:
            node.parent.length += node.length
            node.parent.commas += node.commas
            node.parent.linked += node.linked
    return order


def _within(node: Node, *tags: str) -> bool:
    up: Node | None = node
    while up and up.tag not in tags:
        up = up.parent
    return up is not None


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _blocks(node: Node, out: list[str]) -> None:
    """Texts of the element's blocks in page order, without what is apart. Lists of links go too, but in an article, where
    they are its own."""
    run: list[str] = []
    own = _within(node, "article", "main")

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                out.append(text)

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag == "br":
            run.append(" ")
        elif not x.apart and not (not own and x is not node and x.tag in ("ul", "ol", "dl", "table", "div", "section") and x.length and _density(x) > 0.6):
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(x.items)
    flush()


def main_text(page: str) -> str:
    """The article's blocks, joined by blank lines; empty if there is none. Where names set all text apart, as one around the
    whole page does, they aren't asked."""
    return _text_of(parse(page)) or _text_of(parse(page, by_name=False))


def _text_of(root: Node) -> str:
    order = _measure(root)
    for node in order:
        own = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        if node.tag in ("p", "pre", "blockquote") or node.tag in PARAGRAPH and own >= 25:
            size = node.length if node.tag in ("p", "pre", "blockquote") else own
            if size < 1:
                continue
            points = (1 + min(node.commas, 20) + min(size / 100, 3)) * (1 - _density(node))
            node.mass += points
            up, share = node.parent or node, 1.0
            if node.tag not in ("p", "pre", "blockquote", "li", "td", "dd"):
                up = node
            for _ in range(4):
                if up is None:
                    break
                up.points += points * share
                up, share = up.parent, share / 2
    for node in reversed(order):
        if node.parent:
            node.parent.mass += node.mass
    best, most = None, 0.0
    for node in order:
        if node.points > 0:
            weight = {"article": 4.0, "main": 2.5}.get(node.tag, 1.0) * (1.25 if node.words & LIKELY else 1.0)
            score = node.points * (1 - _density(node)) * weight
            if score > most:
                best, most = node, score
    if best is None:
        best = root
    while best.parent and best.mass < MOST * root.mass and not _within(best, "article", "main"):
        best = best.parent  # parts of one text stand side by side
    out: list[str] = []
    if best.parent is None:
        _blocks(best, out)
        return "\n\n".join(out)
    near = max(3.0, most * 0.2)
    for x in best.parent.items:
        if isinstance(x, str) or x.apart:
            continue
        score = x.points * (1 - _density(x)) * {"article": 4.0, "main": 2.5}.get(x.tag, 1.0)
        headline = x.tag in ("h1", "h2") and not any(not isinstance(y, str) and y.tag == "h1" for y in best.items)
        prose = x.tag in ("p", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "table") and _density(x) < 0.25
        alike = x.tag == best.tag and x.words == best.words and x.length and _density(x) < 0.25
        if x is best or headline or best.tag != "main" and (score >= near or prose or alike):  # a main part stands for itself
            _blocks(x, out)
    return "\n\n".join(out)


def extract_text(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the html) with text and n_chars (code points) of each whole page.

    A narrow map, no shuffle. Null and empty pages have an empty text; broken and cut-off markup is read as far as it
    goes; other columns may be null and pass unchanged; columns of the input named text or n_chars are replaced;
    repeated rows are extracted each; an empty table gives an empty one.
    """
    keep = [c for c in (keep if keep is not None else pages.columns) if c not in (html_column, "text", "n_chars")]
    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x.decode()) if x else "" for x in utf8(b.column(len(keep)))]
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string()), longs([len(t) for t in texts])], [*keep, "text", "n_chars"])

    return map_batches(pages.select(*(F.col(f"`{c}`") for c in keep), F.col(html_column)).toDF(*(f"c{i}" for i in range(len(keep) + 1))), each, f"{schema}text string, n_chars long")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
