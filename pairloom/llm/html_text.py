"""Main text of web pages by tree scoring.

A page becomes a light tree of elements and a list of text blocks in page order. Every block passes points for
its length and its commas to its parent, half of them to the grandparent and ever less further up; each container's sum is
discounted by its link density. The best container and those of its siblings that score well are kept; menus,
adverts and the like inside them go. One narrow pass over batches of pages.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import add_columns, whole

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_GONE = frozenset(
    "aside audio button canvas dialog embed fieldset footer form head iframe input map menu nav noembed noframes noscript object "
    "script select style svg template textarea title video".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BREAKS = frozenset("br td th wbr option".split()) - {"wbr"}
#: Words of class, id and role names that mark what is not the article.
_MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs captcha comment comments commentlist "
    "complementary consent contentinfo cookie cookies dialog disqus feedback footer gdpr login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notification overlay pager pagination paywall popup promo promoted promotion recommended related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar toc widget widgets".split()
)
_HEADERS = frozenset({"header"})
_GOOD = frozenset({"article", "main"})
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Node:
    __slots__ = ("tag", "parent", "gone", "heading_only", "score", "chars", "linked", "links")

    def __init__(self, tag, parent, gone, heading_only):
        self.tag, self.parent, self.gone, self.heading_only = tag, parent, gone, heading_only
        self.score, self.chars, self.linked, self.links = 0.0, 0, 0, 0


def _unwanted(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """(the element goes, only headings stay of it)."""
    if tag in _GONE:
        return True, False
    header = tag == "header"
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name == "hidden" or (name == "aria-hidden" and "true" in value) or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                return True, False
            if name in ("class", "id", "role"):
                words = {w.lower() for w in _WORDS.findall(value)}
                if words & _MARKS:
                    return True, False
                header = header or bool(words & _HEADERS)
    return header and not in_article, header


def parse(page: str) -> tuple[list[_Node], list[list]]:
    """All elements, parents first, and the blocks [element, text, characters in links, links] in page order."""
    root = _Node("", None, False, False)
    nodes, stack, opened = [root], [root], {}
    blocks: list[list] = []
    parts: list[str] = []
    link_chars, links, article = 0, 0, 0

    def flush(at: _Node) -> None:
        nonlocal parts, link_chars, links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append([at, text, min(link_chars, len(text)), links])
            parts, link_chars, links = [], 0, 0

    def holder() -> _Node:
        for n in reversed(stack):
            if n.tag in _BLOCKS or n.gone or n.parent is None:
                return n
        return root

    def pop_to(depth: int) -> None:
        nonlocal article
        for n in stack[depth:]:
            opened[n.tag] -= 1
            article -= n.tag in _GOOD
        del stack[depth:]

    place, size = 0, len(page)
    while place < size:
        m = _TOKEN.search(page, place)
        text = page[place : m.start() if m else size]
        if text and not stack[-1].gone:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if opened.get("a"):
                link_chars += len(" ".join(text.split()))
        if not m:
            break
        place = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in _BREAKS and not stack[-1].gone:
            parts.append(" ")
        if m[1]:  # an end tag
            if opened.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                if tag in _BLOCKS or any(n.tag in _BLOCKS or n.gone for n in stack[depth:]):
                    flush(holder())
                pop_to(depth)
            elif tag == "p":
                flush(holder())
            continue
        if tag in _BLOCKS or tag in _GONE:
            flush(holder())
            if opened.get("p") and tag in _BLOCKS:  # a paragraph ends where the next block begins
                depth = len(stack) - 1
                while stack[depth].tag != "p":
                    depth -= 1
                if not any(n.tag in ("td", "th", "button", "object") for n in stack[depth:]):
                    pop_to(depth)
        if tag in _CLOSES:
            own, stop = _CLOSES[tag]
            if any(opened.get(x) for x in own):
                depth = len(stack) - 1
                while depth > 0 and stack[depth].tag not in own and stack[depth].tag not in stop:
                    depth -= 1
                if depth > 0 and stack[depth].tag in own:
                    flush(holder())
                    pop_to(depth)
        if tag == "a":
            links += 1
            if opened.get("a"):
                depth = len(stack) - 1
                while stack[depth].tag != "a":
                    depth -= 1
                pop_to(depth)
        if tag in _VOID or (m[3] and m[3].rstrip().endswith("/") and tag in ("svg", "path", "iframe")):
            continue
        up = stack[-1]
        gone, heading = (True, False) if up.gone else _unwanted(tag, m[3], article > 0)
        if gone and not up.gone:
            flush(holder())
        node = _Node(tag, up, gone, heading or up.heading_only)
        if tag in _RAW:  # what follows is no markup
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, place)
            place = page.find(">", end.start()) + 1 or size if end else size
            nodes.append(node)
            continue
        nodes.append(node)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        article += tag in _GOOD
    flush(holder())
    return nodes, blocks


def main_text(page: str) -> str:
    """The page's article, its blocks in page order joined by two line feeds."""
    nodes, blocks = parse(page)
    kept = [b for b in blocks if not b[0].gone and (not b[0].heading_only or b[0].tag in _HEADINGS)]
    for node, text, linked, links in kept:
        points = (1 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100, 10)) * (1 - linked / len(text))
        up, share = node if node.tag in ("div", "section", "article", "main", "body") else node.parent, 1.0
        for level in range(6):
            if up is None:
                break
            up.score += points * share
            up, share = up.parent, 1 / (2 * (level + 1))
        at = node
        at.chars, at.linked, at.links = at.chars + len(text), at.linked + linked, at.links + links
    for n in reversed(nodes):  # children follow their parents
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.linked += n.linked
            n.parent.links += n.links

    def value(n: _Node) -> float:
        return n.score * (1 - n.linked / n.chars) if n.chars else 0.0

    best = max((n for n in nodes if n.chars), key=value, default=None)
    if best is None:
        return ""
    for wanted in ("article", "main"):  # a named article is taken whole
        up = best
        while up is not None and up.tag != wanted:
            up = up.parent
        if up is not None:
            best = up
            break
    least = max(10.0, 0.2 * value(best))
    chosen = {id(best)}
    if best.parent is not None and best.tag != "body":
        for n in nodes:
            if n.parent is best.parent and n is not best and n.chars:
                density = n.linked / n.chars
                if value(n) >= least or n.tag == "p" and density < 0.25 and n.chars > 80:
                    chosen.add(id(n))
    inside: dict[int, bool] = {}
    out = []
    for node, text, _, _ in kept:
        path, up = [], node
        while up is not None and id(up) not in inside:
            path.append(up)
            if id(up) in chosen:
                break
            up = up.parent
        held = inside.get(id(up), up is not None and id(up) in chosen) if up is not None else False
        for n in reversed(path):
            menu = n.tag in ("ul", "ol", "div", "table", "dl", "section") and n.links >= 3 and n.linked > 0.6 * n.chars and id(n) not in chosen
            held = held and not menu if id(n) not in chosen else True
            inside[id(n)] = held
        if held:
            out.append(text)
    return "\n\n".join(out)


def extract(pages: DataFrame, html_column: str = "html", text: str = "text") -> DataFrame:
    """pages with a column of the main text instead of the html.

    Null, empty or markup-only html gives the empty text. Character references are decoded, white space (also
    no-break) inside a block becomes one space. Broken markup is read as far as it goes; a page of any length is read
    whole. Other columns stay; a former column named like the text is replaced.
    """
    rest = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in (html_column, text)], F.col(html_column).alias("_html"))
    return add_columns(rest, whole(F.col("_html")), lambda texts: [[main_text(x) for x in texts]], f"`{text}` string").drop("_html")
