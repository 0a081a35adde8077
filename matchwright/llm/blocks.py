"""A page as flat text blocks with what is known about each: words, links, containers."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# ---- fixed values: element names and the words that name page parts ---------------------------

SILENT = "script|style|title|noscript|template|textarea|select|iframe|object|svg|math|canvas|audio|video|datalist"
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SPACERS = frozenset(("br", "td", "th", "wbr"))
CONTAINERS = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form head header html li main menu nav ol section table ul".split()
)
#: Elements that hold page furniture by their name.
FURNITURE = frozenset(("nav", "menu", "aside", "footer", "form", "dialog", "head"))
#: Words of class, id and role that name page furniture.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo "
    "cookie cookies disclaimer footer gdpr header menu modal nav navbar navigation newsletter notice notices pagination popup promo "
    "promoted related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar topbar widget".split()
)
#: Names of parts that hold whole articles of others; an article in them is not the page's own.
FOREIGN = frozenset("aside comment commentlist comments footer menu nav related replies reply respond sidebar".split())
#: First parts of compounds that tell of a layout (`has-sidebar`), not of a part of the page.
LAYOUT = frozenset(("has", "is", "js", "no", "with", "without"))
VOID = frozenset(("hr", "br", "wbr", "img", "input", "meta", "link"))

#: Where a button or option without an end tag stops.
_STOP = r"</?(?:article|aside|footer|form|h[1-6]|header|li|main|nav|ol|p|section|select|table|ul)(?=[\s/>])"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SILENT})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    rf"|<button(?=[\s/>])[^>]*?(?:/>|>.*?(?:</button\s*>|(?={_STOP})|\Z))"
    rf"|<option(?=[\s/>])[^>]*?(?:/>|>.*?(?:</option\s*>|(?=<option[\s>])|(?={_STOP})|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
#: Elements that hold the page or its article: their class, id and role say what lies beside the text, not what they are.
WHOLE = frozenset(("html", "body", "main", "article"))
#: Elements that a page's head may hold; any other start tag ends a head whose end tag is missing.
IN_HEAD = frozenset(("base", "basefont", "bgsound", "head", "html", "link", "meta", "title", "style", "script", "noscript", "template"))


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    tag: str
    article: bool
    furniture: bool
    marked: bool
    named: bool


@dataclass(slots=True, frozen=True)
class _Part:
    """An open container: what it says of the blocks in it. `foreign`: an article in it is not the page's own."""

    tag: str = ""
    article: bool = False
    furniture: bool = False
    marked: bool = False
    named: bool = False
    foreign: bool = False


def _names(attributes: str) -> list[str]:
    """The words of class, id and role."""
    if "=" not in attributes:
        return []
    return [w for m in NAMED.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").split()]


def _hinted(word: str) -> set[str]:
    """Names of page furniture that begin or end a compound such as `cookie-banner` or `leftSidebar`."""
    parts = [x.lower() for x in PARTS.split(word) if x]
    return set() if len(parts) < 2 or parts[0] in LAYOUT else {parts[0], parts[-1]} & NAMES


def _inside(outer: _Part, name: str, attributes: str) -> _Part:
    """What holds in an element within `outer`.

    Whole words and elements that name furniture are a verdict, compounds are evidence for the
    tree. A first article or main ends both, unless it lies in a part that holds articles of others.
    """
    kept = outer.marked or "data-keep" in attributes
    if name in ("article", "main") and not outer.article and not outer.foreign:
        return _Part(name, True, False, kept)
    words = [] if name in WHOLE else _names(attributes)
    whole = {w.lower() for w in words} & NAMES
    hints = set().union(*map(_hinted, words)) - ({"header"} if outer.article else set())
    return _Part(
        name,
        outer.article or name in ("article", "main"),
        outer.furniture or name in FURNITURE or (name == "header" and not outer.article) or bool(whole),
        kept,
        outer.named or bool(hints),
        outer.foreign or not FOREIGN.isdisjoint((name, *whole, *hints)),
    )


def page_blocks(page: str) -> list[Block]:
    """Blocks in page order. Markup may be cut off or unbalanced; unseen parts (scripts, styles, comments) give no text."""
    blocks: list[Block] = []
    stack: list[_Part] = []
    state = page_part = _Part()
    parts: list[str] = []
    linked: list[str] = []
    in_link, tag = False, ""

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                links = len("".join(linked).split())
                blocks.append(Block(text, text.count(" ") + 1, links, tag, state.article, state.furniture, state.marked, state.named))
            parts.clear()
            linked.clear()

    def say(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            linked.append(text + " ")

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name, attributes = name.lower(), m[4]
        if not m[2] and name not in IN_HEAD and stack and stack[-1].tag == "head":
            flush()
            stack.pop()
            state = stack[-1] if stack else page_part
        if name == "a":
            in_link = not m[2]
        elif name in SPACERS:
            parts.append(" ")
        elif name in BREAKS:
            flush()
            in_link, tag = False, "" if m[2] else name
            if name in CONTAINERS and not attributes.endswith("/"):
                if m[2]:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i].tag == name:
                            del stack[i:]
                            break
                    state = stack[-1] if stack else page_part
                else:
                    state = _inside(state, name, attributes)
                    stack.append(state)
    if at < len(page):
        say(page[at:])
    flush()
    return blocks


def title_and_links(page: str) -> tuple[str, list[str]]:
    """The page's title and the targets of its links, in order."""
    m = re.search(r"<title(?=[\s/>])[^>]*>(.*?)(?:</title\s*>|\Z)", page, re.DOTALL | re.IGNORECASE)
    links = [html.unescape(h[1] or h[2] or h[3] or "") for t in TOKEN.finditer(page) if (t[3] or "").lower() == "a" and (h := HREF.search(t[4]))]
    return (" ".join(html.unescape(m[1]).split()) if m else ""), links
