"""A page's text as leaf blocks: runs of text between the edges of block elements, with what stands above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attributes>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<(?![A-Za-z/!?]))",
    re.DOTALL,
)
_LOOSE = re.compile(r"<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attributes>[^>]*)>(?P<text>(?!))?|</?[^>]*>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z]+")

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
#: Elements whose text is no part of a page's running text.
UNSEEN = RAW | {"head", "noscript", "template", "svg", "math", "object", "select", "datalist", "canvas", "audio", "video", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu",
    "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What may stand in a head, and what foreign (SVG, MathML) content holds: any other tag closes the head, these tags end the foreign content.
_IN_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
_ENDS_FOREIGN = {
    "b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr",
    "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span", "strong", "strike", "sub", "sup", "table", "tt",
    "u", "ul", "var",
}
#: Within these foreign elements HTML goes on.
_FOREIGN_HTML = {"foreignobject", "desc", "annotation-xml", "mi", "mo", "mn", "ms", "mtext"}
#: Without an end tag: a list of choices ends at the next block, control or select; an element with fallback content hides nothing.
_CHOICES = {"select", "datalist"}
_ENDS_CHOICES = (BLOCK - {"hr"}) | {"select", "input", "textarea", "keygen"}
_FALLBACK = {"noscript", "object", "canvas", "audio", "video", "map"}
_SCOPE = {"ul", "ol", "dl", "table", "div", "article", "section", "body", "menu"}

#: What an ancestor's tag, or a word of its class, id or role, makes of the blocks below it.
BY_TAG = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "article": "article", "main": "main", "form": "form",
    "button": "form", "label": "form", "fieldset": "form", "dialog": "notice", "ul": "list", "ol": "list", "dl": "list", "table": "table", "blockquote": "quote",
    "pre": "quote", "figure": "figure", "figcaption": "figure", "address": "footer",
}
BY_WORD = {
    kind: words.split()
    for kind, words in {
        "menu": "menu nav navbar navigation breadcrumb breadcrumbs toc pagination pager tabs topbar skip",
        "header": "header masthead banner logo branding sitename tagline",
        "footer": "footer copyright colophon legal imprint bottom",
        "sidebar": "sidebar aside widget related recommend recommended recommendations more popular trending teaser tags rail",
        "advert": "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted dfp",
        "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall subscribe subscription newsletter disclaimer",
        "comments": "comment comments commentlist reply replies respond discussion disqus reactions responses",
        "form": "form search login signup signin register",
        "social": "share sharing social follow like print email author byline meta date",
        "article": "article post entry story content body text main",
        "hidden": "hidden invisible sr offscreen",
    }.items()
}
KINDS = ["menu", "header", "footer", "sidebar", "article", "main", "form", "notice", "list", "table", "quote", "figure", "advert", "comments", "social", "hidden"]
_BIT = {kind: 1 << i for i, kind in enumerate(KINDS)}
_WORD_BITS: dict[str, int] = {}
for _kind, _words in BY_WORD.items():
    for _word in _words:
        _WORD_BITS[_word] = _WORD_BITS.get(_word, 0) | _BIT[_kind]


@dataclass
class LeafBlock:
    """``text`` has single spaces; ``kinds`` are the bits of all ancestors, ``near`` those of the nearest that has any."""

    text: str
    tag: str
    kinds: int
    near: int
    link_characters: int


def _bits(name: str, attributes: str) -> int:
    bits = _BIT.get(BY_TAG.get(name, ""), 0)
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (values[0] or values[1] or values[2]).lower()
            if key in ("class", "id", "role"):
                for word in _WORD.findall(value):
                    bits |= _WORD_BITS.get(word, 0)
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                bits |= _BIT["hidden"]
            elif key == "aria-hidden" and value == "true":
                bits |= _BIT["hidden"]
    return bits


def _never_closed(page: str, name: str) -> set[int]:
    """Where the start tags of an element begin that have no end tag."""
    open_at: list[int] = []
    for match in re.finditer(rf"<(/?){name}(?![A-Za-z0-9:-])", page, re.IGNORECASE):
        if not match[1]:
            open_at.append(match.start())
        elif open_at:
            open_at.pop()
    return set(open_at)


def leaf_blocks(page: str | None) -> list[LeafBlock]:
    """All blocks with text, in page order. Unclosed and stray tags, comments and markup cut off are taken as browsers do, roughly."""
    page = page or ""
    blocks: list[LeafBlock] = []
    stack: list[tuple[str, int, int, str]] = [("", 0, 0, "")]  # name, kinds of all ancestors, of the nearest, nearest block element
    pieces: list[str] = []
    linked = links_open = unseen = 0
    at = 0
    head = 0  # depth of the open head
    choices = 0  # depth of an open list of choices that has no end tag
    never: dict[str, set[int]] = {}

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                _, kinds, near, tag = stack[-1]
                blocks.append(LeafBlock(text, tag, kinds, near, min(linked, len(text))))
            pieces, linked = [], 0

    def leave(depth: int) -> None:
        nonlocal links_open, unseen, head, choices
        head, choices = head if head < depth else 0, choices if choices < depth else 0
        while len(stack) > depth:
            name = stack.pop()[0]
            links_open -= name == "a"
            unseen -= name in UNSEEN

    def end_foreign() -> None:
        depth = len(stack) - 1
        while depth and stack[depth][0] not in _FOREIGN_HTML:
            if stack[depth][0] in ("svg", "math"):
                leave(depth)
            depth -= 1

    size = len(page)
    while at < size:
        match = _TOKEN.match(page, at) or _LOOSE.match(page, at)  # the latter: a quote that never ends
        if match is None:  # a tag that never ends
            break
        at = match.end()
        name = match["name"]
        if name is None:
            text = match["text"]
            if head and unseen == 1 and text is not None and not text.isspace():
                leave(head)
            if text is not None and not unseen:
                pieces.append(text)
                if links_open:
                    linked += len(text)
            continue
        name = name.lower()
        if match["close"]:
            if unseen and name in ("p", "br"):
                end_foreign()
            depth = len(stack) - 1
            while depth and stack[depth][0] != name:
                depth -= 1
            if (depth or name == "p") and name in BLOCK and not unseen:
                flush()
            if depth:
                leave(depth)
            continue
        if unseen:
            if name in _ENDS_FOREIGN:
                end_foreign()
            if choices and unseen == 1 and name in _ENDS_CHOICES:
                leave(choices)
            if head and unseen == 1 and name not in _IN_HEAD:
                leave(head)
        if name == "head" and any(open_name != "html" for open_name, *_ in stack[1:]):
            continue
        if name in _FALLBACK or name in _CHOICES:
            if name not in never:
                never[name] = _never_closed(page, name)
            if match.start() in never[name]:
                if name in _FALLBACK:
                    continue
                choices = choices or len(stack)
        if name in BLOCK and not unseen:
            flush()
            closing = _ENDS_ITSELF.get(name, ())
            for depth in range(len(stack) - 1, 0, -1):
                open_name = stack[depth][0]
                if open_name == "p" or open_name in closing:
                    leave(depth)
                    if open_name in closing and open_name not in ("td", "th"):
                        break
                elif open_name in _SCOPE:
                    break
        if name == "br" and not unseen:
            pieces.append(" ")
        if name in VOID or match["attributes"].endswith("/"):
            continue
        _, kinds, near, tag = stack[-1]
        own = _bits(name, match["attributes"])
        stack.append((name, kinds | own, own or near, name if name in BLOCK else tag))
        links_open += name == "a"
        unseen += name in UNSEEN
        if name == "head":
            head = len(stack) - 1
        if name in RAW:  # its text holds no tags
            end = re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            leave(len(stack) - 1)
    flush()
    return blocks


def visible_text(page: str | None) -> str:
    """All blocks' texts, a line for each."""
    return "\n".join(b.text for b in leaf_blocks(page))
