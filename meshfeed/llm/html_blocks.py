"""Web pages as sequences of leaf text blocks, each with its tag path."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from html import unescape
from zlib import crc32

#: Buckets that all names without a number of their own are hashed to.
OTHER_BUCKETS = 2048

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|</?[A-Za-z][^>]*+\Z",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.IGNORECASE) for t in ("script", "style")}

# fixed values: kinds of elements
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
_CLOSES_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
_SCOPE = frozenset("article aside body div footer form header html main nav ol section table ul dl".split())
_TAGS = (
    "acronym applet canvas caption center col colgroup datalist dir frame frameset hgroup legend map math meter optgroup "
    "option output param picture progress rb rtc script search slot style summary tbody td tfoot th thead tr video audio body"
).split()

# fixed values: names of tags (plain) and of classes, ids and roles (after a dot) around main text and
# around everything else
MAIN_NAMES = (
    "article main .content .article .main .post .entry .story .body .text .prose .page .blog .maincontent "
    ".articlebody .postcontent"
).split()
MENU_NAMES = "nav menu .nav .menu .navigation .navbar .breadcrumb .breadcrumbs .toc .tabs .pagination .pager".split()
HEADER_NAMES = "header .header .masthead .topbar .logo .branding .banner".split()
FOOTER_NAMES = "footer .footer .copyright .legal .colophon .imprint .contentinfo".split()
SIDE_NAMES = "aside .sidebar .side .widget .related .recommended .trending .popular .share .social .tags .author .bio".split()
ADVERT_NAMES = ".ad .ads .advert .advertisement .sponsor .sponsored .promo .promotion .adslot .banner".split()
NOTICE_NAMES = "dialog .cookie .consent .notice .alert .popup .modal .newsletter .subscribe .paywall .gdpr .toast".split()
FORM_NAMES = "form fieldset button select textarea .form .search .login .signup .contact .captcha".split()
COMMENT_NAMES = ".comment .comments .commentlist .discussion .respond .replies .disqus .reviews .feedback".split()
HIDDEN_NAMES = "head title noscript template svg iframe object .hidden .visuallyhidden .print".split()

#: Names with a number of their own: tags, and all names above. Names of the lists meet no other name.
_EXACT = {
    name: k
    for k, name in enumerate(
        sorted(
            {"", *_TAGS, *_VOID, *_INLINE, *_CLOSES_P, *_CLOSES_SAME, *_SCOPE}.union(
                MAIN_NAMES, MENU_NAMES, HEADER_NAMES, FOOTER_NAMES, SIDE_NAMES, ADVERT_NAMES, NOTICE_NAMES, FORM_NAMES,
                COMMENT_NAMES, HIDDEN_NAMES,
            )
        )
    )
}
PATH_BUCKETS = len(_EXACT) + OTHER_BUCKETS


@dataclass(frozen=True, slots=True)
class Block:
    """A run of text without block-level elements in it."""

    text: str
    leaf: str
    path: frozenset[int]
    link_chars: int


def bucket(name: str) -> int:
    """The name's own number, or for names without one a bucket that no such number is among."""
    known = _EXACT.get(name)
    return len(_EXACT) + crc32(name.encode()) % OTHER_BUCKETS if known is None else known


def name_parts(value: str) -> list[str]:
    """Words of a class, id or role: ``site-footer`` and ``siteFooter`` are ``site`` and ``footer``."""
    return _PARTS.findall(_CAMEL.sub(" ", value).lower())


def _tokens(tag: str, attributes: str) -> list[int]:
    out = [bucket(tag)]
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            out += [bucket(f".{p}") for p in name_parts(m[1] or m[2] or m[3] or "")]
    return out


def parse(html: str) -> list[Block]:
    """All text blocks in page order. Character references are decoded and white space runs are one
    space; comments, scripts and styles are no text. Tags may be left open, nested wrongly or cut
    off; a path has each of its hashed names once, so it stays small however deep the page. Time grows
    with the page's length, however many tags are open."""
    blocks: list[Block] = []
    # of each open element: its name, its path, and the nearest block-level name
    stack: list[tuple[str, frozenset[int], str]] = [("", frozenset(), "")]
    places: dict[str, list[int]] = {}  # where in the stack each name is open
    pieces: list[str] = []
    links = open_links = 0
    where: tuple[str, frozenset[int]] | None = None

    def flush() -> None:
        nonlocal links, where
        if where is not None:
            text = " ".join("".join(pieces).split())
            if text:
                leaf, path = where
                blocks.append(Block(text, leaf, path, links))
        pieces.clear()
        links, where = 0, None

    def close(names: tuple[str, ...], stop: frozenset[str]) -> None:
        """Closes the innermost of ``names`` and all inside it, unless one of ``stop`` is inside it too."""
        k = innermost(names)
        if k > innermost(stop.difference(names)):
            for name, _, _ in stack[k:]:
                places[name].pop()
            del stack[k:]

    def innermost(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    at = 0
    while True:
        m = _TAG.search(html, at)
        raw = html[at : m.start()] if m else html[at:]
        if raw:
            text = unescape(raw) if "&" in raw else raw
            if where is None and not text.isspace():
                where = (stack[-1][2], stack[-1][1])
            pieces.append(text)
            if open_links:
                links += len(text)
        if m is None:
            break
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag not in _INLINE:
                flush()
                open_links = 0
            elif tag == "a":
                open_links = 0
            close((tag,), frozenset() if tag not in _INLINE else _SCOPE)
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in _RAW_END:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag == "br":
            pieces.append(" ")
        if tag not in _INLINE:
            flush()
            open_links = 0
            if tag in _CLOSES_P:
                close(("p",), _SCOPE)
            if tag in _CLOSES_SAME:
                close(_CLOSES_SAME[tag], _SCOPE - {"body"} if tag == "body" else _SCOPE)
        elif tag == "a":
            open_links = 1
        if tag not in _VOID and not attributes.rstrip().endswith("/"):
            _, known, leaf = stack[-1]
            names = _tokens(tag, attributes)
            places.setdefault(tag, []).append(len(stack))
            stack.append(
                (tag, known if known.issuperset(names) else known.union(names), leaf if tag in _INLINE else tag)
            )
    flush()
    return blocks
