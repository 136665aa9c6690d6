"""Block tree of a web page: block elements as nodes, text runs in page order."""

from __future__ import annotations

import re
from html import unescape

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr nobr math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac "
    "msqrt mroot mover munder munderover mmultiscripts mprescripts mstyle mpadded mphantom menclose mfenced merror maction "
    "mtable mtr mtd mlabeledtr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Sources of a formula beside the formula itself; they don't break a line.
NOTES = frozenset("annotation annotation-xml".split())
#: Never text of a page.
HIDDEN = frozenset("script style template noscript svg iframe object canvas head title audio video".split()) | NOTES
#: All else, and text, ends an open head.
HEAD = frozenset("html head title meta link base basefont bgsound style script noscript noframes template".split())
#: An opening tag of the set ends an open element of the key.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Elements that an implied end does not reach across.
SCOPE = frozenset("ul ol dl table td th div section article main aside body html form nav header footer".split())

#: Parts of class and id names, by what they speak of.
HINTS = {
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner adsense",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar pager pagination tabs",
    "comment": "comment comments commentlist reply replies disqus discussion respond",
    "foot": "footer foot copyright colophon legal imprint",
    "side": "sidebar side widget related recommended share sharing social tags popular newsletter teaser",
    "notice": "cookie cookies consent gdpr notice popup modal overlay alert subscribe paywall signup login search",
    "head": "header masthead logo branding top hero",
    "main": "content article post entry story body main text page hentry prose",
}
_HINT_OF = {word: kind for kind, words in HINTS.items() for word in words.split()}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is text up to their own end tag; in the second set with character references.
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPED = frozenset("title textarea".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[ \t\n\r\f/>])", re.I | re.A) for tag in RAW | ESCAPED}
_TAG = re.compile(r"(/?)([A-Za-z][^ \t\n\r\f/>]*)")
_GAP = re.compile(r"[ \t\n\r\f/]*")
_KEY = re.compile(r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*")
_EQUALS = re.compile(r"[ \t\n\r\f]*=[ \t\n\r\f]*")
_BARE = re.compile(r"[^ \t\n\r\f>]*")
_LONG_NUMBER = re.compile(r"&#([0-9]{9,})")


def _characters(text: str) -> str:
    """``text`` with its character references decoded; a number beyond all characters is one, however long."""
    if "&" not in text:
        return text
    return unescape(_LONG_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0")[:9] or "0"), text))


def _attributes(html: str, i: int) -> tuple[dict[str, str], int, bool] | None:
    """(attributes, end, closed by itself) of a tag from behind its name; None if the page ends in it."""
    named: dict[str, str] = {}
    while True:
        i = _GAP.match(html, i).end()
        if i == len(html):
            return None
        if html[i] == ">":
            return named, i + 1, html[i - 1] == "/"
        key = _KEY.match(html, i)
        equals, value = _EQUALS.match(html, key.end()), ""
        i = key.end()
        if equals:
            i = equals.end()
            if html[i : i + 1] in ("'", '"'):
                end = html.find(html[i], i + 1)
                if end < 0:
                    return None
                value, i = html[i + 1 : end], end + 1
            else:
                bare = _BARE.match(html, i)
                value, i = bare[0], bare.end()
        named.setdefault(key[0].lower(), _characters(value))


def read(html: str, start, end, data) -> None:
    """Call ``start(tag, attributes)``, ``end(tag)`` and ``data(text)`` for a page, in one pass over it."""
    i = at = 0  # text not yet passed on starts at i
    while (at := html.find("<", at)) >= 0:
        tag = _TAG.match(html, at + 1)
        if not tag and html[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1  # a plain character
            continue
        if i < at:
            data(_characters(html[i:at]))
        if not tag:
            if html.startswith("<!--", at):
                empty = html.startswith((">", "->"), at + 4)
                close = at + 4 if empty else html.find("--", at + 4)
                while close >= 0 and not empty and not html.startswith((">", "!>"), close + 2):
                    close = html.find("--", close + 1)
            else:
                close = at
            close = html.find(">", close) if close >= 0 else -1
            if close < 0:
                return
            i = at = close + 1
            continue
        read_on = _attributes(html, tag.end())
        if read_on is None:
            return
        named, i, alone = read_on
        at, name = i, tag[2].lower()
        if tag[1]:
            end(name)
            continue
        start(name, named)
        if name in _RAW_END:
            close = _RAW_END[name].search(html, i)
            at = close.start() if close else len(html)
            if i < at:
                data(html[i:at] if name in RAW else _characters(html[i:at]))
            i = at
        elif alone and name not in VOID:
            end(name)
    if i < len(html):
        data(_characters(html[i:]))


class Page:
    """Nodes as parallel lists, each parent before its children; ``runs`` holds (node, text).

    Open block and hidden elements lie on a stack, with the depths at which each
    name stands open, so that no tag is answered by walking the stack.
    """

    def __init__(self, html: str):
        self.tags, self.parents, self.hints, self.attributes = ["root"], [-1], [frozenset()], [{}]
        self.chars, self.link_chars = [0], [0]
        self.runs: list[tuple[int, str]] = []
        self._stack: list[tuple[str, int]] = []  # (tag, node); hidden elements with their block's node
        self._open: dict[str, list[int]] = {}
        self._text: list[str] = []
        self._link: int | None = None  # height of the stack at the open link
        self._linked = self._hidden = 0
        read(html, self._start, self._end, self._data)
        self._flush()

    def _node(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            node = self._node()
            self.runs.append((node, text))
            self.chars[node] += len(text)
            self.link_chars[node] += min(self._linked, len(text))
        self._text.clear()
        self._linked = 0

    def _push(self, tag: str, node: int) -> None:
        self._open.setdefault(tag, []).append(len(self._stack))
        self._stack.append((tag, node))

    def _pop(self, depth: int) -> None:
        """Close all elements from ``depth`` on."""
        if self._node() != (self._stack[depth - 1][1] if depth else 0):
            self._flush()
        for tag, _ in self._stack[depth:]:
            self._open[tag].pop()
            self._hidden -= tag in HIDDEN
        del self._stack[depth:]
        if self._link is not None and self._link > depth:
            self._link = None

    def _deepest(self, tags: frozenset) -> int:
        return max((self._open[t][-1] for t in tags if self._open.get(t)), default=-1)

    def _end_implied(self, ended: frozenset, limit: frozenset) -> None:
        depth = self._deepest(ended)
        if depth >= 0 and depth >= self._deepest(limit):
            self._pop(depth)

    def _end_head(self) -> None:
        if self._stack and self._stack[-1][0] == "head":
            self._pop(len(self._stack) - 1)

    def _start(self, tag: str, named: dict[str, str]) -> None:
        if tag not in HEAD:
            self._end_head()
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag != "wbr":
                self._text.append(" ")
            return
        if tag in INLINE:
            if tag == "a":  # a link ends the one before it; a name is none
                self._link = len(self._stack) if "href" in named else None
            return
        if tag in HIDDEN:
            self._hidden += 1
            self._push(tag, self._node())
            return
        if tag == "body":  # a head without an end
            self._end_implied(frozenset(["head"]), frozenset())
        if self._hidden:
            self._push(tag, self._node())
            return
        self._flush()
        self._end_implied(frozenset(["p"]), SCOPE)
        if tag in ENDS:
            self._end_implied(ENDS[tag], SCOPE - {"td", "th"} if tag == "tr" else SCOPE - ENDS[tag])
        parts = _NAME.findall(f"{named.get('class', '')} {named.get('id', '')} {named.get('role', '')}")
        self.tags.append(tag)
        self.parents.append(self._node())
        self.hints.append(frozenset(_HINT_OF[p.lower()] for p in parts if p.lower() in _HINT_OF))
        self.attributes.append(named)
        self.chars.append(0)
        self.link_chars.append(0)
        self._push(tag, len(self.tags) - 1)

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._text.append(" ")
        elif tag == "a":
            self._link = None
        elif tag not in INLINE and self._open.get(tag):
            self._pop(self._open[tag][-1])
        elif tag == "p" and not self._hidden:  # stands for an empty paragraph
            self._flush()

    def _data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self._end_head()
        if not self._hidden:
            self._text.append(data)
            if self._link is not None:
                self._linked += len(data)
