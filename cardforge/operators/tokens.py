"""The tokens of a page, in one pass that scans nothing twice.

Broken markup must not cost more than sound markup, so what lies ahead is
remembered: that no ``-->``, no ``>`` or no end tag of a script follows any more,
and for each quote where the tag that holds it would end (a tag that never ends
is text, and a later tag may run into the same quotes).  Tokens are columns of
integers, not objects: some 60 bytes each.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter

from cardforge.functions.text import unescape

# Elements that never have content (closed as soon as opened).
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
                 "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image",
                 "isindex", "nextid", "spacer")
_VOID = frozenset(VOID_ELEMENTS)
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")

# a tag: a quoted attribute may hold ">"
_TAG = re.compile(r"""</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_SPECIAL = re.compile(r"""[>"']""")
_NAME = re.compile(r"</?([a-zA-Z][^\t\n\r\f />\x00]*)")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
# Html.parser's tolerant attribute pattern (name, "=" value with
# single, double or no quotes; an unquoted value keeps a trailing "/").
_ATTR = re.compile(r"""((?<=['"\s/])[^\s/>][^\s/=>]*)(\s*=+\s*('[^']*'|"[^"]*"|(?!['"])[^>\s]*))?(?:\s|/(?!>))*""")
_VALUE_START = re.compile(r"""=[^'"=]""")

START, END, TEXT = 0, 1, 2


class _Ahead:
    """Where comments and tags end, remembered so that each character is looked at
    a fixed number of times.  To be asked for rising places."""

    def __init__(self, html: str):
        self.html = html
        self.comments = self.brackets = self.sound = True  # an end may still lie ahead; no tag failed yet
        self.special = -1  # the next of > " ' (past the page if none)
        self.ends: dict[int, int] = {}  # a quote outside others -> where its tag ends

    def comment(self, at: int) -> int:
        """The end of the comment, declaration or instruction at ``at`` (0: none)."""
        if self.comments and self.html.startswith("<!--", at):
            end = self.html.find("-->", at + 4)
            if end >= 0:
                return end + 3
            self.comments = False
        if self.brackets:
            end = self.html.find(">", at + 2)
            if end >= 0:
                return end + 1
            self.brackets = False
        return 0

    def tag(self, at: int) -> int:
        """The end of the tag at ``at`` (0: it has none)."""
        if self.sound:
            m = _TAG.match(self.html, at)
            if m:
                return m.end()
            self.sound = False
        return self._broken_tag(at + (3 if self.html[at + 1] == "/" else 2))

    def _next(self, at: int) -> int:
        m = _SPECIAL.search(self.html, at)
        return m.start() if m else len(self.html)

    def _broken_tag(self, at: int) -> int:
        html, ends, chain = self.html, self.ends, []
        if self.special < at:
            self.special = self._next(at)
        place, end = self.special, 0
        while place < len(html):
            if html[place] == ">":
                end = place + 1
                break
            if place in ends:
                end = ends[place]
                break
            chain.append(place)
            close = html.find(html[place], place + 1)
            if close < 0:
                break
            place = self._next(close + 1)
        for place in chain:
            ends[place] = end
        return end


class PageTokens:
    """Columns of a page's tokens.  All: ``kind``, ``name`` (None for text), ``depth``,
    ``parent`` (-1: none), ``end_pos``, markup ``[m0, raw_end)``.  Elements (start tags), in
    order: ``pos``, text ``[t0, t1)`` of the page's text, contents up to ``m_end``, markup
    up to ``m1``.  Texts, in order: ``raws`` and decoded ``texts``."""

    __slots__ = ("html", "kind", "name", "depth", "parent", "end_pos", "m0", "raw_end", "pos", "t0", "t1", "m_end", "m1", "raws", "texts")

    def __init__(self, html: str):
        self.html, self.kind, self.name, self.raws, self.texts = html, bytearray(), [], [], []
        for column in ("depth", "parent", "end_pos", "m0", "raw_end", "pos", "t0", "t1", "m_end", "m1"):
            setattr(self, column, array("i"))

    def __len__(self) -> int:
        return len(self.kind)

    def raw(self, k: int) -> str:
        """The markup of the k-th token, if it is a tag."""
        return self.html[self.m0[k]:self.raw_end[k]]

    def tag(self, k: int) -> str:
        """The start tag of the k-th element."""
        return self.raw(self.pos[k])


def _slash_in_value(raw: str) -> bool:
    """Whether the "/" of a tag that ends in "/>" belongs to an unquoted value."""
    body = raw[:-2]
    bare = body.rstrip()
    if bare.endswith("="):
        return True
    if len(bare) < len(body):
        return False
    before, piece = (["", *body.rsplit(None, 1)])[-2:]
    if ">" in piece:
        return bool(_VALUE_START.search(piece[piece.rfind(">") + 1:]))
    return bool(_VALUE_START.search(piece)) or (before.rstrip().endswith("=") and piece[:1] not in ("", "'", '"', "="))


def read_tokens(html: str) -> PageTokens:
    """The tokens of a page in order.  Comments, declarations and the contents
    of scripts and styles are no tokens (text on both sides of a comment is one
    token), but they stay in the markup ranges."""
    out = PageTokens(html)
    kind, names, end_pos = out.kind, out.name, out.end_pos
    starts, t0, t1, m_end, m1 = out.pos, out.t0, out.t1, out.m_end, out.m1
    add_kind, add_name, add_depth, add_parent = kind.append, names.append, out.depth.append, out.parent.append
    add_end_pos, add_m0, add_raw_end, find = end_pos.append, out.m0.append, out.raw_end.append, html.find
    ahead = _Ahead(html)
    stack: list[int] = []  # open elements
    open_names: Counter[str] = Counter()
    unended: set[str] = set()  # scripts, styles: no end tag follows any more
    at, length, done = 0, 0, len(html)
    top = -1  # the token that opened the innermost open element

    def add(what: int, name: str | None, begin: int, end: int) -> None:
        add_end_pos(len(kind))
        add_kind(what)
        add_name(name)
        add_depth(len(stack))
        add_parent(top)
        add_m0(begin)
        add_raw_end(end)

    def close(element: int, pos: int, end: int) -> None:
        end_pos[starts[element]], t1[element] = pos, length
        m_end[element] = m1[element] = end
        open_names[names[starts[element]]] -= 1

    run: list[str] = []  # a text that comments may have interrupted

    def settle() -> int:
        if not run:
            return 0
        raw = "".join(run)
        run.clear()
        text = unescape(raw)
        out.raws.append(raw)
        out.texts.append(text)
        return len(text)

    while at < done:
        start = at
        if html[at] != "<":
            at = find("<", at)
            if at < 0:
                at = done
            if not run:
                add(TEXT, None, start, at)
            run.append(html[start:at])
            continue
        follows = html[at + 1:at + 2]
        if follows in ("!", "?"):
            end = ahead.comment(at)
            if end:
                at = end
                continue
        elif follows in _LETTERS or (follows == "/" and html[at + 2:at + 3] in _LETTERS):
            end = ahead.tag(at)
        else:
            end = 0
        length += settle()
        if not end:  # a stray "<"
            at += 1
            add(TEXT, None, start, at)
            run.append("<")
            length += settle()
            continue
        at = end
        name = _NAME.match(html, start).group(1).lower()
        if follows == "/":
            pos = len(kind)
            if open_names[name]:
                while names[starts[stack[-1]]] != name:
                    close(stack.pop(), pos, start)
                element = stack.pop()
                close(element, pos, start)
                m1[element] = at
                top = starts[stack[-1]] if stack else -1
            add(END, name, start, at)
            continue
        pos, element = len(kind), len(starts)
        add(START, name, start, at)
        starts.append(pos)
        t0.append(length)
        t1.append(length)
        m_end.append(at)
        m1.append(at)
        if name in _VOID or (html[at - 2] == "/" and not _slash_in_value(html[start:at])):
            continue
        stack.append(element)
        top = pos
        open_names[name] += 1
        if name in _RAW_END and name not in unended:
            m = _RAW_END[name].search(html, at)
            if m:
                at = m.start()
            else:
                unended.add(name)
    length += settle()
    while stack:
        close(stack.pop(), len(kind), done)
    return out


def read_attributes(raw: str) -> list[tuple[str, str]]:
    """Attributes of a start tag in order: names lower-cased, values unquoted and
    decoded, '' without a value."""
    found = []
    for m in _ATTR.finditer(raw[_NAME.match(raw).end():-1]):
        value = m.group(3) or ""
        if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        found.append((m.group(1).lower(), unescape(value)))
    return found
