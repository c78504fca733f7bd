"""Main text of web pages by minimum-cut labelling (operator 8).

A page becomes its text blocks in page order.  Each block has costs of being
labelled content or boilerplate, from a small linear classifier on what the
block is made of and lies in; they become capacities from the source and to the
sink.  Neighbouring blocks, and blocks of one parent element, are tied by
smoothness edges.  Maximum flow gives the cheapest labelling: a short paragraph
between paragraphs stays, a long notice in a side column goes.

Blocks that are never text (scripts, styles, head, controls, comments of markup)
are not read at all.  A form speaks against its blocks the more, the less of the
page's text it holds, as some pages are one form; an article or main inside it
is not of the form.  So does an element with a telling name (class or id): its
weight falls to nothing as it comes to hold all of the page's prose, is shared by
the other words of the name ("related-work" says half of what "related" does), and
takes back what an enclosing article says only if the name has one meaning
("advert", "comments"; not "discussion").  Math is inline text, and so is a button amid the words of a
paragraph.  References are decoded, white space inside a block is one space,
blocks are joined by two line feeds.

Pages are independent: one pass, no shuffle.  Time and memory are in proportion to
the page, however broken it is (``operators.tokens``; open elements are found by
name, not by walking).

Defined results: a null or empty page gives the empty text, as does one without
content blocks; broken markup is read as far as it goes; repeated rows are read
each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict, deque
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.llm.common import text_batches
from cardforge.operators.tokens import END, START, read_attributes, read_tokens

#: elements that start and end a block (fixed values)
BLOCK_TAGS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th
thead tr ul caption""".split())
#: elements without text of the page (fixed values)
SKIPPED_TAGS = set("""script style head title noscript template svg canvas iframe object select option textarea button
input datalist audio video map annotation annotation-xml""".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose end may be missing: closed by the start of one of the given
CLOSED_BY = {
    "p": BLOCK_TAGS - {"body", "html"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
#: tag -> the elements that its start closes
CLOSES = {tag: [name for name, closers in CLOSED_BY.items() if tag in closers] for tag in set().union(*CLOSED_BY.values())}
#: an open paragraph or item is not looked for beyond these
SCOPES = set("article aside body blockquote div dl footer form header main nav ol section table td th ul".split())
#: weights of the classifier: evidence for content (positive) or boilerplate, in units of cost (fixed values)
IN_TAG = {"article": 3.0, "main": 2.5, "nav": -8.0, "footer": -8.0, "aside": -8.0, "menu": -6.0, "dialog": -6.0, "header": -6.0,
          "address": -2.0, "search": -6.0}
IN_ROLE = {"main": 2.5, "article": 3.0, "navigation": -8.0, "banner": -8.0, "contentinfo": -8.0, "complementary": -8.0,
           "search": -8.0, "dialog": -8.0, "alert": -8.0, "alertdialog": -8.0, "menu": -8.0, "menubar": -8.0, "form": -8.0}
NAMED_CONTENT = set("article articlebody body content entry main maincontent post story text".split())
#: names of one meaning, and names that also stand for parts of a text
NAMED_BOILERPLATE = set("""ad adblock adbox adcontainer ads adslot adunit adv advert advertisement advertising adverts adwrapper
banner bottombar branding breadcrumb breadcrumbs byline colophon comment commenters commentlist
comments consent cookie cookies copyright disqus footer gdpr masthead menu modal nav navbar newsletter overlay pager
pagination paywall popup promo promoted replies sidebar sidebars sidecol sidenav signup skip sponsor sponsored subscribe
teaser toast toc toolbar topbar widget widgets""".split())
NAMED_PERHAPS = set("""alert alerts discussion feedback flash foot form guestbook head header legal login metadata navi navigation
notice notices privacy promotion rail ratings related reply respond responses reviews share sharing side social
subscription tags thread threads tracking warning""".split())
#: words that add nothing to a name
NEUTRAL = set("""area block bottom box bar col column component desktop global group holder item items latest left list main mobile
module new page panel primary reader readers region right secondary section site top user users visitor visitors""".split())
#: evidence of a telling name
IN_NAMED = -7.0
OWN_HEAD = {"head", "header"}
#: what follows these in a name is said to be there or not, somewhere inside
WITHOUT = {"has", "no", "with", "without"}
LAYOUT = {"container", "grid", "has", "inner", "layout", "no", "outer", "row", "with", "without", "wrap", "wrapper"}
#: a button amid the words of one of these is part of them, and then has a name of its own
TEXT_BUTTON = "button of a text"
TEXT_TAGS = set("p li dd dt td blockquote figcaption h1 h2 h3 h4 h5 h6".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: against the blocks of a form that holds next to nothing of the page's text
IN_FORM = -12.0
TIE_NEXT = 0.6
TIE_PARENT = 0.8

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Za-z][a-z]*|[0-9]+")


def words_of_name(name: str) -> set[str]:
    """Words of a class or id; in "has-sidebar" or "post-no-footer" the sidebar
    and the footer are not this element."""
    out: set[str] = set()
    for parts in (_NAME.findall(name), re.split(r"[_-]+", name)):
        parts = [p.lower() for p in parts]
        out.update(parts[:next((i for i, p in enumerate(parts) if p in WITHOUT), len(parts))])
    return out


class Block:
    __slots__ = ("text", "links", "tag", "parent", "evidence", "form")

    def __init__(self, text, links, tag, parent, evidence, form):
        self.text, self.links, self.tag, self.parent, self.evidence, self.form = text, links, tag, parent, evidence, form


class BlockReader:
    """Blocks of a page, with what their open elements say about them."""

    def __init__(self):
        # tag, number, evidence, within an article, form's number, first block and weight of a telling name
        self.open: list[tuple[str, int, float, bool, int, int, float]] = []
        self.at: dict[str, list[int]] = defaultdict(list)  # where in it each tag is
        self.block_at: list[int] = []  # where the block elements are
        self.scope_at: list[int] = []  # where the scopes are
        self.named: list[tuple[int, int, float]] = []  # blocks [first, last) of an element with a telling name, its weight
        self.number = 0
        self.skipping = 0
        self.in_link = 0
        self.pieces: list[str] = []
        self.links = 0
        self.blocks: list[Block] = []

    def read(self, html: str) -> list[Block]:
        page, texts = read_tokens(html), 0
        for k in range(len(page)):
            if page.kind[k] == START:
                raw = page.raw(k)
                self.start(page.name[k], dict(read_attributes(raw)) if "=" in raw or " " in raw else {}, page.end_pos[k] == k)
            elif page.kind[k] == END:
                self.end(page.name[k])
            else:
                self.text(page.texts[texts])
                texts += 1
        self.flush()
        self.close_at(0)
        return self.blocks

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.pieces)).strip()
        if text:
            own = self.open[self.block_at[-1]] if self.block_at else ("", 0, 0.0, False, 0)
            parent = self.open[self.block_at[-2]][1] if len(self.block_at) > 1 else 0
            last = self.open[-1] if self.open else own
            self.blocks.append(Block(text, self.links, own[0], parent, last[2], last[4]))
        self.pieces, self.links = [], 0

    def start(self, tag: str, attrs: dict, closed: bool) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        elif tag == "br":
            self.pieces.append(" ")
        # the nearest element that this tag closes, within the nearest scope
        near = max((self.at[name][-1] for name in CLOSES.get(tag, ()) if self.at[name]), default=-1)
        if near >= 0 and near >= (self.scope_at[-1] if self.scope_at else -1):
            self.close_at(near)
        if tag in VOID_TAGS:
            return
        evidence, article, form = self.open[-1][2:5] if self.open else (0.0, False, 0)
        own = self.evidence_of(tag, attrs, article)
        # what speaks against a part outweighs what speaks for the whole
        evidence, before = (min(evidence, 0.0) + own if own < 0 else evidence + own), evidence
        weight = self.weight_of_name(tag, attrs, article, before)
        self.number += 1
        place = len(self.open)
        if tag in BLOCK_TAGS:
            self.block_at.append(place)
        if tag in SCOPES:
            self.scope_at.append(place)
        form = self.number if tag == "form" else 0 if tag in ("article", "main") else form
        name = TEXT_BUTTON if tag == "button" and self.amid_words(form) else tag
        self.at[name].append(place)
        self.open.append((name, self.number, evidence, article or tag in ("article", "main"), form, len(self.blocks) if weight else -1, weight))
        self.skipping += name in SKIPPED_TAGS
        self.in_link += tag == "a"
        if closed and tag not in BLOCK_TAGS:
            self.close_at(place)

    def amid_words(self, form: int) -> bool:
        """Whether a paragraph outside forms has words already."""
        own = self.open[self.block_at[-1]][0] if self.block_at else ""
        return own in TEXT_TAGS and not form and not self.skipping and any(not p.isspace() for p in self.pieces)

    @staticmethod
    def evidence_of(tag: str, attrs: dict, in_article: bool) -> float:
        # the head of an article holds its title, the head of a page its menus
        own = 0.0 if tag == "header" and in_article else IN_TAG.get(tag, 0.0)
        own += IN_ROLE.get((attrs.get("role") or "").strip().lower(), 0.0)
        if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
            own -= 8.0
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.I):
            own -= 8.0
        if tag in BLOCK_TAGS and tag not in ("html", "body"):
            words = BlockReader.words(attrs)
            if words & NAMED_CONTENT and not words & (NAMED_BOILERPLATE | NAMED_PERHAPS):
                own += 2.0
        return own

    @staticmethod
    def words(attrs: dict) -> set[str]:
        return {w for v in (attrs.get("class"), attrs.get("id")) for name in (v or "").split() for w in words_of_name(name)}

    @staticmethod
    def weight_of_name(tag: str, attrs: dict, in_article: bool, evidence: float) -> float:
        """What an element's name says against it (0: nothing)."""
        if tag not in BLOCK_TAGS or tag in ("html", "body"):
            return 0.0
        words = BlockReader.words(attrs)
        # an article's own head belongs to it; a name of both kinds ("content-sidebar-wrap") says nothing
        bad = words & (NAMED_BOILERPLATE | NAMED_PERHAPS) - (OWN_HEAD if in_article else set())
        if not bad or (words & NAMED_CONTENT and words & LAYOUT):
            return 0.0
        other = {w for w in words - bad - NAMED_CONTENT - LAYOUT - NEUTRAL if not w.isdigit()}
        # parts of compound words ("comment-list" and "commentlist") do not count twice
        other = {w for w in other if not any(w != b and (w in b or b in w) for b in bad)}
        share = len(bad) / (len(bad) + len(other))
        if bad & NAMED_BOILERPLATE:
            return IN_NAMED * max(share, 0.7) - max(evidence, 0.0)
        return IN_NAMED * share * (0.4 if in_article and tag == "section" else 1.0)

    def close_at(self, i: int) -> None:
        while self.block_at and self.block_at[-1] >= i:
            self.block_at.pop()
        while self.scope_at and self.scope_at[-1] >= i:
            self.scope_at.pop()
        for name, _, _, _, _, first, weight in self.open[i:]:
            self.at[name].pop()
            self.skipping -= name in SKIPPED_TAGS
            self.in_link -= name == "a"
            if weight:
                self.named.append((first, len(self.blocks), weight))
        del self.open[i:]

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        if tag == "button" and (self.at[TEXT_BUTTON] or [-1])[-1] > (self.at[tag] or [-1])[-1]:
            tag = TEXT_BUTTON
        if not self.at[tag]:
            return
        i = self.at[tag][-1]
        # an inline end tag does not leave its container
        if tag in SCOPES or i > (self.scope_at[-1] if self.scope_at else -1):
            self.close_at(i)

    def text(self, data: str) -> None:
        if not self.skipping:
            self.pieces.append(data)
            if self.in_link:
                self.links += len(data.split())


def blocks_of(html: str) -> list[Block]:
    reader = BlockReader()
    blocks = reader.read(html)
    sizes: Counter[int] = Counter()  # characters of each form; 0: of none
    for b in blocks:
        sizes[b.form] += len(b.text)
    total = sizes.total()
    for b in blocks:
        if b.form:
            b.evidence += IN_FORM * (1 - sizes[b.form] / total) ** 2
    # words that are not of links, up to each block; changes of the evidence at the ends of named elements
    prose = [0, *accumulate(max(len(b.text.split()) - b.links, 0) for b in blocks)]
    change = [0.0] * (len(blocks) + 1)
    for first, last, weight in reader.named:
        share = (prose[last] - prose[first]) / max(prose[-1], 1)
        weight *= min(1.0, 2 * (1 - share))
        change[first] += weight
        change[last] -= weight
    for b, named in zip(blocks, accumulate(change)):
        b.evidence += named
    return blocks


def content_cost(block: Block) -> float:
    """Evidence for content (positive) or boilerplate (negative)."""
    words = len(block.text.split())
    score = block.evidence
    score += 1.5 * min(words, 40) / 40 + 0.1
    linked = block.links / max(words, 1)
    score -= 3.0 * linked * linked
    if block.tag in HEADINGS or block.tag == "p":
        score += 0.7
    if block.text[-1:] in ".!?:;…。":
        score += 0.4
    if block.text[:1] in "©" or "all rights reserved" in block.text.lower():
        score -= 2.0
    return score


def min_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling that maximises the gains of chosen nodes minus the ties
    cut, by maximum flow (level graphs, blocking flows): True on the source side."""
    n = len(gain)
    source, sink = n, n + 1
    to, cap, edges = [], [], [[] for _ in range(n + 2)]

    def add(a, b, forward, back):
        edges[a].append(len(to))
        to.append(b)
        cap.append(forward)
        edges[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            add(source, i, g, 0.0)
        elif g < 0:
            add(i, sink, -g, 0.0)
    for a, b, weight in ties:
        add(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in edges[v]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if cap[e] <= tiny)
                v = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[v] < len(edges[v]):
                e = edges[v][at[v]]
                if cap[e] > tiny and level[to[e]] == level[v] + 1:
                    break
                at[v] += 1
            if at[v] < len(edges[v]):
                path.append(edges[v][at[v]])
                v = to[path[-1]]
            elif path:
                v = to[path.pop() ^ 1]
                at[v] += 1
            else:
                break


def main_blocks(blocks: list[Block]) -> list[Block]:
    gain = [content_cost(b) for b in blocks]
    ties = [(i, i + 1, TIE_NEXT) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if b.parent in last and last[b.parent] != i - 1:
            ties.append((last[b.parent], i, TIE_PARENT))
        elif b.parent in last:
            ties[i - 1] = (i - 1, i, TIE_NEXT + TIE_PARENT)
        last[b.parent] = i
    return [b for b, keep in zip(blocks, min_cut(gain, ties)) if keep]


def main_text(html: str | None) -> str:
    return "\n\n".join(b.text for b in main_blocks(blocks_of(html or "")))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    text_batches(pages.sparkSession)
    key = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, type=pa.string()),
                                              pa.array([len(x) for x in texts], type=pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, f"page_id {key}, url string, text string, n_chars long"))
