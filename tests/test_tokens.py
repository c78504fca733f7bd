"""The one-pass page reader against plain patterns, and its cost on broken pages."""
import html as html_lib
import random
import re
import time
import tracemalloc

import pytest

from cardforge.functions.text import unescape
from cardforge.operators import dom
from cardforge.operators.tokens import START, TEXT, VOID_ELEMENTS, read_attributes, read_tokens

PIECES = ["<", ">", "<a ", "</a>", "<b>", "</b>", '"', "'", "=", "/", "/>", " ", "x", "y=1", "<!--", "-->", "<!", "<?", "<!DOCTYPE x>",
          "&amp;", "&lt", "<script>", "</script>", "</SCRIPT >", "<style>", "</style>", "<p>", '<p class="a">', "<br/>", "<br>", "\n",
          "é", "<div id=x/>", "<div id= x/>", "==", '<i a="', "<i a='", "&#65;", '<a href="x>y"/>', "=x", "\x1c", "</", "<1", "</p"]

PLAIN = re.compile(r"""(?s:<!--.*?-->)|<[!?][^>]*>|</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>|[^<]+|<""")
SLASH_IN_VALUE = re.compile(r"""=+\s*(?:[^\s'"=>][^\s>]*)?/>$""")


def plain_tokens(html):
    """(kind, name, raw, end_pos, depth, parent, text) by trying each pattern at each place."""
    out, stack, at = [], [], 0
    while at < len(html):
        raw = PLAIN.match(html, at).group()
        start, at = at, at + len(raw)
        if raw.startswith(("<!", "<?")):
            continue
        name = re.match(r"</?([a-zA-Z][^\t\n\r\f />\x00]*)", raw)
        depth, parent = len(stack), stack[-1] if stack else -1
        if name is None:
            # comments do not part a text, a lone "<" does
            if out and out[-1][0] == "text" and out[-1][2] != "<" and raw != "<":
                out[-1][2] += raw
            else:
                out.append(["text", None, raw, len(out), depth, parent])
            continue
        name = name.group(1).lower()
        if raw[1] == "/":
            for k in range(len(stack) - 1, -1, -1):
                if out[stack[k]][1] == name:
                    for e in stack[k:]:
                        out[e][3] = len(out)
                    del stack[k:]
                    break
            out.append(["end", name, raw, len(out), len(stack), stack[-1] if stack else -1])
            continue
        out.append(["start", name, raw, len(out), depth, parent])
        if name in VOID_ELEMENTS or (raw.endswith("/>") and not SLASH_IN_VALUE.search(raw)):
            continue
        stack.append(len(out) - 1)
        if name in ("script", "style"):
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.start() if end else at
    for e in stack:
        out[e][3] = len(out)
    return [(*t, html_lib.unescape(t[2]) if t[0] == "text" else None) for t in out]


def columns_as_rows(html):
    page = read_tokens(html)
    rows, texts = [], 0
    for k in range(len(page)):
        raw, text = page.raw(k), None
        if page.kind[k] == TEXT:
            raw, text = page.raws[texts], page.texts[texts]
            texts += 1
        rows.append((("start", "end", "text")[page.kind[k]], page.name[k], raw, page.end_pos[k], page.depth[k], page.parent[k], text))
    return rows


def test_tokens_equal_plain_patterns():
    rng = random.Random(5)
    for _ in range(6000):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        assert columns_as_rows(html) == plain_tokens(html), html


def test_element_ranges():
    html = "a&amp;<p>b<!-- c --><i>d</p>e"
    page = read_tokens(html)
    text = "".join(page.texts)
    assert text == "a&bde"
    cut = [(page.name[k], text[page.t0[j]:page.t1[j]], html[page.m0[k]:page.m_end[j]], html[page.m0[k]:page.m1[j]])
           for j, k in enumerate(page.pos) if page.kind[k] == START]
    assert cut == [("p", "bd", "<p>b<!-- c --><i>d", "<p>b<!-- c --><i>d</p>"), ("i", "d", "<i>d", "<i>d")]


BROKEN = {"tag": "<a ", "comment": "<!--", "double quote": '<a "', "both quotes": "<a \"'", "unclosed inline": "<b>word ", "unclosed block": "<p>",
          "empty comment": "<!-->", "script": "<script>", "comments in a text": "a<!---->", "value": "<a b='", "declaration": "<!x "}


@pytest.mark.parametrize("name", BROKEN)
def test_a_broken_page_costs_as_much_as_its_length(name):
    unit = BROKEN[name]
    begin = time.process_time()
    read_tokens(unit * (1_000_000 // len(unit)))
    assert time.process_time() - begin < 4  # about a second; by trying every pattern anew it is many minutes


def test_one_tag_of_a_million_characters():
    raw = "<a " + "=x" * 500_000 + " y/>"
    begin = time.process_time()
    assert len(read_tokens(raw)) == 1 and len(read_attributes(raw)) == 2
    assert time.process_time() - begin < 2


def test_references_of_any_length():
    assert unescape("&#" + "9" * 10_000 + ";x&#" + "0" * 10_000 + "65;") == "�xA"
    assert unescape("&#x" + "f" * 10_000 + ";") == "�"
    assert unescape("&#" + "0" * 5000 + ";") == html_lib.unescape("&#0;")


# ---------------------------------------------------------------- blocks

RED, BLACK = "#ff0000", "#000000"


def plain_blocks(html, text, els, box):
    """Blocks with their red spans, each with copies of its text and markup."""
    reds = [e for e in els if RED in e["colour"] and box[0] < e["pos"] < box[1]]
    out, seen, images, settled = [], set(), 0, False
    for e in els:
        if not box[0] < e["pos"] < box[1] or e["name"] == "span":
            continue
        if e["name"] == "img":
            images, settled = images + 1, False
            continue
        spans = [(r["pos"], text[r["t0"]:r["t1"]], any(BLACK in b["colour"] and r["pos"] < b["pos"] < r["end_pos"] for b in els))
                 for r in reds if e["pos"] < r["pos"] < e["end_pos"]]
        words, markup, processed, mnemonic = text[e["t0"]:e["t1"]], html[e["m0"]:e["m_end"]], not settled, None
        if processed and spans and "NOTE" not in words and markup not in seen:
            seen.add(markup)
            mnemonic, settled = words, images > 0
        out.append((e["pos"], processed, mnemonic, spans))
    return out


def elements(page):
    out = []
    for j, k in enumerate(page.pos):
        if page.name[k] in ("img", "p", "figcaption", "span"):
            colour = dict(read_attributes(page.tag(j))).get("style", "")
            out.append({"pos": k, "end_pos": page.end_pos[k], "name": page.name[k], "colour": colour, "m0": page.m0[k],
                        **{c: getattr(page, c)[j] for c in ("t0", "t1", "m_end")}})
    return out


def walked(html):
    page, box = read_tokens(html), (-1, 1 << 30)
    els = elements(page)
    ints = {c: [e[c] for e in els] for c in ("pos", "end_pos", "t0", "t1", "m0", "m_end")}
    text = "".join(page.texts)
    blocks, reds = dom.walk_blocks(html, text, [e["name"] for e in els], [e["colour"] for e in els], ints, box)
    return [(p, done, m, reds[lo:hi]) for p, done, m, lo, hi in blocks], plain_blocks(html, text, els, box)


def test_blocks_equal_plain_copies():
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<figcaption>", "</figcaption>", "<img src=x>", f"<span style='{RED}'>", f"<span style='{BLACK}'>", "</span>",
             "<span>", "word ", "NOTE", "NO", "TE ", "<div>", "</div>", "<p>a<span style='#ff0000'>b</span></p>"]
    for _ in range(3000):
        got, want = walked("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))))
        assert got == want


def test_same_markup_in_long_blocks():
    block = f"<p>{'x' * 100}<span style='{RED}'>red</span>{'y' * 100}%s{'z' * 100}</p>"
    got, want = walked("".join(block % k for k in ("one", "two", "one", "six", "two")))
    assert got == want and [m is not None for _, _, m, _ in got] == [True, True, False, True, False]


def test_memory_of_nested_blocks(spark):
    html = f"<div id='mainContent'><h1>A – B</h1>{'<p>' * 333_000}<span style='color:#ff0000'>red</span>"
    tracemalloc.start()
    page = read_tokens(html)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    del page
    small = html.replace("<p>" * 333_000, "<img src=a><p>" + "w<p>" * 20_000)
    pages = spark.createDataFrame([(1, "https://h/x/", small)], "page_id long, url string, html string")
    lesson = dom.extract_lessons(pages).first()
    assert lesson.mnemonic == ["w" * 20_000 + "red"] and lesson.highlighted_text == ["red"]
