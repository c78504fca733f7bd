"""DOM operators against a brute-force tree walk of the same rules."""

from htmlwalk import walk

from pyspark.sql import functions as F

from cardforge.operators.dom import (container_markup, dom_nodes, element, extract_lessons, index_links, next_links, page_trees,
                                     select_container)

R = 'style="color:#ff0000"'
B = 'style="color: #000000"'


def _page(h1, body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><script>var x='</p><div>';</script></head><body>"
            f"{h1}{extra}<div id=\"mainContent\">{body}</div><!-- </div> --></body></html>")


PAGES = [
    # headings
    _page("<h1>Apple – a fruit</h1>", "<p>x</p>"),
    _page("<h1>Pear - green fruit</h1>", ""),
    _page("<h1>A – B – C</h1>", ""),
    _page("<h1>co-op</h1><p>shared shop</p>", ""),
    _page("<h1>A–B</h1>", ""),
    _page("<h1>x – y - z</h1>", ""),
    _page("<h1>Lonely</h1>", ""),
    _page("<h1>Word&nbsp;with&#160;nbsp – def</h1>", ""),
    _page("<h1>Nested <b>bold</b> head</h1><div>next <i>sib</i></div>", ""),
    _page("<h1>First</h1><h1>Second – x</h1>", ""),
    "<html><body><div id='mainContent'><p><span " + R + ">no h1</span></p></div></body></html>",
    # blocks
    _page("<h1>b</h1>", f"<p><span {R}>one</span></p><p><span {R}>two</span></p>"),
    _page("<h1>b</h1>", f"<img src='a.png'><p><span {R}>one</span></p><p><span {R}>two</span></p>"),
    _page("<h1>b</h1>", f"<img><p><span {R}>nosrc</span></p><p><span {R}>skip</span></p>"),
    _page("<h1>b</h1>", f"<img src='/i/x y.jpg'><p><span {R}>NOTE this</span> more</p><p><span {R}>kept</span></p>"),
    _page("<h1>b</h1>", f"<p><span {R}>same</span></p><p><span {R}>same</span></p>"),
    _page("<h1>b</h1>", f"<figcaption>cap <p><span {R}>inner</span></p></figcaption>"),
    _page("<h1>b</h1>", f"<img src=a.png><figcaption>cap <p><span {R}>inner</span></p></figcaption>"),
    _page("<h1>b</h1>", f"<p><span {R}>red <span {B}>black</span></span> tail</p>"),
    _page("<h1>b</h1>", f"<p><span {R}>outer <span {R}>inner</span></span></p>"),
    _page("<h1>b</h1>", "<p><span style=\"COLOR : #FF0000\">caps</span></p>"
          "<p><span style='background:#ff0000'>bg</span></p><p><span " + R + ">  </span></p>"),
    _page("<h1>b</h1>", "<img src='d.png'><img src='d.png'><p>plain</p>"),
    _page("<h1>b</h1>", f"<img src=a.png><p><span {R}>A</span></p><p><span {R}>B</span></p>"
          f"<img src=b.png><p><span {R}>B</span></p>"),
    _page("<h1>b</h1>", f"<p><span {R}>dup</span></p><img src=c.png><p><span {R}>dup</span></p>"
          f"<p><span {R}>after</span></p>"),
    _page("<h1>b</h1>", f"<p><b>unclosed <span {R}>red</span><p>second <span {R}>r2</span></p>"),
    "<html><body><h1>no container</h1><p>x</p></body></html>",
    _page("<h1>b</h1>", f"<div id='mainContent'><p><span {R}>inner container</span></p></div>"),
]
URL = "https://site.example.net/chemistry/topic/page.html"


def test_dom_nodes_match_stack_walk(spark):
    df = spark.createDataFrame([(i, URL, h) for i, h in enumerate(PAGES)], "page_id long, url string, html string")
    rows = dom_nodes(df).filter("kind = 'start'").select("page_id", "pos", "name", "end_pos", "depth").collect()
    by = {}
    for r in rows:
        by.setdefault(r.page_id, []).append(r)
    for i, h in enumerate(PAGES):
        ref = walk(h)
        mine = sorted(by.get(i, []), key=lambda r: r.pos)
        starts = [r.pos for r in mine]
        got = [(r.name, sum(1 for p in starts if p <= r.end_pos), r.depth) for r in mine]
        assert got == [(e["name"], e["end"], e["depth"]) for e in ref], i


# word, definition, mnemonic, highlighted_text, images of each page above (None: no container, no record)
SITE = "https://site.example.net/chemistry/topic/"
LESSONS = [
    ("Apple", "a fruit", [], [], []),
    ("Pear", "green fruit", [], [], []),
    ("A", "B – C", [], [], []),
    ("co-op", "shared shop", [], [], []),
    ("A–B", "", [], [], []),
    ("x", "y - z", [], [], []),
    ("Lonely", "", [], [], []),
    ("Word with nbsp", "def", [], [], []),
    ("Nested bold head", "next sib", [], [], []),
    ("First", "Second – x", [], [], []),
    (None, None, ["no h1"], ["no h1"], []),
    ("b", "onetwo", ["one", "two"], ["one", "two"], []),
    ("b", "onetwo", ["one"], ["one"], [SITE + "a.png"]),
    ("b", "nosrcskip", ["nosrc"], ["nosrc"], []),
    ("b", "NOTE this morekept", ["kept"], ["kept"], ["https://site.example.net/i/x y.jpg"]),
    ("b", "samesame", ["same"], ["same", "same"], []),
    ("b", "cap inner", ["cap inner", "inner"], ["inner", "inner"], []),
    ("b", "cap inner", ["cap inner"], ["inner"], [SITE + "a.png"]),
    ("b", "red black tail", ["red black tail"], [], []),
    ("b", "outer inner", ["outer inner"], ["outer inner", "inner"], []),
    ("b", "capsbg", ["caps", "bg", ""], ["caps", "bg", ""], []),
    ("b", "plain", [], [], [SITE + "d.png", SITE + "d.png"]),
    ("b", "ABB", ["A", "B"], ["A", "B"], [SITE + "a.png", SITE + "b.png"]),
    ("b", "dupdupafter", ["dup", "after"], ["dup", "dup", "after"], [SITE + "c.png"]),
    ("b", "unclosed redsecond r2", ["unclosed redsecond r2", "second r2"], ["red", "r2", "r2"], []),
    None,
    ("b", "inner container", ["inner container"], ["inner container"], []),
]


def test_extract_lessons(spark):
    df = spark.createDataFrame([(i, URL, h) for i, h in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: tuple(r)[2:] for r in extract_lessons(df).collect()}
    assert got == {i: x for i, x in enumerate(LESSONS) if x}


def test_links(spark):
    html = ("<html><body><nav><ul><li><a href='/a'>a</a></li><li><a>no</a></li><li><a href='b/c'>b</a></li>"
            "</ul></nav><div class='x page-next'><span><a href='../next.html'>n</a></span><a href='z'>z</a></div>"
            "</body></html>")
    df = spark.createDataFrame([(1, URL, html), (2, URL, "<p>none</p>")], "page_id long, url string, html string")
    trees = page_trees(df)
    nl = {r.page_id: r.next_url for r in next_links(trees).collect()}
    assert nl == {1: "https://site.example.net/chemistry/next.html", 2: None}
    links = [r.link for r in index_links(trees, element("nav"), "https://site.example.net").orderBy("pos").collect()]
    assert links == ["https://site.example.net/a", "https://site.example.net/b/c"]


def test_containers_and_markup(spark):
    html = ("<html><body><div id='mainContent'><p>a <b>b&amp;c</b></p><!-- kept --><script>if (a<b) x='</div>'</script></div>"
            "<div id='mainContent'>second</div></body></html>")
    pages = [(1, URL, html), (2, URL, "<p>none</p>"), (3, URL, None), (4, URL, "<!-- only -->"), (5, URL, "<p>a<div id='mainContent'>x</p>")]
    trees = page_trees(spark.createDataFrame(pages, "page_id long, url string, html string"))
    inner = "<p>a <b>b&amp;c</b></p><!-- kept --><script>if (a<b) x='</div>'</script>"
    got = {r.page_id: r.container_html for r in container_markup(trees).collect()}
    assert got == {1: f"<div id='mainContent'>{inner}</div>", 5: "<div id='mainContent'>x"}
    got = {r.page_id: r.container_html for r in container_markup(trees, on_missing="empty").collect()}
    assert got == {1: f"<div id='mainContent'>{inner}</div>", 2: "", 3: "", 4: "", 5: "<div id='mainContent'>x"}
    assert select_container(trees, on_missing="empty").count() == 5


def test_index_links_of_every_container(spark):
    html = ("<div class='grid-menu'><a href='1'>x</a></div><a href='no'>x</a><ul class='a grid-menu'><li><a href='2'>x</a><a>y</a></ul>"
            "<div class='grid-menu'><div class='grid-menu'><a href='3'>x</a></div><a href='3'>again</a></div>")
    trees = page_trees(spark.createDataFrame([(1, "https://h/x/", html)], "page_id long, url string, html string"))
    assert [r.link for r in index_links(trees).orderBy("pos").collect()] == ["https://h/x/1", "https://h/x/2", "https://h/x/3", "https://h/x/3"]


def test_long_input(spark):
    pages = ["<p title=" + "x" * 300_000 + ">a</p>", "<a " * 2000 + "text", "<p>" * 5000 + "deep", "&amp;" * 100_000, "<!--" + "x" * 300_000,
             "<b " + "c='d' " * 50_000 + ">t</b>"]
    df = spark.createDataFrame([(i, URL, h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    n = {r.page_id: r.n for r in dom_nodes(df).groupBy("page_id").agg(F.count("*").alias("n")).collect()}
    assert n[0] == 3 and n[2] == 5001 and n[3] == 1 and n[5] == 3
    assert page_trees(df).where("page_id = 3").first().text == "&" * 100_000


MISNESTED = ["<p>a<div><p>b</div><i>c</i></p>", "<b><i>x</b><u>y</u></i>",
             "<div><span><div>x</span><em>e</em></div></div>", "<p>a<div><p>b</div><i>c</i></p><p>d<b>e</b></p>",
             "<b><div></p><div></div><i><p></i></div></div><p></i></b></p>",
             "</i><p><div><div></p><b></b></i>x<i><p><p></div><b>"]


def _fuzz(n, seed=7, lo=3, hi=14):
    import random
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        toks = []
        for _ in range(rnd.randint(lo, hi)):
            r, t = rnd.random(), rnd.choice(["p", "div", "b", "i"])
            toks.append(f"<{t}>" if r < 0.5 else (f"</{t}>" if r < 0.85 else "x"))
        out.append("".join(toks))
    return out


def test_misnested_tags_match_html_parser(spark):
    cases = MISNESTED + _fuzz(300) + _fuzz(2000, 8, 30, 80)
    df = spark.createDataFrame([(i, URL, h) for i, h in enumerate(cases)], "page_id long, url string, html string")
    rows = dom_nodes(df).filter("kind = 'start'").select("page_id", "pos", "name", "end_pos", "depth").collect()
    by = {}
    for r in rows:
        by.setdefault(r.page_id, []).append(r)
    for i, h in enumerate(cases):
        mine = sorted(by.get(i, []), key=lambda r: r.pos)
        starts = [r.pos for r in mine]
        got = [(r.name, sum(1 for p in starts if p <= r.end_pos), r.depth) for r in mine]
        assert got == [(e["name"], e["end"], e["depth"]) for e in walk(h)], h


def _random_lesson(rnd):
    """A page of image, red, NOTE, dark and plain parts, and what its rules give:
    before the first image each new red block counts, after it one an image."""
    parts, mnemonics, marks, images, seen = [], [], [], [], set()
    behind_image = counted = False
    for _ in range(rnd.randint(2, 14)):
        word = rnd.choice(["alpha", "beta", "gamma"])
        kind = rnd.choice(["image", "red", "red", "note", "dark", "plain"])
        if kind == "image":
            parts.append(f"<img src='/i/{word}.png'>")
            images.append(f"https://site.example.net/i/{word}.png")
            behind_image, counted = True, False
            continue
        text = {"red": f"<span {R}>{word}</span> tail", "note": f"<span {R}>NOTE {word}</span>",
                "dark": f"<span {R}>{word} <span {B}>dark</span></span>", "plain": f"plain {word}"}[kind]
        parts.append(f"<p>{text}</p>")
        if counted:
            continue
        if kind == "red":
            marks.append(word)
        if kind in ("red", "dark") and text not in seen:
            seen.add(text)
            mnemonics.append(f"{word} tail" if kind == "red" else f"{word} dark")
            counted = behind_image
    return _page("<h1>Rand – x</h1>", "".join(parts)), ("Rand", "x", mnemonics, marks, images)


def test_extract_lessons_random_pages(spark):
    import random
    rnd = random.Random(11)
    pages = [_random_lesson(rnd) for _ in range(200)]
    df = spark.createDataFrame([(i, URL, h) for i, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: tuple(r)[2:] for r in extract_lessons(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(pages)}


def test_attributes_and_self_closing_random(spark):
    import random
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out = []

        def handle_starttag(self, tag, attrs):
            self.out.append([(k, v if v is not None else "") for k, v in attrs])

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs)

    rnd = random.Random(13)
    names = ["href", "HREF", "class", "data-x", "id", "style", "a-b"]
    vals = ['"v"', "'v'", "v", '"a b"', "'x>y'", '"1&amp;2"', '""', "'it''s'", '"&#65;"', "x/y", "/", "=v"]
    htmls = []
    for _ in range(300):
        attrs = [(n if rnd.random() < 0.2 else n + rnd.choice(["=", " = ", "=="]) + rnd.choice(vals))
                 for n in (rnd.choice(names) for _ in range(rnd.randint(0, 4)))]
        htmls.append("<div " + " ".join(attrs) + rnd.choice([">", " >", "/>", " />"]) + "t<p>u</div>")
    df = spark.createDataFrame([(i, URL, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    rows = dom_nodes(df).filter("kind = 'start'").select("page_id", "pos", "name", "attrs", "end_pos", "depth")
    by = {}
    for r in rows.collect():
        by.setdefault(r.page_id, []).append(r)
    for i, h in enumerate(htmls):
        mine = sorted(by[i], key=lambda r: r.pos)
        p = P()
        p.feed(h)
        assert [(a["k"], a["v"]) for a in mine[0].attrs] == p.out[0], h
        starts = [r.pos for r in mine]
        got = [(r.name, sum(1 for q in starts if q <= r.end_pos), r.depth) for r in mine]
        assert got == [(e["name"], e["end"], e["depth"]) for e in walk(h)], h


def test_what_a_task_holds_does_not_grow_with_the_batch(spark):
    import pyarrow as pa
    page = "<div id=mainContent><p><span style='color:#ff0000'>a</span> b</p></div>" * 40
    pages = spark.createDataFrame([(i, "https://h/", page) for i in range(3)], "page_id long, url string, html string")
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(["https://h/"] * 2000), pa.array([page] * 2000)], ["page_id", "url", "html"])

    from cardforge.operators import dom as D
    seen = {}
    real = type(pages).mapInArrow

    def catch(self, run, schema, *args):
        seen["run"] = run
        return real(self, run, schema, *args)

    type(pages).mapInArrow = catch
    try:
        trees = D.page_trees(pages)
        tree = seen["run"]
        assert trees.count() == 3
    finally:
        type(pages).mapInArrow = real
    out = list(tree(iter([batch])))
    assert len(out) > 2 and sum(b.num_rows for b in out) == 2000
    assert [x for b in out for x in b.column(0).to_pylist()] == list(range(2000))
    assert max(sum(map(len, b.column(2).to_pylist())) for b in out) <= D.PORTION_CHARS
