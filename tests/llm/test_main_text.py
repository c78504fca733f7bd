import itertools
import random

from cardforge.llm import main_text as mt

PAGE = """<html><head><title>T &amp; x</title><script>var a = "<p>no</p>";</script><style>p{}</style></head><body>
<header class="site-header"><h2>Site</h2><p>Welcome to our wonderful site about everything and more.</p></header>
<div class="cookie-notice"><p>We use cookies to improve your experience on this site. Please accept them to go on.</p></div>
<nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav>
<main><article><header><h1>Title &eacute;</h1></header><p>First paragraph of the text that is quite long
 and goes   on for a while.</p><p>Short.</p><!-- <p>comment</p> -->
<div class="ad">Buy now our great product for little money, today only!</div>
<p>Second &lt;b&gt; <b>paragraph</b> with an entity&#33;<ul><li>Item one<li>Item two</ul>
<form><label>Email</label><input><p>Subscribe to our newsletter for more.</p></form>
<table><tr><td>cell a<td>cell b</table><blockquote>A quote here.</blockquote></article></main>
<aside class="sidebar"><h3>Related</h3><p>Long text in the sidebar that would be content otherwise, yes it would be.</p></aside>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I think that this article is very good, thanks a lot.</p></div></section>
<footer>&copy; 2020 example</footer></body></html>"""


def test_a_page():
    assert mt.main_text(PAGE).split("\n\n") == [
        "Title é", "First paragraph of the text that is quite long and goes on for a while.", "Short.",
        "Second <b> paragraph with an entity!", "Item one", "Item two", "cell a", "cell b", "A quote here."]


def test_without_semantic_tags():
    page = """<body><div id=menu><a href=1>Home</a> <a href=2>About us</a></div><div class=post><h1>Hello World</h1>
    <p>Some long paragraph with a lot of words in it so that it stays.<p>Another one with words that go on.</div>
    <div id="footer">Copyright 2020</div>"""
    assert mt.main_text(page) == "Hello World\n\nSome long paragraph with a lot of words in it so that it stays.\n\nAnother one with words that go on."


def test_names_of_wrappers():
    page = """<body class="has-sidebar"><div class="content-sidebar-wrap"><article><div class="article-header"><h1>The title</h1></div>
    <p>A paragraph with enough words to be the text of the page, surely.</p><div id="ad-1">Buy this now and here today!</div>
    </article><div class="widget-area sidebar"><p>Something else that nobody came to this page to read at all.</p></div></div>"""
    assert mt.main_text(page) == "The title\n\nA paragraph with enough words to be the text of the page, surely."


def test_min_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 8)
        gain = [rng.choice([0.0, rng.uniform(-3, 3)]) for _ in range(n)]
        ties = [(i, j, rng.uniform(0, 2)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.4]

        def value(labels):
            return sum(g for g, x in zip(gain, labels) if x) - sum(w for i, j, w in ties if labels[i] != labels[j])

        best = max(value(x) for x in itertools.product([False, True], repeat=n))
        assert abs(value(mt.min_cut(gain, ties)) - best) < 1e-6


def test_edges(spark):
    deep = "<div><p>words in a paragraph.</p>" * 3000
    rows = [(1, "u", PAGE, "t", 3), (2, None, None, None, None), (3, "u", "", "t", 3), (4, "u", "<p>a<p>b &#0; </b></i><", "t", 3),
            (5, "u", deep, "t", 3), (1, "u", PAGE, "t", 3), (None, "u", "<nav>x</nav>", "t", 3)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted(map(tuple, mt.extract_pages(d).collect()), key=repr)
    assert got == sorted(((r[0], r[1], mt.main_text(r[2]), len(mt.main_text(r[2]))) for r in rows), key=repr)
    by = {r[0]: r[2] for r in got}
    assert by[2] == by[3] == by[None] == "" and by[5].count("\n\n") == 2999
    assert mt.extract_pages(d.limit(0)).collect() == []


LONG = "A paragraph with enough words to be the text of the page, surely, and some more of them to go on."


def test_layout_names_say_nothing():
    for name in ("has-sidebar", "no-sidebar", "with-sidebar", "without_comments", "hasSidebar", "layout-with-sidebar"):
        page = f'<body><div class="{name}"><article><h1>The title</h1><p>{LONG}</p></article><div class="sidebar"><p>{LONG}</p></div></div>'
        assert mt.main_text(page) == f"The title\n\n{LONG}", name
    assert mt.main_text(f'<div class="post"><p>{LONG}</p></div><div class="sidebar-no-padding"><p>{LONG}</p></div>') == LONG


def test_page_in_a_form():
    inner = f'<nav><a href=1>Home</a></nav><div class="%s"><h1>The title</h1><p>{LONG}</p><p>{LONG}</p></div>'
    for body in (inner % "text", inner % "x", f"<nav>Home</nav><article><h1>The title</h1><p>{LONG}</p><p>{LONG}</p></article>",
                 f"<main><h1>The title</h1><p>{LONG}</p><p>{LONG}</p></main><label>Email</label><p>Subscribe to our letter for more.</p>"):
        page = f'<body><form id="aspnet"><input type=hidden>{body}<button>Go</button></form><footer>All rights reserved.</footer>'
        assert mt.main_text(page) == f"The title\n\n{LONG}\n\n{LONG}", body
    small = f"<article><p>{LONG}</p><form><p>Subscribe to our newsletter for more.</p></form><p>{LONG}</p></article>"
    assert mt.main_text(small) == f"{LONG}\n\n{LONG}"


def test_math_is_inline_text():
    page = f"<article><p>{LONG} So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='t'>x=1</annotation></math> holds.</p></article>"
    assert mt.main_text(page) == f"{LONG} So x=1 holds."


OTHER = "Another paragraph of the text that goes on for quite a while with words, so that it is long enough to be read by people."


def test_a_section_is_not_lost_by_one_word_of_its_name():
    for part in (f'<section id="discussion"><h2>Discussion</h2><p>{OTHER}</p></section>',
                 f'<section class="related-work"><h2>Discussion</h2><p>{OTHER}</p></section>',
                 f'<div class="social-media-strategy"><h2>Discussion</h2><p>{OTHER}</p></div>'):
        page = f"<body><nav>Home</nav><article><h1>The title</h1><p>{LONG}</p>{part}<p>{LONG}</p></article><footer>x</footer>"
        assert mt.main_text(page) == "\n\n".join(["The title", LONG, "Discussion", OTHER, LONG]), part
    page = f'<main><h1>The title</h1><p>{LONG}</p><div class="privacy-policy"><p>{OTHER}</p></div></main>'
    assert mt.main_text(page) == "\n\n".join(["The title", LONG, OTHER])
    page = f'<nav>Home</nav><div class="lesson-navigation-systems"><p>{LONG}</p><p>{OTHER}</p><p>{LONG}</p></div><footer>x</footer>'
    assert mt.main_text(page) == "\n\n".join([LONG, OTHER, LONG])
    page = f'<nav>Home</nav><div class="comments-wrapper"><article><h1>The title</h1><p>{LONG}</p><p>{OTHER}</p></article></div>'
    assert mt.main_text(page) == "\n\n".join(["The title", LONG, OTHER])


def test_reader_comments_and_adverts_go():
    for part in ('<div class="thread">%s</div>', '<div id="user-reviews">%s</div>', '<section class="comments">%s</section>',
                 '<div class="post-comments"><ol class="comment-list"><li>%s</ol></div>', '<div id="visitor-comments">%s</div>',
                 '<div class="related">%s</div>', '<div class="cookie-notice">%s</div>'):
        said = "<p>I think that this text is very good, thanks a lot for it all.</p>"
        page = f"<main><h1>The title</h1><p>{LONG}</p><p>{OTHER}</p><p>{LONG}</p>{part % said}</main>"
        assert mt.main_text(page) == "\n\n".join(["The title", LONG, OTHER, LONG]), part
    for part in ('<div class="ad">%s</div>', '<section id="comments">%s</section>', '<div class="newsletter-signup">%s</div>'):
        page = f"<article><h1>The title</h1><p>{LONG}</p>{part % '<p>Buy our great product now for little money!</p>'}<p>{LONG}</p></article>"
        assert mt.main_text(page) == "\n\n".join(["The title", LONG, LONG]), part


def test_a_button_amid_words():
    page = f"<article><p>{LONG} Press <button>Start</button> now.</p><p><button>Share</button></p><button>Print</button><form><p>Or <button>Send</button></form></article>"
    assert mt.main_text(page) == f"{LONG} Press Start now."


def test_broken_pages_cost_as_much_as_their_length():
    import time

    for unit in ("<a ", "<!--", '<a "', "<b>word ", "<p>word ", "<div class=ad>word ", "<td>x", "</b><i>x", "<button>x"):
        begin = time.process_time()
        mt.blocks_of(unit * (400_000 // len(unit)))
        assert time.process_time() - begin < 8, unit
