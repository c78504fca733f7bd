"""End-to-end plans: rule scrape over a linked page set, records to flashcards."""

from cardforge.plans.lessons import records_to_flashcards, rule_scrape

BASE = "https://site.example.net/chemistry/gases/"


def _page(name, nxt):
    nav = f'<div class="page-next"><a href="{nxt}.html">next</a></div>' if nxt else ""
    return (f"<html><body><h1>{name} – a gas</h1><div id='mainContent'><p><span style='color:#ff0000'>"
            f"{name} mnemonic</span> rest</p></div>{nav}</body></html>")


def test_rule_scrape_follows_links(spark):
    chain = [("neon", "argon"), ("argon", "xenon"), ("xenon", None), ("radon", "neon")]
    pages = spark.createDataFrame([(i, BASE + f"{a}.html", _page(a.title(), b)) for i, (a, b) in enumerate(chain)],
                                  "page_id long, url string, html string")
    seeds = spark.createDataFrame([(1, BASE + "argon.html")], "seed_id int, url string")
    got = sorted((r.depth, r.word, r.mnemonic[0]) for r in rule_scrape(pages, seeds).collect())
    assert got == [(0, "Argon", "Argon mnemonic rest"), (1, "Xenon", "Xenon mnemonic rest")]


def test_records_to_flashcards(spark):
    rows = [(0, "https://site.example.net/chemistry/a.html",
             '```json\n[{"term": "Neon", "definition": "gas"}, {"term": "Al (name)", "definition": null},'
             ' {"name": "Bo"}]\n```'),
            (1, "https://site.example.net/biology/b.html", "oops")]
    rec = spark.createDataFrame(rows, "row_no long, url string, concept_and_mnemonic string")
    cards, rejects, counts = records_to_flashcards(rec)
    got = sorted((r.subject, r.term, r.question) for r in cards.collect())
    assert got == [("chemistry", "Al (name)", "What is the first name associated with Al?"),
                   ("chemistry", "Bo", None), ("chemistry", "Neon", "What is Neon?")]
    assert [r.row_no for r in rejects.collect()] == [1]
    assert {(r.subject, r.n_items) for r in counts.collect()} == {("chemistry", 3), (None, 3)}
