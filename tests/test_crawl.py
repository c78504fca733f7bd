"""Traversal against a brute-force walk."""

from pyspark.sql import functions as F

from cardforge.operators.crawl import crawl_all, follow_chain, skip_done, until_first_repeat, visit_single


def _links():
    edges = {}
    edges["a1"] = None                                   # length 1
    edges.update({"b1": "b2", "b2": "b3", "b3": None})   # length 3
    for i in range(120):                                 # length 120
        edges[f"c{i}"] = f"c{i + 1}" if i < 119 else None
    edges.update({"d1": "d2", "d2": "d3", "d3": "d1"})   # cycle
    edges["e1"] = "e1"                                   # self-loop
    edges.update({"f1": "f2", "f2": "missing"})          # link to a missing page
    edges.update({"g1": "g3", "g2": "g3", "g3": "g4", "g4": None})  # shared tail
    edges.update({"h1": "h2", "h2": "h3", "h3": "h4", "h4": "h2"})  # tail into a cycle
    return edges


def _walk(edges, s):
    out, seen = [], set()
    cur = s
    while cur is not None and cur not in seen and cur in edges:
        seen.add(cur)
        out.append(cur)
        cur = edges[cur]
    return out


def test_follow_chain_matches_brute_force(spark):
    edges = _links()
    links = spark.createDataFrame(list(edges.items()), "url string, next_url string")
    seeds = [(1, "a1"), (2, "b1"), (3, "c0"), (4, "d2"), (5, "e1"), (6, "f1"), (7, "g1"), (8, "g2"), (9, "h1"),
             (10, "h1"), (11, "zz"), (12, "c60")]
    sd = spark.createDataFrame(seeds, "seed_id int, url string")
    got = sorted((r.seed_id, r.depth, r.url) for r in follow_chain(links, sd).collect())
    exp = sorted((sid, d, u) for sid, s in seeds for d, u in enumerate(_walk(edges, s)))
    assert got == exp
    assert len([r for r in got if r[0] == 3]) == 120


def test_visit_skip_dedup(spark):
    edges = _links()
    links = spark.createDataFrame(list(edges.items()), "url string, next_url string")
    sd = spark.createDataFrame([(1, "g1"), (2, "g2"), (3, "nope")], "seed_id int, url string")
    assert sorted(r.url for r in visit_single(links, sd).collect()) == ["g1", "g2"]
    done = spark.createDataFrame([("g1",), (None,)], "url string")
    assert sorted(r.seed_id for r in skip_done(sd, done).collect()) == [2, 3]
    glob = crawl_all(links, sd, dedup="global")
    assert sorted((r.url, r.seed_id) for r in glob.collect()) == [("g1", 1), ("g2", 2), ("g3", 1), ("g4", 1)]


def test_until_first_repeat(spark):
    rows = [("p", i, t) for i, t in enumerate("abcbd")] + [("q", i, "x") for i in range(3)] + \
           [("r", i, t) for i, t in enumerate("xyz")]
    df = spark.createDataFrame(rows, "part string, ord int, content string")
    got = sorted((r.part, r.content) for r in until_first_repeat(df, "part", "ord", "content").collect())
    assert got == [("p", "a"), ("p", "b"), ("p", "c"), ("q", "x"), ("r", "x"), ("r", "y"), ("r", "z")]


def test_random_graphs(spark):
    import random
    rnd = random.Random(5)
    for n in (1, 7, 60):
        names = [f"p{i}" for i in range(n)]
        edges = {u: rnd.choice([None, "gone", *names]) for u in names}
        links = spark.createDataFrame(list(edges.items()), "url string, next_url string")
        seeds = [(i, rnd.choice(names + ["zz"])) for i in range(25)]
        sd = spark.createDataFrame(seeds, "seed_id int, url string")
        exp = sorted((sid, d, u) for sid, s in seeds for d, u in enumerate(_walk(edges, s)))
        assert sorted((r.seed_id, r.depth, r.url) for r in follow_chain(links, sd).collect()) == exp
        first = {}
        for sid, d, u in exp:
            first[u] = min(first.get(u, (sid, d)), (sid, d))
        got = {r.url: (r.seed_id, r.depth) for r in crawl_all(links, sd, dedup="global").collect()}
        assert got == first


def test_pages_come_out_of_pieces_without_a_shuffle(spark, monkeypatch):
    from cardforge.operators import crawl
    edges = {**_links(), **{f"r{i}": f"r{(i + 1) % 90}" for i in range(90)}, "t1": "r7", "t2": "c100"}
    links = spark.createDataFrame(list(edges.items()), "url string, next_url string")
    seeds = list(enumerate([*edges, "c3", "zz"]))
    sd = spark.createDataFrame(seeds, "seed_id int, url string")
    exp = sorted((sid, d, u) for sid, s in seeds for d, u in enumerate(_walk(edges, s)))
    for piece in (1, 8, 1 << 40):  # with the last, runs are cut where walks meet only, and rings have no start
        monkeypatch.setattr(crawl, "PIECE", piece)
        walks = follow_chain(links, sd)
        assert sorted((r.seed_id, r.depth, r.url) for r in walks.collect()) == exp
        first = {}
        for sid, d, u in exp:
            first[u] = min(first.get(u, (sid, d)), (sid, d))
        assert {r.url: (r.seed_id, r.depth) for r in crawl_all(links, sd, dedup="global").collect()} == first
        plan = walks._jdf.queryExecution().executedPlan().toString()
        assert "Generate" in plan and "Exchange" not in plan[:plan.index("Generate")]


def test_single_visits_of_more_rows_take_more_tasks(spark, monkeypatch):
    from cardforge.operators import crawl
    monkeypatch.setattr(crawl, "TASK_ROWS", 10)
    pages = spark.createDataFrame([(f"p{i % 90}",) for i in range(180)] + [(None,)], "url string")
    seeds = spark.createDataFrame([(i, f"p{i}") for i in range(100)] + [(100, None), (101, "p3")], "seed_id int, url string")
    got = visit_single(pages, seeds)
    assert sorted((r.seed_id, r.depth, r.url) for r in got.collect()) == [(i, 0, f"p{i}") for i in range(90)] + [(101, 0, "p3")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and ", 29), REPARTITION_BY_NUM" in plan


def test_short_cycles_without_a_start_of_their_own(spark):
    # nearly all of these cycles hold no page that begins a piece by its hash
    pages = [(f"{n}-{k}", f"{n}-{(k + 1) % n}") for n in range(1, 25) for k in range(n)]
    links = spark.createDataFrame(pages, "url string, next_url string")
    seeds = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(pages)], "seed_id long, url string")
    number = {u: i for i, (u, _) in enumerate(pages)}
    got = {(r.seed_id, r.depth): r.url for r in follow_chain(links, seeds).collect()}
    assert got == {(number[f"{n}-{k}"], d): f"{n}-{(k + d) % n}" for n in range(1, 25) for k in range(n) for d in range(n)}
    least = {r.url: (r.seed_id, r.depth) for r in crawl_all(links, seeds, dedup="global").collect()}
    assert least == {f"{n}-{k}": (number[f"{n}-0"], k) for n in range(1, 25) for k in range(n)}


def test_pages_of_one_file_are_built_and_read_by_many_tasks(spark, tmp_path):
    from cardforge.plans import fixtures
    spark.range(50_000).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    pages = fixtures.chain_pages(spark, str(tmp_path))
    sizes = [r["count"] for r in pages.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 50_000 and max(sizes) < 20_000
