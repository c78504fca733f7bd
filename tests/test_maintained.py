"""Kept jump tables against a rebuild and a brute-force walk."""
import random

from cardforge.operators.maintained import WalkTables

LINK = "url string, next_url string"


def walk(links, s):
    out = []
    while s in links and s not in out:
        out.append(s)
        s = links[s]
    return out


def check(spark, tables, links):
    pages = sorted(links)
    seeds = spark.createDataFrame([(i, u) for i, u in enumerate(pages)] + [(-1, "nowhere")], "seed_id int, url string")
    got = sorted((r.seed_id, r.depth, r.url) for r in tables.walks(seeds).collect())
    assert got == sorted((i, d, u) for i, s in enumerate(pages) for d, u in enumerate(walk(links, s)))
    names = {r.u: r.url for r in tables._newest("nodes", "url", "url string, u long").collect()}
    top = tables.n_levels()
    assert 1 << (top - 1) >= len(links)
    for k in range(top):
        rows = {names[r.u]: names.get(r.j) for r in tables.level(k).collect()}
        want = {}
        for u in pages:
            v = u
            for _ in range(1 << k):
                v = links.get(v) if v is not None else None
                v = v if v in links else None
            want[u] = v
        assert rows == want, k


def test_insert_delete_and_link_anew(spark, tmp_path):
    tables = WalkTables(spark, str(tmp_path / "walks"))
    links = {"a": "b", "b": "c", "c": None, "x": "y", "y": "x", "l": "gone"}
    d = lambda rows: spark.createDataFrame(list(rows), LINK)
    urls = lambda rows: spark.createDataFrame([(r,) for r in rows], "url string")
    tables.update(d(links.items()))
    check(spark, tables, links)
    steps = [({"gone": "a", "n": "x"}, []), ({"c": "a"}, ["y"]), ({"y": "b", "b": None}, ["nowhere"]), ({}, ["a", "gone"]),
             ({"a": "l", "gone": "gone", None: "a"}, ["x"])]
    for given, deleted in steps:
        tables.update(d(given.items()), urls(deleted))
        links.update({u: v for u, v in given.items() if u is not None})
        links = {u: v for u, v in links.items() if u not in deleted}
        check(spark, tables, links)
    assert tables.versions() == list(range(1, 7))


def test_few_rows_are_touched(spark, tmp_path):
    rng = random.Random(1)
    tables = WalkTables(spark, str(tmp_path / "walks"))
    links = {f"p{c}-{i}": f"p{c}-{i + 1}" if i < 19 else None for c in range(20) for i in range(20)}
    full = tables.update(spark.createDataFrame(list(links.items()), LINK))
    assert full == [400] * len(full) and len(full) == 10
    change = {"p3-5": "p4-0", "new": "p7-18"}
    touched = tables.update(spark.createDataFrame(list(change.items()), LINK))
    links.update(change)
    # the changed page, the pages of its chain before it, and the new one
    assert touched[0] == 2 and max(touched) == 7 and sum(touched) < sum(full) / 50
    check(spark, tables, dict(rng.sample(sorted(links.items(), key=str), len(links))))


def test_a_version_that_was_not_finished_does_not_count(spark, tmp_path):
    tables = WalkTables(spark, str(tmp_path / "walks"))
    tables.update(spark.createDataFrame([("a", "b"), ("b", None)], LINK))
    spark.createDataFrame([(0, None, 0, True)], "u long, j long, m long, gone boolean").write.parquet(f"{tables.path}/level=0/version=2")
    check(spark, tables, {"a": "b", "b": None})
    tables.update(spark.createDataFrame([("b", "a")], LINK))
    check(spark, tables, {"a": "b", "b": "a"})


def test_walks_are_lists_of_pieces(spark, tmp_path):
    tables = WalkTables(spark, str(tmp_path / "walks"))
    tables.update(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "b")], LINK))
    plan = tables.walks(spark.createDataFrame([(1, "x")], "seed_id int, url string"))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[:plan.index("Generate")]


def test_levels_end_where_nothing_is_new(spark, tmp_path):
    tables = WalkTables(spark, str(tmp_path / "walks"))
    d = lambda rows: spark.createDataFrame(list(rows), LINK)
    kept = lambda: len(list((tmp_path / "walks").glob("level=*")))
    # chains of 3 pages, rings of 3, and a tail of 6 into one of them: jumps of 8 see every walk whole
    links = {f"c{c}-{i}": f"c{c}-{i + 1}" if i < 2 else None for c in range(20) for i in range(3)}
    links.update({f"r{c}-{i}": f"r{c}-{(i + 1) % 3}" for c in range(20) for i in range(3)})
    links.update({f"t{i}": f"t{i + 1}" if i < 5 else "r0-0" for i in range(6)})
    assert tables.update(d(links.items())) == [126] * 8
    assert kept() <= 6
    # walks get longer than all former ones: levels are added; a level of a version that was not finished is none
    spark.createDataFrame([(0, None, 0, False)], "u long, j long, m long, gone boolean").write.parquet(f"{tables.path}/level=40/version=2")
    change = {f"c{c}-2": f"c{c + 1}-0" for c in range(12)}
    tables.update(d([*change.items(), ("r1-2", "t0")]))
    links.update({**change, "r1-2": "t0"})
    check(spark, tables, links)
    # and shorter: later changes reach back over the added levels too
    touched = tables.update(d([("c8-0", None), ("new", "c0-0")]))
    links.update({"c8-0": None, "new": "c0-0"})
    assert max(touched) == 26 and tables.n_levels() == 8
    check(spark, tables, links)


def test_a_ring_behind_a_tail_of_rising_numbers(spark, tmp_path):
    tables = WalkTables(spark, str(tmp_path / "walks"))
    names = [f"p{i:02}" for i in range(40)]
    links = dict(zip(names, [*names[1:], names[-1]], strict=True))
    tables.update(spark.createDataFrame(list(links.items()), LINK).coalesce(1))
    links["p20"] = "p03"
    tables.update(spark.createDataFrame([("p20", "p03")], LINK))
    check(spark, tables, links)
