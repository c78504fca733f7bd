"""Traversal over next-page links (TRV-1 .. TRV-5).

The link graph has out-degree <= 1 (a page names at most one next page), so
a walk from a seed is a path that ends at a page without a next link, at a
link to a page that is not in the snapshot (unfetchable: not emitted), or at
the first page it already visited (a cycle).

Nothing iterates once per step.  ``Pieces`` cuts the graph into runs of pages, and
``JumpTables`` holds, for each power of two, where that many runs lead (one self-join a
level, log2(longest walk) levels).  Levels are written to the cluster's checkpoint folder (``spark.checkpoint.dir``),
so lineage stays flat and a lost executor recomputes one level at most.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardforge.session import materialize

#: cut-offs of so many parts (a key and a position each) are broadcast
BROADCAST_PARTS = 100_000
#: rows of both sides that a task of ``visit_single`` joins
TASK_ROWS = 1_000_000
#: one page in so many begins a piece of the link graph
PIECE = 32


def resolve_links(links: DataFrame) -> DataFrame:
    """``(url, nxt)``: one row per fetchable page; ``nxt`` is null when the
    page has no next link or links to a page outside the snapshot."""
    pages = links.select("url").distinct()
    # one next link per page (a snapshot has one row per page; min keeps
    # duplicates deterministic)
    first = links.groupBy("url").agg(F.min("next_url").alias("next_url"))
    target = pages.select(F.col("url").alias("next_url"), F.lit(True).alias("_ok"))
    return (first.join(target, "next_url", "left")
            .select("url", F.when(F.col("_ok"), F.col("next_url")).alias("nxt")))


class JumpTables:
    """Level k: ``(u, j, w)``, the node 2^k steps ahead and the weight of the nodes left
    behind, for nodes whose walk is that long.  Rows of walks that end earlier leave the
    tables, so no join meets their null keys."""

    def __init__(self, edges: DataFrame, nodes: DataFrame, n_nodes: int):
        # m: smallest node number among the 2^k nodes from here on (names a cycle)
        now = materialize(edges.select("u", F.col("v").alias("j"), F.col("u").alias("m"), "w"), "jump")
        self.levels, self.nodes = [now], nodes
        ends = materialize(nodes.select("u", F.col("u").alias("m")).join(edges.select("u"), "u", "left_anti"), "jump")
        image = now.select("j").distinct().count()
        while image:
            # ``m`` of all nodes is needed at the far end of a jump, ended walks included
            none = F.lit(None).cast("long")
            far = now.select(F.col("u").alias("j"), F.col("j").alias("jj"), F.col("m").alias("mm"), F.col("w").alias("ww")) \
                .union(ends.select(F.col("u").alias("j"), none.alias("jj"), F.col("m").alias("mm"), none.alias("ww")))
            both = materialize(now.withColumnRenamed("m", "pm").join(far, "j").select(
                "u", F.col("jj").alias("j"), F.least("pm", "mm").alias("m"), "pm", (F.col("w") + F.col("ww")).alias("w")), "jump")
            nxt = both.where("j is not null")
            # Done when the image of the jump no longer shrinks (the jump permutes it: the
            # image is the cycle nodes) and no minimum on the way changed (windows of
            # cycle nodes hold their whole cycle).  After log2(n) levels at most.
            stats = nxt.agg(F.count_distinct("j").alias("img"), F.count_if(F.col("m") != F.col("pm")).alias("moved")).first()
            ends = materialize(ends.union(both.where("j is null").select("u", "m")), "jump")
            now = nxt.select("u", "j", "m", "w")
            self.levels.append(now)
            if stats["img"] == image and stats["moved"] == 0 or (1 << len(self.levels)) >= 4 * max(n_nodes, 1):
                break
            image = stats["img"]

    def cycles(self) -> DataFrame:
        """``(u, lam)``: the nodes on cycles, and their cycle's weight."""
        top = self.levels[-1]
        on = top.select(F.col("j").alias("u")).distinct().join(top.select("u", "m"), "u")
        # without nodes each weighs one
        on = on.withColumn("n", F.lit(1).cast("long")) if self.nodes is None else on.join(self.nodes, "u")
        return materialize(on.join(on.groupBy("m").agg(F.sum("n").alias("lam")), "m").select("u", "lam"), "cycles")


def page_table(links: DataFrame) -> DataFrame:
    """``(u, url, v)``: the fetchable pages with a number each, and the number of the
    page that each one's next link leads to (null: none, or none in the snapshot)."""
    # one next link per page (a snapshot has one row per page; min keeps duplicates deterministic)
    first = links.where("url is not null").groupBy("url").agg(F.min("next_url").alias("next_url"))
    first = materialize(first.withColumn("u", F.monotonically_increasing_id()), "nodes")
    # pages without a next link spread over the tasks by their number
    apart = F.when(F.col("next_url").isNull(), F.col("u")).otherwise(0).alias("apart")
    to = first.select(F.col("url").alias("next_url"), F.col("u").alias("v"), F.lit(0).cast("long").alias("apart"))
    return materialize(first.select("u", "url", "next_url", apart).join(to, ["next_url", "apart"], "left").select("u", "url", "v"), "pages")


@contextmanager
def hash_joins(spark: SparkSession):
    """Joins run inside take hash tables instead of sorts, where every shuffle partition is small
    (as Spark finds at run time)."""
    key, size = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, spark.conf.get(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _ranked(back: DataFrame) -> DataFrame:
    """``(u, h, i)`` from ``back(u, p)``: the start (``p`` null) that each page comes to by
    going back, and the steps.  Pointers double: all pages within 2^k steps of a start know
    it after k rounds.  On cycles without a start, each page that is less than the one before it
    becomes one."""
    start = F.col("p").isNull()
    rows = materialize(back.select("u", F.coalesce("p", "u").alias("h"), F.when(start, 0).otherwise(1).cast("long").alias("i"),
                                   start.alias("done")), "ranks")
    done, going = [rows.where("done")], rows.where("not done")
    while True:
        known = _union([*done, going])
        ahead = known.select(F.col("u").alias("h"), F.col("h").alias("hh"), F.col("i").alias("ii"), F.col("done").alias("dd"))
        step = materialize(going.join(ahead, "h").select(
            "u", F.col("hh").alias("h"), (F.col("i") + F.col("ii")).alias("i"), F.col("dd").alias("done")), "ranks")
        stats = step.agg(F.count(F.lit(1)).alias("n"), F.count_if("done").alias("ended")).first()
        done, going = [*done, step.where("done")], step.where("not done")
        # a run with pages that go on has some that come to its start in this round
        if stats["ended"] in (0, stats["n"]):
            break
    out = _union(done).select("u", "h", "i")
    if stats["n"] > stats["ended"]:
        # what is left are cycles without a start: there each page below the one before it is one
        left = going.select("u").join(rows, "u").select("u", F.when(F.col("u") > F.col("h"), F.col("h")).alias("p"))
        out = out.union(_ranked(left))
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


class Pieces:
    """The link graph cut into pieces: runs of pages that are reached from the page before
    them only.  One page in ``PIECE``, chosen by its hash, begins a new piece, so pieces are short
    (tens of pages; a few hundred at most) however long a walk is, and a walk is a list of
    few pieces.  A piece is on a cycle as a whole or not at all.

    ``places(url, h, i)``: a page's piece (its first page's number) and place in it;
    ``rows(h, n, urls)``: a row a piece; ``jumps``: the jump tables over pieces."""

    def __init__(self, pages: DataFrame):
        into = pages.where("v is not null").groupBy(F.col("v").alias("u")).agg(F.min("u").alias("p"), F.count(F.lit(1)).alias("n"))
        inner = (F.col("n") == 1) & (F.pmod(F.xxhash64("u"), F.lit(PIECE)) != 0)
        back = pages.select("u").join(into, "u", "left").select("u", F.when(inner, F.col("p")).alias("p"))
        at = materialize(_ranked(back).join(pages, "u").select("url", "h", "i", "v"), "places")
        self.places = at.select("url", "h", "i")
        run = at.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("i", "url", "v"))).alias("run"))
        run = materialize(run.select("h", F.size("run").cast("long").alias("n"), F.col("run.url").alias("urls"),
                                     F.element_at("run", -1)["v"].alias("nxt")), "pieces")
        self.rows = run.select("h", "n", "urls")
        nodes = run.select(F.col("h").alias("u"), "n")
        edges = run.where("nxt is not null").select(F.col("h").alias("u"), F.col("nxt").alias("v"), F.col("n").alias("w"))
        self.jumps = JumpTables(edges, nodes, nodes.count())

    def lengths(self) -> DataFrame:
        """``(h, total, lam)``: the pages that a walk from the piece's first page visits, and
        the length of the cycle that the piece is on (null: on none)."""
        jumps, cyc = self.jumps, self.jumps.cycles()
        st = self.rows.select(F.col("h").alias("u"), "n").join(cyc, "u", "left")
        sizes = self.rows.select(F.col("h").alias("cur"), F.col("n").alias("last_n"))
        st = st.withColumn("cur", F.col("u")).withColumn("steps", F.lit(0).cast("long"))
        on_cycle = cyc.select(F.col("u").alias("to"))
        for k in range(len(jumps.levels) - 1, -1, -1):
            # jumps that do not reach a cycle
            off = jumps.levels[k].select(F.col("u").alias("cur"), F.col("j").alias("to"), "w").join(on_cycle, "to", "left_anti")
            st = st.join(off, "cur", "left")
            move = F.col("lam").isNull() & F.col("to").isNotNull()
            st = (st.withColumn("steps", F.when(move, F.col("steps") + F.col("w")).otherwise(F.col("steps")))
                  .withColumn("cur", F.when(move, F.col("to")).otherwise(F.col("cur"))).drop("to", "w"))
        entry = jumps.levels[0].select(F.col("u").alias("cur"), F.col("j").alias("to")).join(
            cyc.select(F.col("u").alias("to"), F.col("lam").alias("to_lam")), "to").drop("to")
        st = st.join(sizes, "cur").join(entry, "cur", "left")
        total = F.coalesce("lam", F.col("steps") + F.col("last_n") + F.coalesce("to_lam", F.lit(0)))
        return materialize(st.select(F.col("u").alias("h"), total.alias("total"), "lam"), "lengths")

    def walks(self, seeds: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
        """``(seed_id, depth, url)`` of every seed's walk (``lengths``: if the caller has them already)."""
        lengths = self.lengths() if lengths is None else lengths
        # at: the depth of the piece's first page (below 0 if the walk begins inside)
        rows = seeds.select("seed_id", "url").join(self.places, "url").join(lengths, "h").select(
            "seed_id", (-F.col("i")).alias("at"), "h", F.coalesce("lam", F.col("total") - F.col("i")).alias("total"))
        rows = materialize(rows, "walks")
        for level in self.jumps.levels:
            ahead = level.select(F.col("u").alias("h"), F.col("j").alias("to"), "w")
            more = rows.join(ahead, "h").where(F.col("at") + F.col("w") < F.col("total")).select(
                "seed_id", (F.col("at") + F.col("w")).alias("at"), F.col("to").alias("h"), "total")
            more = materialize(more, "walks")
            if more.isEmpty():
                break
            rows = rows.union(more)
        # pages are taken out of the pieces last: no shuffle moves a row a page
        first = F.greatest(-F.col("at"), F.lit(0))
        some = F.slice("urls", (first + 1).cast("int"), (F.least("n", F.col("total") - F.col("at")) - first).cast("int"))
        out = rows.join(self.rows, "h").select("seed_id", (F.col("at") + first).alias("at"), F.posexplode(some).alias("k", "url"))
        return out.select("seed_id", (F.col("at") + F.col("k")).alias("depth"), "url")

    def first_visits(self, seeds: DataFrame) -> DataFrame:
        """``(url, seed_id, depth)``: each page that some walk visits, with its least visit."""
        own = seeds.groupBy("url").agg(F.min(F.struct("seed_id")).alias("s"))
        pages = materialize(self.places.join(own, "url", "left").select(
            "url", "h", "i", F.when(F.col("s").isNotNull(), F.struct("s.seed_id", (-F.col("i")).alias("at"))).alias("s")), "visits")
        best = pages.groupBy("h").agg(F.min("s").alias("b")).where("b is not null")

        def moved(level):
            return best.join(level.select(F.col("u").alias("h"), "j", "w"), "h").select(
                F.col("j").alias("h"), F.struct(F.col("b.seed_id").alias("seed_id"), (F.col("b.at") + F.col("w")).alias("at")).alias("b"))

        for level in self.jumps.levels:
            best = materialize(best, "visits")
            best = best.union(moved(level)).groupBy("h").agg(F.min("b").alias("b"))
        best = materialize(best, "visits")
        # walks that come to the piece's first page, and those that begin inside, before or at the page
        come = moved(self.jumps.levels[0]).groupBy("h").agg(F.min("b").alias("b"))
        inside = Window.partitionBy("h").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        v = pages.withColumn("s", F.min("s").over(inside)).join(come, "h", "left").withColumn("b", F.least("s", "b"))
        return v.where("b is not null").select("url", "b.seed_id", (F.col("b.at") + F.col("i")).alias("depth"))


def _graph(links: DataFrame) -> tuple[DataFrame, Pieces, JumpTables]:
    """Numbered pages, their pieces, and the jump tables over pieces."""
    pages = page_table(links)
    pieces = Pieces(pages)
    return pages, pieces, pieces.jumps


def follow_chain(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """TRV-1: ``(seed_id, depth, url)`` for every page each seed's walk visits.

    ``links(url, next_url)`` is the snapshot (every row is a fetchable page);
    ``seeds(seed_id, url)``.  A walk visits the seed, then follows next links
    until there is no next page, the next page is not in the snapshot, or the
    next page was already visited by this walk.  Seeds outside the snapshot
    give no rows; every seed walks on its own (shared tails repeat).

    A walk's length is its tail, found by descending the jump tables over pieces, and
    its cycle's length.  Its pieces are listed by doubling: those of the first 2^k
    joined to level k give those up to 2^(k+1).  Pages come out of the pieces at the end.
    """
    with hash_joins(links.sparkSession):
        return _graph(links)[1].walks(seeds)


def walk_lengths(edges: DataFrame, jumps: JumpTables, starts: DataFrame) -> DataFrame:
    """``(u, total, lam)`` of the pages ``starts(u)`` by jump tables over pages: the pages that
    a walk from there visits, and the length of the cycle that the page is on (null: on none)."""
    cyc = jumps.cycles()
    st = starts.select("u").join(cyc, "u", "left").withColumn("cur", F.col("u")).withColumn("steps", F.lit(0).cast("long"))
    # starts without such a jump spread over the tasks by their number
    on_cycle = cyc.select(F.col("u").alias("at"), F.col("lam").alias("to_lam"))
    at = F.coalesce("to", -1 - F.col("u")).alias("at")
    for k in range(len(jumps.levels) - 1, -1, -1):
        ahead = jumps.levels[k].select(F.col("u").alias("cur"), F.col("j").alias("to"))
        st = st.join(ahead, "cur", "left").select("u", "lam", "cur", "steps", "to", at).join(on_cycle, "at", "left")
        # jumps that do not reach a cycle
        move = F.col("lam").isNull() & F.col("to").isNotNull() & F.col("to_lam").isNull()
        st = st.select("u", "lam", F.when(move, F.col("to")).otherwise(F.col("cur")).alias("cur"),
                       F.when(move, F.col("steps") + (1 << k)).otherwise(F.col("steps")).alias("steps"))
    entry = edges.select(F.col("u").alias("cur"), F.col("v").alias("to"))
    st = st.join(entry, "cur", "left").select("u", "lam", "steps", at).join(on_cycle, "at", "left")
    total = F.coalesce("lam", F.col("steps") + 1 + F.coalesce("to_lam", F.lit(0)))
    return materialize(st.select("u", total.alias("total"), "lam"), "lengths")


def first_visits(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(url, seed_id, depth)``: each page that some walk visits, with the least
    (seed_id, depth) it is visited at.  Least visits travel along the jump
    tables over pieces, so no walk is expanded."""
    with hash_joins(links.sparkSession):
        return _graph(links)[1].first_visits(seeds)


def visit_single(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """TRV-2: the advance disabled - each seed present in the snapshot is
    visited once: ``(seed_id, depth=0, url)``.  Tasks get more in number, not in
    size, when there are more rows."""
    have = pages.select("url").where("url is not null")
    tasks = (have.count() + seeds.count()) // TASK_ROWS + 1
    if tasks > int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        have, seeds = have.repartition(tasks, "url"), seeds.repartition(tasks, "url")
    return seeds.join(have, "url", "left_semi").select("seed_id", F.lit(0).cast("long").alias("depth"), "url")


def until_first_repeat(df: DataFrame, part: str, order: str, content: str) -> DataFrame:
    """TRV-3: within each ``part``, in ``order``, keep rows up to (excluding)
    the first whose md5(content) appeared earlier in that part; everything
    after it is dropped too.

    Hashes are taken once, over a narrow table.  First occurrences and the
    cut-off per part are aggregates; the caller's rows are then filtered by a
    cut-off a part, broadcast when there are at most ``BROADCAST_PARTS``."""
    h = materialize(df.select(F.col(part).alias("p"), F.col(order).alias("o"), F.md5(F.col(content)).alias("h")), "hashes")
    first = h.groupBy("p", "h").agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rep = h.alias("a").join(first.alias("f"), F.col("a.p").eqNullSafe(F.col("f.p")) & F.col("a.h").eqNullSafe(F.col("f.h")))
    cut = rep.where("o > first").groupBy(F.col("a.p").alias("_part")).agg(F.min("o").alias("_cut"))
    cut = materialize(cut, "cuts")
    if cut.count() <= BROADCAST_PARTS:
        cut = F.broadcast(cut)
    return (df.join(cut, F.col(part).eqNullSafe(F.col("_part")), "left")
            .filter(F.col("_cut").isNull() | (F.col(order) < F.col("_cut"))).drop("_part", "_cut"))


def skip_done(seeds: DataFrame, done: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """TRV-4: drop seeds already in the output.  The done set is read once
    and checked on seeds only; AQE broadcasts it when its measured size
    allows, else sort-merge.  ``keys`` defaults to ``['url']``; rows that
    share one URL (successive states of one page) need ``['url', 'content_md5']``."""
    keys = keys or ["url"]
    return seeds.join(done.select(*keys).dropna().distinct(), keys, "left_anti")


def crawl_all(links: DataFrame, seeds: DataFrame, dedup: str | None = None) -> DataFrame:
    """TRV-5: union of every seed's walk ``(seed_id, depth, url)``, shared pages
    repeated.  ``dedup='global'`` (our addition) keeps each page once, at its
    first (seed_id, depth)."""
    if dedup == "global":
        return first_visits(links, seeds).select("seed_id", "depth", "url")
    return follow_chain(links, seeds)
