"""Jump tables that are kept up to date (TRV-1, TRV-5).

A snapshot changes by a few pages at a time.  The page 2^k steps ahead of a page
changes only if one of the first 2^k pages of its walk did; those pages are found
by going back along the tables: they are the changed pages, and, level by level, the
pages whose jump leads to one found so far.  Only their rows are computed and
written again; a full rebuild computes every row of every level.

Levels are kept up to the one from which on nothing is new: every walk has ended or goes round a
cycle that lies wholly within the jump.  Levels above it are that level, doubled: ``level`` computes them when
they are asked for, and an update that makes walks longer adds those it needs.

Layout: ``links/``, ``nodes/`` and ``level=<k>/``, each with folders ``version=<n>`` that hold
the rows which that version changed; of a page's rows the newest counts.  A version
counts once ``versions/version=<n>/_SUCCESS`` is there, written last.  One writer at a time.

Defined results: a page that is given twice in one update takes its least next link; a page
that is both given and deleted is deleted; deleting an unknown page does nothing; null URLs are left
out; a link to a page that is not there counts as none until that page comes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.operators.crawl import JumpTables, Pieces, hash_joins, walk_lengths
from cardforge.session import materialize
from cardforge.sinks.published import path_names

LINKS = "url string, next_url string, gone boolean"
NODES = "url string, u long"
LEVEL = "u long, j long, m long, gone boolean"
#: since: the version that wrote each kept level first; levels: those that jumps over all pages ask for
VERSION = "version long, since array<long>, levels long, pages long"
#: a row of the level above, from a row of this one and the row that its jump leads to
_AHEAD = ("u", "jj as j", "least(m, mm) as m", "false as gone", "mm < m as moved")


def _doubled(now: DataFrame) -> DataFrame:
    """The level above ``now(u, j, m)``; ``moved``: a lesser page came into the way.  Walks that have
    ended meet no join."""
    far = now.select(F.col("u").alias("j"), F.col("j").alias("jj"), F.col("m").alias("mm"))
    ended = now.where("j is null").select("u", "j", "m", F.lit(False).alias("gone"), F.lit(False).alias("moved"))
    return now.where("j is not null").join(far, "j").selectExpr(*_AHEAD).union(ended)


def _reached(before: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of the level above that change, given the rows of this level that did and its former rows:
    pages whose jump leads to a changed row, and those that changed already."""
    live = rows.where("not gone")
    far = live.select(F.col("u").alias("j"), F.col("j").alias("jj"), F.col("m").alias("mm"))
    # an outer join: an anti join would be pushed below the other, and move all rows of the level once more
    back = before.where("j is not null").join(far, "j").join(rows.select("u", F.lit(True).alias("known")), "u", "left").where("known is null")
    on = live.where("j is not null")
    apart = on.join(far.select("j"), "j", "left_anti").join(
        before.select(F.col("u").alias("j"), F.col("j").alias("jj"), F.col("m").alias("mm")), "j")
    ended = rows.where("gone or j is null").select("u", "j", "m", "gone", F.lit(False).alias("moved"))
    return back.selectExpr(*_AHEAD).union(on.join(far, "j").selectExpr(*_AHEAD)).union(apart.selectExpr(*_AHEAD)).union(ended)


class WalkTables:
    """The maintained tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ storage

    def versions(self) -> list[int]:
        found = path_names(self.spark, f"{self.path}/versions/version=*/_SUCCESS")
        return sorted(int(re.search(r"/version=(\d+)/", p).group(1)) for p in found)

    def _write(self, rows: DataFrame, name: str, version: int) -> DataFrame:
        where = f"{self.path}/{name}/version={version}"
        rows.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(rows.schema).parquet(where)

    def _newest(self, name: str, key: str, schema: str, known: list[int] | None = None) -> DataFrame:
        """The newest row of each ``key``, without those that are gone."""
        known = [f"{self.path}/{name}/version={v}" for v in (self.versions() if known is None else known)]
        known = [p for p in known if path_names(self.spark, p)]
        if not known:
            return self.spark.createDataFrame([], schema).drop("gone")
        rows = self.spark.read.schema(schema).parquet(known[0])
        if len(known) > 1:
            # the first version holds most rows: those that came later are taken out of it, and it is not sorted
            later = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*known[1:])
            others = [c for c in rows.columns if c != key]
            if len(known) > 2:
                later = later.groupBy(key).agg(F.max_by(F.struct(*others), "version").alias("r")).select(key, "r.*")
            # dealt by the key, as the join deals the first: then a join of both by the key moves no row again
            later = later.select(*rows.columns).repartition(key)
            rows = rows.join(later.select(key), key, "left_anti").select(*rows.columns).union(later)
        return rows.where("not gone").drop("gone") if "gone" in rows.columns else rows

    def _nodes(self, known: list[int]) -> DataFrame:
        """``(url, u)`` of all pages that ever were: a page gets its number once."""
        known = [p for v in known if path_names(self.spark, p := f"{self.path}/nodes/version={v}")]
        return self.spark.read.schema(NODES).parquet(*known) if known else self.spark.createDataFrame([], NODES)

    def _state(self) -> tuple[list[int], int, int]:
        """``since``, ``levels`` and ``pages`` of the newest version."""
        known = self.versions()
        if not known:
            return [], 0, 0
        row = self.spark.read.schema(VERSION).parquet(f"{self.path}/versions/version={known[-1]}").first()
        if row["since"] is None:  # tables of a time when every level was kept
            n = len({p.split("/level=")[1] for p in path_names(self.spark, f"{self.path}/level=*")})
            return [1] * n, n, self._newest("links", "url", LINKS).count()
        return list(row["since"]), row["levels"], row["pages"]

    def _kept(self, k: int, known: list[int], since: list[int]) -> DataFrame:
        return self._newest(f"level={k}", "u", LEVEL, [v for v in known if v >= since[k]])

    def level(self, k: int) -> DataFrame:
        """``(u, j, m)``: the page 2^k steps ahead (null: the walk ends before) and the least page on the way."""
        since = self._state()[0]
        now = self._kept(min(k, len(since) - 1), self.versions(), since)
        for _ in range(k - len(since) + 1):
            now = materialize(_doubled(now).select("u", "j", "m"), "jump")
        return now

    def n_levels(self) -> int:
        """Levels until a jump is as long as there are pages."""
        return self._state()[1]

    # ------------------------------------------------------------ changes

    def update(self, given: DataFrame, deleted: DataFrame | None = None) -> list[int]:
        """Applies pages ``given(url, next_url)``, new or linked anew, and ``deleted(url)``;
        returns how many rows of each level changed."""
        with hash_joins(self.spark):
            return self._update(given, deleted)

    def _changed(self, given: DataFrame, deleted: DataFrame | None, known: list[int], version: int) -> tuple[DataFrame, int]:
        """Writes links and numbers; returns ``(u, j, m, gone)``, the first level's rows that change, and
        by how many pages there are more.  What is small is written first, so that joins with the kept tables move that only."""
        links, nodes = self._newest("links", "url", LINKS, known), self._nodes(known)
        given = given.where("url is not null").groupBy("url").agg(F.min("next_url").alias("next_url"))
        delta = given.withColumn("gone", F.lit(False))
        if deleted is not None:
            deleted = deleted.where("url is not null").select("url").distinct()
            delta = delta.join(deleted, "url", "left_anti").union(
                links.select("url").join(deleted, "url", "left_semi").select("url", F.lit(None).cast("string"), F.lit(True)))
        delta = self._write(delta, "links", version)

        # numbers go on after the largest; a page that comes back gets its old one
        number = F.monotonically_increasing_id()
        if known:
            top = nodes.agg(F.coalesce(F.max("u"), F.lit(-1))).first()[0]
            had = materialize(nodes.join(delta.select("url"), "url"), "nodes")
            delta = delta.join(had, "url", "left").select("url", "next_url", "gone", F.coalesce("u", number + top + 1).alias("u"), F.col("u").isNull().alias("fresh"))
        else:
            delta = delta.select("url", "next_url", "gone", number.alias("u"), F.lit(True).alias("fresh"))
        delta = materialize(delta, "nodes")
        fresh = self._write(delta.where("fresh").select("url", "u"), "nodes", version)

        # changed pages: those of the update, and those that link to a page that came or went
        changed, live = delta.select("u", "next_url", "gone"), delta.where("not gone").select("url", "u")
        if known:
            held = materialize(links.select("url").join(delta.select("url"), "url", "left_semi"), "links")
            came = live.select("url").join(held, "url", "left_anti")
            moved = materialize(came.select("url", F.lit(1).alias("n")).union(delta.where("gone").select("url", F.lit(-1))), "links")
            more = moved.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            relinked = materialize(links.join(moved.select(F.col("url").alias("next_url")), "next_url", "left_semi").select("url", "next_url")
                                   .join(delta.select("url"), "url", "left_anti"), "links")
            changed = materialize(changed.union(nodes.join(relinked, "url").select("u", "next_url", F.lit(False))), "links")
            # the pages that changed pages link to, where they are there
            wanted = materialize(changed.select(F.col("next_url").alias("url")).where("url is not null").distinct(), "links")
            kept = links.select("url").join(wanted, "url", "left_semi").join(delta.select("url"), "url", "left_anti")
            live = live.join(wanted, "url", "left_semi").union(nodes.join(materialize(kept, "links"), "url").select("url", "u"))
        else:
            more = fresh.count()
        to = live.select(F.col("url").alias("next_url"), F.col("u").alias("j"))
        none = changed.where("next_url is null").select("u", F.lit(None).cast("long").alias("j"), F.col("u").alias("m"), "gone")
        linked = changed.where("next_url is not null").join(to, "next_url", "left").select("u", "j", F.col("u").alias("m"), "gone")
        return linked.union(none), more

    def _update(self, given: DataFrame, deleted: DataFrame | None) -> list[int]:
        spark, known = self.spark, self.versions()
        version = (known or [0])[-1] + 1
        since, levels, pages = self._state()
        rows, more = self._changed(given, deleted, known, version)
        rows, pages = rows.withColumn("moved", F.lit(False)), pages + more
        k, kept, touched, going, image = 0, len(since), [], None, None
        while True:
            before = self._kept(k, known, since) if k < kept else None
            if before is None:  # a level that was not there: every page's row is written
                since = [*since, version]
            rows, last = self._write(rows, f"level={k}", version), going
            n, going, moved = rows.agg(F.count(F.lit(1)), F.count("j"), F.count_if("moved")).first()
            touched.append(n)
            if k + 1 >= kept:
                now = rows.select("u", "j", "m") if before is None else self._kept(k, [*known, version], since)
                if (1 << k) >= max(pages, 1):
                    break
                # no change reaches further back, no walk ended in this level, no way got a lesser page: the last level
                # if its jumps lead to as many pages as those of the level before (they permute them: the cycles)
                if k and n == touched[-2] and going == last and not moved:
                    image = self._image(k - 1, known, version, since) if image is None else image
                    former, image = image, self._image(k, known, version, since)
                    if image == former:
                        break
                else:
                    image = None
                rows = _doubled(now if before is None else materialize(now, "jump"))
            else:
                rows = _reached(before, rows)
            k += 1
        while (1 << max(levels - 1, 0)) < pages or levels < len(since):
            levels += 1
        # written last: this makes the version count
        spark.createDataFrame([(version, since, levels, pages)], VERSION).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")
        return touched + touched[-1:] * (levels - len(touched))

    def _image(self, k: int, known: list[int], version: int, since: list[int]) -> int:
        """How many pages jumps of level ``k`` lead to, with the rows of a version that is being written."""
        return self._kept(k, [*known, version], since).where("j is not null").select("j").distinct().count()

    # ------------------------------------------------------------ use

    def walks(self, seeds: DataFrame) -> DataFrame:
        """TRV-1 from the kept tables: the rows of ``follow_chain`` for ``seeds(seed_id, url)``."""
        with hash_joins(self.spark):
            known, since = self.versions(), self._state()[0]
            if not since:
                return seeds.select("seed_id", F.lit(0).cast("long").alias("depth"), "url").limit(0)
            jumps = JumpTables.__new__(JumpTables)
            # levels are read where they are; the last is read again and again
            jumps.levels = [self._kept(k, known, since).where("j is not null") for k in range(len(since))]
            jumps.levels[-1] = materialize(jumps.levels[-1], "jump")
            first = self._kept(0, known, since).select("u", F.col("j").alias("v"))
            pages = materialize(self._nodes(known).join(first, "u").select("u", "url", "v"), "pages")
            jumps.nodes = None
            pieces = Pieces(pages)
            lengths = walk_lengths(pages.where("v is not null").select("u", "v"), jumps, pieces.rows.select(F.col("h").alias("u")))
            return pieces.walks(seeds, lengths.withColumnRenamed("u", "h"))
