"""N-gram Jaccard join by token-combination prefixes (operator 1).

Two documents link when their sets of word shingles have a Jaccard similarity
of at least ``percent`` / 100.  Then at most ``misses(n)`` of a set's n shingles
("tokens") are not in the other, so with one global order of all tokens two
linked sets share a token within their first misses + 1.  Three ideas keep that
index small:

* Order.  Tokens of a hash slice (twice the prefix share of all) come first,
  the rarest first.  Tokens of one set only fill prefixes without being indexed,
  so most sets index nothing.  Sets whose slice has too few rare tokens to fill
  a prefix (large groups of near copies, texts made of shared passages) count
  their other tokens too; frequent tokens come last.
* Combinations.  A rare token is indexed alone.  Of frequent tokens the prefix
  is extended, and combinations of 2 (or 3, for very frequent ones) are indexed.
  With tokens dealt into subclasses by hash, a prefix that has r rare and n_s
  tokens in subclass s is long enough once r + sum max(0, n_s - (k - 1)) > misses;
  the number of subclasses follows the size of the set (in powers of two, and
  sets near such a bound index under both).
* Groups.  Equal sets are one class.  The members of an index entry are first
  verified against its least member.  Only entries whose members are then in
  different components have their remaining pairs verified, so groups of near
  copies never give all their pairs.

Verification counts common tokens exactly, first on the slice (which already
disproves most), then on the whole sets.  Bounded Bloom filters keep texts and
tokens that cannot matter out of the shuffles.

Defined results: a null or empty text has no shingles and is linked with
nothing; a text of fewer words than a shingle has its whole sequence as its
only one; rows with a null id keep their row (component null) and are linked
with nothing; repeated rows fall into one class; an empty table gives an empty
result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.llm import bloom
from cardforge.llm.common import chunks, connected_components, materialize, mix64, text_batches, unite
from cardforge.llm.shingles import set_digests, shingle_sets

#: a token in at most so many classes is rare
RARE = 32
#: a token in more classes than this is indexed in threes, else in twos
VERY_FREQUENT = 10_000
#: a slot of a group holds about so many tokens, and so many sets, at most
TILE_TOKENS = 500_000
TILE_SETS = 1500
TILE_COLUMNS = 4096
#: text that is shingled at a time
CHUNK_BYTES = 2 << 20


class Rule:
    """Shingle width and threshold, and what follows from them."""

    def __init__(self, width: int = 3, percent: int = 90):
        if not 80 <= percent < 100:
            raise ValueError("a threshold of 80 to 99 percent")  # below, prefixes of short sets could run out
        self.width, self.percent = width, percent
        #: smallest set that can link with a different one
        self.least = -(-percent // (100 - percent))

    def misses(self, n):
        return n * (100 - self.percent) // 100

    def in_slice(self, tokens: np.ndarray) -> np.ndarray:
        return tokens % np.uint64(1000) < np.uint64(min(1000, 20 * (100 - self.percent)))

    def bands(self, n: int) -> set[int]:
        return {int(n).bit_length(), int(-(-n * self.percent // 100)).bit_length()}

    def subclasses(self, band: int) -> int:
        return max(1, (1 << (band - 1)) * (100 - self.percent) // 100)


def _long(tokens: np.ndarray) -> pa.Array:
    return pa.array(tokens.view(np.int64))


def _lists(tokens: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _long(tokens))


def _select(sets: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sets[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]


def _shingled(docs: DataFrame, rule: Rule, part: str, ids: bloom.Bloom | None = None) -> DataFrame:
    """``(doc_id, n, h1, h2, tokens)`` of ``docs(doc_id, text)``, or of those whose
    id may be in ``ids``: the tokens of the slice, of the rest, or all."""

    def run(batches):
        for batch in batches:
            if ids is not None:
                batch = batch.filter(pa.array(ids.hits(np.asarray(batch.column(0), dtype=np.int64))))
            for lo, hi in chunks(batch.column(1), CHUNK_BYTES):
                sets, bounds = shingle_sets(batch.column(1).slice(lo, hi - lo), rule.width)
                h1, h2 = set_digests(sets, bounds)
                n = np.diff(bounds)
                if part != "all":
                    sets, bounds = _select(sets, bounds, rule.in_slice(sets) == (part == "slice"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(h1), pa.array(h2),
                                                  _lists(sets, bounds)], ["doc_id", "n", "h1", "h2", "tokens"])

    return docs.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, tokens array<long>")


def _token_counts(sets: DataFrame, label: str) -> tuple[DataFrame, bloom.Bloom]:
    """``(token, df)`` of tokens in two classes or more, and their filter."""
    counts = (sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
              .where("df > 1"))
    counts = materialize(counts, label)
    return counts, bloom.build(counts.select("token"), counts.count())


def _shared(sets: DataFrame, counts: DataFrame, keys: bloom.Bloom) -> DataFrame:
    """``(cid, shared)``: each class's tokens with df > 1, and their df."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            tokens = np.asarray(lists.flatten(), dtype=np.int64)
            cid = np.repeat(np.asarray(batch.column(0)), np.diff(np.asarray(lists.offsets)))
            keep = keys.hits(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(cid[keep]), pa.array(tokens[keep])], ["cid", "token"])

    rows = sets.select("cid", "tokens").mapInArrow(run, "cid long, token long").join(counts, "token")
    return rows.groupBy("cid").agg(F.collect_list(F.struct("token", "df")).alias("shared"))


def _split(tokens: np.ndarray, shared: np.ndarray, df: np.ndarray):
    """Tokens of one class: how many are its own, the rare ones that it shares
    (rarest first), the frequent ones and their df."""
    order = np.lexsort((shared, df))
    shared, df = shared[order], df[order]
    rare = df <= RARE
    return len(tokens) - len(shared), shared[rare], shared[~rare], df[~rare]


def _light(rule: Rule, sets: DataFrame, shared: DataFrame) -> DataFrame:
    """``(cid, n, heavy, sigs)`` of the classes whose own tokens of the slice do
    not fill the prefix: the rare tokens that do, or ``heavy`` if they cannot."""
    need = F.floor(F.col("n") * (100 - rule.percent) / 100) + 1
    rows = (sets.select("cid", "n", F.size("tokens").alias("size")).join(shared, "cid", "left")
            .withColumn("missing", need - F.col("size") + F.when(F.col("shared").isNull(), 0).otherwise(F.size("shared"))).where("missing > 0"))
    rare = F.sort_array(F.transform(F.filter(F.coalesce("shared", F.array().cast("array<struct<token:bigint,df:bigint>>")),
                                             lambda x: x["df"] <= RARE), lambda x: F.struct(x["df"], x["token"])))
    rows = rows.select("cid", "n", "missing", rare.alias("rare"))
    heavy = F.size("rare") < F.col("missing")
    return rows.select("cid", "n", heavy.alias("heavy"),
                       F.when(~heavy, F.slice("rare", F.lit(1), F.greatest(F.col("missing"), F.lit(1)).cast("int"))["token"]).alias("sigs"))


def signatures(rule: Rule, n: int, own: int, first: np.ndarray, second: np.ndarray, frequent: np.ndarray,
               df: np.ndarray) -> np.ndarray:
    """Signatures of a class that needs more than its slice: ``own`` tokens that
    nobody shares, shared rare tokens of the slice (``first``) and of the rest
    (``second``, rarest first), and frequent tokens with their df."""
    need = rule.misses(n) + 1
    short = need - own - len(first)
    singles = np.concatenate([first, second[:max(0, short)]])
    short -= len(second)
    out = [singles]
    if short > 0:
        h = mix64(frequent.view(np.uint64))
        order = np.argsort(h)
        h, tokens, k = h[order], frequent[order], np.where(df[order] > VERY_FREQUENT, 3, 2)
        for band in rule.bands(n):
            m = rule.subclasses(band)
            groups: dict[tuple[int, int], list[int]] = {}
            missing = short
            for x, t, size in zip(h.tolist(), tokens.tolist(), k.tolist()):
                members = groups.setdefault((size, (x >> 20) % m), [])
                members.append(t)
                missing -= len(members) >= size
                if not missing:
                    break
            for size in (2, 3):
                combos = [c for (s, _), members in groups.items() if s == size for c in combinations(members, size)]
                if combos:
                    c = np.array(combos, dtype=np.int64).view(np.uint64).reshape(-1, size)
                    sig = mix64(np.full(len(c), band * 4 + size, dtype=np.uint64))
                    for i in range(size):
                        sig = mix64(sig * np.uint64(0x9E3779B97F4A7C15) ^ c[:, i])
                    out.append(sig.view(np.int64))
    return np.concatenate(out)


def _heavy(rule: Rule):
    def run(batches):
        for batch in batches:
            sig, cid, size = [], [], []
            for c, n, t0, s0, t1, s1 in zip(*(batch.column(i).to_pylist() for i in range(6))):
                p0 = np.array([(x["token"], x["df"]) for x in s0 or ()], dtype=np.int64).reshape(-1, 2)
                p1 = np.array([(x["token"], x["df"]) for x in s1 or ()], dtype=np.int64).reshape(-1, 2)
                own0, first, f0, d0 = _split(np.array(t0, dtype=np.int64), p0[:, 0], p0[:, 1])
                own1, second, f1, d1 = _split(np.array(t1 or (), dtype=np.int64), p1[:, 0], p1[:, 1])
                got = signatures(rule, n, own0 + own1, first, second, np.concatenate([f0, f1]), np.concatenate([d0, d1]))
                sig.append(got)
                cid += [c] * len(got)
                size += [n] * len(got)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sig, np.zeros(0, dtype=np.int64)])),
                                              pa.array(cid, type=pa.int64()), pa.array(size, type=pa.int64())],
                                             ["sig", "cid", "n"])

    return run


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(a, na, b, nb)`` with ``la``, ``lb`` (sizes of the given sets) and
    ``common``.  The least members ``b`` recur, so they are joined last, where a
    skewed side is split."""
    a = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tb"))
    return (pairs.join(a, "a").join(b, "b")
            .select("a", "na", "b", "nb", F.size("ta").alias("la"), F.size("tb").alias("lb"),
                    F.size(F.array_intersect("ta", "tb")).alias("common")))


class _Verifier:
    def __init__(self, rule: Rule, docs: DataFrame, classes: DataFrame, slices: DataFrame):
        self.rule, self.docs, self.classes, self.slices = rule, docs, classes, slices

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that reach the threshold."""
        r = self.rule
        most = (F.col("na") * (100 - r.percent) / 100, F.col("nb") * (100 - r.percent) / 100)
        # tokens of the slice that the other lacks are lacking in the whole set too
        near = _overlaps(pairs, self.slices).where((F.col("la") - F.col("common") <= most[0])
                                                   & (F.col("lb") - F.col("common") <= most[1]))
        near = materialize(near.select("a", "na", "b", "nb"), "near")
        ids = near.select(F.col("a").alias("cid")).union(near.select("b")).distinct()
        wanted = materialize(self.classes.join(ids, "cid", "left_semi").select("cid", "first", "h1", "h2"), "wanted")
        sets = materialize(fetch(self.docs, wanted, r, "all"), "sets")
        done = _overlaps(near, sets).where(100 * F.col("common") >= r.percent * (F.col("na") + F.col("nb") - F.col("common")))
        return materialize(done.select("a", "b"), "links")


def fetch(docs: DataFrame, wanted: DataFrame, rule: Rule, part: str) -> DataFrame:
    """``(cid, tokens)`` of the classes ``wanted(cid, first, h1, h2)``, from the
    texts of their first documents."""
    keys = bloom.build(wanted.select("first"), wanted.count())
    rows = _shingled(docs, rule, part, keys)
    w = wanted.withColumnRenamed("first", "doc_id")
    return rows.join(w, ["doc_id", "h1", "h2"]).groupBy("cid").agg(F.first("tokens").alias("tokens"))


def jaccard_components(documents: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row a document."""
    rule = Rule(width, percent)
    text_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(_shingled(docs, rule, "slice").withColumn("rid", F.monotonically_increasing_id()), "slices")
    docs = docs.where("doc_id is not null")
    # classes of equal sets; a class is named by the row of its least document
    some = rows.where("n > 0 and doc_id is not null").select("doc_id", "n", "h1", "h2", "rid")
    classes = (some.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "rid")).alias("m"), F.count(F.lit(1)).alias("size"))
               .select("h1", "h2", "n", F.col("m.doc_id").alias("first"), F.col("m.rid").alias("cid"), "size"))
    classes = materialize(classes, "classes")
    # rows of classes of one document are their class; of the others the first row is looked up
    twice = classes.where("size > 1").select("h1", "h2", "cid")
    keys = bloom.build(twice.select("h1"), twice.count())
    big = rows.where(f"n >= {rule.least} and doc_id is not null").select("h1", F.col("rid").alias("cid"), "n", "tokens")
    sets = (bloom.maybe_in(big, "h1", keys, negate=True)
            .union(bloom.maybe_in(big, "h1", keys).join(classes.select("cid"), "cid", "left_semi").select(big.columns))
            .select("cid", "n", "tokens"))
    sets = materialize(sets, "sets")
    links = _find_links(rule, docs, classes, sets)
    if links is None:
        found = classes.select("h1", "h2", "first")
    else:
        comp = connected_components(links).withColumnRenamed("node", "cid")
        found = classes.join(comp, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        least = found.groupBy("component").agg(F.min("first").alias("least"))
        found = found.join(least, "component").select("h1", "h2", F.col("least").alias("first"))
    # each document's class by its digests; hot classes are split as a skewed join
    result = rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("h1")).alias("h1"), "h2").join(found, ["h1", "h2"], "left")
    kind = documents.schema[id_col].dataType
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id"))
    return result.select(F.col("doc_id").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"),
                         component.cast(kind).alias("component_id"))


def _find_links(rule: Rule, docs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame | None:
    counts, keys = _token_counts(sets, "tokens")
    shared = _shared(sets, counts, keys)
    light = materialize(_light(rule, sets, shared), "light")
    heavy = light.where("heavy").select("cid", "n")
    entries = light.where("not heavy").select(F.explode("sigs").alias("sig"), "cid", "n")
    if not heavy.isEmpty():
        wanted = classes.join(heavy, "cid", "left_semi").select("cid", "first", "h1", "h2")
        rest = materialize(fetch(docs, materialize(wanted, "wanted"), rule, "rest"), "rest")
        more, more_keys = _token_counts(rest, "tokens")
        rest = rest.join(_shared(rest, more, more_keys).withColumnRenamed("shared", "s1"), "cid", "left")
        ids = bloom.build(heavy.select("cid"), heavy.count())
        own = bloom.maybe_in(sets, "cid", ids).join(heavy.select("cid"), "cid", "left_semi")
        own = own.join(_shared(own, counts, keys).withColumnRenamed("shared", "s0"), "cid", "left")
        both = own.select("cid", "n", F.col("tokens").alias("t0"), "s0").join(
            rest.select("cid", F.col("tokens").alias("t1"), "s1"), "cid", "left")
        entries = entries.union(both.select("cid", "n", "t0", "s0", "t1", "s1").mapInArrow(_heavy(rule), "sig long, cid long, n long"))
    entries = materialize(entries, "entries")
    groups = entries.groupBy("sig").agg(F.min(F.struct("cid", "n")).alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = materialize(groups, "groups")
    near = (F.col("na") * 100 >= F.col("nb") * rule.percent) & (F.col("nb") * 100 >= F.col("na") * rule.percent)
    members = entries.join(groups, "sig").select("sig", F.col("cid").alias("a"), F.col("n").alias("na"),
                                                 F.col("least.cid").alias("b"), F.col("least.n").alias("nb"))
    pairs = materialize(members.where((F.col("a") != F.col("b")) & near).select("a", "na", "b", "nb").distinct(), "pairs")
    verifier = _Verifier(rule, docs, classes, sets)
    links = verifier.links(pairs)
    # entries whose members are still in different components: their other pairs
    comp = connected_components(links).select(F.col("node").alias("a"), F.col("component").alias("c"))
    inside = members.join(comp, "a", "left").withColumn("c", F.coalesce("c", "a"))
    open_ = (inside.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size"))
             .where("lo <> hi").select("sig", "size"))
    inside = materialize(inside.join(open_, "sig"), "open")
    # entries of rare tokens have at most RARE members: their pairs, but those with the least member
    small = inside.where((F.col("size") <= RARE) & (F.col("a") != F.col("b"))).select("sig", "a", "na", "c")
    x, y = small.alias("x"), small.alias("y")
    other = (x.join(y, F.col("x.sig") == F.col("y.sig"))
             .where((F.col("x.a") > F.col("y.a")) & (F.col("x.c") != F.col("y.c")))
             .select(F.col("x.a").alias("a"), F.col("x.na").alias("na"), F.col("y.a").alias("b"), F.col("y.na").alias("nb"))
             .where(near).distinct())
    other = materialize(other.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    found = [links]
    if not other.isEmpty():
        found.append(verifier.links(other))
    large = inside.where(F.col("size") > RARE)
    if not large.isEmpty():
        found.append(_within_groups(rule, docs, classes, large.select("a", "na", "b"), comp))
    for more in found[1:]:
        links = links.union(more)
    return None if links.isEmpty() else links


def _within_groups(rule: Rule, docs: DataFrame, classes: DataFrame, members: DataFrame, comp: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join the components of classes which share large
    entries: ``members(a, na, b)``, ``b`` standing for the entry.

    Classes that meet in such entries form groups, each class goes to one group
    with its set, and a group is cut into slots whose pairs are compared tile by
    tile inside tasks.  A tile returns a spanning forest: no pairs leave it."""
    edges = members.where("a <> b").select("a", "b").distinct()
    group = connected_components(edges).select(F.col("node").alias("cid"), F.col("component").alias("g"))
    sizes = members.groupBy("a").agg(F.first("na").alias("n")).withColumnRenamed("a", "cid")
    rows = materialize(sizes.join(group, "cid"), "groups")
    slots = rows.groupBy("g").agg(F.ceil(F.greatest(F.sum("n") / TILE_TOKENS, F.count(F.lit(1)) / TILE_SETS)).cast("int").alias("slots"))
    wanted = materialize(classes.join(rows, "cid", "left_semi").select("cid", "first", "h1", "h2"), "wanted")
    sets = fetch(docs, wanted, rule, "all")
    placed = (rows.join(slots, "g").withColumn("slot", F.pmod(F.xxhash64("cid"), "slots").cast("int"))
              .join(comp.select(F.col("a").alias("cid"), "c"), "cid", "left").withColumn("c", F.coalesce("c", "cid"))
              .join(sets, "cid"))
    at = F.transform(F.sequence(F.lit(0), F.col("slots") - 1),
                     lambda o: F.struct(F.least(o, "slot").alias("s"), F.greatest(o, "slot").alias("t")))
    tiles = placed.select("g", "slot", "cid", "c", "tokens", F.explode(at).alias("at"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        slot = np.asarray(table.column("slot"))
        cid = np.asarray(table.column("cid"))
        lists = table.column("tokens").combine_chunks()
        n = np.diff(np.asarray(lists.offsets)).astype(np.float32)
        flat = np.asarray(lists.flatten())
        row = np.repeat(np.arange(len(cid)), n.astype(np.int64))
        left, right = (np.flatnonzero(slot == table.column("at").combine_chunks().field(x)[0].as_py()) for x in ("s", "t"))
        common = np.zeros((len(left), len(right)), dtype=np.float32)
        _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
        column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[code]
        place = [np.full(len(cid), -1) for _ in range(2)]
        place[0][left], place[1][right] = np.arange(len(left)), np.arange(len(right))
        order = np.argsort(column, kind="stable")
        order = order[np.searchsorted(column[order], 0):]
        cuts = np.searchsorted(column[order], np.arange(0, int((times > 1).sum()) + TILE_COLUMNS, TILE_COLUMNS))
        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            r, c = row[order[lo:hi]], column[order[lo:hi]] - k * TILE_COLUMNS
            sides = []
            for where, size in ((place[0], len(left)), (place[1], len(right))):
                m = np.zeros((size, TILE_COLUMNS), dtype=np.float32)
                mine = where[r] >= 0
                m[where[r[mine]], c[mine]] = 1
                sides.append(m)
            common += sides[0] @ sides[1].T
        ok = 100 * common >= rule.percent * (n[left][:, None] + n[right][None, :] - common)
        i, j = np.nonzero(ok)
        i, j = left[i], right[j]
        _, label = np.unique(np.asarray(table.column("c")), return_inverse=True)
        first = np.full(label.max() + 1, -1)
        first[label[::-1]] = np.arange(len(label))[::-1]
        root = unite(first[label], i, j)
        hit = np.flatnonzero(root != first[label])
        return pa.table({"a": cid[hit], "b": cid[root[hit]]})

    return materialize(tiles.withColumn("s", F.col("at.s")).withColumn("t", F.col("at.t")).groupBy("g", "s", "t")
                       .applyInArrow(compare, "a long, b long"), "links")


def keep_one(documents: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` without near duplicates: of each component the
    row of its least id stays.  Rows that share an id count as one document (one
    of them stays, if that); rows with a null id stay."""
    comp = jaccard_components(documents, width, percent, id_col, text_col)
    drop = comp.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    left = documents.join(drop, id_col, "left_anti").select(documents.columns)
    again = documents.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col)
    again = materialize(again, "again")
    if again.isEmpty():
        return left
    many = left.join(again, id_col, "left_semi").where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).select(documents.columns)
    single = left.join(again.where(F.col(id_col).isNotNull()), id_col, "left_anti").select(documents.columns)
    return single.union(many)
