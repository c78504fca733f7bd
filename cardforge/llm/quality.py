"""Quality rules by robust multivariate outliers (operator 4), native.

Every whole text gives counts (``text_counts``) and from them a vector of
transformed statistics.  Per language and source, per language and over all, a
regularised minimum covariance determinant estimate is fitted: a start from
medians and median absolute deviations, then concentration steps that refit mean
and covariance on the nearer half of the documents (``(n + P + 1) / 2``) until no
estimate changes any more, so that just under half of a source may be junk.  Mean and
covariance are then taken again from all documents within the ``INSIDE`` quantile.

A group's estimate is shrunk towards its language's, and that towards the whole's:
its weight is ``n / (n + PRIOR)`` for the ``n`` documents inside beyond ``2 P`` (of fewer,
an estimate cannot resist any junk), so it grows smoothly with the group.  A document is rejected when its
squared Mahalanobis distance passes a chi-square quantile.

Everything is DataFrame expressions and aggregates.  Quantiles come from exact
counts of narrow bins, so they merge in any order; an estimate is one row of arrays
a group, and a concentration step is one pass over narrow rows and one write, with a
plan whose size does not depend on the step.

Defined results: a null text counts as empty (no words: base rule fails); null
lang or source is a group of its own; repeated rows are rated alike; columns
of the input never clash, as all results sit in one struct; a few documents lie
about as far from their own mean as they can and are kept (as if by the base rules
alone); an empty table gives an empty result.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cardforge.functions._col import let
from cardforge.llm.common import materialize, packed

#: documents of its own at which a group's estimate counts as much as its language's
PRIOR = 50
#: concentration steps end when no centre or factor changes by more than SETTLED (bins are 2% wide)
SETTLED = 0.01
#: estimates (some 600 bytes each) that are broadcast; more are joined by a shuffle
BROADCAST_POOLS = 20_000
#: after so many steps the estimates are taken as they are, with a warning
MOST_STEPS = 60
#: share of normal documents that the reweighted estimate is taken from
INSIDE = 0.975
RIDGE = 0.25
#: chance of a larger distance under normality; small, as clean texts have heavier tails than that
TAIL = 1e-9

#: statistic -> least scale (fixed values): spreads below it are not told apart.  With RIDGE, 0.21 spares
#: a third of equal lines (squared distance 30 alone) and rejects two thirds (61)
STATISTICS = {
    "log_words": 1.0,
    "word_length": 0.15,
    "symbol_share": 0.1,
    "dup_line_share": 0.21,
    "repeat_share": 0.21,
    "loud_share": 0.1,
}
NAMES = list(STATISTICS)
P = len(NAMES)
SPACES = " \t\n\x0b\f\r"


def chi2_quantile(tail: float, dof: int = P) -> float:
    """x with P(chi2 > x) = tail, for an even number of degrees of freedom."""
    if dof % 2:
        raise ValueError("even degrees of freedom only")

    def above(x):
        return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if above(mid) > tail else (lo, mid)
    return lo


def text_counts(text: Column) -> Column:
    """Struct of counts of one text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_loud (upper-case letters and exclamation marks)."""

    def windows(w):
        return F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))

    def covered(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda s: F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        places = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(places))

    def counts(t):
        def of_words(w):
            repeats = let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
            lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
            return let(lines, lambda x: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                repeats.cast("long").alias("n_repeat_words"),
                F.size(x).cast("long").alias("n_lines"),
                (F.length(t) - F.length(F.regexp_replace(t, r"[\p{Lu}!]+", ""))).cast("long").alias("n_loud")))

        return let(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda x: x != ""), of_words)

    return let(F.coalesce(text.cast("string"), F.lit("")), counts)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def statistics(c: Column) -> list[Column]:
    """The transformed statistics of a struct of counts, as doubles."""
    words, lines = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["n_lines"], F.lit(1))
    return [F.log1p(c["n_words"].cast("double")), F.log1p(c["word_chars"] / words), F.sqrt(c["n_symbols"] / words),
            F.sqrt(c["n_dup_lines"] / lines), F.sqrt(c["n_repeat_words"] / words),
            F.sqrt(c["n_loud"] / F.greatest(c["word_chars"], F.lit(1)))]


def _key(lang: Column, source: Column) -> Column:
    return F.concat(F.coalesce(F.concat(F.lit("="), lang), F.lit("-")), F.lit("\x1f"),
                    F.coalesce(F.concat(F.lit("="), source), F.lit("-")))


def _bin_quantile(rows: DataFrame, by: list[str], bin_col: str, share: float, name: str) -> DataFrame:
    """The least bin with at least ``share`` of its group's rows up to it."""
    counts = rows.groupBy(*by, bin_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by)
    upto = w.orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)
    return (counts.select(*by, bin_col, F.sum("n").over(upto).alias("c"), F.sum("n").over(w).alias("t"))
            .where(F.col("c") >= share * F.col("t")).groupBy(*by).agg(F.min(bin_col).alias(name)))


#: the lower triangle of a matrix, row by row
PAIRS = [(j, k) for j in range(P) for k in range(j + 1)]
STEP = 200  # bins a unit, for medians
ALL = "a"


def pooled(rows: DataFrame) -> DataFrame:
    """``(pool, x)``: each row that passes the base rules in its group, its language and the whole."""
    language = F.concat(F.lit("l"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")))
    pools = F.array(F.concat(F.lit("g"), "key"), language, F.lit(ALL))
    return rows.where(~F.col("failed")).select(F.explode(pools).alias("pool"), "x")


def _frame(used: DataFrame) -> DataFrame:
    """``(pool, mu, s)``: medians and scales (median absolute deviations, at least the
    least scales) of each pool, both from one count of narrow bins."""
    bins = F.transform("x", lambda v, i: F.struct(i.alias("dim"), F.floor(v * STEP).alias("bin")))
    hist = materialize(used.select("pool", F.explode(bins).alias("b")).select("pool", "b.*")
                       .groupBy("pool", "dim", "bin").agg(F.count(F.lit(1)).alias("n")), "quality")

    def median(h: DataFrame, bin_col: str, name: str) -> DataFrame:
        w = Window.partitionBy("pool", "dim")
        upto = F.sum("n").over(w.orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0))
        return (h.select("pool", "dim", bin_col, upto.alias("c"), F.sum("n").over(w).alias("t"))
                .where(F.col("c") >= 0.5 * F.col("t")).groupBy("pool", "dim").agg(F.min(bin_col).alias(name)))

    centre = median(hist, "bin", "m")
    spread = median(hist.join(centre, ["pool", "dim"]).withColumn("off", F.abs(F.col("bin") - F.col("m"))), "off", "a")

    def listed(value: Column) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct("dim", value.alias("v")))), lambda e: e["v"])

    floors = F.get(F.lit(list(STATISTICS.values())), F.col("dim"))
    scale = F.greatest(1.4826 * (F.col("a") + 0.5) / STEP, floors)
    return centre.join(spread, ["pool", "dim"]).groupBy("pool").agg(listed((F.col("m") + 0.5) / STEP).alias("mu"), listed(scale).alias("s"))


def _offsets(x: Column, mu: Column, s: Column) -> list[Column]:
    return [(F.get(x, j) - F.get(mu, j)) / F.get(s, j) for j in range(P)]


def _squared(z: list[Column], w: Column) -> Column:
    """The squared length of ``w z`` (``w``: rows of a lower triangular matrix)."""
    total = F.lit(0.0)
    for j in range(P):
        part = F.lit(0.0)
        for k in range(j + 1):
            part = part + F.get(F.get(w, j), k) * z[k]
        total = total + part * part
    return total


class _Columns:
    """The larger expressions of a fit, built once for all its steps."""

    def __init__(self, few: bool) -> None:
        self.few = few
        self.offsets = {f"z{j}": c for j, c in enumerate(_offsets(F.col("x"), F.col("mu"), F.col("s")))}
        z = [F.col(f"z{j}") for j in range(P)]
        self.distance = _squared(z, F.col("w"))
        products = [z[j] * z[k] for j, k in PAIRS]
        self.sums = [F.sum(c).alias(name) for c, name in zip([*z, *products], SUMS)]
        self.averages = _packed([F.avg(c) for c in [*z, *products]])
        part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("half") - F.col("before")) / F.col("n")))
        self.nearer = [part.alias("part"), *[F.col(c) for c in SUMS]]
        self.moments = _packed([F.sum(F.col("part") * F.col(c)) / F.max("half") for c in SUMS])
        self.factor = whitening(covariance(F.col("c"), F.col("e")))
        turned = F.transform(_numbers(range(P)), lambda j: F.abs(F.get(F.get("w", j), j) / F.get(F.get("new", j), j) - 1))
        self.change = F.greatest(F.array_max(F.transform("c", lambda v: F.abs(v))), F.array_max(turned))
        self.moved = F.zip_with("mu", F.zip_with("c", "s", lambda c, s: c * s), lambda m, d: m + d).alias("mu")

    def hint(self, estimates: DataFrame) -> DataFrame:
        """Marks a table of a row a pool for a broadcast, if there are few of them."""
        return F.broadcast(estimates) if self.few else estimates

    def with_distance(self, rows: DataFrame) -> DataFrame:
        """Adds offsets ``z0..`` and the squared distance ``d2`` from ``x`` and an estimate's columns."""
        return rows.withColumns(self.offsets).withColumn("d2", self.distance)


def _log_bin(d: Column) -> Column:
    return F.floor(F.log(d + 1e-9) * 50)


def _of_bin(b: Column) -> Column:
    return F.exp((b + 0.5) / 50)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)


def _numbers(values) -> Column:
    return F.lit([int(v) for v in values])


def covariance(mean: Column, second: Column) -> Column:
    """The packed covariance of a mean and packed second moments."""
    j, k = _numbers(j for j, _ in PAIRS), _numbers(k for _, k in PAIRS)
    return F.transform(second, lambda e, i: e - F.get(mean, F.get(j, i)) * F.get(mean, F.get(k, i)))


def whitening(cov: Column) -> Column:
    """Rows of the inverse Cholesky factor of a packed covariance, made regular by RIDGE."""
    row, column = _numbers(j for j, _ in PAIRS), _numbers(k for _, k in PAIRS)

    def begin(j):  # where row j begins in a packed triangle
        return F.floor(j * (j + 1) / 2).cast("int")

    def next_entry(done, i):
        j, k = F.get(row, i), F.get(column, i)
        rest = (F.get(cov, i) * (1 - RIDGE) + F.when(j == k, RIDGE).otherwise(0.0)
                - _dot(F.slice(done, begin(j) + 1, k), F.slice(done, begin(k) + 1, k)))
        value = F.when(j == k, F.sqrt(F.greatest(rest, F.lit(RIDGE / 10)))).otherwise(rest / F.get(done, begin(k) + k))
        return F.concat(done, F.array(value))

    def inverse(low):
        def next_row(done, j):
            def entry(k):
                above = F.aggregate(F.zip_with(F.slice(low, begin(j) + 1, j), done, lambda a, r: a * F.get(r, k)), F.lit(0.0), lambda t, v: t + v)
                return (F.when(j == k, 1.0).otherwise(0.0) - above) / F.get(low, begin(j) + j)
            return F.concat(done, F.array(F.transform(_numbers(range(P)), entry)))
        return F.aggregate(_numbers(range(P)), F.array().cast("array<array<double>>"), next_row)

    return let(F.aggregate(_numbers(range(len(PAIRS))), F.array().cast("array<double>"), next_entry), inverse)


SUMS = [*[f"c{j}" for j in range(P)], *[f"e{j}_{k}" for j, k in PAIRS]]


def _packed(columns: list[Column]) -> list[Column]:
    return [F.array(*columns[:P]).alias("c"), F.array(*columns[P:]).alias("e")]


def _concentrate(used: DataFrame, est: DataFrame, watch: Observation, columns: _Columns) -> DataFrame:
    """One step: ``(pool, mu, s, w, mid)`` from the ``(n + P + 1) / 2`` rows of each pool
    nearest to its estimate; ``mid`` is the median bin of their distances from the old one.

    Sums are kept a bin of distance; the last bin counts by the part of it that is
    needed, so that a bin full of copies is not taken in whole."""
    rows = columns.with_distance(used.join(columns.hint(est), "pool"))
    bins = rows.groupBy("pool", _log_bin(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("n"), *columns.sums)
    whole = Window.partitionBy("pool")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    bins = bins.withColumns({"half": F.least(F.col("total"), F.floor((F.col("total") + P + 1) / 2)), "before": F.col("upto") - F.col("n")})
    moments = bins.select("pool", "bin", "upto", "total", "half", *columns.nearer).groupBy("pool").agg(
        F.min(F.when(F.col("upto") >= 0.5 * F.col("total"), F.col("bin"))).alias("mid"), *columns.moments)
    new = est.drop("mid").join(columns.hint(moments), "pool").withColumn("new", columns.factor).withColumn("change", columns.change)
    return (new.observe(watch, F.max("change").alias("change"), F.count_if(F.col("change") > SETTLED).alias("moving"))
            .select("pool", columns.moved, "s", F.col("new").alias("w"), "mid"))


def _weight() -> Column:
    """Of a pool's own estimate, against its parent's."""
    n = F.greatest(F.col("n") - 2 * P, F.lit(0))
    return n / (n + PRIOR)


def _shrunk(own: DataFrame, parent: DataFrame, key: str, columns: _Columns) -> DataFrame:
    """``own(pool, n, mu, cov, unit, ...)`` with moments shrunk towards those of the pool named by ``key``."""
    p = parent.select(F.col("pool").alias(key), F.struct("mu", "cov").alias("_p"))
    share = _weight()

    def mix(a: str) -> Column:
        return F.zip_with(F.col(a), F.col(f"_p.{a}"), lambda x, y: share * x + (1 - share) * y)

    return own.join(columns.hint(p), key).withColumns({"mu": mix("mu"), "cov": mix("cov")}).drop("_p")


def _finished(moments: DataFrame) -> DataFrame:
    """Adds scales and whitening of the (shrunk) moments."""
    floors, diagonal = F.lit(list(STATISTICS.values())), _numbers(i for i, (j, k) in enumerate(PAIRS) if j == k)
    row, column = _numbers(j for j, _ in PAIRS), _numbers(k for _, k in PAIRS)
    scale = F.transform(diagonal, lambda i, j: F.greatest(F.sqrt(F.greatest(F.get("cov", i), F.lit(0.0))), F.get(floors, j)))
    d = moments.withColumn("s", scale)
    scaled = F.transform("cov", lambda v, i: v / (F.get("s", F.get(row, i)) * F.get("s", F.get(column, i))))
    return d.withColumn("w", whitening(scaled))


def _unit(mid: Column, share: float = 1.0) -> Column:
    """The consistency factor of the squared distance: its median over the chi-square
    median of the nearest ``share`` of normal rows.  Where the least scales hold,
    distances are small by construction: never inflate them."""
    return F.greatest(_of_bin(mid) / chi2_quantile(1 - share / 2), F.lit(1.0))


def fit(rows: DataFrame, most_steps: int = MOST_STEPS) -> DataFrame:
    """Estimates from ``(key, lang, failed, x)``: ``(pool, mu, s, w, unit)``, one row a
    group that has rows (``g`` and its key)."""
    used = pooled(rows)
    unit_rows = F.transform(_numbers(range(P)), lambda j: F.transform(_numbers(range(P)), lambda k: F.when(j == k, 1.0).otherwise(0.0)))
    pools = Observation()
    est = _frame(used).withColumns({"w": unit_rows, "mid": F.lit(0).cast("bigint")})
    est = materialize(est.observe(pools, F.count(F.lit(1)).alias("n")), "quality")
    columns = _Columns(pools.get["n"] <= BROADCAST_POOLS)
    for _ in range(most_steps):
        watch = Observation()
        est = materialize(_concentrate(used, est, watch, columns), "quality")
        if not watch.get["moving"]:
            break
    else:
        logging.getLogger(__name__).warning("%d estimates still move after %d steps (by up to %.3f)", watch.get["moving"], most_steps,
                                            watch.get["change"])

    # all rows near the estimate of their pool, and moments of these
    known = est.withColumn("unit", _unit(F.col("mid")))
    near = (columns.with_distance(used.join(columns.hint(known), "pool")).where(F.col("d2") <= F.col("unit") * chi2_quantile(1 - INSIDE))
            .select("pool", "x", *[f"z{j}" for j in range(P)]))
    near = materialize(near, "quality")
    sums = near.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), *columns.averages)
    row, column = _numbers(j for j, _ in PAIRS), _numbers(k for _, k in PAIRS)
    moments = est.join(columns.hint(sums), "pool").select(
        "pool", "n", columns.moved,
        F.transform(covariance(F.col("c"), F.col("e")), lambda v, i: v * F.get("s", F.get(row, i)) * F.get("s", F.get(column, i))).alias("cov"))
    languages = rows.select(F.concat(F.lit("g"), "key").alias("pool"), F.concat(F.lit("l"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")))
                            .alias("language")).distinct()
    moments = materialize(moments.join(columns.hint(languages), "pool", "left"), "quality")

    whole = moments.where(F.col("pool") == ALL)
    by_language = _shrunk(moments.where("pool like 'l%'").withColumn("parent", F.lit(ALL)), whole, "parent", columns)
    names = ["pool", "n", "language", "mu", "cov"]
    by_group = _shrunk(moments.where("pool like 'g%'"), by_language, "language", columns)
    est = materialize(_finished(whole.select(*names).union(by_language.select(*names)).union(by_group.select(*names))), "quality")

    # consistency factors, shrunk in the same way
    bins = columns.with_distance(near.select("pool", "x").join(columns.hint(est.select("pool", "mu", "s", "w")), "pool"))
    mids = _bin_quantile(bins.select("pool", _log_bin(F.col("d2")).alias("bin")), ["pool"], "bin", 0.5, "mid")
    units = materialize(est.join(columns.hint(mids), "pool").withColumn("log_unit", F.log(_unit(F.col("mid"), INSIDE))), "quality")
    share = _weight()
    top = units.where(F.col("pool") == ALL).select(F.col("log_unit").alias("_whole"))
    middle = units.where("pool like 'l%'").join(F.broadcast(top)).select(  # one row
        F.col("pool").alias("language"), (share * F.col("log_unit") + (1 - share) * F.col("_whole")).alias("_language"))
    unit = F.exp(share * F.col("log_unit") + (1 - share) * F.col("_language")).alias("unit")
    groups = units.where("pool like 'g%'").join(columns.hint(middle), "language").select("pool", "mu", "s", "w", unit)
    # documents of one source may be a third of all: they meet few estimates by a broadcast
    return columns.hint(materialize(groups, "quality"))


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``row`` (the columns of ``docs``) and struct ``_q``: counts, failed, key,
    lang and statistics ``x``."""
    lang, source = F.col(lang_col).cast("string"), F.col(source_col).cast("string")
    d = docs.select(packed(docs), text_counts(F.col(text_col)).alias("_c"), lang.alias("_lang"), source.alias("_source"))
    c = F.col("_c")
    return d.select("row", F.struct(c.alias("counts"), base_failed(c).alias("failed"),
                                    _key(F.col("_lang"), F.col("_source")).alias("key"), F.col("_lang").alias("lang"),
                                    F.array(*statistics(c)).alias("x")).alias("_q"))


def fit_rows(measured_docs: DataFrame) -> DataFrame:
    return measured_docs.select("_q.key", "_q.lang", "_q.failed", "_q.x")


def rate(measured_docs: DataFrame, estimates: DataFrame, tail: float = TAIL) -> DataFrame:
    """Adds struct ``_v``: squared distance (null: no estimate) and ``kept``."""
    e = estimates.select(F.col("pool").alias("_pool"), F.struct(*[c for c in estimates.columns if c != "pool"]).alias("_e"))
    d = measured_docs.join(e, F.concat(F.lit("g"), F.col("_q.key")) == F.col("_pool"), "left").drop("_pool")
    z = _offsets(F.col("_q.x"), F.col("_e.mu"), F.col("_e.s"))
    d = d.withColumn("_d2", _squared(z, F.col("_e.w")) / F.col("_e.unit"))
    # one expression over both sides of the join: a filter on it stays above, and texts are counted once
    keep = F.when(F.col("_q.failed"), F.lit(False)).otherwise(F.coalesce(F.col("_d2") <= chi2_quantile(tail), F.lit(True)))
    return d.withColumn("_v", F.struct(F.col("_d2").alias("distance2"), keep.alias("kept"))).drop("_e", "_d2")


def quality_rules(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance2, kept)``: one row a document, texts read once."""
    m = materialize(measured(docs).select(F.col("row")[id_col].alias("doc_id"), "_q"), "quality")
    rated = rate(m, fit(fit_rows(m)))
    return rated.select("doc_id", *[f"_q.counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                               "n_repeat_words")],
                        F.col("_q.failed").alias("base_failed"), "_v.distance2", "_v.kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    m = measured(docs)
    rows = materialize(fit_rows(m), "quality")
    return rate(m, fit(rows)).where("_v.kept").select("row.*")
