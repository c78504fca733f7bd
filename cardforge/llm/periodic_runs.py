"""Periodic runs of words by block convolution (operator 11).

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal), of at least ``max(least, 2 q)`` words, that no neighbour extends.

Periods are searched by dyadic scales.  At scale ``B`` (a power of two) a text is
cut into blocks of ``B`` words.  A run of period ``2B <= q < 4B`` has a whole block
among its first ``q`` words, and that block stands again ``q`` words later.  For
each block the sums of squared differences to all places ``2B`` to ``4B - 1`` words
ahead come from one convolution per window of ``2B`` words, by a number-theoretic
transform: ``sum x^2 + sum y^2 - 2 sum x y`` is zero where nothing differs.  (All
integers are residues of one prime: a zero is never missed, and what is zero by
chance fails the exact check at the end.)  Blocks with a word that does not come
again within ``4B`` words cannot recur and are not transformed.  Periods below 8
need no transform: the text is compared with itself 1 to 7 words later.

Blocks in a row that match at one distance seed one stretch; it is extended on
both sides to the first unequal pair (binary search over prefix hashes).  A
stretch of at least two periods with a period that is no smallest one is, by the
periodicity lemma, the same stretch as that of the smallest; so of stretches with
equal ends the least period stays.  The stretches that remain are compared word by
word; should a hash have misled, they are extended again without hashes.

Documents are independent: one pass in Arrow batches, no shuffle.  Memory is a
small multiple of the longest text, time ``n log^2 n`` for any text.

Defined results: a null text, or one without words, has no runs and an empty
collapsed text; equal rows get equal rows; a null id stays null; columns of the
input are not carried, so names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardforge.functions._col import let
from cardforge.llm.common import chunks, text_batches, words_of

#: shortest run, in words
LEAST = 12
#: periods below are compared directly
DIRECT = 8
#: prime 15 * 2^27 + 1 with its primitive root (fixed values): transforms of up to 2^27 points
PRIME, ROOT = 2013265921, 31
#: words of blocks that are transformed together
BATCH_WORDS = 1 << 17
#: primes and bases of the prefix hashes (fixed values)
HASHES = ((2147483647, 1000003), (2147483629, 998244353))

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _mod(x: np.ndarray) -> np.ndarray:
    return x - (x // np.uint64(PRIME)) * np.uint64(PRIME)


@functools.lru_cache(maxsize=64)
def _twiddles(n: int, inverse: bool) -> np.ndarray:
    """Powers 0 to n/2 - 1 of an n-th root of unity."""
    w = pow(ROOT, (PRIME - 1) // n, PRIME)
    if inverse:
        w = pow(w, PRIME - 2, PRIME)
    out = np.ones(max(n // 2, 1), dtype=np.uint64)
    done = 1
    while done < n // 2:
        out[done:2 * done] = _mod(out[:done] * np.uint64(pow(w, done, PRIME)))
        done *= 2
    return out


def ntt(a: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row (a power of two of residues)."""
    rows, n = a.shape
    p = np.uint64(PRIME)
    size, step = n, 1
    while size > 1:
        half = size // 2
        u, v = a[:, :n // 2], a[:, n // 2:]
        out = np.empty((rows, half, 2, step), dtype=np.uint64)
        total = u + v
        np.subtract(total, p, out=total, where=total >= p)
        out[:, :, 0, :] = total.reshape(rows, half, step)
        out[:, :, 1, :] = _mod((u + p - v) * np.repeat(_twiddles(size, inverse), step)).reshape(rows, half, step)
        a, size, step = out.reshape(rows, n), half, step * 2
    if inverse:
        a = _mod(a * np.uint64(pow(n, PRIME - 2, PRIME)))
    return a


def block_matches(codes: np.ndarray, at: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(block start, distance)`` of each place ``2 size`` to ``4 size - 1`` words
    ahead where the block of ``size`` words at ``at`` stands again before ``ends``."""
    places, distances = [], []
    n, k, batch = 2 * size, np.arange(2 * size), max(1, BATCH_WORDS // size)
    for lo in range(0, len(at), batch):
        b, end = at[lo:lo + batch], ends[lo:lo + batch]
        x = codes[b[:, None] + k[:size]].astype(np.uint64)
        turned = np.zeros((len(b), n), dtype=np.uint64)
        turned[:, 0], turned[:, size + 1:] = x[:, 0], x[:, :0:-1]
        turned, own = ntt(turned), _mod(_mod(x * x).sum(axis=1))
        for ahead in (n, n + size):
            fits = np.flatnonzero(b + ahead + size <= end)
            if not len(fits):
                continue
            place = b[fits, None] + ahead + k
            y = np.where(place < end[fits, None], codes[np.minimum(place, len(codes) - 1)], 0).astype(np.uint64)
            cross = ntt(_mod(turned[fits] * ntt(y)), inverse=True)[:, :size]
            sums = np.concatenate((np.zeros((len(fits), 1), dtype=np.uint64), np.cumsum(_mod(y * y), axis=1)), axis=1)
            other = _mod(sums[:, size:n] - sums[:, :size])
            row, lag = np.nonzero(_mod(own[fits, None] + other) == _mod(2 * cross))
            row = fits[row]
            inside = b[row] + ahead + lag + size <= end[row]
            places.append(b[row[inside]])
            distances.append(ahead + lag[inside])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(distances)


class PrefixHashes:
    """Equality of stretches of ``codes`` by two polynomial prefix hashes."""

    def __init__(self, codes: np.ndarray):
        self.parts = []
        for prime, base in HASHES:
            p = np.uint64(prime)
            powers = np.ones(len(codes) + 1, dtype=np.uint64)
            done = 1
            while done < len(powers):
                more = min(done, len(powers) - done)
                powers[done:done + more] = powers[:more] * np.uint64(pow(base, done, prime)) % p
                done += more
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:-1] % p)))
            self.parts.append((p, powers, sums % p))

    def equal(self, i: np.ndarray, d: np.ndarray, size: np.ndarray) -> np.ndarray:
        same = np.ones(len(i), dtype=bool)
        for p, powers, sums in self.parts:
            near = (sums[i + size] + p - sums[i]) % p
            far = (sums[i + d + size] + p - sums[i + d]) % p
            same &= near * powers[d] % p == far
        return same

    def reach(self, at: np.ndarray, d: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The most words from ``at`` on (or before it) that equal those ``d`` later."""
        lo, hi = np.zeros(len(at), dtype=np.int64), most.astype(np.int64)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self.equal(at - mid if back else at, d, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of at least ``least`` true values."""
    hits = np.flatnonzero(equal)
    if not len(hits):
        return hits, hits
    cut = np.flatnonzero(np.diff(hits) > 1)
    start, stop = hits[np.concatenate(([0], cut + 1))], hits[np.concatenate((cut, [len(hits) - 1]))] + 1
    keep = stop - start >= least
    return start[keep], stop[keep]


def _short_periods(codes: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[np.ndarray, ...]]:
    found = []
    for d in range(1, min(DIRECT, len(codes))):
        start, stop = _stretches((codes[d:] == codes[:-d]) & (doc[d:] == doc[:-d]), max(least, 2 * d) - d)
        found.append((start, stop + d, np.full(len(start), d, dtype=np.int64)))
    return found


def _recurs_within(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words until each word comes again in its text (a large number if never)."""
    order = np.argsort(codes, kind="stable")
    gap = np.full(len(codes), 1 << 40, dtype=np.int64)
    a, b = order[:-1], order[1:]
    same = (codes[a] == codes[b]) & (doc[a] == doc[b])
    gap[a[same]] = b[same] - a[same]
    return gap


def _long_periods(codes: np.ndarray, offsets: np.ndarray, doc: np.ndarray, least: int,
                  hashes: PrefixHashes | None = None) -> list[tuple[np.ndarray, ...]]:
    found = []
    lengths = np.diff(offsets)
    gap = _recurs_within(codes, doc)
    size = DIRECT // 2
    while len(lengths) and lengths.max() >= 4 * size:
        near = np.concatenate(([0], np.cumsum(gap < 4 * size)))
        long = np.flatnonzero(lengths >= 4 * size)
        each = (lengths[long] - 3 * size) // size + 1  # blocks that could stand again 2 size ahead
        at = np.repeat(offsets[long], each) + size * (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
        ends = np.repeat(offsets[long + 1], each)
        keep = near[at + size] - near[at] == size
        b, d = block_matches(codes, at[keep], ends[keep], size)
        if len(b):
            hashes = hashes or PrefixHashes(codes)
            order = np.lexsort((b, d))
            b, d = b[order], d[order]
            apart = np.flatnonzero((np.diff(b) != size) | (np.diff(d) != 0) | (doc[b[1:]] != doc[b[:-1]]))
            first, last, d = b[np.concatenate(([0], apart + 1))], b[np.concatenate((apart, [len(b) - 1]))] + size, d[np.concatenate(([0], apart + 1))]
            lo, hi = offsets[doc[first]], offsets[doc[first] + 1]
            start = first - hashes.reach(first, d, np.minimum(2 * size, first - lo), back=True)
            stop = last + d + hashes.reach(last, d, np.minimum(2 * size, hi - d - last), back=False)
            enough = stop - start >= np.maximum(least, 2 * d)
            found.append((start[enough], stop[enough], d[enough]))
        size *= 2
    return found


def _exact(codes, lo, hi, start, stop, d) -> bool:
    """Whether ``[start, stop)`` has period ``d`` and cannot be extended in ``[lo, hi)``."""
    return (np.array_equal(codes[start:stop - d], codes[start + d:stop])
            and (start == lo or codes[start - 1] != codes[start - 1 + d])
            and (stop == hi or codes[stop] != codes[stop - d]))


def periodic_runs(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, stop, period)`` of all runs, in order of start and period; words
    are ``codes``, the words of text ``t`` are those from ``offsets[t]`` on."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    empty = np.zeros(0, dtype=np.int64)
    found = [(empty, empty, empty), *_short_periods(codes, doc, least), *_long_periods(codes, offsets, doc, least)]
    start, stop, d = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    order = np.lexsort((d, stop, start))
    start, stop, d = start[order], stop[order], d[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(stop) != 0)
    start, stop, d = start[first], stop[first], d[first]
    misled = [i for i in range(len(start)) if not _exact(codes, offsets[doc[start[i]]], offsets[doc[start[i]] + 1],
                                                         start[i], stop[i], d[i])]
    if misled:  # a hash took unequal words for equal: compare these texts with themselves at every distance
        texts = np.unique(doc[start[misled]])
        rest = ~np.isin(doc[start], texts)
        again = [_by_distance(codes[offsets[t]:offsets[t + 1]], int(offsets[t]), least) for t in texts]
        start, stop, d = (np.concatenate((old[rest], *new)) for old, new in zip((start, stop, d), zip(*again)))
    order = np.lexsort((d, start))
    return start[order], stop[order], d[order]


def _by_distance(codes: np.ndarray, base: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    seen: dict[tuple[int, int], int] = {}
    for d in range(1, len(codes) // 2 + 1):
        for start, stop in zip(*_stretches(codes[d:] == codes[:-d], max(least, 2 * d) - d)):
            seen.setdefault((base + int(start), base + int(stop) + d), d)
    rows = np.array([(s, e, d) for (s, e), d in seen.items()], dtype=np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row a document: the runs
    ``array<struct<start, length, period>>`` by start and period (``start`` is a word
    number), and the text without the words that follow the first period of a run,
    joined by one space."""
    text_batches(docs.sparkSession)
    key = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                           T.StructField("collapsed", T.StringType())])

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch.column(1)):
                words, offsets = words_of(batch.column(1).slice(lo, hi - lo))
                codes = np.asarray(words.dictionary_encode().indices) if len(words) else np.zeros(0, dtype=np.int32)
                start, stop, period = periodic_runs(codes, offsets, least)
                edges = np.zeros(len(codes) + 1, dtype=np.int64)
                np.add.at(edges, start + period, 1)
                np.add.at(edges, stop, -1)
                stays = np.cumsum(edges[:-1]) == 0
                kept = np.concatenate(([0], np.cumsum(stays)))[offsets]
                if not stays.all():
                    words = words.filter(pa.array(stays))
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), words), pa.scalar(" ", pa.large_string()))
                bounds = np.searchsorted(start, offsets)
                text = np.searchsorted(offsets, start, side="right") - 1
                rows = pa.StructArray.from_arrays([pa.array(start - offsets[text]), pa.array(stop - start), pa.array(period)],
                                                  ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), rows), texts.cast(pa.string())], schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with repeats of known period in about a tenth of the texts.

    With ``h`` the crc32 of the id's digits and ``g = h / 10``: where ``h`` is a multiple of 10
    and the text has ``n > 0`` words, word ``i >= a = g % n`` becomes word ``a + (i - a) % p``,
    ``p = 1 + (n - a) / (3 + g % 8)``, and words are joined by one space.  Other texts, and those of null ids, stay."""

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        place = let(F.expr("g") % n, lambda a: F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + F.expr("g") % 8))).alias("p")))
        return F.when(n == 0, F.lit("")).otherwise(let(place, lambda x: F.array_join(F.transform(
            words, lambda w, i: F.when(i < x["a"], w).otherwise(F.get(words, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " ")))

    text = F.col("text")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select(F.col(id_col).alias("doc_id"), text_col).toDF("doc_id", "text").withColumn("text", text.cast("string"))
    d = d.withColumn("h", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))).withColumn("g", F.floor(F.col("h") / 10))
    return d.select("doc_id", F.when(F.col("h") % 10 == 0, let(words, repeated)).otherwise(text).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256)`` of the output of :func:`find_runs`: the longest run (ties: least
    start, then period) and digests of all runs (``start,length,period`` and a line feed
    each) and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    d = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return d.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"),
                    period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
