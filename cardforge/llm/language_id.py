"""Language identification as multilingual mixture inference (operator 9).

A language is a distribution over hashed character trigrams, counted over all
training texts.  A document's trigrams are modelled as drawn from a mixture of
languages; expectation-maximisation estimates the proportions from the trigram
likelihoods.  Nested sets of its leading languages are then compared by
penalised likelihood: another language must pay for itself by ``PENALTY`` x
log(trigrams).  The prediction is the leading language of the chosen set, the
score its share of the document.

The model has one row a language and trigram bucket, so it is bounded by the
number of languages; more than ``MAX_LANGUAGES`` labels are refused.  The
mixture is always one of all languages; documents are taken in blocks of at most
``BLOCK_CELLS`` likelihoods (one document at least).

Defined results: ``und`` with score 0 for a text that is null or has no letter,
and for all when nothing can be learned (no labelled text); ties go to the
smaller name; repeated rows are predicted alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardforge.llm.common import chunks, mix64, packed, text_batches
from cardforge.llm.pretokenize import LETTER, codepoint_classes

BUCKETS = 1 << 14
SMOOTHING = 0.5
ROUNDS = 8
PENALTY = 6.0
#: a language of a smaller share is not tried for the set
LEAST_SHARE = 0.02
BLOCK_CELLS = 1 << 22
MAX_LANGUAGES = 1000
UNKNOWN = "und"


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every trigram around a letter; what is no
    letter counts as a space."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\x00", " ")
    joined = "\x00".join(texts.to_pylist()).lower()
    cp = np.frombuffer(("\x00" + joined + "\x00").encode("utf-32-le"), dtype="<u4")
    letter = codepoint_classes()[cp] == LETTER
    doc = np.cumsum(cp == 0, dtype=np.int32) - 1
    c = np.where(letter, cp, 0x20).astype(np.uint64)
    at = np.flatnonzero(letter)
    h = mix64((c[at - 1] << np.uint64(42)) ^ (c[at] << np.uint64(21)) ^ c[at + 1])
    return doc[at], (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log-free bucket probabilities, ``(buckets, languages)``,
    from all texts with a label."""
    text_batches(docs.sparkSession)

    def count(batches):
        totals: dict[str, np.ndarray] = {}

        def flush():
            for lang, n in totals.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), type=pa.string()), pa.array(at), pa.array(n[at])],
                                                 ["lang", "bucket", "n"])
            totals.clear()

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo, hi in chunks(batch.column(0), 1 << 20):
                doc, bucket = trigrams(batch.column(0).slice(lo, hi - lo))
                for lang in set(langs[lo:hi]):
                    if lang not in totals:
                        if len(totals) >= 64:
                            yield from flush()
                        totals[lang] = np.zeros(BUCKETS, dtype=np.int64)
                    mine = np.array([x == lang for x in langs[lo:hi]])
                    totals[lang] += np.bincount(bucket[mine[doc]], minlength=BUCKETS)
        yield from flush()

    rows = (docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
            .select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .mapInArrow(count, "lang string, bucket long, n long"))
    sums = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most MAX_LANGUAGES + 1 languages of BUCKETS rows each reach the driver
    names = sorted(r[0] for r in sums.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    got = sums.toArrow()
    n = np.zeros((BUCKETS, len(names)))
    place = {x: i for i, x in enumerate(names)}
    if got.num_rows:
        n[np.asarray(got.column("bucket")), [place[x] for x in got.column("lang").to_pylist()]] = np.asarray(got.column("n"))
    return names, ((n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)


def _mixture(theta: np.ndarray, x: np.ndarray, starts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document; ``theta`` (rows,
    languages) are the likelihoods of its buckets, ``x`` how often they occur."""
    lengths = np.diff(np.append(starts, len(x)))
    total = np.add.reduceat(x, starts)
    k = theta.shape[1]
    share = np.full((len(starts), k), 1.0 / k, dtype=np.float32)
    for _ in range(rounds if k > 1 else 0):
        part = theta * np.repeat(share, lengths, axis=0)
        part *= (x / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / total[:, None]
    mixed = (theta * np.repeat(share, lengths, axis=0)).sum(axis=1)
    return share, np.add.reduceat(x * np.log(np.maximum(mixed, 1e-30)), starts)


def _leading(theta: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading language of each document of a block and its share (see ``_mixture``)."""
    lengths = np.diff(np.append(starts, len(x)))
    share, _ = _mixture(theta, x, starts, ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    rows = np.arange(len(starts))
    logn = np.log(np.maximum(np.add.reduceat(x, starts), 2))
    value = np.add.reduceat(x * np.log(theta[np.arange(len(x)), np.repeat(order[:, 0], lengths)]), starts)
    best, score = order[:, 0].copy(), np.ones(len(starts))
    alive = rows
    for k in range(2, share.shape[1] + 1):
        alive = alive[share[alive, order[alive, k - 1]] >= LEAST_SHARE]
        if not len(alive):
            break
        pick = np.concatenate([np.arange(starts[i], starts[i] + lengths[i]) for i in alive])
        some = np.repeat(order[alive, :k], lengths[alive], axis=0)
        first = np.concatenate(([0], np.cumsum(lengths[alive])[:-1]))
        part, ll = _mixture(theta[pick[:, None], some], x[pick], first, 2 * ROUNDS)
        # the penalty of one language more than in the set accepted last
        better = ll - PENALTY * logn[alive] > value[alive]
        alive, part, ll = alive[better], part[better], ll[better]
        if not len(alive):
            break
        value[alive] = ll
        lead = part.argmax(axis=1)
        best[alive] = order[alive, lead]
        score[alive] = part[np.arange(len(alive)), lead]
    return best, np.clip(score, 0.0, 1.0)


def infer(doc: np.ndarray, bucket: np.ndarray, n: int, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading language of each of ``n`` documents (-1: none) and its share."""
    best, score = np.full(n, -1), np.zeros(n)
    counts = np.bincount(doc.astype(np.int64) * BUCKETS + bucket, minlength=n * BUCKETS)
    key = np.flatnonzero(counts)
    if not len(key) or not probs.shape[1]:
        return best, score
    x = counts[key].astype(np.float32)
    doc, bucket = key // BUCKETS, key % BUCKETS
    ids, starts = np.unique(doc, return_index=True)
    ends = np.append(starts[1:], len(x))
    most, lo = BLOCK_CELLS // probs.shape[1], 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + most, side="right")))
        rows = slice(starts[lo], ends[hi - 1])
        best[ids[lo:hi]], score[ids[lo:hi]] = _leading(probs[bucket[rows]], x[rows], starts[lo:hi] - starts[lo])
        lo = hi
    return best, score


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), ``lang_pred`` and ``score``."""
    names, probs = model
    text_batches(docs.sparkSession)
    rows = docs.select(packed(docs))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            texts = pc.struct_field(batch.column(0), text_col).cast(pa.large_string())
            for lo, hi in chunks(texts, 1 << 20):
                langs, scores = [], []
                doc, bucket = trigrams(texts.slice(lo, hi - lo))
                cuts = np.searchsorted(doc, np.arange(0, hi - lo + 256, 256))
                for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    size = min(256, hi - lo - 256 * s)
                    if size <= 0:
                        break
                    best, score = infer(doc[a:b] - 256 * s, bucket[a:b], size, probs)
                    langs += [names[i] if i >= 0 else UNKNOWN for i in best]
                    scores.append(score)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(langs, type=pa.string()),
                     pa.array(np.concatenate([*scores, np.zeros(0)]))], ["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """One in five, by the id as text."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, learned from the rows that are
    not held out."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                            F.col(lang_col).cast("string").alias("lang"))
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out")))
    return (predict(docs.select("doc_id", "held_out", "text"), model)
            .select("row.doc_id", "row.held_out", "lang_pred", "score"))


def keep_identified(documents: DataFrame, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows of ``documents`` of a known language whose share of the text is
    at least ``least_score``."""
    train_on = documents.where(~held_out(F.col(id_col)))
    return (predict(documents, train(train_on, text_col, lang_col), text_col)
            .where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*"))
