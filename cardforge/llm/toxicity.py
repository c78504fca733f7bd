"""Toxicity severity by cumulative-link ordinal regression (operator 3).

Severity has grades 0 (clean) to ``GRADES`` - 1.  A document's words, and
their first letters, are sparse features with shared weights w; ordered
thresholds t_1 < t_2 < ... split the line of w.x into grades, P(grade >= k) =
s(w.x - t_k) with the logistic s.  The result is the expected grade, the most
probable grade and the chance of any.

Labels say toxic or not, so the grade of a toxic document is hidden.  It is found by
expectation-maximisation in its classifying form: the present weights rank the toxic
documents by their score, the ranking deals them grades 1 to 3 in the proportions
``SHARES`` (the labels' likelihood alone leaves the upper thresholds open; equal scores
get the lower grade), and weights and thresholds of all grades are fitted again, until
the grades stay.  So severity is the weight of learned evidence, not a count of words.

The fit uses at most ``SAMPLE`` labelled documents, chosen by a hash of the id;
its vocabulary is the words that tell the labels apart significantly (a
difference of ``LEAST_Z`` standard errors), the clearest ``FEATURES`` at most.  All
documents are scored, over their whole texts, where they lie.

Defined results: a null or empty text has no features (the model's base rate);
labels that are null, or whose id has contradicting labels, are not learned
from; without labels of both kinds every document has severity 0; repeated rows
are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.llm.common import chunks, materialize, text_batches, words_of
from cardforge.llm.shingles import shingle_sets

SAMPLE = 20_000
FEATURES = 4096
#: first letters of a word that are a feature beside the word
START = 4
GRADES = 4
#: proportions of the hidden grades among toxic documents
SHARES = (1 / 2, 1 / 3, 1 / 6)
#: rounds of expectation-maximisation, and the part of grades that may still change at its end
MOST_ROUNDS, SETTLED = 8, 0.005
LEAST_DOCS = 3
#: of 100,000 words without a preference, less than one passes by chance
LEAST_Z = 4.5
RIDGE = 0.01
ROUNDS = 400
#: characters that are cut off both ends of a word
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha()) + "«»„“”‘’…–—¡¿·"


def _terms(words: pa.Array) -> list[pa.Array]:
    """Terms of words: the bare word, and its first letters."""
    bare = pc.utf8_trim(pc.utf8_lower(words), characters=EDGES)
    start = pc.binary_join_element_wise(pc.utf8_slice_codeunits(bare, 0, START), pa.scalar("*", pa.large_string()),
                                        pa.scalar("", pa.large_string()))
    return [bare, start]


def term_ids(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place in ``terms`` of every occurrence of one of them."""
    flat, offsets = words_of(texts)
    coded = flat.dictionary_encode()
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    docs, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for kind in _terms(coded.dictionary):
        place = np.asarray(pc.fill_null(pc.index_in(kind, value_set=terms), -1))
        at = place[np.asarray(coded.indices)] if len(coded) else np.zeros(0, dtype=np.int64)
        docs.append(doc[at >= 0])
        ids.append(at[at >= 0].astype(np.int64))
    return np.concatenate(docs), np.concatenate(ids)


def _features(doc: np.ndarray, word: np.ndarray, width: int):
    """Rows, columns and values log(1 + count)."""
    key, n = np.unique(doc * width + word, return_counts=True)
    return key // width, key % width, np.log1p(n)


@dataclass
class Model:
    words: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def grade_chances(self, score: np.ndarray) -> np.ndarray:
        """P(grade = k), a row a document."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))
        above = np.concatenate([np.ones((len(score), 1)), above, np.zeros((len(score), 1))], axis=1)
        return above[:, :-1] - above[:, 1:]


def fit_ordinal(row, col, value, width: int, grade: np.ndarray, rounds: int = ROUNDS, ridge: float = RIDGE, start=None):
    """Weights and thresholds of largest penalised likelihood, by accelerated
    gradient steps (from ``start``, if given).  Thresholds are a first one and positive gaps."""
    n, levels = len(grade), GRADES - 1
    times = np.full(n, 1 / n)
    w, first, gaps = np.zeros(width), 0.0, np.zeros(levels - 1)
    if start is not None:
        w, first, gaps = start[0].copy(), start[1][0], np.clip(np.log(np.maximum(np.diff(start[1]), 1e-9)), -6, 6)
    m, v = np.zeros(width + levels), np.zeros(width + levels)
    for step in range(1, rounds + 1):
        t = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        score = np.bincount(row, weights=value * w[col], minlength=n)
        above = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -60, 60)))
        full = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = full * (1 - full)
        at = np.arange(n)
        chance = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        # derivative of log P(grade) by the score, and by each threshold
        by_score = times * (slope[at, grade] - slope[at, grade + 1]) / chance
        by_t = np.array([(np.where(grade == k - 1, times * slope[:, k] / chance, 0)
                          - np.where(grade == k, times * slope[:, k] / chance, 0)).sum() for k in range(1, GRADES)])
        g_w = np.bincount(col, weights=value * by_score[row], minlength=width) - ridge / width * w
        g_gaps = np.array([by_t[k + 1:].sum() for k in range(levels - 1)]) * np.exp(gaps)
        g = np.concatenate([g_w, [by_t.sum()], g_gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
        w, first, gaps = w + move[:width], first + move[width], np.clip(gaps + move[width + 1:], -6, 6)
    return w, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))


def dealt_grades(score: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades of documents by the rank of their score among the toxic ones, 0 for clean ones."""
    ranked = np.sort(score[toxic == 1])
    cuts = ranked[np.maximum(np.ceil(np.cumsum(SHARES)[:-1] * len(ranked) - 1e-9).astype(int) - 1, 0)]
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, score, side="left"), 0)


def fit_hidden(row, col, value, width: int, toxic: np.ndarray):
    """Weights and thresholds from labels that only say toxic (1) or not (0)."""
    n = len(toxic)
    w, t = fit_ordinal(row, col, value, width, toxic)  # one grade above 0: its threshold alone is learned
    grade = toxic
    for _ in range(MOST_ROUNDS):
        dealt = dealt_grades(np.bincount(row, weights=value * w[col], minlength=n), toxic)
        if (dealt != grade).sum() <= SETTLED * n:
            break
        grade = dealt
        w, t = fit_ordinal(row, col, value, width, grade, ROUNDS // 2, start=(w, np.minimum(t, t[0] + np.arange(GRADES - 1))))
    return w, t


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model | None:
    spark = documents.sparkSession
    text_batches(spark)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("lo"), F.max(label_col).alias("hi")).where("lo = hi")
             .select("id", F.col("lo").cast("int").alias("toxic")))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = (documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .join(F.broadcast(chosen), "id"))  # at most ``sample`` ids

    def sketch(batches):
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                sets, bounds = shingle_sets(part.column(0), 5)
                least = np.append(sets, np.uint64(0)).view(np.int64)[bounds[:-1]]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.where(np.diff(bounds) > 0, least, 0))],
                                                 ["text", "toxic", "id", "least"])

    # of texts with the same least shingle one is learned from: copies are no evidence
    texts = (texts.select("text", "toxic", F.xxhash64("id").alias("id")).mapInArrow(sketch, "text string, toxic int, id long, least long")
             .groupBy("least").agg(F.min(F.struct("id", "toxic", "text")).alias("one")).select("one.text", "one.toxic"))
    texts = materialize(texts, "labelled")

    def count(batches):
        """Documents of either label that have a word, summed in the task."""
        for batch in batches:
            toxic = np.asarray(batch.column(1), dtype=np.int64)
            for lo, hi in chunks(batch.column(0)):
                flat, offsets = words_of(batch.column(0).slice(lo, hi - lo))
                doc = np.repeat(np.arange(hi - lo), np.diff(offsets))
                for terms in _terms(flat):
                    coded = terms.dictionary_encode()
                    width = max(len(coded.dictionary), 1)
                    pairs = np.unique(doc * width + np.asarray(coded.indices))
                    kind = toxic[lo:hi][pairs // width]
                    both = [np.bincount(pairs[kind == k] % width, minlength=len(coded.dictionary)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), *map(pa.array, both)],
                                                     ["word", "clean", "toxic"])

    words = (texts.select("text", "toxic").mapInArrow(count, "word string, clean long, toxic long")
             .where("word not in ('', '*')").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    kinds = {r[0]: r[1] for r in texts.groupBy("toxic").agg(F.count(F.lit(1))).collect()}
    if not kinds.get(0) or not kinds.get(1):
        return None
    # signed root of the log-likelihood ratio's leading term: difference over its standard error
    a, b = F.col("toxic") / kinds[1], F.col("clean") / kinds[0]
    both = (F.col("toxic") + F.col("clean")) / (kinds[0] + kinds[1])
    z = (a - b) / F.sqrt(both * (1 - both) * (1 / kinds[0] + 1 / kinds[1]) + 1e-9)
    best = (words.where(F.col("toxic") + F.col("clean") >= LEAST_DOCS).withColumn("z", z)
            .where(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "word").limit(FEATURES).toArrow())
    if not best.num_rows:
        return None
    vocabulary = best.column("word").combine_chunks().cast(pa.large_string())

    def featurize(batches):
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                doc, word = term_ids(batch.column(0).slice(lo, hi - lo), vocabulary)
                r, c, x = _features(doc, word, len(vocabulary))
                ends = np.searchsorted(r, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(c)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(x))], ["toxic", "c", "x"])

    # at most ``sample`` documents of at most FEATURES words
    got = texts.select("text", "toxic").mapInArrow(featurize, "toxic int, c array<long>, x array<double>").toArrow()
    toxic = np.asarray(got.column("toxic"))
    lists = got.column("c").combine_chunks()
    row = np.repeat(np.arange(len(toxic)), np.diff(np.asarray(lists.offsets)))
    w, t = fit_hidden(row, np.asarray(lists.flatten()), np.asarray(got.column("x").combine_chunks().flatten()),
                      len(vocabulary), toxic.astype(np.int64))
    keep = np.abs(w) > 1e-3
    return Model([x for x, k in zip(vocabulary.to_pylist(), keep) if k], w[keep], t)


def score(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, severity, grade, toxic_probability, toxic)`` of every document."""
    text_batches(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    names = ["doc_id", "severity", "grade", "toxic_probability", "toxic"]
    words = pa.array(model.words if model else [], type=pa.large_string())

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch.column(1)):
                if model is None:
                    chances = np.repeat([[1.0] + [0.0] * (GRADES - 1)], hi - lo, axis=0)
                else:
                    r, c, x = _features(*term_ids(batch.column(1).slice(lo, hi - lo), words), max(len(words), 1))
                    chances = model.grade_chances(np.bincount(r, weights=x * model.weights[c], minlength=hi - lo))
                any_ = 1 - chances[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(chances @ np.arange(GRADES)),
                     pa.array(chances.argmax(axis=1).astype(np.int32)), pa.array(any_), pa.array(any_ >= 0.5)], names)

    return (documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {key}, severity double, grade int, toxic_probability double, toxic boolean"))


def rate(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, train(documents, labels))
