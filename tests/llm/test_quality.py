import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cardforge.llm import quality

from samples import words

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_and_base_rule(edge_docs, edge_rows, no_docs):
    got = quality.quality_rules(edge_docs).collect()
    want = []
    for i, t, *_ in edge_rows:
        c = brute_counts(t)
        want.append((i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(want, key=repr)
    # too few documents for an estimate: the base rule decides
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.quality_rules(no_docs).collect() == []
    kept = quality.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_outliers_of_language_and_source(spark):
    rng = random.Random(2)
    rows = []
    for i in range(700):
        w = words(rng, rng.randint(60, 300), "abcdefghijklmnop")
        rows.append((i, " ".join(w), "en", "s0" if i < 400 else "s1"))
    for i in range(700, 730):  # a text full of symbols is an outlier of its source
        rows.append((i, " ".join(x + "%%%" for x in words(rng, 100, "abcdefghijklmnop")), "en", "s0"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()}
    assert not any(got[i] for i in range(700, 730))
    assert sum(got[i] for i in range(700)) == 700


def test_distance_is_mahalanobis(spark):
    """The whitening factors invert the regularised covariance."""
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.standard_normal((quality.P, quality.P))
    x = rng.standard_normal((500, quality.P)) @ a
    c, e = x.mean(axis=0), x.T @ x / len(x)
    row = ([float(v) for v in c], [float(e[j, k]) for j, k in quality.PAIRS])
    d = spark.createDataFrame([row], "c array<double>, e array<double>")
    w = np.array(d.select(quality.whitening(quality.covariance(F.col("c"), F.col("e")))).first()[0])
    cov = (e - np.outer(c, c)) * (1 - quality.RIDGE) + quality.RIDGE * np.eye(quality.P)
    assert np.allclose(np.triu(w, 1), 0) and np.allclose(w.T @ w, np.linalg.inv(cov))


def plain_estimates(groups):
    """The estimate of the module docstring, by numpy: ``{(lang, source): (mu, s, cov, unit)}``."""
    import numpy as np

    p, floors = quality.P, np.array(list(quality.STATISTICS.values()))

    def lower_median(values):
        v = np.sort(values, axis=0)
        return v[int(np.ceil(0.5 * len(v))) - 1]

    def regular(cov):
        return cov * (1 - quality.RIDGE) + quality.RIDGE * np.eye(p)

    def distances(z, cov):
        return np.einsum("ij,jk,ik->i", z, np.linalg.inv(regular(cov)), z)

    def log_bin(d):
        return np.floor(np.log(d + 1e-9) * 50)

    def unit(d, share=1.0):
        return max(np.exp((lower_median(log_bin(d)) + 0.5) / 50) / quality.chi2_quantile(1 - share / 2), 1.0)

    def robust(x):
        bins = np.floor(x * quality.STEP)
        m = lower_median(bins)
        mu = (m + 0.5) / quality.STEP
        s = np.maximum(1.4826 * (lower_median(np.abs(bins - m)) + 0.5) / quality.STEP, floors)
        cov = np.eye(p)
        white = np.linalg.inv(np.linalg.cholesky(np.eye(p)))
        for _ in range(200):
            z = (x - mu) / s
            d = np.einsum("ij,ij->i", z @ white.T, z @ white.T)
            b = log_bin(d)
            half, weight, before = min(len(x), (len(x) + p + 1) // 2), np.zeros(len(x)), 0
            for v in np.unique(b):
                n = int((b == v).sum())
                weight[b == v] = min(1.0, max(0.0, (half - before) / n))
                before += n
            c = weight @ z / half
            cov = (z * weight[:, None]).T @ z / half - np.outer(c, c)
            new = np.linalg.inv(np.linalg.cholesky(regular(cov)))
            change = max(np.abs(c).max(), np.abs(np.diag(white) / np.diag(new) - 1).max())
            last, mu, white = d, mu + c * s, new
            if change <= quality.SETTLED:
                break
        z = (x - mu) / s
        inside = distances(z, cov) <= unit(last) * quality.chi2_quantile(1 - quality.INSIDE)
        z = z[inside]
        return {"x": x[inside], "n": len(z), "mu": mu + s * z.mean(axis=0), "cov": np.cov(z.T, bias=True) * np.outer(s, s)}

    def weight(e):
        n = max(e["n"] - 2 * p, 0)
        return n / (n + quality.PRIOR)

    def finish(e, parent):
        a = weight(e) if parent else 1.0
        for name in ("mu", "cov"):
            e[name] = a * e[name] + (1 - a) * parent[name] if parent else e[name]
        e["s"] = np.maximum(np.sqrt(np.diag(e["cov"])), floors)
        e["r"] = e["cov"] / np.outer(e["s"], e["s"])
        own = np.log(unit(distances((e["x"] - e["mu"]) / e["s"], e["r"]), quality.INSIDE))
        e["log_unit"] = a * own + (1 - a) * parent["log_unit"] if parent else own
        return e

    whole = finish(robust(np.concatenate(list(groups.values()))), None)
    langs = {lang: finish(robust(np.concatenate([x for (g, _), x in groups.items() if g == lang])), whole)
             for lang in {lang for lang, _ in groups}}
    found = {key: finish(robust(x), langs[key[0]]) for key, x in groups.items()}
    return lambda key, x: distances((x - found[key]["mu"]) / found[key]["s"], found[key]["r"]) / np.exp(found[key]["log_unit"])


def test_distances_against_plain_estimates(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    groups, rows = {}, []
    for lang, source, n, junk in (("en", "a", 300, 40), ("en", "b", 60, 5), ("en", "c", 9, 1), ("de", "a", 150, 0), (None, None, 30, 12)):
        x = rng.standard_normal((n, quality.P)) * [0.5, 0.1, 0.05, 0.02, 0.05, 0.03] + [5, 1.7, 0.1, 0.0, 0.2, 0.2]
        x[:junk] += [0, 0, 1.5, 0, 0, 0]
        groups[lang, source] = x
        rows += [(f"{lang}/{source}", lang, False, [float(v) for v in r]) for r in x]
    data = spark.createDataFrame(rows, "key string, lang string, failed boolean, x array<double>").repartition(5)
    est = quality.fit(data)
    counts = F.struct(F.lit(60).alias("n_words"))
    measured = data.select(F.struct(F.lit(1).alias("one")).alias("row"), F.struct(counts.alias("counts"), "failed", "key", "lang", "x").alias("_q"))
    got = {tuple(r.x): r.d for r in quality.rate(measured, est).select("_q.x", F.col("_v.distance2").alias("d")).collect()}
    plain = plain_estimates(groups)
    for key, x in groups.items():
        for r, d in zip(x, plain(key, x)):
            assert abs(got[tuple(float(v) for v in r)] / d - 1) < 0.02, key  # a distance on a bin's edge may fall on either side


def test_junk_in_small_inputs(spark):
    """No number of documents switches the verdict on or off."""
    for n in (60, 120, 199, 220):
        rng = random.Random(n)
        rows = [(i, " ".join(words(rng, rng.randint(60, 300), "abcdefghijklmnop")), "en", "s0") for i in range(n)]
        rows += [(n + i, " ".join(x + "%%%" for x in words(rng, 100, "abcdefghijklmnop")), "en", "s0") for i in range(n // 20)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        kept = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
        assert kept == set(range(n)), n


def test_many_pools_without_broadcasts(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, 80, "abcdefghijklmnop")) + (" %" * 60 if i % 40 == 0 else ""), f"l{i % 2}", f"s{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = sorted((r.doc_id, r.kept, round(r.distance2, 6)) for r in quality.quality_rules(docs).collect())
    monkeypatch.setattr(quality, "BROADCAST_POOLS", 0)
    assert sorted((r.doc_id, r.kept, round(r.distance2, 6)) for r in quality.quality_rules(docs).collect()) == want


def test_no_python_in_the_plan(edge_docs):
    plan = quality.measured(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quantile():
    assert abs(quality.chi2_quantile(0.05, 6) - 12.5916) < 1e-3
    assert F is not None


def test_junk_of_nearly_half_a_source(spark):
    """Far junk, distinct or copies of one text, does not hide itself."""
    rng = random.Random(3)
    rows, junk = [], set()
    for source, share, copied in (("d35", 35, False), ("d45", 45, False), ("c35", 35, True), ("c45", 45, True)):
        one = " ".join(x + "%" for x in words(rng, 120, "abcdefghijklmnop"))
        for i in range(400):
            w = words(rng, rng.randint(60, 300), "abcdefghijklmnop")
            bad = i % 100 < share
            if bad:
                junk.add(len(rows))
            rows.append((len(rows), (one if copied else " ".join(x + "%" for x in w)) if bad else " ".join(w), "en", source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
    assert not kept & junk
    assert len(kept) == len(rows) - len(junk)


def test_texts_of_mostly_equal_lines(spark):
    """Repeated lines alone reject a text when most of it is them, not when a third is."""
    rng = random.Random(6)
    rows = [(i, "\n".join(" ".join(words(rng, 30, "abcdefghijklmnop")) for _ in range(rng.randint(3, 9))), "en", "s") for i in range(300)]
    prose = " ".join(words(rng, 220, "abcdefghijklmnop"))
    mostly = [prose + "\nRead more" * 100, "Read more\n" * 40 + prose]
    third = [prose + "\nRead more\nRead more", "Read all of it\n" + prose + "\nRead all of it"]
    rows += [(1000 + i, t, "en", "s") for i, t in enumerate(mostly + third)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.quality_rules(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [got[1000 + i]["kept"] for i in range(4)] == [False, False, True, True]
    assert all(got[i]["kept"] for i in range(300))
