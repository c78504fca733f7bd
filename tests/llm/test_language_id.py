import random
import zlib

from cardforge.llm import language_id as li

SOUNDS = {"en": ["the", "ing", "er", "th", "and", "wh"], "de": ["sch", "ung", "ein", "ü", "ch", "tz"], "es": ["ción", "os", "que", "ñ", "ado", "rr"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy_and_mixtures(spark):
    rng = random.Random(8)
    rows = [(i, text(rng, lang, rng.randint(5, 60)), lang if rng.random() < 0.9 else None, lang)
            for i in range(400) for lang in [rng.choice(list(SOUNDS))]]
    mixed = [(1000 + i, text(rng, "en", 60) + " " + text(rng, "de", 30), None, "en") for i in range(20)]
    docs = spark.createDataFrame([r[:3] for r in rows + mixed], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in li.identify(docs).collect()}
    for i, _, _, true in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert len(held) > 50 and sum(got[r[0]]["lang_pred"] == r[3] for r in held) >= 0.97 * len(held)
    assert all(got[1000 + i]["lang_pred"] == "en" and 0.45 < got[1000 + i]["score"] < 0.9 for i in range(20))


def test_labels_of_held_out_documents_do_not_matter(spark):
    rng = random.Random(9)
    rows = [(i, text(rng, lang, 20), lang) for i in range(150) for lang in [rng.choice(list(SOUNDS))]]
    a = li.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    held = {r["doc_id"] for r in a if r["held_out"]}
    other = [(i, t, "zz" if i in held else x) for i, t, x in rows]
    b = li.identify(spark.createDataFrame(other, "doc_id long, text string, lang string")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_edges(edge_docs, edge_rows, no_docs, spark):
    got = li.identify(edge_docs).collect()
    assert len(got) == len(edge_rows)
    texts = {r[0]: r[1] for r in edge_rows}
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["lang_pred"] == "und") == (t is None or not any(c.isalpha() for c in t)) and 0 <= r["score"] <= 1
    assert li.identify(no_docs).collect() == []
    unlabelled = edge_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {tuple(r)[2:] for r in li.identify(unlabelled).collect()} == {("und", 0.0)}
    kept = li.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns and 0 < kept.count() < len(edge_rows)


def test_more_languages_than_candidates():
    import numpy as np

    rng = np.random.default_rng(1)
    probs = rng.dirichlet(np.full(li.BUCKETS, 0.05), size=12).T.astype(np.float32) + 1e-9
    doc = np.repeat(np.arange(12), 300)
    bucket = np.concatenate([rng.choice(li.BUCKETS, 300, p=probs[:, j].astype(float) / probs[:, j].astype(float).sum()) for j in range(12)])
    best, score = li.infer(doc, bucket, 12, probs)
    assert best.tolist() == list(range(12)) and (score > 0.8).all()


def test_mixed_document_among_many_languages(monkeypatch):
    """The largest part of a document leads, also when each of many other languages explains it better alone."""
    import numpy as np

    rng = np.random.default_rng(2)
    common = rng.dirichlet(np.full(li.BUCKETS // 2, 0.05))
    probs = np.zeros((li.BUCKETS, 14))
    for j in range(13):
        probs[:li.BUCKETS // 2, j] = 0.8 * common + 0.2 * rng.dirichlet(np.full(li.BUCKETS // 2, 0.05))
    probs[li.BUCKETS // 2:, 13] = rng.dirichlet(np.full(li.BUCKETS // 2, 0.05))
    probs = (probs + 1e-6) / (probs + 1e-6).sum(axis=0)
    parts = [rng.choice(li.BUCKETS, 900, p=probs[:, 13])] + [rng.choice(li.BUCKETS, 85, p=probs[:, j]) for j in range(13)]
    bucket = np.tile(np.concatenate(parts), 3)
    doc = np.repeat(np.arange(3), len(bucket) // 3)
    whole = li.infer(doc, bucket, 4, probs.astype(np.float32))
    assert whole[0].tolist() == [13, 13, 13, -1] and (whole[1][:3] > 0.4).all()
    monkeypatch.setattr(li, "BLOCK_CELLS", 14)
    blocks = li.infer(doc, bucket, 4, probs.astype(np.float32))
    assert blocks[0].tolist() == whole[0].tolist() and np.allclose(blocks[1], whole[1])
