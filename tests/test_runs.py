"""Totals, numbers and snapshots that last over runs."""
import random

import pytest
from pyspark.sql import functions as F

from cardforge.operators import numbering as N
from cardforge.sources import snapshot as S
from cardforge.streaming import streams, totals


def test_totals_of_a_stream_with_replays_and_compaction(spark, tmp_path):
    rng = random.Random(2)
    batches = [[(rng.choice(["a", "b", None]),) for _ in range(rng.randint(1, 30))] for _ in range(5)]
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    keys = {"subject": F.col("s")}

    def now():
        return {r.subject: r.n_items for r in totals.read_totals(spark, out).collect()}

    def want(upto):
        flat = [x[0] for b in batches[:upto] for x in b]
        return {s: flat.count(s) for s in set(flat)}

    assert totals.read_totals(spark, out) is None and totals.compact(spark, out) is None
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "s string").coalesce(1).write.mode("append").parquet(src)
        totals.stream_totals(streams.page_stream(spark, src, 1), keys, out, ckpt).awaitTermination()
        assert now() == want(k + 1)
        if k in (1, 3):
            assert totals.compact(spark, out) == k and totals.compact(spark, out) == k
            assert now() == want(k + 1)
        # the batch is delivered again, before or after it was folded into the base
        totals.write_partial(spark.createDataFrame(rows, "s string"), keys, out, k)
        assert now() == want(k + 1)


def test_numbers_go_on(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")

    def run(rows, batch):
        d = spark.createDataFrame(rows, "row_no long, n long").repartition(3)
        return sorted(tuple(r) for r in N.number_batch(d, path, batch).collect())

    assert run([(3, 2), (1, 3), (2, 0)], "one") == [(1, 1, 3), (2, 4, 0), (3, 4, 2)]
    assert run([(10, 1), (3, 2), (5, 4)], "two") == [(3, 4, 2), (5, 6, 4), (10, 10, 1)]  # 3 came again
    assert run([(10, 1), (3, 2), (5, 4)], "two") == [(3, 4, 2), (5, 6, 4), (10, 10, 1)]  # replayed
    assert run([(1, 9), (4, 1), (4, 2), (None, 5)], "three") == [(1, 1, 3), (4, 11, 2)]
    assert run([], "none") == [] and N.numbered_upto(spark, path) == 12
    # a batch that fails before its total is written is done again, from the same number
    real = N.numbered_upto

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(N, "prefix_offsets", stop)
        with pytest.raises(RuntimeError):
            run([(20, 2)], "four")
    spark.createDataFrame([(20, 99, 2)], N.INTERVAL).write.parquet(f"{path}/intervals/batch=four")
    assert real(spark, path) == 12 and run([(20, 2), (21, 1)], "four") == [(20, 13, 2), (21, 15, 1)]
    numbers = sorted(x for r in N.ledger(spark, path).collect() for x in range(r.first, r.first + r.n))
    assert numbers == list(range(1, 16))


def test_a_snapshot_is_read_by_url(spark, tmp_path):
    path = str(tmp_path / "snap")
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://h/"), F.col("id")).alias("url"),
                                     F.repeat(F.lit("x"), 50).alias("html"), F.lit(1).alias("extra"))
    pages = pages.union(pages.where("page_id = 7")).union(pages.where("page_id = 8").withColumn("url", F.lit(None).cast("string")))
    S.write_snapshot(pages, path, files=16)
    few = spark.createDataFrame([("https://h/7",), ("https://h/7",), ("https://h/99",), ("https://gone/",), (None,)], "url string")
    got = S.read_urls(spark, path, few)
    assert got.columns == pages.columns and sorted(r.page_id for r in got.collect()) == [7, 7, 99]
    assert len(got.inputFiles()) <= 3  # one a wanted URL at most
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "url_hash" in plan.split("PushedFilters")[1].split("]")[0]
    assert S.read_urls(spark, path, few.where("url = 'https://gone/'")).count() == 0
    assert S.read_urls(spark, path, few.limit(0)).count() == 0
    many = pages.where("page_id % 2 = 0").select("url")
    assert S.read_urls(spark, path, many).count() == 2000
