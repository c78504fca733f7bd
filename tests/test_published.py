"""Outputs by manifest: a failed run changes nothing, a replayed one adds nothing."""
import pytest
from pyspark.sql import functions as F

from cardforge.sinks import published as P


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def failing(spark):
    """Rows of which one raises when it is computed."""
    return spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("int").alias("v"))


def live(spark, path):
    d = P.read_published(spark, path)
    return None if d is None else sorted(r.v for r in d.collect())


def test_append_and_refresh(spark, tmp_path):
    path = str(tmp_path / "out")
    assert live(spark, path) is None
    assert P.append_run(rows(spark, 1, 2), path, "r1") and P.append_run(rows(spark, 3), path, "r2")
    assert live(spark, path) == [1, 2, 3]
    assert not P.append_run(rows(spark, 3), path, "r2") and live(spark, path) == [1, 2, 3]  # replayed
    assert P.refresh_run(rows(spark, 9), path, "r3") and live(spark, path) == [9]
    assert not P.append_run(rows(spark, 1, 2), path, "r1") and live(spark, path) == [9]  # replayed after it was replaced
    assert P.append_run(rows(spark), path, "empty") and live(spark, path) == [9]
    assert [f.rsplit("=", 1)[1] for f in P.expired_runs(spark, path, keep=1)] == ["r1", "r2"]
    assert sorted(r.v for r in P.read_published(spark, path, version=2).collect()) == [1, 2, 3]  # an older version


def test_a_run_that_fails_while_it_writes(spark, tmp_path):
    path = str(tmp_path / "out")
    P.refresh_run(rows(spark, 1, 2), path, "good")
    for write in (P.refresh_run, P.append_run):
        with pytest.raises(Exception):
            write(failing(spark), path, "bad")
        assert live(spark, path) == [1, 2]
    assert P.refresh_run(rows(spark, 5), path, "bad") and live(spark, path) == [5]  # tried again


def test_a_run_that_fails_between_staging_and_publishing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    P.refresh_run(rows(spark, 1), path, "good")

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(P, "publish", stop)
        for write in (P.append_run, P.refresh_run):
            with pytest.raises(RuntimeError):
                write(rows(spark, 7, 8), path, "late")
            assert live(spark, path) == [1]
    assert [f.rsplit("=", 1)[1] for f in P.expired_runs(spark, path)] == ["late"]
    # a manifest without its mark does not count
    rows(spark, 0).select(F.lit("late").alias("run"), F.lit(None).cast("string").alias("subject")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/manifest/v=2")
    assert live(spark, path) == [1] and P.versions(spark, path) == [1]
    assert P.append_run(rows(spark, 7, 8), path, "late") and live(spark, path) == [1, 7, 8]


def test_subjects_change_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")

    def items(*pairs):
        return spark.createDataFrame(list(pairs), "subject string, v int")

    def now():
        return sorted((r.subject, r.v) for r in P.read_published(spark, path).collect())

    P.write_subjects_run(items(("art", 1), ("art", 2), ("7", 3), (None, 4)), path, "a")
    assert now() == [("7", 3), ("art", 1), ("art", 2), ("unknown", 4)]
    P.write_subjects_run(items(("art", 5), ("bio", 6)), path, "b")
    assert now() == [("7", 3), ("art", 5), ("bio", 6), ("unknown", 4)]
    assert not P.write_subjects_run(items(("art", 1)), path, "a")
    assert P.write_subjects_run(items(), path, "none") and not P.write_subjects_run(items(), path, "none")
    monkeypatch.setattr(P, "BROADCAST_ENTRIES", 0)
    assert now() == [("7", 3), ("art", 5), ("bio", 6), ("unknown", 4)]
    with pytest.raises(ValueError):
        P.append_run(items(), path, "../x")
