import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagewright.operators import incremental as I

ARRIVALS = "arrival_id bigint, file_path string, file_hash string, modified_at timestamp, h string, v int"
TRACKED = "id bigint, file_hash string, status string, completed_at timestamp, sides int"
T = lambda d: dt.datetime(2031, 3, d)


def pending(spark, arrivals, tracked):
    a, t = spark.createDataFrame(arrivals, ARRIVALS), spark.createDataFrame(tracked, TRACKED)
    both = [sorted(r[0] for r in f(a, t).collect()) for f in (I.pending_content, I.pending_by_versions)]
    assert both[0] == both[1]
    return both[0]


def test_current_version_and_commits(spark):
    arrivals = [
        (1, "a", " AA ", T(1), "x", 1), (2, "a", "bb", T(2), "x", 1), (3, "a", "cc", T(2), "x", 1),  # a tie goes to the later arrival
        (3, "a", "cc", T(2), "x", 1), (4, "b", "dd", T(1), None, None), (5, "b", "EE", None, None, None), (6, None, "ff", T(9), None, None), (7, "c", "  ", T(1), None, None), (8, "d", None, T(1), None, None), (9, "e", "gg", T(1), None, None),
    ]
    tracked = [(1, "DD ", "COMPLETE", T(3), 0), (2, "cc", "COMPLETE", None, 0), (3, "gg", "FAILED", T(3), 0), (3, "gg", "FAILED", T(3), 0)]
    assert pending(spark, arrivals, tracked) == ["cc", "gg"]


def test_empty_tables(spark):
    assert pending(spark, [], []) == []
    assert pending(spark, [(1, "a", "x", T(1), None, None)], []) == ["x"]
    assert pending(spark, [], [(1, "x", "COMPLETE", T(1), 0)]) == []


def test_diff_is_null_safe_and_counts_once(spark):
    a, b = spark.createDataFrame([("x",), ("x",), (None,)], "k string"), spark.createDataFrame([("y",), (None,)], "k string")
    assert sorted(tuple(r) for r in I.diff_manifests(a, b, ["k"]).collect()) == [("x", "removed"), ("y", "added")]


def keys(df):
    return sorted((r["k"], r["_change"]) for r in df.collect())


def test_versioned_table_changes_and_deletion_vectors(spark, tmp_path):
    t = I.VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.version() == 0 and t.manifest()["files"] == {}
    t.commit(add=spark.range(10).select(F.col("id").alias("k"), F.lit("n").alias("_v")).coalesce(1))
    t.commit(add=spark.range(10, 15).select(F.col("id").alias("k"), F.lit("n").alias("_v")).coalesce(1))
    assert t.snapshot().count() == 15 and t.snapshot(1).count() == 10
    assert keys(t.changes(1, 2)) == [(k, "added") for k in range(10, 15)]
    live = t.rows(t.manifest()["files"])
    t.commit(delete=live.where("k IN (3, 12)"))
    assert keys(t.changes(2, 3)) == [(3, "removed"), (12, "removed")]
    live = t.rows(t.manifest()["files"])
    t.commit(delete=live.where("k = 4"))
    assert sorted(r["k"] for r in t.snapshot().collect()) == [k for k in range(15) if k not in (3, 4, 12)]
    first = next(n for n, v in t.manifest()["files"].items() if n in t.manifest(1)["files"])
    t.commit(remove=[first])
    assert keys(t.changes(4, 5)) == [(k, "removed") for k in range(10) if k not in (3, 4)]
    assert keys(t.changes(0, 5)) == [(k, "added") for k in (10, 11, 13, 14)]


def test_processing_survives_failure_and_rivals(spark, tmp_path):
    source, sink = I.VersionedTable(spark, f"file://{tmp_path}/s"), I.VersionedTable(spark, f"file://{tmp_path}/o")
    step = lambda df: df.where("_change = 'added'").select("k")
    assert I.process_new(source, sink, step) is None
    source.commit(add=spark.range(3).toDF("k"))
    with pytest.raises(ZeroDivisionError):
        I.process_new(source, sink, lambda df: 1 / 0)
    assert sink.version() == 0
    assert I.process_new(source, sink, step) == 1 and I.process_new(source, sink, step) is None
    source.commit(add=spark.range(3, 5).toDF("k"))
    source.commit(add=spark.range(5, 6).toDF("k"))
    assert I.process_new(source, sink, step) == 3
    assert sorted(r["k"] for r in sink.snapshot().collect()) == list(range(6))
    before = {p.name for p in (tmp_path / "o").iterdir()}
    with pytest.raises(I.CommitConflict):
        sink.commit(add=spark.range(1).toDF("k"), base=sink.version() - 1)
    assert sorted(r["k"] for r in sink.snapshot().collect()) == list(range(6))
    assert {p.name for p in (tmp_path / "o").iterdir()} == before  # the loser leaves no files behind
