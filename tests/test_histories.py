import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from silvertide.operators import history as H
from silvertide.sources import histories, versions

KIND = "k string, v string, w double, note string"
KEYS, TRACKED = ["k"], ["v", "w"]


def _rows(df):
    return Counter(map(tuple, df.select("k", "v", "w", "note", "valid_from", "valid_to", "is_current").collect()))


def test_bucketed_history_equals_the_full_merge(spark, tmp_path):
    rng, path = random.Random(7), str(tmp_path / "h")
    full = None
    for day in range(1, 5):
        rows = [(f"k{i}", rng.choice(["a", "b", None]), rng.choice([1.0, None]), f"n{day}") for i in range(60) if rng.random() < 0.7]
        snapshot = spark.createDataFrame(rows + rows[:5], KIND)
        stamp = f"2026-01-0{day} 10:00:00"
        if full is None:
            full = snapshot.limit(0).select("*", F.lit(stamp).cast("timestamp").alias("valid_from"),
                                            F.lit(stamp).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
        full = spark.createDataFrame(H.scd2_merge(full, snapshot, KEYS, TRACKED, stamp).collect(), full.schema)
        histories.merge_history(snapshot, path, KEYS, TRACKED, stamp, buckets=8)
        assert _rows(histories.read_history(spark, path)) == _rows(full)


def test_only_buckets_with_changes_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = [(f"k{i}", "a", 1.0, None) for i in range(500)]
    first = histories.merge_history(spark.createDataFrame(rows, KIND), path, KEYS, TRACKED, "2026-01-01", buckets=64)
    assert len(first) == 64 and versions.manifest(spark, path).version == 1
    files = {f for f in versions.read(spark, path).inputFiles()}
    rows[3], rows[4] = ("k3", "b", 1.0, None), ("k4", "a", None, None)
    touched = histories.merge_history(spark.createDataFrame(rows + [("new", "a", 0.0, None)], KIND), path, KEYS, TRACKED, "2026-01-02")
    assert 1 <= len(touched) <= 3
    now = versions.read(spark, path)
    untouched = {f for f in files if int(f.split("balde=")[1].split("/")[0]) not in touched}
    assert untouched <= set(now.inputFiles()) and len(set(now.inputFiles()) & files) == len(untouched)
    assert now.count() == 503 and now.where("is_current").count() == 501
    closed = {f for f in now.inputFiles() if "is_current=false" in f}
    assert closed
    rows[3] = ("k3", "c", 1.0, None)
    histories.merge_history(spark.createDataFrame(rows, KIND), path, KEYS, TRACKED, "2026-01-03")
    assert closed <= set(versions.read(spark, path).inputFiles())
    assert sorted(r.v for r in histories.read_history(spark, path).where("k = 'k3'").collect()) == ["a", "b", "c"]


def test_nothing_changed_and_nothing_there(spark, tmp_path):
    path, snapshot = str(tmp_path / "h"), spark.createDataFrame([("a", None, None, "x")], KIND)
    histories.merge_history(snapshot, path, KEYS, TRACKED, "2026-01-01", buckets=4)
    assert histories.merge_history(snapshot.withColumn("note", F.lit("y")), path, KEYS, TRACKED, "2026-01-02") == []
    assert histories.merge_history(snapshot.limit(0), path, KEYS, TRACKED, "2026-01-02") == []
    assert versions.versions(spark, path) == [1]
    empty = str(tmp_path / "e")
    histories.merge_history(snapshot.limit(0), empty, KEYS, TRACKED, "2026-01-01", buckets=4)
    assert histories.read_history(spark, empty).count() == 0
    histories.merge_history(snapshot, empty, KEYS, TRACKED, "2026-01-02")
    row = histories.read_history(spark, empty).first()
    assert row.k == "a" and row.valid_from == datetime(2026, 1, 2)


def test_null_keys_and_a_second_writer_are_errors(spark, tmp_path):
    path, snapshot = str(tmp_path / "h"), spark.createDataFrame([("a", "1", 1.0, "x")], KIND)
    histories.merge_history(snapshot, path, KEYS, TRACKED, "2026-01-01", buckets=4)
    with pytest.raises(Exception, match="k is required"):
        histories.merge_history(spark.createDataFrame([(None, "1", 1.0, "x")], KIND), path, KEYS, TRACKED, "2026-01-02")
    with pytest.raises(RuntimeError, match="another writer"):
        versions.replace_partitions(versions.read(spark, path), path, histories.PARTITIONS, None, based_on=0)
    assert versions.versions(spark, path) == [1]
