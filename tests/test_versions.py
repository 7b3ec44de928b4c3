import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from contract.gold import TEST_KEYS
from silvertide.plans.governance import TABLE_ASPECTS
from silvertide.sources import tables, versions


def hour(tmp_path, day, number, lines):
    folder = tmp_path / "in" / f"fecha={day}" / f"hora={number}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "transacciones.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def load(spark, tmp_path, hours):
    tables.load_hours(spark, str(tmp_path / "in"), str(tmp_path / "silver"), ["2026-03-25"], hours, "2026-03-26", TEST_KEYS, str(tmp_path / "bad"))


def rows(spark, path, column):
    return sorted((r.hora, r[column]) for r in versions.read(spark, str(path)).select("hora", column).collect())


def test_hour_that_turned_bad_is_emptied_and_repaired_hour_clears_its_rejects(spark, tmp_path):
    hour(tmp_path, "2026-03-25", 10, [{"id_transaccion": "a"}, "{broken"])
    hour(tmp_path, "2026-03-25", 11, [{"id_transaccion": "b"}])
    load(spark, tmp_path, [10, 11])
    assert rows(spark, tmp_path / "silver", "id_transaccion") == [(10, "a"), (11, "b")] and rows(spark, tmp_path / "bad", "motivo") == [(10, "ilegible")]
    hour(tmp_path, "2026-03-25", 10, ["{worse"])
    load(spark, tmp_path, [10])
    assert rows(spark, tmp_path / "silver", "id_transaccion") == [(11, "b")] and rows(spark, tmp_path / "bad", "_corrupt_record") == [(10, "{worse")]
    hour(tmp_path, "2026-03-25", 10, [{"id_transaccion": "c"}])
    load(spark, tmp_path, [9, 10])  # hour 9 has not arrived
    assert rows(spark, tmp_path / "silver", "id_transaccion") == [(10, "c"), (11, "b")] and rows(spark, tmp_path / "bad", "motivo") == []


def test_hour_that_has_not_arrived_stays(spark, tmp_path, capsys):
    hour(tmp_path, "2026-03-25", 7, [{"id_transaccion": "a"}])
    load(spark, tmp_path, [7])
    (tmp_path / "in" / "fecha=2026-03-25" / "hora=7").rename(tmp_path / "moved")
    load(spark, tmp_path, [7])
    assert "no input for 1 of 1 hours" in capsys.readouterr().out
    assert rows(spark, tmp_path / "silver", "id_transaccion") == [(7, "a")]


@pytest.mark.parametrize("step", ["write", "rename_new"])
def test_failed_load_leaves_the_last_version(spark, tmp_path, monkeypatch, step):
    hour(tmp_path, "2026-03-25", 10, [{"id_transaccion": "a"}])
    load(spark, tmp_path, [10])
    hour(tmp_path, "2026-03-25", 10, [{"id_transaccion": "b"}])
    with monkeypatch.context() as m:
        m.setattr(versions.Files, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load(spark, tmp_path, [10])
    assert rows(spark, tmp_path / "silver", "id_transaccion") == [(10, "a")]
    load(spark, tmp_path, [10])
    assert rows(spark, tmp_path / "silver", "id_transaccion") == [(10, "b")]


def test_rows_outside_of_the_scope_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "p int, v string")
    versions.replace_partitions(df, path, ["p"], [(1,), (2,)])
    with pytest.raises(ValueError, match="outside"):
        versions.replace_partitions(df, path, ["p"], [(1,)])
    assert versions.read(spark, path).count() == 2 and versions.versions(spark, path) == [1]


def test_partitions_of_several_snapshots(spark, tmp_path):
    path, make = str(tmp_path / "t"), lambda rows: spark.createDataFrame(rows, "p int, v string")
    versions.replace_partitions(make([(1, "a"), (2, "a"), (3, "a")]), path, ["p"])
    versions.replace_partitions(make([(2, "b"), (3, "b")]), path, ["p"])
    versions.append(make([(3, "c"), (4, "c")]), path, ["p"])
    versions.replace_partitions(make([(4, "d")]), path, ["p"], [(1,), (4,), (9,)])
    got = {(r.p, r.v) for r in versions.read(spark, path).collect()}
    assert got == {(2, "b"), (3, "b"), (3, "c"), (4, "d")}
    assert {(r.p, r.v) for r in versions.read(spark, path, 1).collect()} == {(1, "a"), (2, "a"), (3, "a")}
    versions.replace_partitions(make([]), path, ["p"], [(2,), (3,), (4,)])
    assert versions.read(spark, path).columns == ["p", "v"] and versions.read(spark, path).count() == 0


def test_reader_keeps_its_version_and_columns_may_change(spark, tmp_path):
    path = str(tmp_path / "t")
    old = tables.publish_gold(spark.range(5), path)
    new = tables.publish_gold(old.select(F.col("id").alias("other")).limit(2), path)  # made from the version it replaces
    assert old.count() == 5 and old.columns == ["id"] and new.count() == 2 and new.columns == ["other"]


def test_publication_that_fails_midway(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_gold(spark.range(5), path)
    broken = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        tables.publish_gold(broken, path)
    assert versions.read(spark, path).count() == 5


def test_second_writer_builds_on_the_first(spark, tmp_path, monkeypatch):
    path, make = str(tmp_path / "t"), lambda p, v: spark.createDataFrame([(p, v)], "p int, v string")
    versions.replace_partitions(make(1, "a"), path, ["p"])
    original, raced = versions.Files.rename_new, []

    def late(self, source, target):
        if not raced:
            raced.append(1)
            versions.replace_partitions(make(2, "first"), path, ["p"])
        return original(self, source, target)

    monkeypatch.setattr(versions.Files, "rename_new", late)
    versions.replace_partitions(make(3, "second"), path, ["p"])
    assert {r.v for r in versions.read(spark, path).collect()} == {"a", "first", "second"} and versions.versions(spark, path) == [1, 2, 3]


def test_expired_versions_go_with_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        versions.replace_table(spark.range(n + 1), path)
    assert versions.expire(spark, path, datetime(2000, 1, 1)) == []
    assert versions.expire(spark, path, datetime.now(timezone.utc) + timedelta(hours=1)) == [1, 2]
    assert versions.read(spark, path).count() == 3 and len(list((tmp_path / "t" / "data").glob("*=*"))) == 1


def test_sets_and_aspects(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2):
        made = {name: versions.replace_table(spark.range(n), f"{root}/{name}").version for name in ("a", "b")}
        if n == 1:
            versions.publish_set(spark, root, made)
    assert {name: df.count() for name, df in versions.read_set(spark, root).items()} == {"a": 1, "b": 1}
    tables.publish_gold(spark.range(1), f"{root}/a", aspects=TABLE_ASPECTS["dim_cliente"])
    found = {r.tabla: r for r in tables.published_aspects(spark, {n: f"{root}/{n}" for n in ("a", "b", "none")}).collect()}
    assert found["a"].sensitivity_level == "INTERNAL" and found["a"].retention_years == 7
    assert found["b"].sensitivity_level is None and found["none"].data_owner is None
    versions.set_properties(spark, f"{root}/b", {"aspect.data_owner": "Risk Team"})
    assert versions.read(spark, f"{root}/b").count() == 2


def test_no_table(spark, tmp_path):
    assert versions.manifest(spark, str(tmp_path / "t")) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        versions.replace_table(spark.range(1).withColumn(versions.SNAPSHOT, F.lit(1)), str(tmp_path / "t"))
