import random
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from silvertide.operators import calendar as C
from silvertide.operators import history as H
from silvertide.operators import scale as S
from silvertide.operators.latest import latest_per_key


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- one row per key --------------------------------------------------------


def test_latest_per_key_with_a_hot_key(spark):
    # A third of all rows share one key, with ties on the order column.
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("ts"),
        F.col("id").alias("v"),
    )
    out = latest_per_key(df, ["k"], [F.desc("ts")])
    assert plan_of(out).count("WindowGroupLimit") == 2
    rows = out.collect()
    assert len(rows) == 20_001
    hot = [r for r in rows if r["k"] == 0]
    assert hot == [(0, 6, min(i for i in range(0, 30_000, 3) if i % 7 == 6))]


# --- percentile -------------------------------------------------------------


@pytest.mark.parametrize("buckets", [2, 50, 4096])
@pytest.mark.parametrize("shape", ["uniform", "ties", "lognormal", "constant", "two"])
def test_exact_quantile(spark, shape, buckets):
    rng = np.random.default_rng(5)
    values = {
        "uniform": rng.uniform(-5, 5, 4000),
        "ties": np.where(rng.uniform(size=4000) < 0.4, 3.0, np.round(rng.uniform(0, 9, 4000), 2)),
        "lognormal": rng.lognormal(3, 4, 4000),
        "constant": np.full(500, 2.5),
        "two": np.array([1.0, 2.0]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "d double").repartition(5)
    for share in (0.95, 0.5, 0.0, 1.0):
        want = float(np.quantile(values, share))
        assert S.exact_quantile(df, "d", share, buckets) == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_exact_quantile_reads_back_few_rows(spark):
    df = spark.range(200_000).select((F.xxhash64("id") / 1e15).alias("d")).repartition(40)
    want = float(np.quantile(np.array([r["d"] for r in df.collect()]), 0.95))
    assert S.exact_quantile(df, "d", 0.95) == pytest.approx(want, rel=1e-12)
    assert len(S._histogram(df.select(F.col("d").alias("v")), -1e5, 1e5, 64)) <= 65
    wide = spark.createDataFrame([(-1.7e308,), (5e-324,), (0.0,), (1.7e308,)], "d double")
    assert S.exact_quantile(wide, "d", 1 / 3) == 0.0 and S.exact_quantile(wide, "d", 1.0) == 1.7e308


def test_exact_quantile_of_nothing(spark):
    assert S.exact_quantile(spark.createDataFrame([], "d double"), "d", 0.95) is None


def test_scores_and_classes(spark):
    rows = [(float(i), i == 3) for i in range(1, 101)] + [(50.0, None)]
    df = spark.createDataFrame(rows, "distancia_centroide double, es_anomalia_flag boolean")
    scored = S.score_normalize(df)
    assert scored.agg(F.max("score_ml"), F.min("score_ml")).first() == (1.0, 0.01)
    assert "Window" not in plan_of(scored) and "NestedLoop" not in plan_of(scored)
    odd = {r[0] for r in S.classify_p95(df).where("clasificacion_ml = 'ANOMALA'").collect()}
    assert odd == {3.0, 96.0, 97.0, 98.0, 99.0, 100.0}


def test_score_of_zero_distances_is_null(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "distancia_centroide double")
    assert [r["score_ml"] for r in S.score_normalize(df).collect()] == [None, None]


def test_ratio_to_max(spark):
    df = spark.createDataFrame([("a", 8), ("b", 3), ("c", 1)], "r string, total long")
    assert [r["porcentaje"] for r in S.ratio_to_max(df, "total").orderBy("r").collect()] == [100.0, 38.0, 13.0]


# --- snapshots and versions -------------------------------------------------

CLIENT = "id_cliente string, arcop_estado string"


def _snapshots(spark):
    prev = [("a", "ACTIVO"), ("b", "ACTIVO"), ("c", "BLOQUEADO"), ("d", "ELIMINADO"), ("gone", "ACTIVO"), ("n", None)]
    curr = [("a", "ELIMINADO"), ("b", "BLOQUEADO"), ("c", "ACTIVO"), ("d", "ELIMINADO"), ("e", "ACTIVO"), ("n", "ACTIVO")]
    return spark.createDataFrame(prev, CLIENT), spark.createDataFrame(curr, CLIENT)


def test_snapshot_delta(spark):
    got = {(r["cambio"], r["id_cliente"]) for r in H.snapshot_delta(*_snapshots(spark), "2026-03-25").collect()}
    assert got == {("eliminados", "a"), ("bloqueados", "b"), ("reactivados", "c"), ("nuevos", "e")}


@pytest.mark.parametrize("parts", [1, 10])
def test_delta_record_parts_hold_every_id(spark, parts):
    prev = spark.createDataFrame([], CLIENT)
    curr = spark.range(1000).select(F.format_string("C%05d", "id").alias("id_cliente"), F.lit("ACTIVO").alias("arcop_estado"))
    records = H.delta_records(prev, curr, "2026-03-25", parts).collect()
    assert len(records) == parts
    assert sorted(i for p in records for i in p["nuevos"]) == [f"C{i:05d}" for i in range(1000)]
    assert {(p["total_maestro"], p["total_activos"]) for p in records} == {(1000, 1000)}


def test_quiet_day_still_has_a_record(spark):
    _, curr = _snapshots(spark)
    record = H.delta_records(curr, curr, "2026-03-25").collect()
    assert len(record) == 1 and record[0]["nuevos"] == [] and record[0]["total_activos"] == 3


def test_repeated_ids_do_not_multiply(spark):
    prev, curr = _snapshots(spark)
    many = curr.union(curr).union(curr)
    assert H.snapshot_delta(prev.union(prev), many, "2026-03-25").count() == 4
    assert "Join" not in plan_of(H.snapshot_delta(prev, many, "2026-03-25"))


def _history(df):
    return df.select(
        "*",
        F.lit("2026-01-01").cast("timestamp").alias("valid_from"),
        F.lit(H.END_OF_TIME).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def test_scd2_over_three_days(spark):
    first, second = _snapshots(spark)
    day1 = H.scd2_merge(_history(first), second, ["id_cliente"], ["arcop_estado"], "2026-02-01")
    rows = day1.collect()
    assert Counter(r["id_cliente"] for r in rows) == {"a": 2, "b": 2, "c": 2, "d": 1, "gone": 1, "e": 1, "n": 2}
    assert sum(r["is_current"] for r in rows) == 7
    closed = [r for r in rows if not r["is_current"]]
    assert {str(r["valid_to"]) for r in closed} == {"2026-02-01"}

    again = H.scd2_merge(day1, second, ["id_cliente"], ["arcop_estado"], "2026-03-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))

    repeated = second.union(second)
    assert H.scd2_merge(day1, repeated, ["id_cliente"], ["arcop_estado"], "2026-03-01").count() == len(rows)


def test_scd2_sees_microseconds_and_nulls(spark):
    kind = "k string, seen timestamp, note string"
    at = lambda u: datetime(2026, 1, 1, 0, 0, 0, u)
    first = spark.createDataFrame([("a", at(100), None), ("b", at(5), "x"), ("c", None, ""), ("d", at(1), None)], kind)
    second = spark.createDataFrame([("a", at(900), None), ("b", at(5), "x"), ("c", None, None), ("d", at(1), None)], kind)
    rows = H.scd2_merge(_history(first), second, ["k"], ["seen", "note"], "2026-02-01").collect()
    assert Counter(r["k"] for r in rows) == {"a": 2, "b": 1, "c": 2, "d": 1}


def test_scd2_refuses_null_keys(spark):
    kind = "k string, v string"
    good, bad = spark.createDataFrame([("a", "1")], kind), spark.createDataFrame([("a", "1"), (None, "2")], kind)
    for history, snapshot in ((_history(good), bad), (_history(bad), good)):
        with pytest.raises(Exception, match="k is required"):
            H.scd2_merge(history, snapshot, ["k"], ["v"], "2026-02-01").collect()


# --- calendar ---------------------------------------------------------------


def _walk(start, n):
    day = start
    while n:
        day += timedelta(days=1)
        if day.weekday() < 5 and day.strftime("%m-%d") not in {h[5:] for h in C.HOLIDAYS_2026}:
            n -= 1
    return day


def test_add_business_days_against_a_walk(spark):
    days = [date(2026, 1, 1) + timedelta(days=i) for i in range(0, 350, 3)] + [date(1999, 12, 30), date(2000, 2, 28)]
    rows = [(d, n) for d in days for n in (0, 1, 5, 15, 300)]
    df = spark.createDataFrame(rows, "d date, n int")
    got = C.add_business_days(df, "d", F.col("n"), "out").collect()
    assert len(got) == len(rows)
    assert all(r["out"] == _walk(r["d"], r["n"]) for r in got)
    assert "Join" not in plan_of(C.add_business_days(df, "d", F.col("n"), "out"))


def test_dates_out_of_range_touch_only_their_row(spark):
    rows = [(date(1, 1, 1), 5), (date(9999, 12, 31), 5), (date(9999, 12, 31), 0), (date(2026, 3, 2), 5), (None, 5), (date(2026, 3, 2), None), (date(2026, 3, 2), -1)]
    got = C.add_business_days(spark.createDataFrame(rows, "d date, n int"), "d", F.col("n"), "out").collect()
    assert [r["out"] for r in got] == [_walk(date(1, 1, 1), 5), None, date(9999, 12, 31), date(2026, 3, 9), None, None, None]


@pytest.mark.parametrize("shape", ["skewed", "tied", "one value"])
def test_sketched_quantile_is_within_its_bound(spark, shape):
    value = {"skewed": F.exp(F.col("id") % 9973 / 700.0), "tied": F.floor(F.sqrt(F.col("id") % 400)).cast("double"), "one value": F.lit(3.5)}[shape]
    df = spark.range(60_000).select((F.col("id") % 13).alias("day"), value.alias("d")).union(spark.createDataFrame([(1, None), (2, float("nan")), (99, None)], "day long, d double"))
    sketches = S.quantile_sketches(df, "d", ["day"]).cache()
    assert sketches.agg(F.sum("filas")).first()[0] == 60_000 and sketches.where("day = 99").count() == 0
    n = 60_000
    for order in (F.col("day").desc(), F.hash("day")):
        for share in (0.5, 0.95):
            got = S.sketched_quantile(sketches.orderBy(order), share)
            low, high = df.where("NOT isnan(d)").agg(F.count_if(F.col("d") < got), F.count_if(F.col("d") <= got)).first()
            assert low / n - S.rank_error() <= share <= high / n + S.rank_error()


def test_classification_by_sketches(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("distancia_centroide"), F.lit(False).alias("es_anomalia_flag"))
    stored = S.quantile_sketches(df, "distancia_centroide")
    for options in ({"approx": True}, {"approx": True, "sketches": stored}):
        odd = S.classify_p95(df, **options).where("clasificacion_ml = 'ANOMALA'").count()
        assert abs(odd / 20_000 - 0.05) <= S.rank_error()
    assert S.sketched_quantile(stored.limit(0), 0.95) is None and S.sketched_quantile(S.quantile_sketches(df.limit(0), "distancia_centroide"), 0.5) is None


def test_calendar_against_a_walk(spark):
    got = C.business_calendar(spark, "2023-12-20", "2028-03-05").orderBy("dia").collect()
    count = 0
    for r in got:
        work = _walk(r["dia"] - timedelta(days=1), 1) == r["dia"]
        count += work
        assert (r["habil"], r["ordinal"], r["siguiente_habil"]) == (work, count, _walk(r["dia"], 1))
    assert len(got) == (date(2028, 3, 5) - date(2023, 12, 20)).days + 1 and sum(r["festivo"] for r in got) > 60
    assert C.business_calendar(spark, "2026-01-02", "2026-01-01").count() == 0


def test_calendar_of_other_holidays(spark):
    df = spark.createDataFrame([(date(2024, 2, 28), 1), (date(2023, 2, 28), 1), (date(2399, 12, 31), 3), (date(1999, 12, 31), 521)], "d date, n int")
    after = lambda pattern: [r[0] for r in df.select(C.business_days_after("d", "n", pattern)).collect()]
    assert after(["2024-02-29"])[:2] == [date(2024, 3, 1), date(2023, 3, 1)] and after([])[:2] == [date(2024, 2, 29), date(2023, 3, 1)]
    assert after([])[2:] == [date(2400, 1, 5), date(2001, 12, 31)]
    every = [str(date(2024, 1, 1) + timedelta(days=i)) for i in range(366)]
    assert after(every) == [None] * 4


def test_workdays(spark):
    df = spark.createDataFrame([(date(2026, 1, 1) + timedelta(days=i),) for i in range(800)] + [(None,)], "d date")
    for r in df.select("d", C.is_workday("d").alias("w")).collect():
        assert r["w"] == (None if r["d"] is None else _walk(r["d"] - timedelta(days=1), 1) == r["d"])


def test_request_states(spark):
    rows = [("new", date(2026, 6, 1), 5), ("fresh", date(2026, 5, 30), 1), ("late", date(2026, 3, 2), 16),
            ("done", date(2026, 3, 2), 15), ("wait", date(2026, 5, 25), 10)]
    df = spark.createDataFrame(rows, "id string, fecha_solicitud date, dias_resolucion_estimados long")
    got = {r["id"]: r for r in C.age_requests(df, "2026-06-01").collect()}
    assert {k: r["estado_calculado"] for k, r in got.items()} == {
        "new": "PENDIENTE", "fresh": "EN_PROCESO", "late": "VENCIDO", "done": "COMPLETADO", "wait": "EN_PROCESO",
    }
    assert got["done"]["resolucion"] == _walk(date(2026, 3, 2), 15) and got["late"]["resolucion"] is None
    assert got["done"]["dias_restantes"] == 0
