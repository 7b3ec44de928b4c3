from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silvertide.functions import buckets as B
from silvertide.functions import rules as R


def test_age_bucket_published_gaps(one):
    today = date(2024, 6, 1)
    ages = [-1, 0, 16, 17, 18, 24, 25, 26, 34, 35, 45, 55, 65, 66]
    births = [str(today - timedelta(days=365 * a)) for a in ages] + ["2020-1-1", "nope", None, ""]
    assert one(births, lambda c: B.age_bucket(c, today)) == [
        "66+", "menor_18", "menor_18", "66+", "18-25", "18-25", "66+", "26-35", "26-35",
        "66+", "66+", "66+", "66+", "66+", "desconocido", "desconocido", "desconocido", "desconocido",
    ]


def test_age_one_day_ahead_is_negative(one):
    assert one(["2024-06-02"], lambda c: B.age_bucket(c, "2024-06-01")) == ["66+"]
    assert one(["2024-06-02"], lambda c: B.age_bucket(c, "2024-06-01", contiguous=True)) == ["desconocido"]


def test_debt_and_balance(one):
    assert one([0.0, 0.5, 1.0, -3.0, 500000.0, None], lambda c: B.bucketize(c, B.DEBT), "double") == [
        "10M+", "10M+", "0-500K", "10M+", "500K-2M", "desconocido",
    ]
    assert one([-1.0, 0.0, 5e7], lambda c: B.bucketize(c, B.BALANCE), "double") == ["50M+", "0-500K", "50M+"]
    closed = one([-1.0, 0.0, 17.0, 25.0, 99.0], lambda c: B.bucketize(c, B.AGE, contiguous=True), "double")
    assert closed == ["desconocido", "menor_18", "menor_18", "18-25", "66+"]


def _digit(number: int) -> str:
    total, weight = 0, 2
    for ch in reversed(str(number)):
        total += int(ch) * weight
        weight = 2 if weight == 7 else weight + 1
    rest = 11 - total % 11
    return {10: "K", 11: "0"}.get(rest, str(rest))


def test_check_digit(one):
    known = {12345678: "5", 5000000: "1", 7654321: "6"}
    special = [n for n in range(5_000_000, 5_000_200) if _digit(n) in "K0"]
    numbers = [*known, *special]
    got = one([str(n) for n in numbers], R.check_digit)
    assert got == [_digit(n) for n in numbers]
    assert {"K", "0"} <= set(got) and got[:3] == list(known.values())


def test_rut_validity(one):
    assert one(["12.345.678-5", "12345678-5", "12.345.678-6", "x", None], R.rut_is_valid) == [
        True, True, False, False, False,
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(5_000_000, 25_000_000), min_size=20, max_size=20))
def test_formatted_ids_are_valid(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n long").select(R.format_rut("n").alias("r"))
    assert df.where(~R.rut_is_valid("r")).count() == 0


def test_luhn(one):
    assert one(["4539 1488 0343 6467", "4539148803436468", "0"], R.luhn_is_valid) == [True, False, True]


def test_ratio_score_and_lights(spark):
    df = spark.createDataFrame([(98, 100), (95, 100), (94, 100), (0, 0)], "v long, t long")
    rows = df.select(R.quality_score("v", "t"), R.traffic_light(R.ratio("v", "t"))).collect()
    assert [tuple(r) for r in rows] == [(98.0, "VERDE"), (95.0, "AMARILLO"), (94.0, "ROJO"), (None, "ROJO")]


def test_risk_level(one):
    assert one([0.8, 0.79, 0.5, 0.49, None], R.risk_level, "double") == ["ALTO", "MEDIO", "MEDIO", "BAJO", "BAJO"]


@pytest.mark.parametrize("day,expected", [(14, False), (15, True), (16, True), (27, False), (28, True), (31, True)])
def test_midmonth(spark, day, expected):
    assert spark.range(1).select(R.is_midmonth(F.lit(date(2026, 1, day)))).first()[0] is expected
