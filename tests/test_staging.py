from datetime import date

import pytest

from silvertide.plans import staging as S

TXN = (
    "id_transaccion string, monto_clp double, categoria_gasto string, region string, descripcion string, fecha_hora string"
)


def _txn(spark, rows):
    df = spark.createDataFrame(rows, TXN)
    return {r["id_transaccion"]: r for r in S.stage_transactions(df, "2026-04-01 00:00:00").collect()}


def test_transaction_flags(spark):
    got = _txn(spark, [
        ("ok", 5e6, "a", "r", "x", "2026-03-25T10:00:00-04:43"),
        ("neg", -1.0, "a", "r", "x", "2026-03-25T10:00:00-04:43"),
        ("fut", 1.0, "a", "r", "x", "2026-05-01T00:00:00+00:00"),
        ("noreg", 1.0, "a", None, "x", "2026-03-25T10:00:00Z"),
        ("nocat", 1.0, None, "r", "x [CHILE_RUT]", "2026-03-25T10:00:00Z"),
        ("null", None, "a", "r", None, None),
    ])
    assert got["ok"]["hora"] == 14 and got["ok"]["flag_uaf_threshold"] and got["ok"]["es_registro_valido"]
    assert got["ok"]["dia_semana"] == 4 and got["ok"]["nombre_dia"] == "Wednesday"
    assert got["neg"]["flag_monto_negativo"] and not got["neg"]["es_registro_valido"]
    assert got["fut"]["flag_fecha_futura"] and not got["fut"]["es_registro_valido"]
    assert got["noreg"]["flag_campos_nulos"] and got["noreg"]["es_registro_valido"]
    assert got["nocat"]["flag_pii_en_descripcion"] and not got["nocat"]["es_registro_valido"]
    flags = [k for k in got["null"].asDict() if k.startswith("flag_")]
    assert not any(got["null"][k] for k in flags) and got["null"]["es_registro_valido"]


def test_local_hour(spark):
    df = spark.createDataFrame([("2026-03-25 14:43:00",)], "fecha_hora string")
    assert S.with_time_parts(df, tz="America/Santiago").first()["hora"] == 11


def test_malformed_time_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        _txn(spark, [("bad", 1.0, "a", "r", "x", "yesterday")])


def test_client_nulls_are_valid(spark):
    schema = (
        "email_masked string, genero string, score_crediticio long, categoria_riesgo string, rango_edad string, "
        "rango_saldo string, comentario_operador string"
    )
    rows = [
        (None, None, None, None, None, None, ""),
        ("a@b", "M", 751, "ALTO", "18-25", "0-500K", ""),
        ("a@b", "M", 750, "ALTO", "18-25", "0-500K", ""),
        ("a@b", "X", 300, "BAJO", "18-25", "0-500K", ""),
        ("a@b", "M", 901, "BAJO", "18-25", "0-500K", ""),
        ("a@b", "M", 900, "BAJO", "menor_18", "0-500K", ""),
        ("a@b", "M", 900, "BAJO", "18-25", "desconocido", ""),
    ]
    got = S.stage_clients(spark.createDataFrame(rows, schema), "2026-04-01 00:00:00").collect()
    assert [r["es_registro_valido"] for r in got] == [True, False, True, False, False, False, False]
    assert "comentario_operador" not in got[0]


def test_request_flags(spark):
    schema = (
        "id string, tipo_derecho string, estado string, fecha_solicitud string, fecha_limite string, "
        "fecha_resolucion string, vence_en_dias long"
    )
    rows = [
        ("overdue", "A", "PENDIENTE", "2026-03-01", "2026-03-31", None, 0),
        ("today", "A", "PENDIENTE", "2026-03-01", "2026-04-01", None, 3),
        ("cancel", "C", "VENCIDO", "2026-03-01", "2026-03-10", None, 0),
        ("met", "A", "COMPLETADO", "2026-03-01", "2026-03-10", "2026-03-10", 2),
        ("open-ended", "A", "COMPLETADO", "2026-03-01", "2026-03-10", None, None),
    ]
    got = {r["id"]: r for r in S.stage_requests(spark.createDataFrame(rows, schema), "2026-04-01").collect()}
    names = ("flag_vencida", "flag_proxima_vencer", "flag_cancelacion_pendiente", "flag_cumplida_en_plazo")
    assert {k: [r[n] for n in names] for k, r in got.items()} == {
        "overdue": [True, False, False, False],
        "today": [False, True, False, False],
        "cancel": [False, False, True, False],
        "met": [False, False, False, True],
        "open-ended": [False, False, False, False],
    }
    assert got["met"]["dias_transcurridos"] == 31


def test_periods(spark):
    assert S.period_bounds("today", "2026-03-31") == (date(2026, 3, 31), date(2026, 3, 31))
    assert S.period_bounds("7d", "2026-03-31")[0] == date(2026, 3, 25)
    assert S.period_bounds("30d", "2026-03-31 10:00:00")[0] == date(2026, 3, 2)
    assert S.period_bounds("all", "2026-03-31") == (None, None)
    df = spark.sql("SELECT explode(sequence(DATE '2026-01-01', DATE '2026-01-10')) AS fecha")
    count = lambda **b: S.date_range(df, **b).count()
    assert count() == 10 and count(start="2026-01-04") == 7 and count(end=date(2026, 1, 4)) == 4
    assert count(start="2026-01-04", end="2026-01-04") == 1
    with pytest.raises(ValueError):
        S.date_range(df, start="2026-01-01' OR 1=1")
