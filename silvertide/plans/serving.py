"""Reporting queries over the Gold tables, with typed parameters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.functions.rules import is_true, money

from .marts import current_clients
from .staging import date_range

ANOMALY = "ANOMALA"
Bound = date | str | None


def _text_flag(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def kpis(dim: DataFrame, ml: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    """Clients, transactions, anomalies and threshold alerts: one row, one pass per table."""
    clients = current_clients(dim).agg(F.count("*"))
    counts = date_range(ml, "fecha", start, end).agg(
        F.count("*").alias("transacciones"),
        F.count_if(F.col("clasificacion_ml") == ANOMALY).alias("anomalias"),
        F.count_if(is_true(F.col("flag_uaf_threshold"))).alias("uaf"),
    )
    return counts.select(clients.scalar().alias("clientes"), "transacciones", "anomalias", "uaf")


def quality_summary(mart: DataFrame) -> DataFrame:
    return mart.select("tabla", "score_calidad", "semaforo")


def compliance_summary(mart: DataFrame) -> DataFrame:
    """Overdue is the alert count, not the number of requests in the overdue state."""
    return mart.select(
        "total_solicitudes", "total_pendientes", "total_completadas",
        F.col("alertas_vencidas").alias("total_vencidas"),
        F.col("alertas_proximas_vencer").alias("proximas_vencer"),
        F.round(F.coalesce("pct_cumplimiento", F.lit(0.0)), 1).alias("tasa_cumplimiento"),
        "semaforo_cumplimiento",
    ).limit(1)


def top_regions(ml: DataFrame, n: int = 6, start: Bound = None, end: Bound = None) -> DataFrame:
    return (
        date_range(ml, "fecha", start, end)
        .where(F.col("clasificacion_ml") == ANOMALY)
        .groupBy("region")
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), F.asc_nulls_last("region"))
        .limit(n)
    )


def client_list(dim: DataFrame, n: int = 20) -> DataFrame:
    return (
        current_clients(dim)
        .select(
            "id_cliente", "rut_pseudo", "nombre_masked", "email_masked",
            "rango_edad", "rango_saldo", "region", "categoria_riesgo",
        )
        .orderBy("id_cliente")
        .limit(n)
    )


def top_anomalies(ml: DataFrame, n: int = 15, start: Bound = None, end: Bound = None) -> DataFrame:
    return (
        date_range(ml, "fecha", start, end)
        .where(F.col("clasificacion_ml") == ANOMALY)
        .orderBy(F.desc("monto_clp"), "id_transaccion")
        .limit(n)
        .select(
            "id_transaccion", F.col("fecha").cast("string").alias("fecha"), "canal", "monto_clp", "hora",
            "cluster_id", "clasificacion_ml", _text_flag("flag_uaf_threshold"),
        )
    )


def class_summary(ml: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    return date_range(ml, "fecha", start, end).groupBy("clasificacion_ml").agg(
        F.count("*").alias("total"),
        F.round(F.avg(money("monto_clp")), 0).cast("double").alias("monto_prom"),
        F.count_if(is_true(F.col("flag_uaf_threshold"))).alias("uaf"),
    )


def client_ids(dim: DataFrame, n: int = 100) -> DataFrame:
    return current_clients(dim).select("id_cliente").distinct().orderBy("id_cliente").limit(n)


def _one_client(df: DataFrame, client: str) -> DataFrame:
    if not client or not client.strip():
        raise ValueError("a client id is required")
    return df.where(F.col("id_cliente") == F.lit(client.strip()))


def client_detail(dim: DataFrame, client: str) -> DataFrame:
    return (
        _one_client(current_clients(dim), client)
        .select(
            "id_cliente", "rut_pseudo", "nombre_masked", "email_masked", "rango_edad", "rango_saldo",
            "rango_renta", "region", "genero", "ocupacion", "score_crediticio", "categoria_riesgo",
            "arcop_estado", "tipo_cuenta", F.col("valid_from").cast("string").alias("valid_from"),
        )
        .limit(1)
    )


def client_transactions(ml: DataFrame, client: str, n: int = 8) -> DataFrame:
    """Latest transactions of a client; within a day by hour and id."""
    return (
        _one_client(ml, client)
        .orderBy(F.desc("fecha"), F.desc("hora"), "id_transaccion")
        .limit(n)
        .select(
            F.col("fecha").cast("string").alias("fecha"), "hora", "canal", "monto_clp",
            "clasificacion_ml", "nivel_riesgo_anomalia", _text_flag("flag_uaf_threshold"),
        )
    )


def client_requests(fact: DataFrame, client: str, n: int = 5) -> DataFrame:
    """Latest requests of a client; within a day by id."""
    return (
        _one_client(fact, client)
        .orderBy(F.desc("fecha_solicitud"), "id_solicitud")
        .limit(n)
        .select(
            "tipo_derecho", "estado", F.col("vence_en_dias").alias("dias_restantes"), "prioridad",
            "flag_vencida", "flag_proxima_vencer",
        )
    )
