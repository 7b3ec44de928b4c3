"""Gold tables: dimension, facts, summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvertide.functions.rules import (
    instant, is_true, money, quality_score, ratio, risk_level, traffic_light,
)
from silvertide.operators.history import DELETED, END_OF_TIME
from silvertide.operators.latest import latest_per_key

from .staging import OPEN_STATES

# Fixed value: what stands for null inside a surrogate key.
_NULL_IN_KEY = "_dbt_utils_surrogate_key_null_"
CLIENT_FLAGS = (
    "flag_email_invalido", "flag_genero_invalido", "flag_score_fuera_rango",
    "flag_score_categoria_inconsistente", "flag_edad_invalida", "flag_saldo_invalido",
)


def surrogate_key(*columns: str):
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL_IN_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def build_dim_client(stg: DataFrame) -> DataFrame:
    """Client dimension: the current version of every client."""
    ordered = [
        c for c in stg.columns
        if c not in (*CLIENT_FLAGS, "es_registro_valido", "fecha_deidentify", "version_dlp", "fecha_staging")
    ]
    return stg.select(
        surrogate_key("id_cliente", "arcop_estado", "fecha_deidentify").alias("sk_cliente"),
        *ordered,
        *CLIENT_FLAGS,
        "es_registro_valido",
        F.col("fecha_deidentify").cast("timestamp").alias("valid_from"),
        F.lit(END_OF_TIME).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        "fecha_staging",
    )


def current_clients(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def active_clients(dim: DataFrame) -> DataFrame:
    """Current clients that neither asked for cancellation nor were deleted."""
    return current_clients(dim).where(
        ~F.col("arcop_cancelacion_solicitado") & (F.col("arcop_estado") != DELETED)
    )


def build_fact_transactions(txn: DataFrame, dim: DataFrame, as_of: datetime | str) -> DataFrame:
    """Transactions of active clients, newest load of each transaction.

    The clients are broadcast when they are small; otherwise both sides are
    shuffled and the partitions of hot clients are split. The client filter comes
    before the choice of the newest version, as published.
    """
    clients = active_clients(dim).select(
        "id_cliente", "rut_pseudo", "categoria_riesgo", "score_crediticio", "arcop_estado", "arcop_oposicion_activa"
    )
    joined = txn.join(clients, "id_cliente", "inner").select(
        "id_transaccion", "id_cliente", "num_cuenta_fpe", "num_tarjeta_mask",
        "monto_clp", "tipo_transaccion", "canal", "categoria_gasto", "region", "descripcion", "estado",
        "fecha", "fecha_hora", "hora", "dia_semana", "nombre_dia",
        "es_anomalia_flag", "score_anomalia", risk_level("score_anomalia").alias("nivel_riesgo_anomalia"),
        "flag_monto_negativo", "flag_fecha_futura", "flag_campos_nulos", "flag_pii_en_descripcion",
        "flag_uaf_threshold", "es_registro_valido", "es_duplicado",
        "rut_pseudo", "categoria_riesgo", "score_crediticio", "arcop_estado", "arcop_oposicion_activa",
        "fecha_deidentify", "fecha_staging", instant(as_of).alias("fecha_gold"),
    )
    # Load times are text with a zone offset: compare instants, not strings. Equal
    # load times are ordered by a hash of the transaction's columns, which hold all
    # that differs between versions, so only one number travels with the sort.
    told_apart = [c for c in joined.columns if c in txn.columns and c != "id_transaccion"]
    newest = [F.col("fecha_deidentify").cast("timestamp").desc(), F.xxhash64(*told_apart)]
    return latest_per_key(joined, ["id_transaccion"], newest, ties=[])


def build_fact_requests(req: DataFrame, dim: DataFrame, as_of: datetime | str) -> DataFrame:
    """All requests with the data of their client, when there is one."""
    clients = current_clients(dim).select("id_cliente", "rut_pseudo", "region", "arcop_estado")
    priority = (
        F.when(F.col("flag_vencida"), "CRITICA")
        .when(F.col("flag_cancelacion_pendiente"), "ALTA")
        .when(F.col("flag_proxima_vencer"), "MEDIA")
        .otherwise("NORMAL")
    )
    return req.join(clients, "id_cliente", "left").select(
        "id_solicitud", "id_cliente", "tipo_derecho", "descripcion_tipo", "canal", "responsable",
        "fecha_solicitud", "fecha_limite", "fecha_resolucion",
        "dias_habiles_max", "dias_resolucion_estimados", "vence_en_dias", "dias_transcurridos",
        "estado", "es_critico",
        "flag_vencida", "flag_proxima_vencer", "flag_cancelacion_pendiente", "flag_cumplida_en_plazo",
        priority.alias("prioridad"), "rut_pseudo", "region", "arcop_estado",
        instant(as_of).alias("fecha_gold"),
    )


def anomaly_candidates(fact: DataFrame) -> DataFrame:
    """Valid transactions that are flagged, large, or scored at least 0.5."""
    return fact.where(
        F.col("es_registro_valido")
        & (F.col("es_anomalia_flag") | F.col("flag_uaf_threshold") | (F.col("score_anomalia") >= 0.5))
    )


def build_anomaly_mart(fact: DataFrame) -> DataFrame:
    """Anomalies with the reason of the alert, the first that applies."""
    large, flagged = F.col("flag_uaf_threshold"), is_true(F.col("es_anomalia_flag"))
    score = F.col("score_anomalia")
    reason = (
        F.when(large & flagged, "MONTO_UAF_Y_PATRON_ANOMALO")
        .when(large, "MONTO_SOBRE_UMBRAL_UAF")
        .when(score >= 0.8, "PATRON_ANOMALO_ALTO")
        .when(score >= 0.5, "PATRON_ANOMALO_MEDIO")
        .otherwise("REVISION_PREVENTIVA")
    )
    return anomaly_candidates(fact).select(
        "id_transaccion", "id_cliente", "rut_pseudo", "num_cuenta_fpe",
        "monto_clp", "tipo_transaccion", "canal", "categoria_gasto", "region",
        "fecha", "fecha_hora", "hora", "nombre_dia",
        "score_anomalia", "nivel_riesgo_anomalia", "es_anomalia_flag", "flag_uaf_threshold",
        reason.alias("motivo_alerta"), "categoria_riesgo", "score_crediticio", "arcop_estado", "fecha_gold",
    )


def daily_alert_summary(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("fecha", "region", "nivel_riesgo_anomalia").agg(
        F.count("*").alias("total_alertas"),
        F.sum(money("monto_clp")).alias("monto_total_alertado"),
        F.avg("score_anomalia").alias("score_promedio"),
        F.count_if("flag_uaf_threshold").alias("alertas_uaf"),
        F.max("monto_clp").alias("monto_maximo"),
    )


def _quality(stg: DataFrame, as_of: datetime | str, name: str, errors: dict[str, str]) -> DataFrame:
    now = instant(as_of)
    counts = stg.agg(
        F.count("*").alias("total_registros"),
        F.count_if("es_registro_valido").alias("registros_validos"),
        F.count_if(~F.col("es_registro_valido")).alias("registros_invalidos"),
        *[F.count_if(flag).alias(out) for out, flag in errors.items()],
    )
    return counts.select(
        F.to_date(now).alias("fecha"),
        now.alias("timestamp_reporte"),
        F.lit(name).alias("tabla"),
        "total_registros", "registros_validos", "registros_invalidos",
        quality_score("registros_validos", "total_registros").alias("score_calidad"),
        traffic_light(ratio("registros_validos", "total_registros")).alias("semaforo"),
        *errors,
    )


def quality_clients(stg: DataFrame, as_of: datetime | str) -> DataFrame:
    """Quality of the clients: one row."""
    names = (
        "errores_email", "errores_genero", "errores_score_rango",
        "errores_score_categoria", "errores_edad", "errores_saldo",
    )
    return _quality(stg, as_of, "clientes_deidentified", dict(zip(names, CLIENT_FLAGS)))


def quality_transactions(stg: DataFrame, as_of: datetime | str) -> DataFrame:
    """Quality of the transactions: one row."""
    errors = {
        "errores_monto_negativo": "flag_monto_negativo",
        "errores_fecha_futura": "flag_fecha_futura",
        "errores_campos_nulos": "flag_campos_nulos",
        "errores_pii_descripcion": "flag_pii_en_descripcion",
        "alertas_uaf": "flag_uaf_threshold",
        "registros_duplicados": "es_duplicado",
    }
    return _quality(stg, as_of, "transacciones_deidentified", errors)


def quality_mart(stg_clients: DataFrame, stg_transactions: DataFrame, as_of: datetime | str) -> DataFrame:
    """Both quality rows; each leaves the other's error columns empty."""
    return quality_clients(stg_clients, as_of).unionByName(
        quality_transactions(stg_transactions, as_of), allowMissingColumns=True
    )


def compliance_mart(fact: DataFrame, as_of: datetime | str) -> DataFrame:
    """Legal indicators of the requests: one row from one aggregate."""
    now = instant(as_of)
    state, right, channel = F.col("estado"), F.col("tipo_derecho"), F.col("canal")
    counted = {
        "total_pendientes": state == "PENDIENTE",
        "total_en_proceso": state == "EN_PROCESO",
        "total_completadas": state == "COMPLETADO",
        "total_vencidas": state == "VENCIDO",
        "solicitudes_acceso": right == "A",
        "solicitudes_rectificacion": right == "R",
        "solicitudes_cancelacion": right == "C",
        "solicitudes_oposicion": right == "O",
        "solicitudes_portabilidad": right == "P",
        "alertas_vencidas": F.col("flag_vencida"),
        "alertas_proximas_vencer": F.col("flag_proxima_vencer"),
        "clientes_bloqueados_pipeline": F.col("flag_cancelacion_pendiente"),
        "cumplidas_en_plazo": F.col("flag_cumplida_en_plazo"),
        "canal_web": channel == "WEB",
        "canal_app": channel == "APP",
        "canal_sucursal": channel == "SUCURSAL",
        "canal_email": channel == "EMAIL",
        "__abiertas": state.isin(*OPEN_STATES),
    }
    counts = fact.agg(
        F.count("*").alias("total_solicitudes"),
        F.avg("dias_transcurridos").alias("promedio_dias_resolucion"),
        F.max("dias_transcurridos").alias("max_dias_sin_resolver"),
        *[F.count_if(cond).alias(name) for name, cond in counted.items()],
    )
    met = ratio("cumplidas_en_plazo", "total_completadas")
    overdue = F.col("alertas_vencidas")
    light = (
        F.when((overdue == 0) & (met >= 0.95), "VERDE")
        .when((overdue <= 3) & (met >= 0.80), "AMARILLO")
        .otherwise("ROJO")
    )
    names = [n for n in counted if not n.startswith("__")]
    return counts.select(
        F.to_date(now).alias("fecha_reporte"),
        now.alias("timestamp_reporte"),
        "total_solicitudes",
        *names[:13],
        (met * 100).alias("pct_cumplimiento"),
        (ratio("alertas_vencidas", "__abiertas") * 100).alias("pct_vencidas"),
        "promedio_dias_resolucion",
        "max_dias_sin_resolver",
        *names[13:],
        light.alias("semaforo_cumplimiento"),
    )


