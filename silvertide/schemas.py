"""Fixed table schemas (field names and types are part of the data contract)."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def _ddl(text: str, required: str | None = None) -> T.StructType:
    """Schema from `name TYPE, ...`, without needing a running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], name != required) for name, kind in pairs])


BRONZE_CLIENTS = _ddl("""
    id_cliente STRING, rut STRING, nombre_completo STRING, email STRING, telefono STRING,
    num_tarjeta STRING, num_cuenta STRING, fecha_nacimiento STRING, genero STRING, region STRING,
    comuna STRING, ocupacion STRING, estado_civil STRING, nivel_educacion STRING, tipo_cuenta STRING,
    saldo_cuenta DOUBLE, deuda_total DOUBLE, score_crediticio BIGINT, renta_mensual DOUBLE,
    tiene_credito BOOLEAN, categoria_riesgo STRING, comentario_operador STRING, fecha_creacion STRING,
    arcop_estado STRING, arcop_acceso_solicitado BOOLEAN, arcop_rectificacion_pending BOOLEAN,
    arcop_cancelacion_solicitado BOOLEAN, arcop_oposicion_activa BOOLEAN,
    arcop_portabilidad_entregada BOOLEAN, consentimiento_ley19628 BOOLEAN, fecha_consentimiento STRING
""")

BRONZE_TRANSACTIONS = _ddl("""
    id_transaccion STRING, id_cliente STRING, num_cuenta STRING, num_tarjeta_mask STRING,
    monto_clp DOUBLE, tipo_transaccion STRING, canal STRING, categoria_gasto STRING, region STRING,
    comuna STRING, fecha_hora STRING, descripcion STRING, es_anomalia_flag BOOLEAN,
    score_anomalia DOUBLE, estado STRING, es_duplicado BOOLEAN
""")

_REQUESTS = """
    id_solicitud STRING, id_cliente STRING, tipo_derecho STRING, descripcion_tipo STRING,
    fecha_solicitud STRING, fecha_limite STRING, fecha_resolucion STRING, estado STRING, canal STRING,
    dias_habiles_max BIGINT, dias_resolucion_estimados BIGINT, vence_en_dias BIGINT,
    es_critico BOOLEAN, responsable STRING
"""
BRONZE_REQUESTS = _ddl(_REQUESTS)

BRONZE_DELTA = _ddl("""
    fecha STRING, nuevos ARRAY<STRING>, eliminados ARRAY<STRING>, bloqueados ARRAY<STRING>,
    reactivados ARRAY<STRING>, total_maestro BIGINT, total_activos BIGINT
""")

SILVER_CLIENTS = _ddl("""
    id_cliente STRING, rut_pseudo STRING, nombre_masked STRING, email_masked STRING,
    telefono_masked STRING, num_tarjeta_fpe STRING, num_cuenta_fpe STRING, rango_edad STRING,
    genero STRING, region STRING, ocupacion STRING, estado_civil STRING, nivel_educacion STRING,
    tipo_cuenta STRING, rango_saldo STRING, rango_renta STRING, rango_deuda STRING,
    score_crediticio BIGINT, categoria_riesgo STRING, tiene_credito BOOLEAN,
    comentario_operador STRING, fecha_creacion STRING, arcop_estado STRING,
    arcop_acceso_solicitado BOOLEAN, arcop_rectificacion_pending BOOLEAN,
    arcop_cancelacion_solicitado BOOLEAN, arcop_oposicion_activa BOOLEAN,
    arcop_portabilidad_entregada BOOLEAN, consentimiento_ley19628 BOOLEAN,
    fecha_consentimiento STRING, fecha_deidentify STRING, version_dlp STRING
""", required="id_cliente")

SILVER_TRANSACTIONS = _ddl("""
    id_transaccion STRING, id_cliente STRING, num_cuenta_fpe STRING, num_tarjeta_mask STRING,
    monto_clp DOUBLE, tipo_transaccion STRING, canal STRING, categoria_gasto STRING, region STRING,
    fecha_hora STRING, estado STRING, descripcion STRING, es_anomalia_flag BOOLEAN,
    score_anomalia DOUBLE, es_duplicado BOOLEAN, fecha_deidentify STRING
""", required="id_transaccion")

SILVER_REQUESTS = _ddl(_REQUESTS, required="id_solicitud")


def with_hour_partitions(schema: T.StructType) -> T.StructType:
    """The schema plus the `fecha=/hora=` path columns, typed so no inference is needed."""
    return T.StructType(
        schema.fields + [T.StructField("fecha", T.DateType()), T.StructField("hora", T.IntegerType())]
    )


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
