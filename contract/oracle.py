"""Equivalent SQL for the registered queries, written for DuckDB.

Only the raw tables are visible there, so every statement starts from them and
pulls in the shared steps it needs as common table expressions.
"""

from __future__ import annotations

import re

from silvertide.operators.quality import SILVER_CHECKS
from silvertide.plans.governance import TABLE_ASPECTS

# Fixed values, written out here so that a wrong one in the library shows.
HOLIDAYS_2026 = (
    "2026-01-01", "2026-04-03", "2026-04-04", "2026-05-01", "2026-05-21", "2026-06-29", "2026-07-16",
    "2026-08-15", "2026-09-18", "2026-09-19", "2026-10-12", "2026-10-31", "2026-11-01", "2026-12-08",
    "2026-12-25",
)
UNEXPECTED_FIELDS = (
    "descripcion", "comentario_operador", "categoria_gasto", "region", "comuna", "ocupacion",
)

SALT, TOKEN = "test-salt", "test-token"
CLIENTS_DAY = "DATE '2024-02-01'"
TXN_NOW = "TIMESTAMP '2024-01-28 00:00:00'"
REQ_DAY = "DATE '2001-07-20'"

RUT = r"\b\d{1,2}\.?\d{3}\.?\d{3}-[\dkK]\b"
MOBILE = r"\+?56\s?9\s?\d{4}\s?\d{4}"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
CARD = r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"
INTL = r"\+\d{8,15}\b"


# --- expression fragments ---------------------------------------------------


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _day(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _remainder(n: str) -> str:
    total = " + ".join(f"(({n}) // {10**i} % 10) * {2 + i % 6}" for i in range(8))
    return f"(11 - ({total}) % 11)"


def _rut(n: str) -> str:
    digit = f"CASE {_remainder(n)} WHEN 10 THEN 'K' WHEN 11 THEN '0' ELSE CAST({_remainder(n)} AS VARCHAR) END"
    groups = f"({n} // 1000000) || '.' || printf('%03d', {n} // 1000 % 1000) || '.' || printf('%03d', {n} % 1000)"
    return f"({groups} || '-' || {digit})"


def _number(k: str) -> str:
    return f"(5000000 + ({k} * 7919) % 20000000)"


def _client(k: str) -> str:
    return f"printf('C%07d', {k} + 1)"


def _card(k: str) -> str:
    return f"('4532' || printf('%012d', ({k} * 15485863) % 1000000000000))"


def _account(k: str) -> str:
    return f"CAST(10000000 + ({k} * 7907) % 90000000 AS VARCHAR)"


def _mobile(k: str) -> str:
    return f"('+569' || CAST(10000000 + ({k} * 104729) % 90000000 AS VARCHAR))"


def _pick(k: str, *labels: str) -> str:
    return f"list_extract([{_list(labels)}], CAST({k} % {len(labels)} AS INTEGER) + 1)"


def _token(x: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    pool = f"regexp_replace(sha256('fpe:' || {x} || ':{TOKEN}'), '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN {digits} = '' THEN {x} "
        f"ELSE left({digits}, 4) || left({pool}, greatest(least(length({digits}), 16) - 4, 0)) END"
    )


def _redact(x: str) -> str:
    out = f"coalesce({x}, '')"
    for tag, pattern in (
        ("CHILE_RUT", RUT), ("PHONE_NUMBER", MOBILE), ("EMAIL_ADDRESS", EMAIL), ("CREDIT_CARD_NUMBER", CARD),
    ):
        out = f"regexp_replace({out}, '{pattern}', '[{tag}]', 'g')"
    return out


def _initial(w: str) -> str:
    return f"(left({w}, 1) || repeat('*', length({w}) - 1))"


def _mask_email(x: str) -> str:
    user, domain = f"split_part({x}, '@', 1)", f"substr({x}, instr({x}, '@') + 1)"
    return (
        f"CASE WHEN NOT coalesce(contains({x}, '@'), false) THEN '***@***.***' ELSE "
        f"(CASE WHEN length({user}) > 1 THEN {_initial(user)} ELSE '*' END) || '@' || "
        f"repeat('*', length(split_part({domain}, '.', 1))) || '.' || "
        f"(CASE WHEN contains({domain}, '.') THEN split_part({domain}, '.', -1) ELSE '***' END) END"
    )


def _mask_phone(x: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN length({digits}) < 8 THEN repeat('*', length({x})) "
        f"ELSE '+569' || repeat('*', length({digits}) - 7) || right({digits}, 4) END"
    )


def _mask_name(x: str) -> str:
    words = f"list_filter(string_split_regex(coalesce({x}, ''), '\\s+'), lambda w: w <> '')"
    return f"array_to_string(list_transform({words}, lambda w: {_initial('w')}), ' ')"


def _mask_middle(x: str, char: str, start: int, end: int) -> str:
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN length({x}) <= {start + end} THEN repeat('{char}', length({x})) "
        f"ELSE left({x}, {start}) || repeat('{char}', length({x}) - {start + end}) || right({x}, {end}) END"
    )


def _steps(x: str, below_first: str, steps: list[tuple[int, str]], last: str) -> str:
    arms = " ".join(f"WHEN {x} < {upper} THEN '{label}'" for upper, label in steps)
    return f"CASE WHEN {x} IS NULL THEN 'desconocido' {below_first} {arms} ELSE '{last}' END"


def _balance(x: str, negative: str = "50M+") -> str:
    steps = [(500000, "0-500K"), (1000000, "500K-1M"), (5000000, "1M-5M"), (10000000, "5M-10M"), (50000000, "10M-50M")]
    return _steps(x, f"WHEN {x} < 0 THEN '{negative}'", steps, "50M+")


def _income(x: str) -> str:
    steps = [(400000, "0-400K"), (800000, "400K-800K"), (1500000, "800K-1.5M"), (3000000, "1.5M-3M"), (6000000, "3M-6M")]
    return _steps(x, f"WHEN {x} < 0 THEN '6M+'", steps, "6M+")


def _debt(x: str) -> str:
    steps = [(500000, "0-500K"), (2000000, "500K-2M"), (5000000, "2M-5M"), (10000000, "5M-10M")]
    return _steps(x, f"WHEN {x} < 1 THEN '10M+'", steps, "10M+")


def _age(x: str) -> str:
    years = f"floor(date_diff('day', TRY_CAST({x} AS DATE), {CLIENTS_DAY}) / 365)"
    arms = " ".join(
        f"WHEN {years} BETWEEN {a} AND {b} THEN '{label}'"
        for a, b, label in (
            (0, 16, "menor_18"), (18, 24, "18-25"), (26, 34, "26-35"),
            (36, 44, "36-45"), (46, 54, "46-55"), (56, 64, "56-65"),
        )
    )
    return f"CASE WHEN {years} IS NULL THEN 'desconocido' {arms} ELSE '66+' END"


def _light(x: str, green: float, amber: float) -> str:
    return f"CASE WHEN {x} >= {green} THEN 'VERDE' WHEN {x} >= {amber} THEN 'AMARILLO' ELSE 'ROJO' END"


def _share(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / nullif({whole}, 0))"


def _money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18, 2))"


# --- shared steps -----------------------------------------------------------

_K = "c_custkey"
_E, _U = "event_id", "user_id"
_O = "o_orderkey"

STEPS: dict[str, str] = {}

STEPS["cli"] = f"""
SELECT {_client(_K)} AS id_cliente, {_rut(_number(_K))} AS rut,
       replace(c_name, '#', ' ') AS nombre_completo,
       CASE WHEN {_K} % 200 = 7 THEN printf('user%d example cl', {_K})
            ELSE printf('user%d@mail%d.example.com', {_K}, {_K} % 9) END AS email,
       {_mobile(_K)} AS telefono, {_card(_K)} AS num_tarjeta, {_account(_K)} AS num_cuenta,
       CASE WHEN {_K} % 500 = 3 THEN '2030-01-01' WHEN {_K} % 333 = 5 THEN NULL
            ELSE CAST(make_date(1940 + {_K} % 66, 1 + {_K} % 12, 1 + {_K} % 28) AS VARCHAR) END AS fecha_nacimiento,
       CASE WHEN {_K} % 50 = 11 THEN 'X' WHEN {_K} % 2 = 0 THEN 'M' ELSE 'F' END AS genero,
       CASE WHEN {_K} % 97 = 13 THEN NULL ELSE r_name END AS region,
       n_name AS comuna, '' AS ocupacion, '' AS estado_civil, '' AS nivel_educacion,
       c_mktsegment AS tipo_cuenta, c_acctbal * 5000 AS saldo_cuenta,
       CAST(CASE WHEN {_K} % 10 = 0 THEN 0 ELSE (({_K} * 7919) % 20000) * 1000 END AS DOUBLE) AS deuda_total,
       CAST(CASE WHEN {_K} % 400 = 9 THEN 950 WHEN {_K} % 300 = 8 THEN 800
            ELSE 300 + ({_K} * 31) % 601 END AS BIGINT) AS score_crediticio,
       CAST(400000 + (({_K} * 6661) % 9600) * 1000 AS DOUBLE) AS renta_mensual,
       {_K} % 2 = 0 AS tiene_credito,
       CASE WHEN {_K} % 300 = 8 THEN 'ALTO' ELSE {_pick(_K, 'BAJO', 'MEDIO', 'ALTO')} END AS categoria_riesgo,
       CASE WHEN {_K} % 100 = 6 THEN 'Cliente verificado RUT ' || {_rut(_number(_K))} || ' en sucursal'
            ELSE '' END AS comentario_operador,
       '2020-01-01' AS fecha_creacion,
       CASE WHEN {_K} % 40 = 1 THEN 'ELIMINADO' WHEN {_K} % 25 = 2 THEN 'BLOQUEADO' ELSE 'ACTIVO' END AS arcop_estado,
       false AS arcop_acceso_solicitado, false AS arcop_rectificacion_pending,
       {_K} % 60 = 4 AS arcop_cancelacion_solicitado, {_K} % 70 = 5 AS arcop_oposicion_activa,
       false AS arcop_portabilidad_entregada, true AS consentimiento_ley19628,
       '2020-01-02' AS fecha_consentimiento
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

STEPS["txn1"] = f"""
SELECT printf('T%09d', {_E}) AS id_transaccion, {_client(_U)} AS id_cliente, {_account(_U)} AS num_cuenta,
       right({_card(_U)}, 4) AS num_tarjeta_mask, value * 20000 - 100000 AS monto_clp,
       {_pick(_E, 'CREDITO', 'DEBITO', 'GIRO')} AS tipo_transaccion,
       {_pick(_E, 'APP', 'WEB', 'CAJERO', 'SUCURSAL', 'POS')} AS canal,
       CASE WHEN {_E} % 83 = 0 THEN NULL ELSE event_type END AS categoria_gasto,
       CASE WHEN {_E} % 89 = 0 THEN NULL ELSE 'R' || CAST({_U} % 5 AS VARCHAR) END AS region,
       '' AS comuna, {_iso('ts')} AS fecha_hora,
       CASE {_E} % 100 WHEN 1 THEN 'Pago con tarjeta ' || {_card(_U)} || ' autorizado'
            WHEN 2 THEN printf('Aviso enviado a user%d@mail.example.com', {_U})
            WHEN 3 THEN 'Solicitada por RUT ' || {_rut(_number(_U))} || ' fono ' || {_mobile(_U)}
            ELSE 'Compra normal' END AS descripcion,
       event_type = 'error' AND value > 150 AS es_anomalia_flag, least(1.0, value / 350) AS score_anomalia,
       'COMPLETADA' AS estado, {_E} % 125 = 0 AS es_duplicado
FROM events"""

STEPS["txn"] = f"""
SELECT txn1.*, copia FROM txn1,
     unnest(CASE WHEN CAST(substr(id_transaccion, 2) AS BIGINT) % 20 = 0 THEN [1, 2] ELSE [1] END) AS u(copia)"""

STEPS["req"] = f"""
SELECT 'ARCOP' || CAST({_O} AS VARCHAR) AS id_solicitud, {_client('o_custkey')} AS id_cliente,
       CASE WHEN {_O} % 20 < 9 THEN 'A' WHEN {_O} % 20 < 14 THEN 'R' WHEN {_O} % 20 < 17 THEN 'P'
            WHEN {_O} % 20 < 19 THEN 'O' ELSE 'C' END AS tipo_derecho,
       CASE WHEN {_O} % 20 < 9 THEN 'Acceso' WHEN {_O} % 20 < 14 THEN 'Rectificacion' WHEN {_O} % 20 < 17 THEN 'Portabilidad'
            WHEN {_O} % 20 < 19 THEN 'Oposicion' ELSE 'Cancelacion' END AS descripcion_tipo,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha_solicitud,
       CAST(CAST(o_orderdate AS DATE) + 21 AS VARCHAR) AS fecha_limite,
       CASE WHEN o_orderstatus = 'F'
            THEN CAST(CAST(o_orderdate AS DATE) + CAST({_O} % 30 AS INTEGER) AS VARCHAR) END AS fecha_resolucion,
       CASE WHEN {_O} % 17 = 0 THEN 'VENCIDO' WHEN o_orderstatus = 'F' THEN 'COMPLETADO'
            WHEN o_orderstatus = 'O' THEN 'EN_PROCESO' ELSE 'PENDIENTE' END AS estado,
       {_pick(_O, 'WEB', 'APP', 'SUCURSAL', 'EMAIL')} AS canal,
       CAST(15 AS BIGINT) AS dias_habiles_max, CAST(2 + {_O} % 14 AS BIGINT) AS dias_resolucion_estimados,
       CAST(greatest(0, date_diff('day', {REQ_DAY}, CAST(o_orderdate AS DATE) + 21)) AS BIGINT) AS vence_en_dias,
       {_O} % 20 = 19 AS es_critico,
       {_pick(_O, 'Data Steward Norte', 'Data Steward Sur', 'Data Steward RM')} AS responsable
FROM orders"""

STEPS["s_cli"] = f"""
SELECT id_cliente, left(sha256('{SALT}:' || rut), 16) AS rut_pseudo,
       {_mask_name('nombre_completo')} AS nombre_masked, {_mask_email('email')} AS email_masked,
       {_mask_phone('telefono')} AS telefono_masked,
       {_token('num_tarjeta')} AS num_tarjeta_fpe, {_token('num_cuenta')} AS num_cuenta_fpe,
       {_age('fecha_nacimiento')} AS rango_edad, genero, region, ocupacion, estado_civil, nivel_educacion, tipo_cuenta,
       {_balance('saldo_cuenta')} AS rango_saldo, {_income('renta_mensual')} AS rango_renta,
       {_debt('deuda_total')} AS rango_deuda, score_crediticio, categoria_riesgo, tiene_credito,
       {_redact('comentario_operador')} AS comentario_operador, fecha_creacion, arcop_estado,
       arcop_acceso_solicitado, arcop_rectificacion_pending, arcop_cancelacion_solicitado, arcop_oposicion_activa,
       arcop_portabilidad_entregada, consentimiento_ley19628, fecha_consentimiento,
       {_iso(f'CAST({CLIENTS_DAY} AS TIMESTAMP)')} AS fecha_deidentify, '1.0' AS version_dlp
FROM cli"""

_S_TXN = f"""id_transaccion, id_cliente, {_token('num_cuenta')} AS num_cuenta_fpe, num_tarjeta_mask, monto_clp,
       tipo_transaccion, canal, categoria_gasto, region, fecha_hora, estado, {_redact('descripcion')} AS descripcion,
       es_anomalia_flag, score_anomalia, es_duplicado"""

STEPS["s_txn"] = f"""
SELECT {_S_TXN}, {_iso(f"CAST({CLIENTS_DAY} AS TIMESTAMP) + to_hours(CAST(copia AS INTEGER))")} AS fecha_deidentify
FROM txn"""

_C_FLAGS = {
    "flag_email_invalido": "NOT contains(email_masked, '@')",
    "flag_genero_invalido": "genero <> 'M' AND genero <> 'F'",
    "flag_score_fuera_rango": "score_crediticio NOT BETWEEN 300 AND 900",
    "flag_score_categoria_inconsistente": "categoria_riesgo = 'ALTO' AND score_crediticio >= 751",
    "flag_edad_invalida": "list_contains(['menor_18', 'desconocido'], rango_edad)",
    "flag_saldo_invalido": "rango_saldo = 'desconocido'",
}
_ANY = " OR ".join(_C_FLAGS)

STEPS["g_cli"] = f"""
SELECT *, NOT ({_ANY}) AS es_registro_valido, CAST({CLIENTS_DAY} AS TIMESTAMP) AS fecha_staging
FROM (SELECT * EXCLUDE (comentario_operador),
             {', '.join(f'coalesce({c}, false) AS {n}' for n, c in _C_FLAGS.items())} FROM s_cli)"""

STEPS["g_txn"] = f"""
SELECT *, NOT (flag_monto_negativo OR flag_fecha_futura OR categoria_gasto IS NULL) AS es_registro_valido,
       {TXN_NOW} AS fecha_staging
FROM (SELECT *, CAST(fecha_hora AS DATE) AS fecha, CAST(hour(fecha_hora) AS INTEGER) AS hora,
             CAST(dayofweek(fecha_hora) + 1 AS INTEGER) AS dia_semana, dayname(fecha_hora) AS nombre_dia,
             coalesce(monto_clp < 0, false) AS flag_monto_negativo,
             coalesce(fecha_hora > {TXN_NOW}, false) AS flag_fecha_futura,
             categoria_gasto IS NULL OR region IS NULL AS flag_campos_nulos,
             regexp_matches(descripcion, '\\[(CHILE_RUT|EMAIL_ADDRESS|PHONE_NUMBER|CREDIT_CARD_NUMBER|PERSON_NAME)\\]')
                 AS flag_pii_en_descripcion,
             coalesce(monto_clp >= 5000000, false) AS flag_uaf_threshold
      FROM (SELECT * REPLACE (CAST(rtrim(fecha_hora, 'Z') AS TIMESTAMP) AS fecha_hora) FROM s_txn))"""

STEPS["g_req"] = f"""
SELECT * REPLACE (CAST(fecha_solicitud AS DATE) AS fecha_solicitud, CAST(fecha_limite AS DATE) AS fecha_limite,
                  CAST(fecha_resolucion AS DATE) AS fecha_resolucion),
       CAST(date_diff('day', CAST(fecha_solicitud AS DATE), {REQ_DAY}) AS INTEGER) AS dias_transcurridos,
       coalesce(estado IN ('PENDIENTE', 'EN_PROCESO') AND CAST(fecha_limite AS DATE) < {REQ_DAY}, false) AS flag_vencida,
       coalesce(estado IN ('PENDIENTE', 'EN_PROCESO') AND vence_en_dias IN (1, 2, 3), false) AS flag_proxima_vencer,
       coalesce(tipo_derecho = 'C' AND NOT estado = 'COMPLETADO', false) AS flag_cancelacion_pendiente,
       coalesce(estado = 'COMPLETADO' AND CAST(fecha_limite AS DATE) >= CAST(fecha_resolucion AS DATE), false)
           AS flag_cumplida_en_plazo,
       CAST({REQ_DAY} AS TIMESTAMP) AS fecha_staging
FROM req"""

STEPS["dim"] = f"""
SELECT md5(id_cliente || '-' || arcop_estado || '-' || fecha_deidentify) AS sk_cliente,
       * EXCLUDE (fecha_deidentify, version_dlp), CAST({CLIENTS_DAY} AS TIMESTAMP) AS valid_from,
       DATE '9999-12-31' AS valid_to, true AS is_current
FROM g_cli"""

STEPS["act"] = """
SELECT * FROM dim WHERE is_current AND arcop_cancelacion_solicitado = false AND arcop_estado IN ('ACTIVO', 'BLOQUEADO')"""

STEPS["fact"] = f"""
SELECT * EXCLUDE (version) FROM (
    SELECT g_txn.*,
           CASE WHEN score_anomalia < 0.5 THEN 'BAJO' WHEN score_anomalia < 0.8 THEN 'MEDIO'
                WHEN score_anomalia >= 0.8 THEN 'ALTO' ELSE 'BAJO' END AS nivel_riesgo_anomalia,
           act.rut_pseudo, act.categoria_riesgo, act.score_crediticio, act.arcop_estado, act.arcop_oposicion_activa,
           {TXN_NOW} AS fecha_gold,
           row_number() OVER (PARTITION BY id_transaccion ORDER BY fecha_deidentify DESC) AS version
    FROM g_txn JOIN act USING (id_cliente)) WHERE version = 1"""

STEPS["factreq"] = f"""
SELECT g_req.* EXCLUDE (fecha_staging), dim.rut_pseudo, dim.region, dim.arcop_estado,
       list_extract(list_filter([CASE WHEN flag_vencida THEN 'CRITICA' END,
                                 CASE WHEN flag_cancelacion_pendiente THEN 'ALTA' END,
                                 CASE WHEN flag_proxima_vencer THEN 'MEDIA' END, 'NORMAL'],
                                lambda p: p IS NOT NULL), 1) AS prioridad,
       CAST({REQ_DAY} AS TIMESTAMP) AS fecha_gold
FROM g_req LEFT JOIN dim ON g_req.id_cliente = dim.id_cliente AND dim.is_current"""

STEPS["anom"] = """
SELECT id_transaccion, id_cliente, rut_pseudo, num_cuenta_fpe, monto_clp, tipo_transaccion, canal, categoria_gasto,
       region, fecha, fecha_hora, hora, nombre_dia, score_anomalia, nivel_riesgo_anomalia, es_anomalia_flag,
       flag_uaf_threshold,
       CASE WHEN flag_uaf_threshold THEN if(es_anomalia_flag, 'MONTO_UAF_Y_PATRON_ANOMALO', 'MONTO_SOBRE_UMBRAL_UAF')
            WHEN nivel_riesgo_anomalia <> 'BAJO' THEN 'PATRON_ANOMALO_' || nivel_riesgo_anomalia
            ELSE 'REVISION_PREVENTIVA' END AS motivo_alerta,
       categoria_riesgo, score_crediticio, arcop_estado, fecha_gold
FROM fact WHERE es_registro_valido AND (es_anomalia_flag OR flag_uaf_threshold OR score_anomalia >= 0.5)"""

STEPS["dist"] = """
SELECT *, monto_clp / 1000000 + hora / 10 AS distancia_centroide,
       CAST(1 + CAST(substr(id_transaccion, 2) AS BIGINT) % 5 AS INTEGER) AS cluster_id
FROM fact WHERE es_registro_valido AND NOT es_duplicado AND monto_clp >= 0"""

STEPS["ml"] = """
SELECT id_transaccion, id_cliente, monto_clp, hora, dia_semana, canal, region, fecha, es_anomalia_flag,
       score_anomalia AS score_generador, cluster_id, distancia_centroide,
       round(distancia_centroide / nullif((SELECT max(distancia_centroide) FROM dist), 0), 4) AS score_ml,
       if(es_anomalia_flag OR distancia_centroide > (SELECT quantile_cont(distancia_centroide, 0.95) FROM dist),
          'ANOMALA', 'NORMAL') AS clasificacion_ml,
       flag_uaf_threshold, nivel_riesgo_anomalia, categoria_riesgo, arcop_estado, fecha_gold
FROM dist"""

STEPS["centres"] = """
SELECT * FROM (VALUES (1, -0.5, -1.0, 0.0, -0.5), (2, -0.5, 1.0, 0.5, 0.0), (3, 0.5, 0.0, -1.0, 0.5), (4, 1.5, 0.5, 1.0, 1.0),
                      (5, 3.0, 0.0, 0.0, 4.0)) v(c, a, b, e, f)"""

STEPS["fixed"] = """
SELECT * EXCLUDE (rn, c), CAST(c AS INTEGER) AS cluster_id FROM (
    SELECT *, row_number() OVER (PARTITION BY id_transaccion ORDER BY d, c) AS rn FROM (
        SELECT dist.* EXCLUDE (cluster_id), c,
               sqrt(((monto_clp - 900000.0::DOUBLE) / 800000.0::DOUBLE - a::DOUBLE) ** 2 + ((hora - 12.0::DOUBLE) / 6.5::DOUBLE - b::DOUBLE) ** 2
                    + ((dia_semana - 4.0::DOUBLE) / 2.0::DOUBLE - e::DOUBLE) ** 2
                    + ((coalesce(score_anomalia, 0.25::DOUBLE) - 0.25::DOUBLE) / 0.125::DOUBLE - f::DOUBLE) ** 2) AS d
        FROM dist JOIN centres ON true)) WHERE rn = 1"""

STEPS["own"] = """
SELECT cluster_id, count(*) AS n, avg(d) AS s, sum(d * d) AS sq FROM fixed WHERE arcop_estado <> 'ELIMINADO' GROUP BY cluster_id"""

STEPS["period"] = "SELECT * FROM ml WHERE fecha >= DATE '2024-01-03' AND fecha <= DATE '2024-01-25'"

STEPS["qcli"] = f"""
SELECT 'clientes_deidentified' AS tabla, count(*) AS total_registros,
       count(*) FILTER (es_registro_valido) AS registros_validos,
       count(*) FILTER (NOT es_registro_valido) AS registros_invalidos,
       count(*) FILTER (flag_email_invalido) AS errores_email, count(*) FILTER (flag_genero_invalido) AS errores_genero,
       count(*) FILTER (flag_score_fuera_rango) AS errores_score_rango,
       count(*) FILTER (flag_score_categoria_inconsistente) AS errores_score_categoria,
       count(*) FILTER (flag_edad_invalida) AS errores_edad, count(*) FILTER (flag_saldo_invalido) AS errores_saldo
FROM g_cli"""

STEPS["qtxn"] = f"""
SELECT 'transacciones_deidentified' AS tabla, count(*) AS total_registros,
       count(*) FILTER (es_registro_valido) AS registros_validos,
       count(*) FILTER (NOT es_registro_valido) AS registros_invalidos,
       count(*) FILTER (flag_monto_negativo) AS errores_monto_negativo,
       count(*) FILTER (flag_fecha_futura) AS errores_fecha_futura,
       count(*) FILTER (flag_campos_nulos) AS errores_campos_nulos,
       count(*) FILTER (flag_pii_en_descripcion) AS errores_pii_descripcion,
       count(*) FILTER (flag_uaf_threshold) AS alertas_uaf, count(*) FILTER (es_duplicado) AS registros_duplicados
FROM g_txn"""

_VALID = _share("registros_validos", "total_registros")
STEPS["qmart"] = f"""
SELECT *, round({_VALID} * 100, 2) AS score_calidad, {_light(_VALID, 0.98, 0.95)} AS semaforo,
       '2024-01-28' AS fecha, '2024-01-28 00:00:00.000000' AS timestamp_reporte
FROM (SELECT * FROM qcli UNION ALL BY NAME SELECT * FROM qtxn)"""

_COUNTED = {
    "total_pendientes": "estado = 'PENDIENTE'", "total_en_proceso": "estado = 'EN_PROCESO'",
    "total_completadas": "estado = 'COMPLETADO'", "total_vencidas": "estado = 'VENCIDO'",
    "solicitudes_acceso": "tipo_derecho = 'A'", "solicitudes_rectificacion": "tipo_derecho = 'R'",
    "solicitudes_cancelacion": "tipo_derecho = 'C'", "solicitudes_oposicion": "tipo_derecho = 'O'",
    "solicitudes_portabilidad": "tipo_derecho = 'P'", "alertas_vencidas": "flag_vencida",
    "alertas_proximas_vencer": "flag_proxima_vencer", "clientes_bloqueados_pipeline": "flag_cancelacion_pendiente",
    "cumplidas_en_plazo": "flag_cumplida_en_plazo", "canal_web": "canal = 'WEB'", "canal_app": "canal = 'APP'",
    "canal_sucursal": "canal = 'SUCURSAL'", "canal_email": "canal = 'EMAIL'",
}
_MET = _share("cumplidas_en_plazo", "total_completadas")
STEPS["comp"] = f"""
SELECT '2001-07-20' AS fecha_reporte, '2001-07-20 00:00:00.000000' AS timestamp_reporte, *,
       {_MET} * 100 AS pct_cumplimiento,
       {_share('alertas_vencidas', '(total_pendientes + total_en_proceso)')} * 100 AS pct_vencidas,
       CASE WHEN alertas_vencidas = 0 AND {_MET} >= 0.95 THEN 'VERDE'
            WHEN alertas_vencidas <= 3 AND {_MET} >= 0.80 THEN 'AMARILLO' ELSE 'ROJO' END AS semaforo_cumplimiento
FROM (SELECT count(*) AS total_solicitudes, avg(dias_transcurridos) AS promedio_dias_resolucion,
             max(dias_transcurridos) AS max_dias_sin_resolver,
             {', '.join(f'count(*) FILTER ({c}) AS {n}' for n, c in _COUNTED.items())} FROM factreq)"""

# Every cell of the inspected tables as text.
STEPS["cells"] = """
SELECT 'clientes_maestro' AS tabla, id, campo, celda FROM
    (UNPIVOT (SELECT id_cliente AS id, CAST(COLUMNS(* EXCLUDE (id_cliente)) AS VARCHAR) FROM cli)
     ON COLUMNS(* EXCLUDE (id)) INTO NAME campo VALUE celda)
UNION ALL
SELECT 'transacciones', id, campo, celda FROM
    (UNPIVOT (SELECT id_transaccion AS id, CAST(COLUMNS(* EXCLUDE (id_transaccion)) AS VARCHAR) FROM txn1)
     ON COLUMNS(* EXCLUDE (id)) INTO NAME campo VALUE celda)
UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), 'text', text FROM documents"""

_HOT = r"(?i)(rut|r\.u\.t|cédula|cedula|identificación|id)"
_R = "reverse(regexp_replace(muestra, '[^0-9]', '', 'g'))"
_TERM = f"CAST(substr({_R}, i, 1) AS INTEGER)"
_LUHN = (
    f"list_sum(list_transform(range(1, length({_R}) + 1), "
    f"lambda i: CASE WHEN i % 2 = 1 THEN {_TERM} ELSE {_TERM} * 2 - if({_TERM} > 4, 9, 0) END)) % 10 = 0"
)


def _hit(info_type: str, pattern: str, likelihood: str) -> str:
    return f"""
    SELECT tabla, id, campo, '{info_type}' AS info_type, muestra, {likelihood} AS likelihood, ocurrencia
    FROM (SELECT tabla, id, campo, unnest(l) AS muestra, CAST(generate_subscripts(l, 1) AS INTEGER) AS ocurrencia
          FROM (SELECT tabla, id, campo, regexp_extract_all(celda, '{pattern}') AS l FROM cells))"""


STEPS["allhits"] = f"""
    SELECT tabla, id, campo, 'CHILE_RUT' AS info_type, muestra,
           if(regexp_matches(antes, '{_HOT}'), 'VERY_LIKELY', 'LIKELY') AS likelihood, ocurrencia
    FROM (SELECT tabla, id, campo, unnest(a) AS antes, unnest(l) AS muestra,
                 CAST(generate_subscripts(l, 1) AS INTEGER) AS ocurrencia
          FROM (SELECT tabla, id, campo, regexp_extract_all(celda, '(?s)(.{{0,10}}?)({RUT})', 1) AS a,
                       regexp_extract_all(celda, '(?s)(.{{0,10}}?)({RUT})', 2) AS l FROM cells))
    UNION ALL {_hit('CHILE_PHONE', MOBILE, "'LIKELY'")}
    UNION ALL {_hit('EMAIL_ADDRESS', EMAIL, "'LIKELY'")}
    UNION ALL {_hit('PHONE_NUMBER', INTL, "'LIKELY'")}
    UNION ALL {_hit('CREDIT_CARD_NUMBER', CARD, f"if({_LUHN}, 'VERY_LIKELY', 'POSSIBLE')")}"""
STEPS["hits"] = "SELECT * FROM allhits WHERE likelihood IN ('LIKELY', 'VERY_LIKELY')"
_ODD = f"campo IN ({_list(UNEXPECTED_FIELDS)})"

_FEASTS = _list(h[5:] for h in HOLIDAYS_2026)
STEPS["cal"] = f"""
SELECT dia, habil, sum(CAST(habil AS INTEGER)) OVER (ORDER BY dia) AS ordinal
FROM (SELECT CAST(d AS DATE) AS dia, isodow(d) < 6 AND strftime(d, '%m-%d') NOT IN ({_FEASTS}) AS habil
      FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) + 120,
                                          INTERVAL 1 DAY)) AS d FROM orders))"""
STEPS["workday"] = "SELECT ordinal, dia FROM cal WHERE habil"

_CK = "CAST(substr(id_cliente, 2) AS BIGINT)"
STEPS["before"] = f"SELECT * FROM cli WHERE {_CK} % 50 <> 49"
STEPS["after"] = f"""
SELECT * REPLACE (
    CASE WHEN arcop_estado = 'ACTIVO' AND {_CK} % 70 = 9 THEN 'ELIMINADO'
         WHEN arcop_estado = 'ACTIVO' AND {_CK} % 45 = 8 THEN 'BLOQUEADO'
         WHEN arcop_estado = 'BLOQUEADO' AND {_CK} % 4 = 3 THEN 'ACTIVO' ELSE arcop_estado END AS arcop_estado,
    score_crediticio + if({_CK} % 90 = 17, 5, 0) AS score_crediticio) FROM cli"""
STEPS["moves"] = """
SELECT '2024-02-02' AS fecha, id_cliente,
       CASE WHEN b.id_cliente IS NULL THEN 'nuevos'
            WHEN b.arcop_estado = 'ACTIVO' AND a.arcop_estado = 'ELIMINADO' THEN 'eliminados'
            WHEN b.arcop_estado = 'ACTIVO' AND a.arcop_estado = 'BLOQUEADO' THEN 'bloqueados'
            WHEN b.arcop_estado = 'BLOQUEADO' AND a.arcop_estado = 'ACTIVO' THEN 'reactivados' END AS cambio
FROM after a LEFT JOIN before b USING (id_cliente)"""


def statement(select: str) -> str:
    """The SELECT with the shared steps it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(STEPS[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" + select


# --- one statement per query ------------------------------------------------

_G_CLI = f"* REPLACE ({_stamp('fecha_staging')} AS fecha_staging)"
_G_TXN = f"* REPLACE ({_stamp('fecha_staging')} AS fecha_staging, {_stamp('fecha_hora')} AS fecha_hora, {_day('fecha')} AS fecha)"
_FACT = (
    f"* REPLACE ({_stamp('fecha_staging')} AS fecha_staging, {_stamp('fecha_hora')} AS fecha_hora, "
    f"{_day('fecha')} AS fecha, {_stamp('fecha_gold')} AS fecha_gold)"
)
_DATES = ", ".join(f"{_day(c)} AS {c}" for c in ("fecha_solicitud", "fecha_limite", "fecha_resolucion"))
_DIM = (
    f"* REPLACE ({_stamp('fecha_staging')} AS fecha_staging, {_stamp('valid_from')} AS valid_from, "
    f"{_day('valid_to')} AS valid_to)"
)
_ML = f"* REPLACE ({_day('fecha')} AS fecha, {_stamp('fecha_gold')} AS fecha_gold)"
_CAST_TS = "CAST(rtrim(fecha_hora, 'Z') AS TIMESTAMP)"
_BY_CHANNEL = "(SELECT canal, count(*) AS total, count(*) FILTER (es_registro_valido) AS validas FROM g_txn GROUP BY canal)"
_TEXT_FLAG = "CAST(flag_uaf_threshold AS VARCHAR) AS flag_uaf_threshold"


def _check_rows() -> str:
    sources = {"clientes_deidentified": "s_cli", "transacciones_deidentified": "s_txn", "arcop_solicitudes": "req"}
    rows = []
    for c in SILVER_CHECKS:
        table, col = sources[c.table], c.column
        failing = {
            "not_null": f"SELECT count(*) FROM {table} WHERE {col} IS NULL",
            "unique": f"SELECT count(*) FROM (SELECT {col} FROM {table} GROUP BY {col} HAVING count(*) > 1)",
            "accepted_values": f"SELECT count(DISTINCT {col}) FROM {table} WHERE {col} NOT IN ({_list(c.values)})",
        }[c.kind]
        rows.append(f"SELECT '{c.name}' AS prueba, '{c.table}' AS tabla, '{col}' AS columna, ({failing}) AS fallos")
    return f"SELECT *, if(fallos = 0, 'OK', 'FALLA') AS estado FROM ({' UNION ALL '.join(rows)})"


def _aspect_rows() -> str:
    sources = {
        "clientes_deidentified": "s_cli", "transacciones_deidentified": "s_txn", "arcop_solicitudes": "req",
        "dim_cliente": "dim", "fact_transacciones": "fact", "fact_arcop_solicitudes": "factreq",
        "mart_calidad_datos": "qmart", "mart_arcop_compliance": "comp", "mart_anomalias": "anom",
    }
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, '{a.sensitivity_level}' AS sensitivity_level, {str(a.pii_present).lower()} AS pii_present, "
        f"{str(a.ley_19628_applies).lower()} AS ley_19628_applies, '{a.data_owner}' AS data_owner, "
        f"CAST({a.retention_years} AS INTEGER) AS retention_years, {str(a.arcop_relevant).lower()} AS arcop_relevant, "
        f"(SELECT count(*) FROM {sources[t]}) AS filas"
        for t, a in TABLE_ASPECTS.items()
    )


def _aspects_of(names: tuple[str, ...]) -> str:
    """The rows of published_aspects: those of the named tables, and one without aspects."""
    own = f"SELECT * FROM ({_aspect_rows()}) WHERE tabla IN ({_list(names)})"
    none = "NULL::VARCHAR, NULL::BOOLEAN, NULL::BOOLEAN, NULL::VARCHAR, NULL::INTEGER, NULL::BOOLEAN"
    return f"{own} UNION ALL SELECT 'sin_aspectos', {none}, (SELECT count(*) FROM req)"


def _preset(name: str, where: str) -> str:
    return (
        f"SELECT '{name}' AS periodo, count(*) AS n, CAST(min(fecha) AS VARCHAR) AS desde, "
        f"CAST(max(fecha) AS VARCHAR) AS hasta FROM fact {where}"
    )


SELECTS: dict[str, str] = {
    "bronze_scan": "SELECT * FROM cli",
    "bronze_hour": f"""SELECT *, CAST(CAST({_CAST_TS} AS DATE) AS VARCHAR) AS fecha, CAST(hour({_CAST_TS}) AS INTEGER) AS hora
        FROM txn1 WHERE date_trunc('hour', {_CAST_TS}) = TIMESTAMP '2024-01-10 13:00:00'""",
    "bronze_roundtrip": f"""SELECT *, CAST(CAST({_CAST_TS} AS DATE) AS VARCHAR) AS fecha,
        CAST(hour({_CAST_TS}) AS INTEGER) AS hora FROM txn1""",
    "silver_schema_cast": "SELECT * FROM s_cli",
    "gold_partitioned": f"SELECT {_FACT} FROM fact",
    "ctas_replace": f"SELECT {_ML} FROM ml",
    "staging_view": """SELECT canal, genero, count(*) AS n, count(*) FILTER (t.es_registro_valido) AS validas
        FROM g_txn t JOIN g_cli c USING (id_cliente) GROUP BY canal, genero""",
    "backfill_hours": f"""SELECT id_transaccion, monto_clp, {_day('fecha')} AS fecha, nivel_riesgo_anomalia, es_registro_valido,
        coalesce(es_registro_valido AND NOT es_duplicado AND monto_clp >= 0, false) AS clasificada
        FROM fact WHERE hour(fecha_hora) BETWEEN 8 AND 19""",
    "reload_hours": f"""SELECT if(hora = 10, 'ilegible', 'silver') AS tabla, CAST(fecha AS VARCHAR) AS fecha, hora, count(*) AS filas
        FROM (SELECT CAST({_CAST_TS} AS DATE) AS fecha, CAST(hour({_CAST_TS}) AS INTEGER) AS hora FROM txn1) GROUP BY ALL""",
    "published_versions": """SELECT 'anterior' AS version, canal, count(*) AS filas FROM fact WHERE canal = 'WEB' GROUP BY canal
        UNION ALL SELECT 'actual', canal, count(*) FROM fact GROUP BY canal""",
    "published_aspects": _aspects_of(("mart_anomalias", "dim_cliente", "fact_transacciones")),
    "pseudonymize": f"SELECT id_cliente, rut, left(sha256('{SALT}:' || rut), 16) AS rut_pseudo FROM cli",
    "mask_middle": f"""SELECT id_cliente, {_mask_middle('num_tarjeta', '*', 4, 4)} AS tarjeta,
        {_mask_middle('region', '#', 1, 0)} AS region, {_mask_middle('genero', '*', 1, 0)} AS genero FROM cli""",
    "mask_email": f"SELECT id_cliente, email, {_mask_email('email')} AS email_masked FROM cli",
    "mask_phone": f"SELECT id_cliente, telefono, {_mask_phone('telefono')} AS telefono_masked FROM cli",
    "mask_name": f"SELECT id_cliente, nombre_completo, {_mask_name('nombre_completo')} AS nombre_masked FROM cli",
    "bucket_balance": f"""SELECT id_cliente, {_balance('saldo_cuenta')} AS rango_saldo, {_income('renta_mensual')} AS rango_renta,
        {_debt('deuda_total')} AS rango_deuda, {_balance('saldo_cuenta', 'desconocido')} AS rango_saldo_cerrado FROM cli""",
    "age_bucket": f"SELECT id_cliente, fecha_nacimiento, {_age('fecha_nacimiento')} AS rango_edad FROM cli",
    "tokenize_card": f"""SELECT id_cliente, {_token('num_tarjeta')} AS num_tarjeta_fpe, {_token('num_cuenta')} AS num_cuenta_fpe,
        {_token('comuna')} AS comuna_fpe FROM cli""",
    "redact_documents": f"SELECT doc_id, {_redact('text')} AS texto FROM documents",
    "silver_clients": "SELECT * FROM s_cli",
    "silver_transactions": "SELECT * FROM s_txn",
    "silver_requests": "SELECT * FROM req",
    "redaction_preview": """SELECT id_transaccion, descripcion FROM s_txn WHERE contains(descripcion, '[')
        ORDER BY id_transaccion, fecha_deidentify LIMIT 3""",
    "pii_findings": "SELECT * FROM hits",
    "pii_hotword": """SELECT tabla, campo, likelihood, count(*) AS hallazgos FROM hits
        WHERE info_type = 'CHILE_RUT' GROUP BY ALL""",
    "pii_min_likelihood": "SELECT tabla, info_type, likelihood, count(*) AS hallazgos FROM allhits GROUP BY ALL",
    "pii_sample": "SELECT * FROM hits WHERE tabla = 'clientes_maestro'",
    "pii_bounded_sample": """SELECT * FROM hits WHERE tabla = 'clientes_maestro'
        AND id IN (SELECT id_cliente FROM cli ORDER BY md5(id_cliente), id_cliente LIMIT 100)
        ORDER BY md5(id || '|' || campo || '|' || info_type || '|' || ocurrencia) LIMIT 250""",
    "pii_by_field": "SELECT tabla, campo, info_type, count(*) AS hallazgos FROM hits GROUP BY ALL",
    "pii_alerts": f"SELECT * REPLACE (left(muestra, 50) AS muestra) FROM hits WHERE {_ODD}",
    "pii_field_class": f"""SELECT tabla, campo, info_type, count(*) AS hallazgos, if({_ODD}, 'INESPERADO', 'esperado') AS clase
        FROM hits GROUP BY ALL""",
    "pii_report": f"""SELECT '2024-01-28' AS fecha, CAST(0 AS BIGINT) AS hora, 'LIKELY' AS threshold, CAST(0 AS INTEGER) AS parte,
        tabla, registros_muestra, total_findings, (SELECT string_agg(campo || ':' || info_type || '=' || n, ',' ORDER BY campo || ':' || info_type || '=' || n)
         FROM (SELECT tabla AS tb, campo, info_type, count(*) AS n FROM hits GROUP BY ALL) WHERE tb = tabla) AS por_campo,
        (SELECT string_agg(campo || '|' || info_type || '|' || likelihood || '|' || left(muestra, 50), ';'
                           ORDER BY campo || '|' || info_type || '|' || likelihood || '|' || left(muestra, 50))
         FROM (SELECT * EXCLUDE (tabla), tabla AS tb FROM hits) WHERE tb = tabla AND {_ODD}) AS alertas,
        CAST(sum(total_findings) OVER () AS BIGINT) AS resumen_findings,
        CAST(sum(alertas) OVER () AS BIGINT) AS resumen_alertas,
        (SELECT string_agg(campo, ',' ORDER BY campo) FROM (SELECT DISTINCT campo FROM hits)) AS campos_con_pii,
        (SELECT string_agg(campo, ',' ORDER BY campo) FROM (SELECT DISTINCT campo FROM hits WHERE {_ODD})) AS campos_con_pii_inesperado
        FROM (SELECT tabla, count(*) AS total_findings, count(*) FILTER ({_ODD}) AS alertas FROM hits GROUP BY tabla)
        JOIN (SELECT 'clientes_maestro' AS tabla, count(*) AS registros_muestra FROM customer
              UNION ALL SELECT 'transacciones', count(*) FROM events
              UNION ALL SELECT 'documents', count(*) FROM documents) USING (tabla)""",
    "stg_clients": f"SELECT {_G_CLI} FROM g_cli",
    "client_validity": "SELECT id_cliente, es_registro_valido FROM g_cli",
    "stg_time_parts": f"""SELECT printf('T%09d', event_id) AS id_transaccion, {_stamp('ts')} AS fecha_hora,
        CAST(CAST(ts AS DATE) AS VARCHAR) AS fecha, CAST(hour(ts) AS INTEGER) AS hora,
        CAST(isodow(ts) % 7 + 1 AS INTEGER) AS dia_semana, strftime(ts, '%A') AS nombre_dia FROM events""",
    "stg_transactions": f"SELECT {_G_TXN} FROM g_txn",
    "txn_validity": "SELECT es_registro_valido, flag_campos_nulos, count(*) AS n FROM g_txn GROUP BY ALL",
    "stg_requests": f"SELECT * REPLACE ({_DATES}, {_stamp('fecha_staging')} AS fecha_staging) FROM g_req",
    "active_clients": "SELECT id_cliente, arcop_estado, rut_pseudo, region FROM act",
    "anomaly_candidates": "SELECT id_transaccion, monto_clp, score_anomalia, es_anomalia_flag FROM anom",
    "date_range": f"""SELECT id_transaccion, {_day('fecha')} AS fecha, monto_clp FROM fact
        WHERE fecha BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""",
    "date_preset": " UNION ALL ".join(
        (
            _preset("today", "WHERE fecha = DATE '2024-01-28'"),
            _preset("7d", "WHERE fecha BETWEEN DATE '2024-01-22' AND DATE '2024-01-28'"),
            _preset("30d", "WHERE fecha BETWEEN DATE '2023-12-30' AND DATE '2024-01-28'"),
            _preset("all", ""),
        )
    ),
    "fact_transactions": f"SELECT {_FACT} FROM fact",
    "fact_requests": f"SELECT * REPLACE ({_DATES}, {_stamp('fecha_gold')} AS fecha_gold) FROM factreq",
    "dim_client": f"SELECT {_DIM} FROM dim",
    "mart_anomalies": f"""SELECT * REPLACE ({_day('fecha')} AS fecha, {_stamp('fecha_hora')} AS fecha_hora,
        {_stamp('fecha_gold')} AS fecha_gold) FROM anom""",
    "daily_alerts": f"""SELECT {_day('fecha')} AS fecha, region, nivel_riesgo_anomalia, count(*) AS total_alertas,
        CAST(sum({_money('monto_clp')}) AS DOUBLE) AS monto_total_alertado, round(avg(score_anomalia), 6) AS score_promedio,
        count(*) FILTER (flag_uaf_threshold) AS alertas_uaf, max(monto_clp) AS monto_maximo
        FROM anom GROUP BY anom.fecha, region, nivel_riesgo_anomalia""",
    "risk_level": """SELECT id_transaccion, CASE WHEN score_anomalia >= 0.8 THEN 'ALTO' WHEN score_anomalia >= 0.5 THEN 'MEDIO'
        ELSE 'BAJO' END AS nivel FROM txn1""",
    "request_priority": "SELECT prioridad, tipo_derecho, count(*) AS n FROM factreq GROUP BY ALL",
    "quality_clients": f"""SELECT *, '2024-02-01' AS fecha, '2024-02-01 00:00:00.000000' AS timestamp_reporte,
        round({_VALID} * 100, 2) AS score_calidad, {_light(_VALID, 0.98, 0.95)} AS semaforo FROM qcli""",
    "quality_transactions": f"""SELECT *, '2024-01-28' AS fecha, '2024-01-28 00:00:00.000000' AS timestamp_reporte,
        round({_VALID} * 100, 2) AS score_calidad, {_light(_VALID, 0.98, 0.95)} AS semaforo FROM qtxn""",
    "quality_mart": "SELECT * FROM qmart",
    "quality_score": f"SELECT canal, round({_share('validas', 'total')} * 100, 2) AS score FROM {_BY_CHANNEL}",
    "traffic_light": f"""SELECT canal, {_light(_share('validas', 'total'), 0.98, 0.95)} AS semaforo,
        {_light(_share('validas', 'total'), 0.90, 0.75)} AS semaforo_tablero FROM {_BY_CHANNEL}""",
    "compliance_mart": "SELECT * FROM comp",
    "compliance_pct": "SELECT pct_cumplimiento, pct_vencidas FROM comp",
    "compliance_days": "SELECT promedio_dias_resolucion, max_dias_sin_resolver FROM comp",
    "compliance_light": "SELECT alertas_vencidas, cumplidas_en_plazo, semaforo_cumplimiento FROM comp",
    "batch_profile": """SELECT *, round(duplicados * 100.0 / total, 2) AS pct_duplicados, round(anomalas * 100.0 / total, 2) AS pct_anomalas,
        round(con_nulos * 100.0 / total, 2) AS pct_con_nulos, round(pii_en_descripcion * 100.0 / total, 2) AS pct_pii_en_descripcion
        FROM (SELECT count(*) AS total, count(*) FILTER (es_duplicado) AS duplicados, count(*) FILTER (es_anomalia_flag) AS anomalas,
                     count(*) FILTER (categoria_gasto IS NULL) AS con_nulos,
                     count(*) FILTER (regexp_matches(descripcion, 'RUT|tarjeta|@')) AS pii_en_descripcion FROM txn1)""",
    "latest_per_key": f"""SELECT * EXCLUDE (rn) REPLACE ({_stamp('l_shipdate')} AS l_shipdate) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
    "score_normalize": "SELECT id_transaccion, distancia_centroide, score_ml FROM ml",
    "p95_sketches": f"SELECT count(DISTINCT {_day('fecha')}) AS dias, CAST(count(d) AS BIGINT) AS filas, true AS dentro FROM fixed WHERE d IS NOT NULL",
    "classify_p95": "SELECT id_transaccion, clasificacion_ml FROM ml",
    "regions_ratio": """SELECT region, total, round(CAST(total AS DOUBLE) / max(total) OVER () * 100, 0) AS porcentaje FROM (
        SELECT region, count(*) AS total FROM ml WHERE clasificacion_ml = 'ANOMALA' GROUP BY region
        ORDER BY total DESC, region NULLS LAST LIMIT 6)""",
    "q_kpis": """SELECT (SELECT count(*) FROM dim WHERE is_current) AS clientes, count(*) AS transacciones,
        count(*) FILTER (clasificacion_ml = 'ANOMALA') AS anomalias, count(*) FILTER (flag_uaf_threshold) AS uaf FROM period""",
    "q_quality": "SELECT tabla, score_calidad, semaforo FROM qmart",
    "q_compliance": """SELECT total_solicitudes, total_pendientes, total_completadas, alertas_vencidas AS total_vencidas,
        alertas_proximas_vencer AS proximas_vencer, round(coalesce(pct_cumplimiento, 0), 1) AS tasa_cumplimiento,
        semaforo_cumplimiento FROM comp""",
    "q_regions": """SELECT region, count(*) AS total FROM period WHERE clasificacion_ml = 'ANOMALA' GROUP BY region
        ORDER BY total DESC, region NULLS LAST LIMIT 6""",
    "q_clients": """SELECT id_cliente, rut_pseudo, nombre_masked, email_masked, rango_edad, rango_saldo, region, categoria_riesgo
        FROM dim WHERE is_current ORDER BY id_cliente LIMIT 20""",
    "q_top_anomalies": f"""SELECT id_transaccion, {_day('fecha')} AS fecha, canal, monto_clp, hora, cluster_id, clasificacion_ml,
        {_TEXT_FLAG} FROM period WHERE clasificacion_ml = 'ANOMALA' ORDER BY monto_clp DESC, id_transaccion LIMIT 15""",
    "q_ml_summary": f"""SELECT clasificacion_ml, count(*) AS total, round(avg({_money('monto_clp')}), 0) AS monto_prom,
        count(*) FILTER (flag_uaf_threshold) AS uaf FROM period GROUP BY clasificacion_ml""",
    "ml_summary": f"""SELECT clasificacion_ml, count(*) AS total, round(avg({_money('monto_clp')}), 0) AS monto_promedio,
        round(avg(score_ml), 4) AS score_ml_promedio, count(*) FILTER (flag_uaf_threshold) AS alertas_uaf
        FROM ml GROUP BY clasificacion_ml""",
    "q_client_ids": "SELECT DISTINCT id_cliente FROM dim WHERE is_current ORDER BY id_cliente LIMIT 100",
    "q_client_detail": """SELECT id_cliente, rut_pseudo, nombre_masked, email_masked, rango_edad, rango_saldo, rango_renta, region,
        genero, ocupacion, score_crediticio, categoria_riesgo, arcop_estado, tipo_cuenta, CAST(valid_from AS VARCHAR) AS valid_from
        FROM dim WHERE is_current AND id_cliente = 'C0000009'""",
    "q_client_txn": f"""SELECT {_day('fecha')} AS fecha, hora, canal, monto_clp, clasificacion_ml, nivel_riesgo_anomalia, {_TEXT_FLAG}
        FROM ml WHERE id_cliente = 'C0000009' ORDER BY ml.fecha DESC, hora DESC, id_transaccion LIMIT 8""",
    "q_client_requests": """SELECT tipo_derecho, estado, vence_en_dias AS dias_restantes, prioridad, flag_vencida, flag_proxima_vencer
        FROM factreq WHERE id_cliente = 'C0000009' ORDER BY fecha_solicitud DESC, id_solicitud LIMIT 5""",
    "dq_not_null": """SELECT id_cliente, 'region' AS columna FROM cli WHERE region IS NULL
        UNION ALL SELECT id_cliente, 'fecha_nacimiento' FROM cli WHERE fecha_nacimiento IS NULL""",
    "dq_unique": "SELECT id_transaccion, count(*) AS n FROM txn GROUP BY id_transaccion HAVING count(*) > 1",
    "dq_accepted": """SELECT genero AS valor, count(*) AS n FROM cli WHERE genero NOT IN ('M', 'F') GROUP BY genero
        UNION ALL SELECT canal, count(*) FROM txn1 WHERE canal NOT IN ('APP', 'WEB', 'POS') GROUP BY canal""",
    "dq_suite": _check_rows(),
    "column_policy": _DIM.join(("SELECT ", " FROM dim")).replace(
        "REPLACE (", "REPLACE (CAST(NULL AS VARCHAR) AS rut_pseudo, CAST(NULL AS BIGINT) AS score_crediticio, "
    ),
    "guarded_columns": """SELECT d.rango_saldo, f.canal, count(*) AS n, count(DISTINCT f.id_cliente) AS clientes
        FROM fact f JOIN dim d USING (id_cliente) GROUP BY ALL""",
    "table_aspects": _aspect_rows(),
    "rut_check": f"""SELECT id_cliente, left(rut, length(rut) - 1) || '0' AS rut FROM cli
        WHERE {_CK} % 11 = 4 AND right(rut, 1) <> '0'""",
    "region_commune": f"""SELECT c.id_cliente, c.region, c.comuna FROM
        (SELECT id_cliente, region, if({_CK} % 61 = 7, 'NATION_0', comuna) AS comuna FROM cli) c
        JOIN nation ON n_name = c.comuna JOIN region r ON r_regionkey = n_regionkey WHERE c.region <> r.r_name""",
    "business_days": f"""SELECT o_orderkey, {_day('dia')} AS dia, habil FROM orders
        JOIN cal ON cal.dia = CAST(o_orderdate AS DATE)""",
    "business_calendar": f"""SELECT {_day('c.dia')} AS dia, habil, strftime(c.dia, '%m-%d') IN ({_FEASTS}) AS festivo,
        CAST(c.ordinal AS INTEGER) AS ordinal, {_day('w.dia')} AS siguiente_habil, coalesce(pedidos, 0) AS pedidos
        FROM cal c JOIN workday w ON w.ordinal = c.ordinal + 1
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS dia, count(*) AS pedidos FROM orders GROUP BY 1) o ON o.dia = c.dia
        WHERE c.dia <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "add_business_days": f"""SELECT o_orderkey, {_day('cal.dia')} AS dia, {_day('w.dia')} AS limite FROM orders
        JOIN cal ON cal.dia = CAST(o_orderdate AS DATE) JOIN workday w ON w.ordinal = cal.ordinal + 15""",
    "request_state": f"""SELECT id_solicitud, {_day('visto')} AS visto, {_day('limite')} AS limite, {_day('resolucion')} AS resolucion,
        CASE WHEN visto = dia THEN 'PENDIENTE' WHEN visto <= dia + 2 OR visto < dia + CAST(dias AS INTEGER) THEN 'EN_PROCESO'
             WHEN resolucion > limite THEN 'VENCIDO' ELSE 'COMPLETADO' END AS estado
        FROM (SELECT id_solicitud, cal.dia AS dia, dias_resolucion_estimados AS dias, l.dia AS limite, s.dia AS resolucion,
                     cal.dia + CAST(n % 21 AS INTEGER) AS visto
              FROM (SELECT *, CAST(substr(id_solicitud, 6) AS BIGINT) AS n FROM req) q
              JOIN cal ON cal.dia = CAST(fecha_solicitud AS DATE)
              JOIN workday l ON l.ordinal = cal.ordinal + 15
              JOIN workday s ON s.ordinal = cal.ordinal + dias_resolucion_estimados + n % 3)""",
    "calendar_features": """SELECT o_orderkey, day(o_orderdate) IN (15, 16) OR day(o_orderdate) >= 28 AS quincena FROM orders""",
    "snapshot_delta": """SELECT '2024-02-02' AS fecha, CAST(0 AS INTEGER) AS parte,
        coalesce(string_agg(id_cliente, ',' ORDER BY id_cliente) FILTER (cambio = 'nuevos'), '') AS nuevos,
        coalesce(string_agg(id_cliente, ',' ORDER BY id_cliente) FILTER (cambio = 'eliminados'), '') AS eliminados,
        coalesce(string_agg(id_cliente, ',' ORDER BY id_cliente) FILTER (cambio = 'bloqueados'), '') AS bloqueados,
        coalesce(string_agg(id_cliente, ',' ORDER BY id_cliente) FILTER (cambio = 'reactivados'), '') AS reactivados,
        (SELECT count(*) FROM after) AS total_maestro,
        (SELECT count(*) FROM after WHERE arcop_estado = 'ACTIVO') AS total_activos FROM moves""",
    "snapshot_changes": "SELECT fecha, cambio, id_cliente FROM moves WHERE cambio IS NOT NULL",
    "scd2_merge": f"""SELECT id_cliente, b.arcop_estado, b.score_crediticio, b.region, '2024-01-01 00:00:00.000000' AS valid_from,
        if(same, '9999-12-31', '2024-02-02') AS valid_to, same AS is_current FROM (
            SELECT id_cliente, b, (b.arcop_estado, b.score_crediticio, b.region)
                   IS NOT DISTINCT FROM (a.arcop_estado, a.score_crediticio, a.region) AS same
            FROM before b JOIN after a USING (id_cliente))
        UNION ALL
        SELECT id_cliente, a.arcop_estado, a.score_crediticio, a.region, '2024-02-02 00:00:00.000000', '9999-12-31', true
        FROM after a LEFT JOIN before b USING (id_cliente)
        WHERE b.id_cliente IS NULL OR (b.arcop_estado, b.score_crediticio, b.region)
              IS DISTINCT FROM (a.arcop_estado, a.score_crediticio, a.region)""",
    "ml_training_set": "SELECT monto_clp, hora, dia_semana, score_anomalia FROM dist WHERE arcop_estado <> 'ELIMINADO'",
    "training_count": "SELECT count(*) AS total FROM dist WHERE arcop_estado <> 'ELIMINADO'",
    "stream_silver": f"SELECT {_S_TXN}, {_iso(f'CAST({CLIENTS_DAY} AS TIMESTAMP)')} AS fecha_deidentify FROM txn1",
    "stream_dedupe": f"""SELECT DISTINCT id_transaccion, id_cliente, monto_clp, {_stamp(_CAST_TS)} AS fecha_hora FROM txn""",
    "stream_alert_windows": f"""SELECT {_stamp('inicio')} AS desde, {_stamp("inicio + INTERVAL 1 HOUR")} AS hasta, region, count(*) AS total_alertas,
        CAST(sum({_money('monto_clp')}) AS DOUBLE) AS monto_total_alertado, max(monto_clp) AS monto_maximo
        FROM (SELECT *, date_trunc('hour', momento) AS inicio, max(momento) OVER () AS ultimo
              FROM (SELECT *, {_CAST_TS} AS momento FROM txn1 WHERE score_anomalia >= 0.5))
        WHERE inicio + INTERVAL 1 HOUR <= ultimo - INTERVAL 1 DAY GROUP BY inicio, region""",
    "stream_alerts": f"""SELECT {_stamp('inicio')} AS desde, region, count(*) AS total_alertas,
        CAST(sum({_money('monto_clp')}) AS DOUBLE) AS monto_total_alertado, max(monto_clp) AS monto_maximo
        FROM (SELECT *, date_trunc('hour', {_CAST_TS}) AS inicio FROM txn1 WHERE score_anomalia >= 0.5) GROUP BY inicio, region""",
    "ml_train": """SELECT CAST(5 AS BIGINT) AS grupos, CAST(1 AS INTEGER) AS primero, CAST(5 AS INTEGER) AS ultimo, count(*) AS filas,
        true AS mejor_que_uno FROM dist WHERE arcop_estado <> 'ELIMINADO'""",
    "ml_scored": """SELECT id_transaccion, cluster_id, round(d, 9) AS distancia_centroide,
        round(d / nullif(max(d) OVER (), 0), 4) AS score_ml,
        if(es_anomalia_flag OR d > quantile_cont(d, 0.95) OVER (), 'ANOMALA', 'NORMAL') AS clasificacion_ml FROM fixed""",
    "ml_centroids": """SELECT centroid_id, feature, numerical_value, filas FROM (
            SELECT c AS centroid_id, unnest(['monto_clp', 'hora', 'dia_semana', 'score_anomalia']) AS feature,
                   unnest([a * 800000.0 + 900000.0, b * 6.5 + 12.0, e * 2.0 + 4.0, f * 0.125 + 0.25])::DOUBLE AS numerical_value FROM centres)
        LEFT JOIN (SELECT cluster_id AS centroid_id, count(*) AS filas FROM fixed WHERE arcop_estado <> 'ELIMINADO' GROUP BY cluster_id)
        USING (centroid_id)""",
    "ml_evaluate": """SELECT round(avg(worst), 6) AS davies_bouldin_index, (SELECT round(sum(sq) / sum(n), 6) FROM own) AS mean_squared_distance,
               (SELECT CAST(sum(n) AS BIGINT) FROM own) AS filas
        FROM (SELECT x.cluster_id, max((x.s + y.s) / sqrt((p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.e - q.e) ** 2 + (p.f - q.f) ** 2)) AS worst
              FROM own x JOIN own y ON x.cluster_id <> y.cluster_id JOIN centres p ON p.c = x.cluster_id
              JOIN centres q ON q.c = y.cluster_id GROUP BY x.cluster_id)""",
}

# The report written as JSON and read back holds the same.
SELECTS["report_json"] = SELECTS["pii_report"]
SELECTS["scd2_table"] = SELECTS["scd2_merge"]


def all_statements() -> dict[str, str]:
    return {name: statement(select) for name, select in SELECTS.items()}
