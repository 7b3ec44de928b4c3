"""Silver to staging: typed columns, quality flags, validity."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.functions.buckets import UNKNOWN
from silvertide.functions.rules import instant, is_true

REPORTING_THRESHOLD = 5_000_000
OPEN_STATES = ("PENDIENTE", "EN_PROCESO")
# Tags that mark redacted text.
TEXT_TAGS = ("[CHILE_RUT]", "[EMAIL_ADDRESS]", "[PHONE_NUMBER]", "[CREDIT_CARD_NUMBER]", "[PERSON_NAME]")


def _with_flags(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    return df.withColumns({name: is_true(cond) for name, cond in flags.items()})


def stage_clients(df: DataFrame, as_of: datetime | str) -> DataFrame:
    """Client flags; a client is valid when none is raised. The free comment is dropped."""
    score = F.col("score_crediticio")
    flags = {
        "flag_email_invalido": ~F.col("email_masked").contains("@"),
        "flag_genero_invalido": ~F.col("genero").isin("M", "F"),
        "flag_score_fuera_rango": ~score.between(300, 900),
        "flag_score_categoria_inconsistente": (score > 750) & (F.col("categoria_riesgo") == "ALTO"),
        "flag_edad_invalida": F.col("rango_edad").isin("menor_18", UNKNOWN),
        "flag_saldo_invalido": F.col("rango_saldo") == UNKNOWN,
    }
    raised = None
    for name in flags:
        raised = F.col(name) if raised is None else raised | F.col(name)
    return (
        _with_flags(df.drop("comentario_operador"), flags)
        .withColumn("es_registro_valido", ~raised)
        .withColumn("fecha_staging", instant(as_of))
    )


def with_time_parts(df: DataFrame, column: str = "fecha_hora", tz: str | None = None) -> DataFrame:
    """Timestamp, day, hour, weekday (1 is Sunday) and English day name.

    Parts are taken in the session zone (UTC); `tz` takes them in another one.
    """
    moment = F.col(column).cast("timestamp")
    local = F.col(column) if tz is None else F.from_utc_timestamp(column, tz)
    return df.withColumn(column, moment).withColumns(
        {
            "fecha": F.to_date(local),
            "hora": F.hour(local),
            "dia_semana": F.dayofweek(local),
            "nombre_dia": F.date_format(local, "EEEE"),
        }
    )


def stage_transactions(
    df: DataFrame, as_of: datetime | str, threshold: float = REPORTING_THRESHOLD, tz: str | None = None
) -> DataFrame:
    """Transaction flags and validity. A missing region is flagged yet still valid."""
    text = F.col("descripcion")
    tagged = text.contains(TEXT_TAGS[0])
    for tag in TEXT_TAGS[1:]:
        tagged = tagged | text.contains(tag)
    no_category = F.col("categoria_gasto").isNull()
    flags = {
        "flag_monto_negativo": F.col("monto_clp") < 0,
        "flag_fecha_futura": F.col("fecha_hora") > instant(as_of),
        "flag_campos_nulos": no_category | F.col("region").isNull(),
        "flag_pii_en_descripcion": tagged,
        "flag_uaf_threshold": F.col("monto_clp") >= threshold,
    }
    return (
        _with_flags(with_time_parts(df, tz=tz), flags)
        .withColumn(
            "es_registro_valido",
            ~(F.col("flag_monto_negativo") | F.col("flag_fecha_futura") | no_category),
        )
        .withColumn("fecha_staging", instant(as_of))
    )


def stage_requests(df: DataFrame, as_of: datetime | str) -> DataFrame:
    """Request dates, age and legal flags; an unknown date raises no flag."""
    today = F.to_date(instant(as_of))
    days = ("fecha_solicitud", "fecha_limite", "fecha_resolucion")
    still_open = F.col("estado").isin(*OPEN_STATES)
    flags = {
        "flag_vencida": still_open & (F.col("fecha_limite") < today),
        "flag_proxima_vencer": still_open & F.col("vence_en_dias").between(1, 3),
        "flag_cancelacion_pendiente": (F.col("tipo_derecho") == "C") & (F.col("estado") != "COMPLETADO"),
        "flag_cumplida_en_plazo": (F.col("estado") == "COMPLETADO")
        & (F.col("fecha_resolucion") <= F.col("fecha_limite")),
    }
    dated = df.withColumns({c: F.to_date(c) for c in days}).withColumn(
        "dias_transcurridos", F.datediff(today, "fecha_solicitud")
    )
    return _with_flags(dated, flags).withColumn("fecha_staging", instant(as_of))


def date_range(
    df: DataFrame, column: str = "fecha", start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Rows between optional inclusive bounds, as typed literals so partitions are pruned."""
    for bound, keep in ((start, lambda c, v: c >= v), (end, lambda c, v: c <= v)):
        if bound:
            df = df.where(keep(F.col(column), F.lit(date.fromisoformat(str(bound)))))
    return df


# Days a preset reaches back.
PRESETS = {"today": 0, "7d": 6, "30d": 29}


def period_bounds(preset: str, as_of: date | str) -> tuple[date | None, date | None]:
    """First and last day of a preset; any other name means no bound."""
    if preset not in PRESETS:
        return None, None
    end = date.fromisoformat(str(as_of)[:10])
    return end - timedelta(days=PRESETS[preset]), end
