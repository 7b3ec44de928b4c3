"""Bronze to Silver: the de-identification jobs, one projection each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide import schemas
from silvertide.functions import buckets as B
from silvertide.functions import masking as M
from silvertide.functions.rules import instant

VERSION = "1.0"
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@dataclass(frozen=True)
class Keys:
    """Secrets of the tokens; they come from the caller or the session settings."""

    salt: str
    token: str

    @classmethod
    def from_session(cls, spark: SparkSession) -> Keys:
        salt = spark.conf.get("spark.silvertide.salt", None)
        token = spark.conf.get("spark.silvertide.tokenKey", None)
        if not salt or not token:
            raise ValueError("set spark.silvertide.salt and spark.silvertide.tokenKey")
        return cls(salt, token)


def conform(df: DataFrame, schema) -> DataFrame:
    """Exactly the columns and types of a schema, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _load_time(as_of: datetime | str | Column) -> Column:
    return F.date_format(instant(as_of), ISO_INSTANT)


def deidentify_clients(df: DataFrame, as_of: datetime | str, keys: Keys) -> DataFrame:
    """31 client fields in, 32 out; exact money, birth date and commune stay behind."""
    derived = {
        "rut_pseudo": M.pseudonymize("rut", keys.salt),
        "nombre_masked": M.mask_name("nombre_completo"),
        "email_masked": M.mask_email("email"),
        "telefono_masked": M.mask_phone("telefono"),
        "num_tarjeta_fpe": M.tokenize_number("num_tarjeta", keys.token),
        "num_cuenta_fpe": M.tokenize_number("num_cuenta", keys.token),
        "rango_edad": B.age_bucket("fecha_nacimiento", str(as_of)[:10]),
        "rango_saldo": B.bucketize("saldo_cuenta", B.BALANCE),
        "rango_renta": B.bucketize("renta_mensual", B.INCOME),
        "rango_deuda": B.bucketize("deuda_total", B.DEBT),
        "comentario_operador": M.redact_text("comentario_operador"),
        "fecha_deidentify": _load_time(as_of),
        "version_dlp": F.lit(VERSION),
    }
    return _project(df, schemas.SILVER_CLIENTS, derived)


def deidentify_transactions(
    df: DataFrame, as_of: datetime | str | Column, keys: Keys, keep: Sequence[str] = ()
) -> DataFrame:
    """Account token and text redaction; business fields stay, the commune does not.

    `keep` names further columns to carry along, such as the arrival hour.
    """
    derived = {
        "num_cuenta_fpe": M.tokenize_number("num_cuenta", keys.token),
        "descripcion": M.redact_text("descripcion"),
        "fecha_deidentify": _load_time(as_of),
    }
    return _project(df, schemas.SILVER_TRANSACTIONS, derived, keep)


def conform_requests(df: DataFrame) -> DataFrame:
    """Requests hold no direct personal data: types only."""
    return conform(df, schemas.SILVER_REQUESTS)


def _project(df: DataFrame, schema, derived: dict[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        *[derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields], *keep
    )


def redaction_preview(df: DataFrame, n: int = 3) -> DataFrame:
    """A few transactions whose text was redacted."""
    return (
        df.where(F.col("descripcion").contains("["))
        .orderBy("id_transaccion", "fecha_deidentify")
        .select("id_transaccion", "descripcion")
        .limit(n)
    )
