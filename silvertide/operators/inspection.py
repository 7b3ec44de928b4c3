"""Search for personal data in any table, as a distributed pattern scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from itertools import accumulate
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvertide.functions import patterns as P
from silvertide.functions.masking import ColumnLike, as_col
from silvertide.functions.rules import instant, luhn_is_valid

# Certainty levels, lowest first.
LIKELIHOODS = ("VERY_UNLIKELY", "UNLIKELY", "POSSIBLE", "LIKELY", "VERY_LIKELY")
MIN_LIKELIHOOD = "LIKELY"

# Fields where personal data is normal, and where it is an alert.
EXPECTED_FIELDS = ("rut", "nombre_completo", "email", "telefono", "num_tarjeta", "num_cuenta")
UNEXPECTED_FIELDS = (
    "descripcion", "comentario_operador", "categoria_gasto", "region", "comuna", "ocupacion",
)
QUOTE_LIMIT = 50
#: Alerts that one part of a report may hold on average.
ALERTS_PER_PART = 100_000
#: Ranges of the sampling key, by its first three hex digits.
KEY_RANGES = 4096


@dataclass(frozen=True)
class Detector:
    """A pattern, its certainty, and what a cell must have for it to be able to match."""

    info_type: str
    pattern: str
    likelihood: str = "LIKELY"
    needs: str | None = None
    min_length: int = 0
    hotwords: str | None = None
    luhn: bool = False

    def possible(self, cell: Column) -> Column:
        """Cheap test that spares most cells the pattern."""
        long_enough = F.length(cell) >= self.min_length
        return long_enough & cell.contains(self.needs) if self.needs else long_enough


DETECTORS = (
    Detector("CHILE_RUT", P.RUT, needs="-", min_length=9, hotwords=P.RUT_HOTWORDS),
    Detector("CHILE_PHONE", P.MOBILE, needs="56", min_length=11),
    Detector("EMAIL_ADDRESS", P.EMAIL, needs="@", min_length=6),
    Detector("PHONE_NUMBER", P.INTL_PHONE, needs="+", min_length=9),
    # Sixteen digits that pass the Luhn test are a card; others only might be one.
    Detector("CREDIT_CARD_NUMBER", P.CARD, likelihood="POSSIBLE", min_length=16, luhn=True),
)


def likelihood_rank(value: ColumnLike) -> Column:
    levels = F.array(*[F.lit(x) for x in LIKELIHOODS])
    return F.array_position(levels, as_col(value))


def _findings(cell: Column, detector: Detector) -> Column:
    """Array of (info_type, muestra, likelihood, ocurrencia) for one cell."""

    def finding(quote: Column, position: Column, likelihood: Column) -> Column:
        return F.struct(
            F.lit(detector.info_type).alias("info_type"),
            quote.alias("muestra"),
            likelihood.alias("likelihood"),
            (position + 1).cast("int").alias("ocurrencia"),
        )

    base = F.lit(detector.likelihood)
    if detector.hotwords:
        # Lazy prefix: up to the window's characters before each match.
        framed = F.lit(rf"(?s)(.{{0,{P.HOTWORD_WINDOW}}}?)({detector.pattern})")
        pairs = F.arrays_zip(
            F.regexp_extract_all(cell, framed, 1).alias("antes"),
            F.regexp_extract_all(cell, framed, 2).alias("valor"),
        )
        found = F.transform(
            pairs,
            lambda x, i: finding(
                x["valor"], i, F.when(x["antes"].rlike(detector.hotwords), "VERY_LIKELY").otherwise(base)
            ),
        )
    else:
        quotes = F.regexp_extract_all(cell, F.lit(detector.pattern), 0)
        if detector.luhn:
            found = F.transform(
                quotes,
                lambda q, i: finding(q, i, F.when(luhn_is_valid(q), "VERY_LIKELY").otherwise(base)),
            )
        else:
            found = F.transform(quotes, lambda q, i: finding(q, i, base))
    empty = F.array().cast(
        "array<struct<info_type:string,muestra:string,likelihood:string,ocurrencia:int>>"
    )
    possible = detector.possible(cell)
    if detector.hotwords:
        # The pattern with its prefix is slow, so only cells with a match pay for it.
        possible = possible & cell.rlike(detector.pattern)
    return F.when(possible, found).otherwise(empty)


def cell_text(df: DataFrame, name: str) -> Column:
    """A cell as text; fractions in plain digits, not with an exponent, from 1e-4 to 1e16."""
    col = F.col(name)
    text = col.cast("string")
    if not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return text
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    return F.when(text.contains("E") & (F.abs(col) >= 1e-4) & (F.abs(col) < 1e16), plain).otherwise(text)


def least_rows(df: DataFrame, key: Column, ties: Sequence[Column], n: int) -> DataFrame:
    """The n rows with the least key, a lower-case hex text spread evenly; equal keys go by `ties`.

    The same rows whatever the layout. A first pass counts the rows of KEY_RANGES ranges of the key; of the rows, only
    those in the ranges that hold the n least are ordered, and each task sends on no more than n of them.
    """
    if n < 0:
        raise ValueError("a number of rows cannot be negative")
    digits = len(f"{KEY_RANGES - 1:x}")
    head = F.left(key, F.lit(digits))
    counts = {int(r[0], 16): r[1] for r in df.groupBy(head.alias("h")).agg(F.count("*").alias("n")).collect()}
    reached = accumulate(counts.get(i, 0) for i in range(KEY_RANGES))
    last = next((i for i, total in enumerate(reached) if total >= n), KEY_RANGES - 1)
    return df.where(head <= f"{last:0{digits}x}").orderBy(key, *ties).limit(n)


def scan_pii(
    df: DataFrame,
    id_col: str,
    fields: Sequence[str] | None = None,
    detectors: Sequence[Detector] = DETECTORS,
    min_likelihood: str = MIN_LIKELIHOOD,
    table: str = "tabla",
    sample_rows: int | None = None,
    max_findings: int | None = None,
) -> DataFrame:
    """Every finding: (tabla, id, campo, info_type, muestra, likelihood, ocurrencia).

    Each cell becomes one narrow row, is scanned once per detector, and gives
    its findings; nothing is shuffled. The whole table is read, unless
    `sample_rows` asks for that many rows, those with the least MD5 of the id (a
    null id counts as empty text), then by their cells. `max_findings` keeps that
    many findings, those with the least MD5 of id, field, type and occurrence.
    """
    names = list(fields) if fields is not None else [c for c in df.columns if c != id_col]
    if sample_rows is not None:
        own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
        df = least_rows(df.select(id_col, *names), F.md5(own.cast("binary")), [own, *[cell_text(df, c) for c in names]], sample_rows)
    found = _scan(df, id_col, names, detectors, min_likelihood, table)
    if max_findings is None:
        return found
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("id", "campo", "info_type", "ocurrencia")]
    return least_rows(found, F.md5(F.concat_ws("|", *place).cast("binary")), [*place, F.col("muestra")], max_findings)


def _scan(
    df: DataFrame, id_col: str, names: Sequence[str], detectors: Sequence[Detector], min_likelihood: str, table: str
) -> DataFrame:
    cells = df.select(
        F.col(id_col).cast("string").alias("id"), *[cell_text(df, c).alias(c) for c in names]
    ).unpivot("id", names, "campo", "celda")
    arrays = [_findings(F.col("celda"), d) for d in detectors]
    worth = reduce(or_, [d.possible(F.col("celda")) for d in detectors])
    return (
        cells.where(worth)
        .select(F.lit(table).alias("tabla"), "id", "campo", F.inline(F.concat(*arrays)))
        .where(likelihood_rank("likelihood") >= LIKELIHOODS.index(min_likelihood) + 1)
    )


def pii_by_field(findings: DataFrame) -> DataFrame:
    return findings.groupBy("tabla", "campo", "info_type").agg(F.count("*").alias("hallazgos"))


def classify_field(field: ColumnLike, unexpected: Iterable[str] = UNEXPECTED_FIELDS) -> Column:
    """INESPERADO for listed fields; all others, listed as expected or not, are normal."""
    return F.when(as_col(field).isin(*unexpected), "INESPERADO").otherwise("esperado")


def pii_alerts(findings: DataFrame, unexpected: Iterable[str] = UNEXPECTED_FIELDS) -> DataFrame:
    """Findings in fields that should hold no personal data, quote cut to 50 characters."""
    return findings.where(F.col("campo").isin(*unexpected)).withColumn(
        "muestra", F.left("muestra", F.lit(QUOTE_LIMIT))
    )


def pii_summary(findings: DataFrame, unexpected: Iterable[str] = UNEXPECTED_FIELDS) -> DataFrame:
    """Totals per table and the distinct fields with (unexpected) personal data.

    Counts are merged per field first, so the field lists are built from a few rows.
    """
    per_field = findings.groupBy("tabla", "campo").agg(F.count("*").alias("n"))
    odd = F.col("campo").isin(*unexpected)
    return per_field.groupBy("tabla").agg(
        F.sum("n").alias("total_findings"),
        F.sum(F.when(odd, F.col("n")).otherwise(0)).alias("total_alertas"),
        F.array_sort(F.collect_set("campo")).alias("campos_con_pii"),
        F.array_sort(F.collect_set(F.when(odd, F.col("campo")))).alias("campos_con_pii_inesperado"),
    )


def pii_report(
    findings: DataFrame,
    as_of: datetime | str,
    rows_scanned: DataFrame,
    threshold: str = MIN_LIKELIHOOD,
    unexpected: Iterable[str] = UNEXPECTED_FIELDS,
    parts: int | None = None,
) -> DataFrame:
    """Nested inspection report, one row per table and part.

    `rows_scanned` holds (tabla, registros_muestra). The counts are nested maps
    of a size set by the schema. The alert list is as long as there are alerts;
    it is shared out over parts, which together hold every alert: as many as asked
    for, or by the number of alerts, ALERTS_PER_PART to one. `pii_alerts` has
    them as rows. `findings` is read several times, so pass a written table.
    """
    unexpected = tuple(unexpected)
    alerts = pii_alerts(findings, unexpected)
    if parts is None:
        parts = max(1, ceil(alerts.count() / ALERTS_PER_PART))
    by_type = pii_by_field(findings)
    by_field = by_type.groupBy("tabla", "campo").agg(
        F.map_from_entries(F.collect_list(F.struct("info_type", "hallazgos"))).alias("tipos")
    )
    nested = by_field.groupBy("tabla").agg(
        F.map_from_entries(F.collect_list(F.struct("campo", "tipos"))).alias("findings_por_campo")
    )
    listed = (
        alerts.withColumn("parte", F.pmod(F.xxhash64("id", "campo", "info_type", "ocurrencia"), F.lit(parts)).cast("int"))
        .groupBy("tabla", "parte")
        .agg(F.array_sort(F.collect_list(F.struct("campo", "info_type", "likelihood", "muestra", "tabla"))).alias("alertas_pii_inesperado"))
    )
    tables = rows_scanned.withColumn("parte", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    when = instant(as_of)
    summary = pii_summary(findings, unexpected)

    def all_fields(name: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)

    overall = summary.agg(
        F.struct(
            F.coalesce(F.sum("total_findings"), F.lit(0)).alias("total_findings"),
            F.coalesce(F.sum("total_alertas"), F.lit(0)).alias("total_alertas"),
            all_fields("campos_con_pii"),
            all_fields("campos_con_pii_inesperado"),
        )
    ).scalar()
    return (
        tables.join(summary.select("tabla", "total_findings"), "tabla", "left")
        .join(nested, "tabla", "left")
        .join(listed, ["tabla", "parte"], "left")
        .select(
            F.to_date(when).cast("string").alias("fecha"),
            F.hour(when).cast("long").alias("hora"),
            when.cast("string").alias("ejecutado"),
            F.lit(threshold).alias("threshold"),
            "parte",
            F.struct(
                "tabla",
                "registros_muestra",
                F.coalesce("total_findings", F.lit(0)).alias("total_findings"),
                "findings_por_campo",
                "alertas_pii_inesperado",
            ).alias("resultado"),
            overall.alias("resumen"),
        )
    )
