"""Declarative data tests and batch checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.functions.rules import ratio, rut_is_valid



@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null, unique, accepted_values
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# The published data tests of the de-identified tables.
SILVER_CHECKS = (
    Check("clientes_deidentified", "id_cliente", "not_null"),
    Check("clientes_deidentified", "id_cliente", "unique"),
    Check("clientes_deidentified", "rut_pseudo", "not_null"),
    Check("clientes_deidentified", "score_crediticio", "not_null"),
    Check("clientes_deidentified", "arcop_estado", "not_null"),
    Check("clientes_deidentified", "arcop_estado", "accepted_values", ("ACTIVO", "BLOQUEADO", "ELIMINADO")),
    Check("transacciones_deidentified", "id_transaccion", "not_null"),
    Check("transacciones_deidentified", "id_transaccion", "unique"),
    Check("transacciones_deidentified", "id_cliente", "not_null"),
    Check("arcop_solicitudes", "id_solicitud", "not_null"),
    Check("arcop_solicitudes", "id_solicitud", "unique"),
    Check("arcop_solicitudes", "tipo_derecho", "not_null"),
    Check("arcop_solicitudes", "tipo_derecho", "accepted_values", ("A", "R", "C", "O", "P")),
    Check("arcop_solicitudes", "estado", "not_null"),
    Check("arcop_solicitudes", "estado", "accepted_values", ("PENDIENTE", "EN_PROCESO", "COMPLETADO", "VENCIDO")),
)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Failing rows."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their count; null is left to the not-null test."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = SILVER_CHECKS) -> DataFrame:
    """One row per test: (prueba, tabla, columna, fallos, estado).

    A table is scanned once for all of its tests: its tested cells are counted by column and value, repeats already in
    the map tasks, and one more aggregate reads every test off these counts. A column that is only tested for nulls has
    two values there.
    """
    results = []
    for table, df in tables.items():
        mine = [c for c in checks if c.table == table]
        if not mine:
            continue
        columns = list(dict.fromkeys(c.column for c in mine))
        by_value = {c.column for c in mine if c.kind != "not_null"}
        cells = [
            F.struct(F.lit(i).alias("i"), (F.col(c).cast("string") if c in by_value else F.when(F.col(c).isNotNull(), F.lit(""))).alias("value"))
            for i, c in enumerate(columns)
        ]
        counted = df.select(F.inline(F.array(*cells))).groupBy("i", "value").agg(F.count("*").alias("n"))
        wide = counted.agg(*[_failures(c, columns.index(c.column)).alias(c.name) for c in mine])
        results.append(
            wide.unpivot([], [c.name for c in mine], "prueba", "fallos")
            .withColumn("tabla", F.lit(table))
            .withColumn("columna", _lookup({c.name: c.column for c in mine}, "prueba"))
        )
    everything = reduce(DataFrame.unionByName, results)
    return everything.select(
        "prueba", "tabla", "columna", "fallos", F.when(F.col("fallos") == 0, "OK").otherwise("FALLA").alias("estado")
    )


def _failures(check: Check, i: int) -> Column:
    """Failures of a test from the counts (i, value, n): null rows, repeated values, or values outside of the list."""
    own, value = F.col("i") == i, F.col("value")
    if check.kind == "not_null":
        return F.coalesce(F.sum(F.when(own & value.isNull(), F.col("n"))), F.lit(0).cast("long"))
    if check.kind == "unique":
        return F.count_if(own & value.isNotNull() & (F.col("n") > 1))
    return F.count_if(own & ~value.isin(*check.values))


def _lookup(mapping: Mapping[str, str], column: str) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.create_map(*pairs)[F.col(column)]


# The communes of each region.
REGION_COMMUNES = {
    "Metropolitana": ("Santiago", "Las Condes", "Providencia", "Maipú", "Puente Alto", "Ñuñoa", "La Florida"),
    "Valparaíso": ("Valparaíso", "Viña del Mar", "Quilpué", "Villa Alemana", "San Antonio"),
    "Biobío": ("Concepción", "Talcahuano", "Chillán", "Los Ángeles", "Coronel"),
    "La Araucanía": ("Temuco", "Padre Las Casas", "Angol", "Victoria"),
    "Los Lagos": ("Puerto Montt", "Osorno", "Castro", "Puerto Varas"),
    "Antofagasta": ("Antofagasta", "Calama", "Tocopilla", "Mejillones"),
    "Coquimbo": ("La Serena", "Coquimbo", "Ovalle", "Illapel"),
    "O'Higgins": ("Rancagua", "San Fernando", "Pichilemu", "Rengo"),
    "Maule": ("Talca", "Curicó", "Linares", "Cauquenes"),
    "Los Ríos": ("Valdivia", "La Unión", "Panguipulli"),
}


def region_communes(spark: SparkSession) -> DataFrame:
    """The known (region, comuna) pairs."""
    pairs = [(region, commune) for region, communes in REGION_COMMUNES.items() for commune in communes]
    return spark.createDataFrame(pairs, "region string, comuna string")


def batch_profile(df: DataFrame) -> DataFrame:
    """Counts and shares of oddities in a batch of transactions."""
    text = F.coalesce(F.col("descripcion"), F.lit(""))
    counts = {
        "duplicados": F.col("es_duplicado"),
        "anomalas": F.col("es_anomalia_flag"),
        "con_nulos": F.col("categoria_gasto").isNull(),
        "pii_en_descripcion": text.contains("RUT") | text.contains("tarjeta") | text.contains("@"),
    }
    totals = df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in counts.items()])
    shares = [F.round(ratio(n, "total") * 100, 2).alias(f"pct_{n}") for n in counts]
    return totals.select("*", *shares)


def check_rut(df: DataFrame, column: str = "rut") -> DataFrame:
    """Rows whose national id has a wrong form or check digit."""
    return df.where(~rut_is_valid(column))


def check_region_commune(
    df: DataFrame, reference: DataFrame, region: str = "region", commune: str = "comuna"
) -> DataFrame:
    """Rows whose commune does not belong to their region.

    Rows without a region or commune cannot be judged and are left to the
    not-null tests. `reference` has the columns region and comuna.
    """
    known = reference.select(F.col("region").alias("__r"), F.col("comuna").alias("__c"))
    judged = df.where(F.col(region).isNotNull() & F.col(commune).isNotNull())
    return judged.join(known, (F.col(region) == F.col("__r")) & (F.col(commune) == F.col("__c")), "left_anti")
