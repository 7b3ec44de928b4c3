"""Column policies and table aspects."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIDENTIAL, INTERNAL = "CONFIDENTIAL", "INTERNAL"

# The tag of every protected column.
COLUMN_TAGS = {
    "dim_cliente": {
        "rut_pseudo": CONFIDENTIAL, "score_crediticio": CONFIDENTIAL,
        "num_tarjeta_fpe": INTERNAL, "num_cuenta_fpe": INTERNAL,
        "rango_saldo": INTERNAL, "rango_renta": INTERNAL,
    },
    "fact_transacciones": {
        "rut_pseudo": CONFIDENTIAL, "score_crediticio": CONFIDENTIAL,
        "num_cuenta_fpe": INTERNAL, "num_tarjeta_mask": INTERNAL,
    },
}


def apply_column_policy(df: DataFrame, table: str, grants: Iterable[str] = ()) -> DataFrame:
    """The table as a reader with some grants sees it: other tagged columns are null."""
    allowed = set(grants)
    tags = COLUMN_TAGS.get(table, {})
    return df.select(
        *[
            F.col(f.name)
            if tags.get(f.name) is None or tags[f.name] in allowed
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def guard_columns(df: DataFrame, table: str, grants: Iterable[str] = ()) -> DataFrame:
    """The table as a reader with some grants may query it: a query that uses another tagged column fails.

    Such a column is an error that nobody can evaluate. Spark drops columns a query does not use, so other queries run,
    and what is left of the error in the optimized plan is the query's lineage: through aliases, expressions, filters,
    join keys, groups and stars. `authorize` finds it before anything runs; without that the query fails as it runs,
    unless it meets no row.
    """
    allowed = set(grants)
    tags = COLUMN_TAGS.get(table, {})
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if tags.get(f.name) is None or tags[f.name] in allowed
            else F.raise_error(F.lit(f"access denied to <{table}.{f.name}>: {tags[f.name]}")).cast(f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


_DENIED = re.compile(r"access denied to <([^>]+)>")


def denied_columns(query: DataFrame) -> list[str]:
    """Guarded columns that a query uses, as table.column, sorted. Nothing is run."""
    conf, fields = query.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(fields)
    conf.set(fields, str(2**31 - 1))
    try:
        plan = query._jdf.queryExecution().optimizedPlan().toString()
    except Exception as error:  # a plan over constants is evaluated while it is optimized
        plan = str(error)
        if not _DENIED.search(plan):
            raise
    finally:
        conf.set(fields, before)
    return sorted(set(_DENIED.findall(plan)))


def authorize(query: DataFrame) -> DataFrame:
    """The query itself, if it uses no column that the reader has no grant for; else PermissionError names them."""
    if denied := denied_columns(query):
        raise PermissionError(f"no grant for {', '.join(denied)}")
    return query


@dataclass(frozen=True)
class Aspects:
    sensitivity_level: str
    pii_present: bool
    ley_19628_applies: bool
    data_owner: str
    retention_years: int
    arcop_relevant: bool


# Aspects of the Silver and Gold tables.
TABLE_ASPECTS = {
    "clientes_deidentified": Aspects("CONFIDENTIAL", True, True, "Data Engineering", 7, True),
    "transacciones_deidentified": Aspects("CONFIDENTIAL", True, True, "Data Engineering", 7, True),
    "arcop_solicitudes": Aspects("CONFIDENTIAL", False, True, "Compliance Team", 7, True),
    "dim_cliente": Aspects("INTERNAL", False, True, "Analytics Team", 7, True),
    "fact_transacciones": Aspects("INTERNAL", False, True, "Analytics Team", 7, True),
    "fact_arcop_solicitudes": Aspects("INTERNAL", False, True, "Compliance Team", 7, True),
    "mart_calidad_datos": Aspects("INTERNAL", False, False, "Data Engineering", 3, False),
    "mart_arcop_compliance": Aspects("INTERNAL", False, True, "Compliance Team", 7, True),
    "mart_anomalias": Aspects("INTERNAL", False, True, "Risk Team", 7, True),
}
_PREFIX = "aspect."


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def as_properties(found: Aspects) -> dict[str, str]:
    """Aspects as properties of a table."""
    return {_PREFIX + name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in vars(found).items()}


def set_aspects(spark: SparkSession, table: str, aspects: Aspects) -> None:
    """Record the aspects as properties of a catalog table."""
    pairs = ", ".join(f"'{name}' = '{_quoted(value)}'" for name, value in as_properties(aspects).items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def aspects(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """Aspects of some catalog tables, one row each, read back from the catalog."""
    found = {}
    for table in tables:
        found[table.split(".")[-1]] = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return aspects_frame(spark, found)


def aspects_frame(spark: SparkSession, properties: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One row per table from its properties; what is not set is null."""
    names = list(Aspects.__dataclass_fields__)
    rows = [(table, *[own.get(_PREFIX + n) for n in names]) for table, own in properties.items()]
    text = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in ("tabla", *names)))
    return text.select(
        "tabla", "sensitivity_level",
        F.col("pii_present").cast("boolean").alias("pii_present"),
        F.col("ley_19628_applies").cast("boolean").alias("ley_19628_applies"),
        "data_owner",
        F.col("retention_years").cast("int").alias("retention_years"),
        F.col("arcop_relevant").cast("boolean").alias("arcop_relevant"),
    )
