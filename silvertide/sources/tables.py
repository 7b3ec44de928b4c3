"""Silver and Gold tables: typed loads, publication, views, reprocessing."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvertide import schemas
from silvertide.plans import marts, staging
from silvertide.plans.deidentify import Keys, conform_requests, deidentify_clients, deidentify_transactions
from silvertide.plans.governance import TABLE_ASPECTS, Aspects, as_properties, aspects_frame, set_aspects
from silvertide.plans.model import AnomalyModel, apply_model, ml_table, train_anomaly_model, training_set

from silvertide.session import scratch_path

from . import versions
from .bronze import days_between, mark_rejected, previous_hour, read_named_hours, split_marked, split_rejected


def require_keys(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise while writing when a required column is null."""
    for field in schema.fields:
        if not field.nullable:
            stop = F.raise_error(F.lit(f"{field.name} is required")).cast(field.dataType)
            df = df.withColumn(field.name, F.coalesce(F.col(field.name), stop))
    return df


def silver_frame(df: DataFrame, schema: T.StructType, partition_by: Sequence[str] = ()) -> DataFrame:
    typed = df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
        *[c for c in partition_by if c not in schema.fieldNames()],
    )
    return require_keys(typed, schema)


def load_silver(
    df: DataFrame, path: str, schema: T.StructType, mode: str = "append", partition_by: Sequence[str] = (),
    scope: Collection[Sequence[object]] | None = None,
) -> bool:
    """Write a batch with an enforced schema as a version of the table; False when nothing was done.

    `truncate` replaces the table, `append` adds, `partition` replaces the partitions named by `scope`, also those without
    a row in the batch, or without a scope those in the batch. An empty batch does not truncate. Readers see the whole
    batch or nothing of it (`versions.read`).
    """
    if mode == "truncate" and df.isEmpty():
        return False
    if mode == "partition" and not partition_by:
        raise ValueError("partition mode needs partition columns")
    out = silver_frame(df, schema, partition_by)
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if mode == "truncate":
        versions.replace_table(out, path, partition_by)
    elif mode == "partition":
        versions.replace_partitions(out, path, partition_by, scope)
    else:
        versions.append(out, path, partition_by)
    return True


def publish_gold(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    lookup_by: Sequence[str] = (),
    table: str | None = None,
    aspects: Aspects | None = None,
) -> DataFrame:
    """Create or replace a Gold table in one step and return it as read back; its aspects come with it.

    Rows are rebalanced by partition (crowded days are split, small ones merged),
    or by the cluster columns where there are no partitions, so that no task sorts
    more than its share, and sorted by the cluster columns inside each file, so the statistics of the
    row groups let readers skip. Columns that single values are looked up by get a
    Bloom filter. A run that fails leaves the last version; who reads it goes on
    reading it. With `table` a catalog table is made instead.
    """
    if partition_by or cluster_by:
        df = df.hint("rebalance", *(partition_by or cluster_by)).sortWithinPartitions(*partition_by, *cluster_by)
    options = {f"parquet.bloom.filter.enabled#{column}": "true" for column in lookup_by}
    spark = df.sparkSession
    if table is None:
        made = versions.replace_table(df, path, partition_by, options, as_properties(aspects) if aspects else None)
        return versions.read(spark, path, made.version)
    writer = df.write.mode("overwrite").format("parquet").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", path).saveAsTable(table)
    if aspects:
        set_aspects(spark, table, aspects)
    return spark.table(table)


def register_views(spark: SparkSession, layers: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Staging layers as views: nothing is computed or stored."""
    for name, df in layers.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in layers]


REQUIRED = tuple(f.name for f in schemas.SILVER_TRANSACTIONS.fields if not f.nullable)
HOUR = ("fecha", "hora")


def load_hours(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    days: Sequence[str],
    hours: Sequence[int],
    as_of: datetime | str,
    keys: Keys,
    rejected_path: str | None = None,
) -> None:
    """Load some hours of some days of transactions; see load_named_hours."""
    load_named_hours(spark, bronze_root, silver_path, [(d, h) for d in days for h in hours], as_of, keys, rejected_path)


def load_named_hours(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    hours: Collection[tuple[str, int]],
    as_of: datetime | str,
    keys: Keys,
    rejected_path: str | None = None,
) -> None:
    """Load (day, hour) pairs of transactions; exactly the partitions of those arrival hours are replaced, in one step.

    The Silver partition is the arrival hour of the file, not the time a row reports. Unreadable lines and rows without
    a required value go to `rejected_path`, by the same hours, or are left out. An hour whose lines are all bad is empty
    in Silver afterwards, and one without bad lines is empty in the rejects. Hours that have not arrived are left as they
    are. Lines are parsed once: with rejects they are stored between parsing and splitting.
    """
    lines, arrived = read_named_hours(spark, bronze_root, schemas.BRONZE_TRANSACTIONS, hours)
    if not arrived:
        return
    required = [c for c in REQUIRED if c in lines.columns]
    parsed = scratch_path(spark, "parsed") if rejected_path else None
    try:
        if parsed:
            mark_rejected(lines, required).write.parquet(parsed)
            good, bad = split_marked(spark.read.parquet(parsed))
            versions.replace_partitions(bad.hint("rebalance", *HOUR), rejected_path, HOUR, arrived)
        else:
            good, _ = split_rejected(lines, required)
        silver = deidentify_transactions(good, as_of, keys, keep=HOUR)
        load_silver(silver, silver_path, schemas.SILVER_TRANSACTIONS, "partition", HOUR, arrived)
    finally:
        if parsed:
            versions.Files(spark, parsed).delete(parsed)


def load_previous_hour(spark: SparkSession, bronze_root: str, silver_path: str, as_of: datetime | str, keys: Keys, rejected_path: str | None = None) -> None:
    """The hourly run: the hour before `as_of`."""
    day, hour = previous_hour(as_of)
    load_hours(spark, bronze_root, silver_path, [day], [hour], as_of, keys, rejected_path)


def load_clients(df: DataFrame, path: str, as_of: datetime | str, keys: Keys) -> None:
    """The client master replaces the Silver table as a whole."""
    load_silver(deidentify_clients(df, as_of, keys), path, schemas.SILVER_CLIENTS, "truncate")


def load_requests(df: DataFrame, path: str, day: date | str) -> None:
    """The requests of one day replace those of that day (`fecha_carga`)."""
    dated = conform_requests(df).withColumn("fecha_carga", F.lit(str(day)))
    load_silver(dated, path, schemas.SILVER_REQUESTS, "partition", ("fecha_carga",))


#: Silver tables whose names in the catalog differ from their folders.
SILVER_TABLES = {"transacciones": "transacciones_deidentified", "clientes": "clientes_deidentified", "solicitudes": "arcop_solicitudes"}
_NO_TABLE = versions.Manifest(0, "", (), (), "")

#: Partition, cluster and lookup columns of the Gold tables.
GOLD_LAYOUT = {
    "dim_cliente": ([], ["id_cliente"], ["id_cliente"]),
    "fact_transacciones": (["fecha"], ["canal", "tipo_transaccion"], []),
    "fact_arcop_solicitudes": ([], ["id_cliente"], ["id_cliente"]),
    "mart_anomalias": (["fecha"], ["region"], []),
    "mart_calidad_datos": ([], [], []),
    "mart_arcop_compliance": ([], [], []),
    "fact_transacciones_ml": (["fecha"], ["id_cliente"], ["id_cliente"]),
}


def build_gold(
    clients: DataFrame,
    transactions: DataFrame,
    requests: DataFrame,
    root: str,
    as_of: datetime | str,
    model: AnomalyModel | None = None,
) -> dict[str, DataFrame]:
    """All Gold tables from the Silver ones, each from the tables already written, published with their aspects.

    Without a model one is trained on the new facts. The new versions become the set that `current_gold` reads when the
    last of them is written; until then it reads the last set.
    """
    spark, made = transactions.sparkSession, {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        made[name] = publish_gold(df, f"{root}/{name}", *GOLD_LAYOUT[name], aspects=TABLE_ASPECTS.get(name))
        return made[name]

    stg_clients, stg_txn = staging.stage_clients(clients, as_of), staging.stage_transactions(transactions, as_of)
    dim = publish("dim_cliente", marts.build_dim_client(stg_clients))
    fact = publish("fact_transacciones", marts.build_fact_transactions(stg_txn, dim, as_of))
    asked = publish("fact_arcop_solicitudes", marts.build_fact_requests(staging.stage_requests(requests, as_of), dim, as_of))
    publish("mart_anomalias", marts.build_anomaly_mart(fact))
    publish("mart_calidad_datos", marts.quality_mart(stg_clients, stg_txn, as_of))
    publish("mart_arcop_compliance", marts.compliance_mart(asked, as_of))
    model = model or train_anomaly_model(training_set(fact))
    scored = f"{root}/distancias"
    versions.replace_table(apply_model(fact, model), scored)
    publish("fact_transacciones_ml", ml_table(versions.read(spark, scored)))
    versions.publish_set(spark, root, {name: versions.versions(spark, f"{root}/{name}")[-1] for name in made})
    return made


def current_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The Gold tables of the last complete build, for any process that knows the folder."""
    return versions.read_set(spark, root)


def backfill(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    first_day: date | str,
    last_day: date | str,
    hours: Sequence[int],
    as_of: datetime | str,
    keys: Keys,
) -> dict[str, DataFrame]:
    """Load a range of hours again, then rebuild the Gold tables and the model from all of Silver.

    Silver holds `transacciones`, `clientes` and `solicitudes`; rejected lines go beside them. Gold gets new versions in
    `gold_root`: readers of the last ones are not disturbed, and `current_gold` finds the new ones when all are there.
    """
    load_hours(
        spark, bronze_root, f"{silver_root}/transacciones", days_between(first_day, last_day), hours, as_of, keys,
        f"{silver_root}/rechazadas",
    )
    transactions, clients, requests = (versions.read(spark, f"{silver_root}/{n}") for n in ("transacciones", "clientes", "solicitudes"))
    for name, table in SILVER_TABLES.items():
        versions.set_properties(spark, f"{silver_root}/{name}", as_properties(TABLE_ASPECTS[table]))
    return build_gold(clients, transactions.drop(*HOUR), requests, gold_root, as_of)


def published_aspects(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Aspects of published tables by name and path, one row each; a table without aspects has nulls."""
    rows = {name: (versions.manifest(spark, path) or _NO_TABLE).properties for name, path in paths.items()}
    return aspects_frame(spark, rows)


def write_report(df: DataFrame, path: str) -> None:
    """A report with nested columns as JSON."""
    df.write.mode("overwrite").json(path)
