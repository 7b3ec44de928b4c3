"""Tables derived from the star-schema test tables, for the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvertide.operators.scale import classify_p95, score_normalize
from silvertide.plans import adapters as A
from silvertide.plans import marts, model, staging
from silvertide.plans.deidentify import Keys, conform_requests, deidentify_clients, deidentify_transactions
from silvertide.session import prepare, scratch_path
from silvertide.sources import versions
from silvertide.sources.tables import publish_gold

# Test keys only; a deployment passes its own.
TEST_KEYS = Keys(salt="test-salt", token="test-token")


class Layers:
    """Bronze, Silver, staging and Gold frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return A.table(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def clients(self) -> DataFrame:
        return A.clients(self.spark, self.sf_dir)

    @cached_property
    def transactions(self) -> DataFrame:
        return A.transactions(self.spark, self.sf_dir)

    @cached_property
    def single_transactions(self) -> DataFrame:
        return A.transactions(self.spark, self.sf_dir, copies=False)

    @cached_property
    def requests(self) -> DataFrame:
        return A.requests(self.spark, self.sf_dir)

    @cached_property
    def silver_clients(self) -> DataFrame:
        return deidentify_clients(self.clients, A.CLIENTS_AS_OF, TEST_KEYS)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        loaded = F.lit(A.CLIENTS_AS_OF).cast("timestamp") + F.make_dt_interval(hours=F.col("copia"))
        return deidentify_transactions(self.transactions, loaded, TEST_KEYS)

    @cached_property
    def silver_requests(self) -> DataFrame:
        return conform_requests(self.requests)

    @cached_property
    def stg_clients(self) -> DataFrame:
        return staging.stage_clients(self.silver_clients, A.CLIENTS_AS_OF)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stage_transactions(self.silver_transactions, A.TRANSACTIONS_AS_OF)

    @cached_property
    def stg_requests(self) -> DataFrame:
        return staging.stage_requests(self.silver_requests, A.REQUESTS_AS_OF)

    @cached_property
    def dim(self) -> DataFrame:
        return marts.build_dim_client(self.stg_clients)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.build_fact_transactions(self.stg_transactions, self.dim, A.TRANSACTIONS_AS_OF)

    @cached_property
    def fact_requests(self) -> DataFrame:
        return marts.build_fact_requests(self.stg_requests, self.dim, A.REQUESTS_AS_OF)

    @cached_property
    def distances(self) -> DataFrame:
        """Scoreable facts with a fixed distance and cluster in place of a trained model."""
        number = F.substring("id_transaccion", 2, 20).cast("long")
        return model.scoreable(self.fact).withColumns(
            {
                "distancia_centroide": F.col("monto_clp") / 1000000 + F.col("hora") / 10,
                "cluster_id": (1 + number % 5).cast("int"),
            }
        )


_LAYERS: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The frames over a folder; they are plans without data, so one set serves all queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    found = _LAYERS.get(key)
    if found is None or found.spark is not spark:
        found = _LAYERS[key] = Layers(spark, sf_dir)
    prepare(spark)
    return found


# Published tables of this process: (application, folder, name) -> path.
_PUBLISHED: dict[tuple[str, str, str], str] = {}


def published(t: Layers, name: str) -> DataFrame:
    """A Gold table as the reporting queries see it: written once, then only read."""
    spark = t.spark
    key = (spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _PUBLISHED:
        path = t.scratch(name)
        publish_gold(_GOLD[name](t), path, *_LAYOUT.get(name, ()))
        _PUBLISHED[key] = path
    return versions.read(spark, _PUBLISHED[key])


def _ml(t: Layers) -> DataFrame:
    scored = published(t, "distances")
    labelled = classify_p95(score_normalize(scored)).withColumnRenamed("score_anomalia", "score_generador")
    return labelled.select(*model.ML_COLUMNS)


_GOLD = {
    "dim_cliente": lambda t: t.dim,
    "fact_transacciones": lambda t: t.fact,
    "fact_arcop_solicitudes": lambda t: t.fact_requests,
    "mart_calidad_datos": lambda t: marts.quality_mart(t.stg_clients, t.stg_transactions, A.TRANSACTIONS_AS_OF),
    "mart_arcop_compliance": lambda t: marts.compliance_mart(t.fact_requests, A.REQUESTS_AS_OF),
    "mart_anomalias": lambda t: marts.build_anomaly_mart(published(t, "fact_transacciones")),
    "distances": lambda t: t.distances,
    "fact_transacciones_ml": _ml,
}
_LAYOUT = {
    "dim_cliente": ([], ["id_cliente"], ["id_cliente"]),
    "fact_transacciones": (["fecha"], ["canal", "tipo_transaccion"]),
    "fact_transacciones_ml": (["fecha"], ["id_cliente"], ["id_cliente"]),
    "fact_arcop_solicitudes": ([], ["id_cliente"], ["id_cliente"]),
}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, exact numbers as doubles, lists as joined text.

    Only for comparing with another engine, whose types have other names.
    """
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        out.append(col.alias(f.name))
    return df.select(*out)
