"""One registered query per operator; each reads the given tables as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide import schemas
from silvertide.functions import buckets as B
from silvertide.functions import masking as M
from silvertide.functions import rules as R
from silvertide.operators import calendar as C
from silvertide.operators import history as H
from silvertide.operators import inspection as I
from silvertide.operators import quality as Q
from silvertide.operators import scale as S
from silvertide.operators.latest import latest_per_key
from silvertide.plans import adapters as A
from silvertide.plans import deidentify as D
from silvertide.plans import governance as G
from silvertide.plans import marts, model, serving, staging
from silvertide.sources import bronze, histories, tables, versions
from silvertide.streaming import silver as ST

from .gold import TEST_KEYS, Layers, layers, plain, published

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(build: Callable[[Layers], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(layers(spark, sf_dir)))

        _REGISTRY[name] = run
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- sources and sinks ------------------------------------------------------


@query("bronze_scan")
def bronze_scan(t: Layers) -> DataFrame:
    path = t.scratch("clientes_maestro")
    bronze.write_bronze(t.clients, path, ())
    return bronze.read_bronze(t.spark, path, schemas.BRONZE_CLIENTS)


def _bronze_hours(t: Layers) -> str:
    path = t.scratch("transacciones")
    bronze.write_bronze(A.with_hour(t.single_transactions), path)
    return path


@query("bronze_hour")
def bronze_hour(t: Layers) -> DataFrame:
    return bronze.read_bronze_hour(t.spark, _bronze_hours(t), schemas.BRONZE_TRANSACTIONS, "2024-01-10", 13)


@query("bronze_roundtrip")
def bronze_roundtrip(t: Layers) -> DataFrame:
    path = _bronze_hours(t)
    schema = schemas.with_hour_partitions(schemas.BRONZE_TRANSACTIONS)
    return bronze.read_bronze(t.spark, path, schema)


@query("silver_schema_cast")
def silver_schema_cast(t: Layers) -> DataFrame:
    path = t.scratch("clientes_deidentified")
    for _ in range(2):
        tables.load_silver(t.silver_clients, path, schemas.SILVER_CLIENTS, "truncate")
    return versions.read(t.spark, path)


@query("gold_partitioned")
def gold_partitioned(t: Layers) -> DataFrame:
    return tables.publish_gold(t.fact, t.scratch("fact"), ["fecha"], ["canal", "tipo_transaccion"])


@query("ctas_replace")
def ctas_replace(t: Layers) -> DataFrame:
    path = t.scratch("fact_transacciones_ml")
    tables.publish_gold(t.distances.select("id_transaccion", "cluster_id"), path)
    return tables.publish_gold(published(t, "fact_transacciones_ml"), path)


@query("staging_view")
def staging_view(t: Layers) -> DataFrame:
    tables.register_views(
        t.spark, {"stg_clientes": t.stg_clients, "stg_transacciones": t.stg_transactions}, "silvertide_"
    )
    return t.spark.sql(
        """SELECT canal, genero, count(*) AS n, count_if(t.es_registro_valido) AS validas
           FROM silvertide_stg_transacciones t JOIN silvertide_stg_clientes c USING (id_cliente)
           GROUP BY canal, genero"""
    )


@query("backfill_hours")
def backfill_hours(t: Layers) -> DataFrame:
    """Silver hours are loaded, loaded again later, and Gold and the model are rebuilt: the rebuilt facts."""
    source, silver = _bronze_hours(t), t.scratch("silver")
    tables.load_clients(t.clients, f"{silver}/clientes", A.CLIENTS_AS_OF, TEST_KEYS)
    tables.load_requests(t.requests, f"{silver}/solicitudes", A.REQUESTS_AS_OF[:10])
    span = t.raw("events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    tables.load_hours(t.spark, source, f"{silver}/transacciones", bronze.days_between(*span), range(8, 20), A.TRANSACTIONS_AS_OF, TEST_KEYS)
    gold = tables.backfill(t.spark, source, silver, t.scratch("gold"), *span, range(8, 20), A.TRANSACTIONS_AS_OF, TEST_KEYS)
    scored = gold["fact_transacciones_ml"].select("id_transaccion", F.col("cluster_id").isNotNull().alias("clasificada"))
    return gold["fact_transacciones"].join(scored, "id_transaccion", "left").select(
        "id_transaccion", "monto_clp", F.col("fecha").cast("string").alias("fecha"), "nivel_riesgo_anomalia", "es_registro_valido",
        F.coalesce("clasificada", F.lit(False)).alias("clasificada"),
    )


@query("reload_hours")
def reload_hours(t: Layers) -> DataFrame:
    """Two hours of every day are loaded again: one whose lines have all become unreadable, one that has been repaired."""
    source, silver, rejected = t.scratch("transacciones"), t.scratch("silver"), t.scratch("rechazadas")
    rows = A.with_hour(t.single_transactions)
    without = F.when(F.col("hora") != 11, F.col("id_transaccion"))
    bronze.write_bronze(rows.withColumn("id_transaccion", without), source)
    span = t.raw("events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    load = lambda hours: tables.load_hours(
        t.spark, source, silver, bronze.days_between(*span), hours, A.TRANSACTIONS_AS_OF, TEST_KEYS, rejected
    )
    load(range(24))
    bronze.write_bronze(rows.where("hora = 11"), source)
    broken = rows.where("hora = 10").select(F.concat(F.lit("{"), "id_transaccion").alias("value"), "fecha", "hora")
    broken.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fecha", "hora").text(source)
    load([10, 11])
    kept = versions.read(t.spark, silver).select(F.lit("silver").alias("tabla"), "fecha", "hora")
    refused = versions.read(t.spark, rejected).select(F.col("motivo").alias("tabla"), "fecha", "hora")
    return kept.unionByName(refused).groupBy("tabla", "fecha", "hora").agg(F.count("*").alias("filas"))


@query("published_versions")
def published_versions(t: Layers) -> DataFrame:
    """A table is replaced while its last version is being read: rows that each of the two readers sees."""
    path = t.scratch("fact")
    before = tables.publish_gold(t.fact.where("canal = 'WEB'"), path, ["fecha"])
    after = tables.publish_gold(t.fact, path, ["fecha"])
    count = lambda df, name: df.groupBy("canal").agg(F.count("*").alias("filas")).withColumn("version", F.lit(name))
    return count(before, "anterior").unionByName(count(after, "actual"))


@query("published_aspects")
def published_aspects(t: Layers) -> DataFrame:
    """Aspects that come with publication, and the one table that was published without them, each with its rows."""
    frames = {"mart_anomalias": marts.build_anomaly_mart(t.fact), "dim_cliente": t.dim, "fact_transacciones": t.fact, "sin_aspectos": t.stg_requests}
    paths = {name: t.scratch(name) for name in frames}
    counts = None
    for name, df in frames.items():
        out = tables.publish_gold(df, paths[name], aspects=G.TABLE_ASPECTS.get(name))
        row = out.agg(F.count("*").alias("filas")).withColumn("tabla", F.lit(name))
        counts = row if counts is None else counts.unionByName(row)
    return tables.published_aspects(t.spark, paths).join(counts, "tabla")


# --- de-identification ------------------------------------------------------


def _client_column(t: Layers, source: str, out: str, expression) -> DataFrame:
    return t.clients.select("id_cliente", source, expression.alias(out))


@query("pseudonymize")
def pseudonymize(t: Layers) -> DataFrame:
    return _client_column(t, "rut", "rut_pseudo", M.pseudonymize("rut", TEST_KEYS.salt))


@query("mask_middle")
def mask_middle(t: Layers) -> DataFrame:
    return t.clients.select(
        "id_cliente",
        M.mask_middle("num_tarjeta", keep_start=4, keep_end=4).alias("tarjeta"),
        M.mask_middle("region", "#", 1).alias("region"),
        M.mask_middle("genero", keep_start=1).alias("genero"),
    )


@query("mask_email")
def mask_email(t: Layers) -> DataFrame:
    return _client_column(t, "email", "email_masked", M.mask_email("email"))


@query("mask_phone")
def mask_phone(t: Layers) -> DataFrame:
    return _client_column(t, "telefono", "telefono_masked", M.mask_phone("telefono"))


@query("mask_name")
def mask_name(t: Layers) -> DataFrame:
    return _client_column(t, "nombre_completo", "nombre_masked", M.mask_name("nombre_completo"))


@query("bucket_balance")
def bucket_balance(t: Layers) -> DataFrame:
    return t.clients.select(
        "id_cliente",
        B.bucketize("saldo_cuenta", B.BALANCE).alias("rango_saldo"),
        B.bucketize("renta_mensual", B.INCOME).alias("rango_renta"),
        B.bucketize("deuda_total", B.DEBT).alias("rango_deuda"),
        B.bucketize("saldo_cuenta", B.BALANCE, contiguous=True).alias("rango_saldo_cerrado"),
    )


@query("age_bucket")
def age_bucket(t: Layers) -> DataFrame:
    return _client_column(
        t, "fecha_nacimiento", "rango_edad", B.age_bucket("fecha_nacimiento", A.CLIENTS_AS_OF[:10])
    )


@query("tokenize_card")
def tokenize_card(t: Layers) -> DataFrame:
    return t.clients.select(
        "id_cliente",
        M.tokenize_number("num_tarjeta", TEST_KEYS.token).alias("num_tarjeta_fpe"),
        M.tokenize_number("num_cuenta", TEST_KEYS.token).alias("num_cuenta_fpe"),
        M.tokenize_number("comuna", TEST_KEYS.token).alias("comuna_fpe"),
    )


@query("redact_documents")
def redact_documents(t: Layers) -> DataFrame:
    return t.raw("documents").select("doc_id", M.redact_text("text").alias("texto"))


@query("silver_clients")
def silver_clients(t: Layers) -> DataFrame:
    return t.silver_clients


@query("silver_transactions")
def silver_transactions(t: Layers) -> DataFrame:
    return t.silver_transactions


@query("silver_requests")
def silver_requests(t: Layers) -> DataFrame:
    return t.silver_requests


@query("redaction_preview")
def redaction_preview(t: Layers) -> DataFrame:
    return D.redaction_preview(t.silver_transactions)


# --- inspection -------------------------------------------------------------


def _findings(t: Layers, min_likelihood: str = I.MIN_LIKELIHOOD) -> DataFrame:
    """Findings in the clients, the transactions and the documents."""
    scans = [
        I.scan_pii(t.clients, "id_cliente", table="clientes_maestro", min_likelihood=min_likelihood),
        I.scan_pii(t.single_transactions, "id_transaccion", table="transacciones", min_likelihood=min_likelihood),
        I.scan_pii(t.raw("documents"), "doc_id", ["text"], table="documents", min_likelihood=min_likelihood),
    ]
    return scans[0].unionByName(scans[1]).unionByName(scans[2])


def _report(t: Layers) -> DataFrame:
    path = t.scratch("findings")
    _findings(t).write.parquet(path)
    sizes = [
        df.agg(F.count("*").alias("registros_muestra")).withColumn("tabla", F.lit(name))
        for name, df in (
            ("clientes_maestro", t.clients), ("transacciones", t.single_transactions), ("documents", t.raw("documents")),
        )
    ]
    scanned = sizes[0].unionByName(sizes[1]).unionByName(sizes[2])
    return I.pii_report(t.spark.read.parquet(path), A.TRANSACTIONS_AS_OF, scanned)


@query("pii_findings")
def pii_findings(t: Layers) -> DataFrame:
    return _findings(t)


@query("pii_hotword")
def pii_hotword(t: Layers) -> DataFrame:
    found = _findings(t).where(F.col("info_type") == "CHILE_RUT")
    return found.groupBy("tabla", "campo", "likelihood").agg(F.count("*").alias("hallazgos"))


@query("pii_min_likelihood")
def pii_min_likelihood(t: Layers) -> DataFrame:
    found = _findings(t, "VERY_UNLIKELY")
    return found.groupBy("tabla", "info_type", "likelihood").agg(F.count("*").alias("hallazgos"))


@query("pii_sample")
def pii_sample(t: Layers) -> DataFrame:
    return I.scan_pii(t.clients, "id_cliente", table="clientes_maestro")


@query("pii_bounded_sample")
def pii_bounded_sample(t: Layers) -> DataFrame:
    return I.scan_pii(t.clients, "id_cliente", table="clientes_maestro", sample_rows=100, max_findings=250)


@query("pii_by_field")
def pii_by_field(t: Layers) -> DataFrame:
    return I.pii_by_field(_findings(t))


@query("pii_alerts")
def pii_alerts(t: Layers) -> DataFrame:
    return I.pii_alerts(_findings(t))


@query("pii_field_class")
def pii_field_class(t: Layers) -> DataFrame:
    return I.pii_by_field(_findings(t)).withColumn("clase", I.classify_field("campo"))


def _flat(report: DataFrame) -> DataFrame:
    """The nested maps and lists of a report, every entry of them, as text for the comparison."""
    r, s = F.col("resultado"), F.col("resumen")
    entries = F.flatten(F.transform(
        F.map_entries(r.findings_por_campo),
        lambda f: F.transform(F.map_entries(f["value"]), lambda k: F.concat(f["key"], F.lit(":"), k["key"], F.lit("="), k["value"].cast("string"))),
    ))
    alerts = F.transform(r.alertas_pii_inesperado, lambda a: F.concat_ws("|", a["campo"], a["info_type"], a["likelihood"], a["muestra"]))
    return report.select(
        "fecha", "hora", "threshold", "parte", r.tabla.alias("tabla"), r.registros_muestra.alias("registros_muestra"),
        r.total_findings.alias("total_findings"),
        F.array_join(F.array_sort(entries), ",").alias("por_campo"),
        F.array_join(F.array_sort(alerts), ";").alias("alertas"),
        s.total_findings.alias("resumen_findings"), s.total_alertas.alias("resumen_alertas"),
        s.campos_con_pii.alias("campos_con_pii"), s.campos_con_pii_inesperado.alias("campos_con_pii_inesperado"),
    )


@query("pii_report")
def pii_report(t: Layers) -> DataFrame:
    return _flat(_report(t))


@query("report_json")
def report_json(t: Layers) -> DataFrame:
    path, report = t.scratch("inspect_report"), _report(t)
    tables.write_report(report, path)
    return _flat(t.spark.read.schema(report.schema).json(path))


# --- staging ----------------------------------------------------------------


@query("stg_clients")
def stg_clients(t: Layers) -> DataFrame:
    return t.stg_clients


@query("client_validity")
def client_validity(t: Layers) -> DataFrame:
    return t.stg_clients.select("id_cliente", "es_registro_valido")


@query("stg_time_parts")
def stg_time_parts(t: Layers) -> DataFrame:
    return staging.with_time_parts(t.single_transactions).select(
        "id_transaccion", "fecha_hora", "fecha", "hora", "dia_semana", "nombre_dia"
    )


@query("stg_transactions")
def stg_transactions(t: Layers) -> DataFrame:
    return t.stg_transactions


@query("txn_validity")
def txn_validity(t: Layers) -> DataFrame:
    return t.stg_transactions.groupBy("es_registro_valido", "flag_campos_nulos").agg(F.count("*").alias("n"))


@query("stg_requests")
def stg_requests(t: Layers) -> DataFrame:
    return t.stg_requests


@query("active_clients")
def active_clients(t: Layers) -> DataFrame:
    return marts.active_clients(t.dim).select("id_cliente", "arcop_estado", "rut_pseudo", "region")


@query("anomaly_candidates")
def anomaly_candidates(t: Layers) -> DataFrame:
    return marts.anomaly_candidates(t.fact).select("id_transaccion", "monto_clp", "score_anomalia", "es_anomalia_flag")


@query("date_range")
def date_range(t: Layers) -> DataFrame:
    return staging.date_range(t.fact, "fecha", "2024-01-05", "2024-01-12").select("id_transaccion", "fecha", "monto_clp")


@query("date_preset")
def date_preset(t: Layers) -> DataFrame:
    fact = published(t, "fact_transacciones")
    out = None
    for preset in ("today", "7d", "30d", "all"):
        start, end = staging.period_bounds(preset, A.TRANSACTIONS_AS_OF)
        row = staging.date_range(fact, "fecha", start, end).agg(
            F.count("*").alias("n"), F.min("fecha").alias("desde"), F.max("fecha").alias("hasta")
        ).withColumn("periodo", F.lit(preset))
        out = row if out is None else out.unionByName(row)
    return out


# --- facts and marts --------------------------------------------------------


@query("fact_transactions")
def fact_transactions(t: Layers) -> DataFrame:
    return t.fact


@query("fact_requests")
def fact_requests(t: Layers) -> DataFrame:
    return t.fact_requests


@query("dim_client")
def dim_client(t: Layers) -> DataFrame:
    return t.dim


@query("mart_anomalies")
def mart_anomalies(t: Layers) -> DataFrame:
    return marts.build_anomaly_mart(t.fact)


@query("daily_alerts")
def daily_alerts(t: Layers) -> DataFrame:
    return marts.daily_alert_summary(marts.build_anomaly_mart(t.fact)).withColumn(
        "score_promedio", F.round("score_promedio", 6)
    )


@query("risk_level")
def risk_level(t: Layers) -> DataFrame:
    return t.single_transactions.select("id_transaccion", R.risk_level("score_anomalia").alias("nivel"))


@query("request_priority")
def request_priority(t: Layers) -> DataFrame:
    return t.fact_requests.groupBy("prioridad", "tipo_derecho").agg(F.count("*").alias("n"))


@query("quality_clients")
def quality_clients(t: Layers) -> DataFrame:
    return marts.quality_clients(t.stg_clients, A.CLIENTS_AS_OF)


@query("quality_transactions")
def quality_transactions(t: Layers) -> DataFrame:
    return marts.quality_transactions(t.stg_transactions, A.TRANSACTIONS_AS_OF)


@query("quality_mart")
def quality_mart(t: Layers) -> DataFrame:
    return marts.quality_mart(t.stg_clients, t.stg_transactions, A.TRANSACTIONS_AS_OF)


def _valid_by_channel(t: Layers) -> DataFrame:
    return t.stg_transactions.groupBy("canal").agg(
        F.count("*").alias("total"), F.count_if("es_registro_valido").alias("validas")
    )


@query("quality_score")
def quality_score(t: Layers) -> DataFrame:
    return _valid_by_channel(t).select("canal", R.quality_score("validas", "total").alias("score"))


@query("traffic_light")
def traffic_light(t: Layers) -> DataFrame:
    share = R.ratio("validas", "total")
    return _valid_by_channel(t).select(
        "canal", R.traffic_light(share).alias("semaforo"), R.traffic_light(share, 0.90, 0.75).alias("semaforo_tablero")
    )


@query("compliance_mart")
def compliance_mart(t: Layers) -> DataFrame:
    return marts.compliance_mart(t.fact_requests, A.REQUESTS_AS_OF)


@query("compliance_pct")
def compliance_pct(t: Layers) -> DataFrame:
    return marts.compliance_mart(t.fact_requests, A.REQUESTS_AS_OF).select("pct_cumplimiento", "pct_vencidas")


@query("compliance_days")
def compliance_days(t: Layers) -> DataFrame:
    mart = marts.compliance_mart(t.fact_requests, A.REQUESTS_AS_OF)
    return mart.select("promedio_dias_resolucion", "max_dias_sin_resolver")


@query("compliance_light")
def compliance_light(t: Layers) -> DataFrame:
    mart = marts.compliance_mart(t.fact_requests, A.REQUESTS_AS_OF)
    return mart.select("alertas_vencidas", "cumplidas_en_plazo", "semaforo_cumplimiento")


@query("batch_profile")
def batch_profile(t: Layers) -> DataFrame:
    return Q.batch_profile(t.single_transactions)


# --- one row per key, global measures ---------------------------------------


@query("latest_per_key")
def latest_line(t: Layers) -> DataFrame:
    lines = t.raw("lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query("score_normalize")
def score_normalize(t: Layers) -> DataFrame:
    return S.score_normalize(published(t, "distances")).select("id_transaccion", "distancia_centroide", "score_ml")


@query("p95_sketches")
def p95_sketches(t: Layers) -> DataFrame:
    """Sketches stored by day, one day replaced, and the percentile of all days: whether its rank is within the bound."""
    path, rows = t.scratch("bocetos"), published(t, "distances")
    daily = lambda df: S.quantile_sketches(df, "distancia_centroide", ["fecha"])
    versions.replace_partitions(daily(rows), path, ["fecha"])
    day = rows.agg(F.min("fecha")).first()[0]
    versions.replace_partitions(daily(rows.where(F.col("fecha") == day)), path, ["fecha"], [(day,)])
    stored = versions.read(t.spark, path)
    cut = S.sketched_quantile(stored, 0.95)
    below = F.avg((F.col("distancia_centroide") < cut).cast("double")) - 0.95 <= S.rank_error()
    upto = F.avg((F.col("distancia_centroide") <= cut).cast("double")) - 0.95 >= -S.rank_error()
    dias = stored.agg(F.countDistinct("fecha").alias("dias"), F.sum("filas").alias("filas"))
    return rows.agg((below & upto).alias("dentro"), F.count("distancia_centroide").alias("n")).join(dias, F.col("n") == F.col("filas")).select("dias", "filas", "dentro")


@query("classify_p95")
def classify_p95(t: Layers) -> DataFrame:
    return S.classify_p95(published(t, "distances")).select("id_transaccion", "clasificacion_ml")


@query("regions_ratio")
def regions_ratio(t: Layers) -> DataFrame:
    return S.ratio_to_max(serving.top_regions(published(t, "fact_transacciones_ml")), "total")


# --- reporting queries ------------------------------------------------------

_PERIOD = {"start": "2024-01-03", "end": "2024-01-25"}


@query("q_kpis")
def q_kpis(t: Layers) -> DataFrame:
    return serving.kpis(published(t, "dim_cliente"), published(t, "fact_transacciones_ml"), **_PERIOD)


@query("q_quality")
def q_quality(t: Layers) -> DataFrame:
    return serving.quality_summary(published(t, "mart_calidad_datos"))


@query("q_compliance")
def q_compliance(t: Layers) -> DataFrame:
    return serving.compliance_summary(published(t, "mart_arcop_compliance"))


@query("q_regions")
def q_regions(t: Layers) -> DataFrame:
    return serving.top_regions(published(t, "fact_transacciones_ml"), **_PERIOD)


@query("q_clients")
def q_clients(t: Layers) -> DataFrame:
    return serving.client_list(published(t, "dim_cliente"))


@query("q_top_anomalies")
def q_top_anomalies(t: Layers) -> DataFrame:
    return serving.top_anomalies(published(t, "fact_transacciones_ml"), **_PERIOD)


@query("q_ml_summary")
def q_ml_summary(t: Layers) -> DataFrame:
    return serving.class_summary(published(t, "fact_transacciones_ml"), **_PERIOD)


@query("ml_summary")
def ml_summary(t: Layers) -> DataFrame:
    return model.ml_summary(published(t, "fact_transacciones_ml"))


@query("q_client_ids")
def q_client_ids(t: Layers) -> DataFrame:
    return serving.client_ids(published(t, "dim_cliente"))


@query("q_client_detail")
def q_client_detail(t: Layers) -> DataFrame:
    return serving.client_detail(published(t, "dim_cliente"), "C0000009")


@query("q_client_txn")
def q_client_txn(t: Layers) -> DataFrame:
    return serving.client_transactions(published(t, "fact_transacciones_ml"), "C0000009")


@query("q_client_requests")
def q_client_requests(t: Layers) -> DataFrame:
    return serving.client_requests(published(t, "fact_arcop_solicitudes"), "C0000009")


# --- data tests and governance ----------------------------------------------


@query("dq_not_null")
def dq_not_null(t: Layers) -> DataFrame:
    failing = Q.check_not_null(t.clients, "region").select("id_cliente", F.lit("region").alias("columna"))
    born = Q.check_not_null(t.clients, "fecha_nacimiento")
    return failing.unionByName(born.select("id_cliente", F.lit("fecha_nacimiento").alias("columna")))


@query("dq_unique")
def dq_unique(t: Layers) -> DataFrame:
    return Q.check_unique(t.silver_transactions, "id_transaccion")


@query("dq_accepted")
def dq_accepted(t: Layers) -> DataFrame:
    genders = Q.check_accepted(t.clients, "genero", ["M", "F"]).withColumnRenamed("genero", "valor")
    channels = Q.check_accepted(t.single_transactions, "canal", ["APP", "WEB", "POS"]).withColumnRenamed("canal", "valor")
    return genders.unionByName(channels)


@query("dq_suite")
def dq_suite(t: Layers) -> DataFrame:
    return Q.run_checks(
        {
            "clientes_deidentified": t.silver_clients,
            "transacciones_deidentified": t.silver_transactions,
            "arcop_solicitudes": t.silver_requests,
        }
    )


@query("column_policy")
def column_policy(t: Layers) -> DataFrame:
    return G.apply_column_policy(t.dim, "dim_cliente", [G.INTERNAL])


@query("guarded_columns")
def guarded_columns(t: Layers) -> DataFrame:
    """A report over guarded tables that needs the grant of one tag, beside columns that the reader has no grant for."""
    dim = G.guard_columns(t.dim, "dim_cliente", [G.INTERNAL])
    fact = G.guard_columns(t.fact, "fact_transacciones")
    joined = fact.join(dim.select("id_cliente", "rango_saldo"), "id_cliente")
    return G.authorize(joined.groupBy("rango_saldo", "canal").agg(F.count("*").alias("n"), F.countDistinct("id_cliente").alias("clientes")))


@query("table_aspects")
def table_aspects(t: Layers) -> DataFrame:
    database = f"silvertide_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{t.scratch(database)}'")
    frames = {
        "clientes_deidentified": t.silver_clients,
        "transacciones_deidentified": t.silver_transactions,
        "arcop_solicitudes": t.silver_requests,
        "mart_anomalias": marts.build_anomaly_mart(t.fact),
    }
    sizes = None
    for name in G.TABLE_ASPECTS:
        df = frames.get(name)
        df = published(t, name) if df is None else df
        full = f"{database}.{name}"
        out = tables.publish_gold(df, t.scratch(name), table=full)
        G.set_aspects(t.spark, full, G.TABLE_ASPECTS[name])
        row = out.agg(F.count("*").alias("filas")).withColumn("tabla", F.lit(name))
        sizes = row if sizes is None else sizes.unionByName(row)
    found = G.aspects(t.spark, [f"{database}.{n}" for n in G.TABLE_ASPECTS])
    path = t.scratch("aspects")
    found.join(sizes, "tabla").write.parquet(path)
    t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return t.spark.read.parquet(path)


@query("rut_check")
def rut_check(t: Layers) -> DataFrame:
    # Every eleventh id loses its right check digit.
    k = F.substring("id_cliente", 2, 20).cast("long")
    spoiled = F.when(k % 11 == 4, F.regexp_replace("rut", "-.$", "-0")).otherwise(F.col("rut"))
    return Q.check_rut(t.clients.withColumn("rut", spoiled)).select("id_cliente", "rut")


@query("region_commune")
def region_commune(t: Layers) -> DataFrame:
    nation, region = t.raw("nation"), t.raw("region")
    reference = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("region"), F.col("n_name").alias("comuna")
    )
    # Some clients get the commune of another region.
    k = F.substring("id_cliente", 2, 20).cast("long")
    moved = t.clients.withColumn("comuna", F.when(k % 61 == 7, "NATION_0").otherwise(F.col("comuna")))
    return Q.check_region_commune(moved, reference).select("id_cliente", "region", "comuna")


# --- calendar and history ---------------------------------------------------


@query("business_days")
def business_days(t: Layers) -> DataFrame:
    orders = t.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
    return orders.withColumn("habil", C.is_workday("dia"))


@query("business_calendar")
def business_calendar(t: Layers) -> DataFrame:
    """The calendar of the days from the first order to the last, with the orders of each day."""
    days = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("dia")).agg(F.count("*").alias("pedidos"))
    span = t.raw("orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return C.business_calendar(t.spark, *span).join(days, "dia", "left").withColumn("pedidos", F.coalesce("pedidos", F.lit(0)))


@query("add_business_days")
def add_business_days(t: Layers) -> DataFrame:
    orders = t.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
    return C.add_business_days(orders, "dia", C.LEGAL_LIMIT_DAYS, "limite")


@query("request_state")
def request_state(t: Layers) -> DataFrame:
    # Each request is seen up to 20 days after it was made, so all states occur.
    req = t.requests.select("id_solicitud", "fecha_solicitud", "dias_resolucion_estimados")
    number = F.substring("id_solicitud", 6, 20).cast("long")
    req = C.add_business_days(req, "fecha_solicitud", C.LEGAL_LIMIT_DAYS, "limite")
    req = C.add_business_days(req, "fecha_solicitud", F.col("dias_resolucion_estimados") + number % 3, "resolucion")
    seen = F.date_add(F.to_date("fecha_solicitud"), (number % 21).cast("int"))
    return req.withColumn("visto", seen).select(
        "id_solicitud", "visto", "limite", "resolucion",
        C.request_state(F.to_date("fecha_solicitud"), "dias_resolucion_estimados", "resolucion", "limite", F.col("visto")).alias("estado"),
    )


@query("calendar_features")
def calendar_features(t: Layers) -> DataFrame:
    return t.raw("orders").select("o_orderkey", R.is_midmonth(F.to_date("o_orderdate")).alias("quincena"))


def _snapshots(t: Layers) -> tuple[DataFrame, DataFrame]:
    """Two days of the client master: some arrive, and states move."""
    k = F.substring("id_cliente", 2, 20).cast("long")
    before = t.clients.where(k % 50 != 49)
    state = (
        F.when((F.col("arcop_estado") == "ACTIVO") & (k % 70 == 9), "ELIMINADO")
        .when((F.col("arcop_estado") == "ACTIVO") & (k % 45 == 8), "BLOQUEADO")
        .when((F.col("arcop_estado") == "BLOQUEADO") & (k % 4 == 3), "ACTIVO")
        .otherwise(F.col("arcop_estado"))
    )
    after = t.clients.withColumn("arcop_estado", state).withColumn(
        "score_crediticio", F.col("score_crediticio") + F.when(k % 90 == 17, 5).otherwise(0)
    )
    return before, after


@query("snapshot_delta")
def snapshot_delta(t: Layers) -> DataFrame:
    return H.delta_records(*_snapshots(t), "2024-02-02")


@query("snapshot_changes")
def snapshot_changes(t: Layers) -> DataFrame:
    return H.snapshot_delta(*_snapshots(t), "2024-02-02")


@query("scd2_merge")
def scd2_merge(t: Layers) -> DataFrame:
    columns = ("id_cliente", "arcop_estado", "score_crediticio", "region")
    before, after = (df.select(*columns) for df in _snapshots(t))
    first = before.select(
        *columns,
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("valid_from"),
        F.lit(H.END_OF_TIME).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return H.scd2_merge(first, after, ["id_cliente"], ["arcop_estado", "score_crediticio", "region"], "2024-02-02 00:00:00")


@query("scd2_table")
def scd2_table(t: Layers) -> DataFrame:
    columns = ("id_cliente", "arcop_estado", "score_crediticio", "region")
    path = t.scratch("history")
    for snapshot, day in zip(_snapshots(t), ("2024-01-01 00:00:00", "2024-02-02 00:00:00"), strict=True):
        histories.merge_history(snapshot.select(*columns), path, ["id_cliente"], columns[1:], day)
    return histories.read_history(t.spark, path)


# --- model ------------------------------------------------------------------


@query("ml_training_set")
def ml_training_set(t: Layers) -> DataFrame:
    return model.training_set(t.fact)


@query("training_count")
def training_count(t: Layers) -> DataFrame:
    return model.training_count(t.fact)


def _trained(t: Layers) -> model.AnomalyModel:
    return model.train_anomaly_model(model.training_set(published(t, "fact_transacciones")))


@query("ml_train")
def ml_train(t: Layers) -> DataFrame:
    """What any trained model must satisfy: k clusters 1 to k, all rows assigned, tighter than a single cluster."""
    rows = model.training_set(published(t, "fact_transacciones"))
    fitted = _trained(t)
    path = t.scratch("anomaly_model")
    fitted.save(t.spark, path)
    again = model.AnomalyModel.load(t.spark, path)
    one = model.AnomalyModel(again.features, again.means, again.deviations, ((0.0,) * len(again.features),))
    square = F.sum(F.col("distancia_centroide") * F.col("distancia_centroide"))
    cost = model.assign(rows, one).agg(square).first()[0]
    return model.assign(rows, again).agg(
        F.count_distinct("cluster_id").alias("grupos"), F.min("cluster_id").alias("primero"), F.max("cluster_id").alias("ultimo"),
        F.count("*").alias("filas"), (square < cost).alias("mejor_que_uno"),
    )


# A model of fixed numbers, so that its scores can be stated in SQL.
FIXED = model.AnomalyModel(
    model.FEATURES, (900000.0, 12.0, 4.0, 0.25), (800000.0, 6.5, 2.0, 0.125),
    ((-0.5, -1.0, 0.0, -0.5), (-0.5, 1.0, 0.5, 0.0), (0.5, 0.0, -1.0, 0.5), (1.5, 0.5, 1.0, 1.0), (3.0, 0.0, 0.0, 4.0)),
)


@query("ml_evaluate")
def ml_evaluate(t: Layers) -> DataFrame:
    found = model.evaluate(model.assign(model.training_set(published(t, "fact_transacciones")), FIXED), FIXED)
    return found.select(
        F.round("davies_bouldin_index", 6).alias("davies_bouldin_index"), F.round("mean_squared_distance", 6).alias("mean_squared_distance"), "filas"
    )


@query("ml_centroids")
def ml_centroids(t: Layers) -> DataFrame:
    """Centroids in original units, with the rows of the facts nearest to each."""
    rows = model.assign(model.training_set(published(t, "fact_transacciones")), FIXED).groupBy("cluster_id").agg(F.count("*").alias("filas"))
    return model.centroids(FIXED, t.spark).join(rows.withColumnRenamed("cluster_id", "centroid_id"), "centroid_id", "left")


@query("ml_scored")
def ml_scored(t: Layers) -> DataFrame:
    path = t.scratch("scored")
    model.apply_model(published(t, "fact_transacciones"), FIXED).write.parquet(path)
    return model.ml_table(t.spark.read.parquet(path)).select(
        "id_transaccion", "cluster_id", F.round("distancia_centroide", 9).alias("distancia_centroide"), "score_ml", "clasificacion_ml"
    )


# --- streams ----------------------------------------------------------------


@query("stream_silver")
def stream_silver(t: Layers) -> DataFrame:
    source, sink, checkpoint = _bronze_hours(t), t.scratch("silver"), t.scratch("checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ST.stream_silver(t.spark, source, sink, checkpoint, A.CLIENTS_AS_OF, TEST_KEYS)
    return versions.read(t.spark, sink).drop("fecha", "hora")


@query("stream_dedupe")
def stream_dedupe(t: Layers) -> DataFrame:
    """Several batches, the last of them with the earliest hours."""
    source, sink, checkpoint = t.scratch("bronze"), t.scratch("unique"), t.scratch("checkpoint")
    early = F.hour("fecha_hora") < 12
    for part in (t.transactions.where(~early), t.transactions.where(early)):
        bronze.write_bronze(part.drop("copia"), source, (), mode="append")
        rows = ST.stream_bronze(t.spark, source).select("id_transaccion", "id_cliente", "monto_clp", F.col("fecha_hora").cast("timestamp").alias("fecha_hora"))
        ST.stream_dedupe(rows, sink, checkpoint, ["id_transaccion"])
    return t.spark.read.parquet(sink)


@query("stream_alert_windows")
def stream_alert_windows(t: Layers) -> DataFrame:
    """Hourly windows that the watermark has closed, over three runs in the order of the event time."""
    source, sink, checkpoint = t.scratch("bronze"), t.scratch("windows"), t.scratch("checkpoint")
    day = F.dayofmonth("fecha_hora")
    for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
        bronze.write_bronze(t.single_transactions.where(part), source, (), mode="append")
        rows = ST.stream_bronze(t.spark, source).where(F.col("score_anomalia") >= 0.5)
        ST.stream_alert_windows(rows, sink, checkpoint, delay="1 day")
    return t.spark.read.parquet(sink)


@query("stream_alerts")
def stream_alerts(t: Layers) -> DataFrame:
    source, sink, checkpoint = t.scratch("bronze"), t.scratch("alerts"), t.scratch("checkpoint")
    early = F.hour("fecha_hora") < 12
    for part in (t.single_transactions.where(~early), t.single_transactions.where(early)):
        bronze.write_bronze(part, source, (), mode="append")
        ST.stream_alerts(ST.stream_bronze(t.spark, source).where(F.col("score_anomalia") >= 0.5), sink, checkpoint)
    return ST.alert_windows(t.spark, sink)
