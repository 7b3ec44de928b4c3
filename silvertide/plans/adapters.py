"""Bronze-shaped tables derived from the star-schema test tables.

Rows are built only from the given tables, without random functions, and carry
known faults (negative amounts, future times, malformed addresses, personal data
in text) so that every rule has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide import schemas
from silvertide.functions.rules import format_rut

CLIENTS_AS_OF = "2024-02-01 00:00:00"
TRANSACTIONS_AS_OF = "2024-01-28 00:00:00"
REQUESTS_AS_OF = "2001-07-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zero_padded(number: Column, width: int) -> Column:
    """At least `width` digits; longer numbers are not cut."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def client_id(number: Column) -> Column:
    return F.concat(F.lit("C"), zero_padded(number + 1, 7))


def account(number: Column) -> Column:
    return (F.lit(10000000) + (number * 7907) % 90000000).cast("string")


def card(number: Column) -> Column:
    return F.concat(F.lit("4532"), zero_padded((number * 15485863) % 1000000000000, 12))


def mobile(number: Column) -> Column:
    return F.concat(F.lit("+569"), (F.lit(10000000) + (number * 104729) % 90000000).cast("string"))


def national_id(number: Column) -> Column:
    return format_rut(F.lit(5000000) + (number * 7919) % 20000000)


def pick(index: Column, *labels: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index % len(labels)).cast("int") + 1)


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client master: one row per customer."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    # Dealt out by key: masking a client costs far more than its bytes in the file tell the split of the scan.
    customer = table(spark, sf_dir, "customer").repartition("c_custkey")
    base = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    k = F.col("c_custkey")
    born = F.make_date((1940 + k % 66).cast("int"), (1 + k % 12).cast("int"), (1 + k % 28).cast("int"))
    values = {
        "id_cliente": client_id(k),
        "rut": national_id(k),
        "nombre_completo": F.replace("c_name", F.lit("#"), F.lit(" ")),
        "email": F.when(k % 200 == 7, F.format_string("user%d example cl", k)).otherwise(
            F.format_string("user%d@mail%d.example.com", k, k % 9)
        ),
        "telefono": mobile(k),
        "num_tarjeta": card(k),
        "num_cuenta": account(k),
        "fecha_nacimiento": F.when(k % 500 == 3, "2030-01-01")
        .when(k % 333 == 5, F.lit(None))
        .otherwise(born.cast("string")),
        "genero": F.when(k % 50 == 11, "X").when(k % 2 == 0, "M").otherwise("F"),
        "region": F.when(k % 97 == 13, F.lit(None)).otherwise(F.col("r_name")),
        "comuna": F.col("n_name"),
        "ocupacion": F.lit(""),
        "estado_civil": F.lit(""),
        "nivel_educacion": F.lit(""),
        "tipo_cuenta": F.col("c_mktsegment"),
        "saldo_cuenta": F.col("c_acctbal") * 5000,
        "deuda_total": F.when(k % 10 == 0, 0).otherwise(((k * 7919) % 20000) * 1000),
        "score_crediticio": F.when(k % 400 == 9, 950).when(k % 300 == 8, 800).otherwise(300 + (k * 31) % 601),
        "renta_mensual": F.lit(400000) + ((k * 6661) % 9600) * 1000,
        "tiene_credito": k % 2 == 0,
        "categoria_riesgo": F.when(k % 300 == 8, "ALTO").otherwise(pick(k, "BAJO", "MEDIO", "ALTO")),
        "comentario_operador": F.when(
            k % 100 == 6,
            F.concat(F.lit("Cliente verificado RUT "), national_id(k), F.lit(" en sucursal")),
        ).otherwise(""),
        "fecha_creacion": F.lit("2020-01-01"),
        "arcop_estado": F.when(k % 40 == 1, "ELIMINADO").when(k % 25 == 2, "BLOQUEADO").otherwise("ACTIVO"),
        "arcop_acceso_solicitado": F.lit(False),
        "arcop_rectificacion_pending": F.lit(False),
        "arcop_cancelacion_solicitado": k % 60 == 4,
        "arcop_oposicion_activa": k % 70 == 5,
        "arcop_portabilidad_entregada": F.lit(False),
        "consentimiento_ley19628": F.lit(True),
        "fecha_consentimiento": F.lit("2020-01-02"),
    }
    return base.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.BRONZE_CLIENTS])


def transactions(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Transactions: one row per event, every twentieth one loaded twice (`copia`)."""
    events = table(spark, sf_dir, "events")
    e, u = F.col("event_id"), F.col("user_id")
    repeat = F.when(e % 20 == 0, 2).otherwise(1) if copies else F.lit(1)
    values = {
        "id_transaccion": F.concat(F.lit("T"), zero_padded(e, 9)),
        "id_cliente": client_id(u),
        "num_cuenta": account(u),
        "num_tarjeta_mask": F.right(card(u), F.lit(4)),
        "monto_clp": F.col("value") * 20000 - 100000,
        "tipo_transaccion": pick(e, "CREDITO", "DEBITO", "GIRO"),
        "canal": pick(e, "APP", "WEB", "CAJERO", "SUCURSAL", "POS"),
        "categoria_gasto": F.when(e % 83 == 0, F.lit(None)).otherwise(F.col("event_type")),
        "region": F.when(e % 89 == 0, F.lit(None)).otherwise(F.concat(F.lit("R"), (u % 5).cast("string"))),
        "comuna": F.lit(""),
        "fecha_hora": F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        "descripcion": F.when(e % 100 == 1, F.concat(F.lit("Pago con tarjeta "), card(u), F.lit(" autorizado")))
        .when(e % 100 == 2, F.format_string("Aviso enviado a user%d@mail.example.com", u))
        .when(
            e % 100 == 3,
            F.concat(F.lit("Solicitada por RUT "), national_id(u), F.lit(" fono "), mobile(u)),
        )
        .otherwise("Compra normal"),
        "es_anomalia_flag": (F.col("event_type") == "error") & (F.col("value") > 150),
        "score_anomalia": F.least(F.lit(1.0), F.col("value") / 350),
        "estado": F.lit("COMPLETADA"),
        "es_duplicado": e % 125 == 0,
    }
    shaped = events.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.BRONZE_TRANSACTIONS],
        F.explode(F.sequence(F.lit(1), repeat)).alias("copia"),
    )
    return shaped if copies else shaped.drop("copia")


def with_hour(txn: DataFrame) -> DataFrame:
    """The partition path columns of the hour a transaction belongs to."""
    moment = F.col("fecha_hora").cast("timestamp")
    return txn.withColumn("fecha", F.to_date(moment)).withColumn("hora", F.hour(moment))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-subject requests: one row per order."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kind_index = k % 20
    kind = (
        F.when(kind_index <= 8, "A")
        .when(kind_index <= 13, "R")
        .when(kind_index <= 16, "P")
        .when(kind_index <= 18, "O")
        .otherwise("C")
    )
    names = {"A": "Acceso", "R": "Rectificacion", "C": "Cancelacion", "O": "Oposicion", "P": "Portabilidad"}
    name = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[kind]
    asked = F.to_date("o_orderdate")
    limit = F.date_add(asked, 21)
    today = F.lit(REQUESTS_AS_OF[:10]).cast("date")
    status = F.col("o_orderstatus")
    values = {
        "id_solicitud": F.concat(F.lit("ARCOP"), k.cast("string")),
        "id_cliente": client_id(F.col("o_custkey")),
        "tipo_derecho": kind,
        "descripcion_tipo": name,
        "fecha_solicitud": asked,
        "fecha_limite": limit,
        "fecha_resolucion": F.when(status == "F", F.date_add(asked, (k % 30).cast("int"))),
        "estado": F.when(k % 17 == 0, "VENCIDO")
        .when(status == "F", "COMPLETADO")
        .when(status == "O", "EN_PROCESO")
        .otherwise("PENDIENTE"),
        "canal": pick(k, "WEB", "APP", "SUCURSAL", "EMAIL"),
        "dias_habiles_max": F.lit(15),
        "dias_resolucion_estimados": 2 + k % 14,
        "vence_en_dias": F.greatest(F.lit(0), F.datediff(limit, today)),
        "es_critico": kind == "C",
        "responsable": pick(k, "Data Steward Norte", "Data Steward Sur", "Data Steward RM"),
    }
    return orders.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.BRONZE_REQUESTS])
