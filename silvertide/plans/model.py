"""Anomaly model: k-means over transaction behaviour, and its scores."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.functions.rules import is_true, money
from silvertide.operators.history import DELETED
from silvertide.operators.scale import classify_p95, score_normalize

FEATURES = ("monto_clp", "hora", "dia_semana", "score_anomalia")


def scoreable(fact: DataFrame) -> DataFrame:
    """Valid, not marked duplicate, amount not negative; unknown values drop out."""
    return fact.where(F.col("es_registro_valido") & ~F.col("es_duplicado") & (F.col("monto_clp") >= 0))


def training_rows(fact: DataFrame, exclude_objections: bool = False) -> DataFrame:
    rows = scoreable(fact).where(F.col("arcop_estado") != DELETED)
    if exclude_objections:
        rows = rows.where(~is_true(F.col("arcop_oposicion_activa")))
    return rows


def training_set(fact: DataFrame, exclude_objections: bool = False) -> DataFrame:
    """Features of the rows the model may learn from."""
    return training_rows(fact, exclude_objections).select(*FEATURES)


def training_count(fact: DataFrame) -> DataFrame:
    return training_rows(fact).agg(F.count("*").alias("total"))


@dataclass(frozen=True)
class AnomalyModel:
    """Standardisation and centroids (in standard units) of a trained model.

    A few dozen numbers, so scoring is plain column arithmetic.
    """

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centroids: tuple[tuple[float, ...], ...]

    def standardised(self) -> list[Column]:
        out = []
        for name, mean, deviation in zip(self.features, self.means, self.deviations):
            filled = F.coalesce(F.col(name).cast("double"), F.lit(mean))
            out.append((filled - mean) / deviation if deviation else F.lit(0.0))
        return out

    def distances(self) -> list[Column]:
        scaled = self.standardised()
        out = []
        for centre in self.centroids:
            squares = [(x - F.lit(c)) * (x - F.lit(c)) for x, c in zip(scaled, centre)]
            total = squares[0]
            for square in squares[1:]:
                total = total + square
            out.append(F.sqrt(total))
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "modelo string").coalesce(1).write.mode(
            "overwrite"
        ).text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> AnomalyModel:
        raw = json.loads(spark.read.text(path).first()[0])
        return cls(
            tuple(raw["features"]), tuple(raw["means"]), tuple(raw["deviations"]),
            tuple(tuple(c) for c in raw["centroids"]),
        )


def train_anomaly_model(
    training: DataFrame,
    k: int = 5,
    max_iter: int = 20,
    seed: int = 7,
    min_rows: int = 0,
    features: Sequence[str] = FEATURES,
) -> AnomalyModel:
    """K-means on standardised features; missing values count as the mean.

    Every iteration reads `training`: pass a written table rather than a long plan. `min_rows` refuses smaller tables.
    """
    numeric = [F.col(f).cast("double") for f in features]
    stats = training.agg(
        F.count("*").alias("n"),
        *[measure(c).alias(f"{name}_{f}") for f, c in zip(features, numeric) for name, measure in (("known", F.count), ("mean", F.avg), ("spread", F.stddev_samp))],
    ).first()
    n = stats["n"]
    if n < max(min_rows, 1):
        raise ValueError(f"{n} rows to train on, {max(min_rows, 1)} needed")
    means = tuple(float(stats[f"mean_{f}"] or 0.0) for f in features)
    # Missing values count as the mean, so they add rows but no spread.
    deviations = tuple(
        float(stats[f"spread_{f}"] or 0.0) * ((max(stats[f"known_{f}"], 1) - 1) / max(n - 1, 1)) ** 0.5 for f in features
    )
    filled = training.select(*[F.coalesce(c, F.lit(m)).alias(f) for f, c, m in zip(features, numeric, means)])

    blank = AnomalyModel(tuple(features), means, deviations, ())
    scaled = filled.select(*[c.alias(f) for f, c in zip(features, blank.standardised())])
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(scaled).select("features")
    fitted = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features").fit(vectors)
    centres = tuple(sorted(tuple(float(x) for x in c) for c in fitted.clusterCenters()))
    return AnomalyModel(tuple(features), means, deviations, centres)


def assign(df: DataFrame, model: AnomalyModel) -> DataFrame:
    """Nearest centroid (from 1) and the distance to it."""
    options = [F.struct(d.alias("d"), F.lit(i).alias("c")) for i, d in enumerate(model.distances(), start=1)]
    return (
        df.withColumn("__nearest", F.array_min(F.array(*options)))
        .withColumn("cluster_id", F.col("__nearest.c"))
        .withColumn("distancia_centroide", F.col("__nearest.d"))
        .drop("__nearest")
    )


def evaluate(scored: DataFrame, model: AnomalyModel) -> DataFrame:
    """Davies-Bouldin index and mean squared distance of scored rows.

    One pass gives a row per cluster; the pairs are among the k clusters only.
    """
    per_cluster = scored.groupBy("cluster_id").agg(
        F.count("*").alias("n"),
        F.avg("distancia_centroide").alias("s"),
        F.sum(F.col("distancia_centroide") * F.col("distancia_centroide")).alias("sq"),
    )
    rows = {r["cluster_id"]: r for r in per_cluster.collect()}  # at most k rows

    def gap(i: int, j: int) -> float:
        a, b = model.centroids[i - 1], model.centroids[j - 1]
        return sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5

    worst = [
        max((rows[i]["s"] + rows[j]["s"]) / gap(i, j) for j in rows if j != i and gap(i, j) > 0)
        for i in rows
    ] if len(rows) > 1 else []
    index = sum(worst) / len(worst) if worst else None
    total = sum(r["n"] for r in rows.values())
    mean_square = sum(r["sq"] for r in rows.values()) / total if total else None
    return scored.sparkSession.createDataFrame(
        [(index, mean_square, total)], "davies_bouldin_index double, mean_squared_distance double, filas long"
    )


def centroids(model: AnomalyModel, spark: SparkSession) -> DataFrame:
    """Centroids in original units: (centroid_id, feature, numerical_value), ordered."""
    rows = [
        (i, f, c * d + m)
        for i, centre in enumerate(model.centroids, start=1)
        for f, c, m, d in zip(model.features, centre, model.means, model.deviations)
    ]
    return spark.createDataFrame(rows, "centroid_id int, feature string, numerical_value double").orderBy(
        "centroid_id", "feature"
    )


def apply_model(fact: DataFrame, model: AnomalyModel) -> DataFrame:
    """Every scoreable transaction with its cluster and distance.

    Transaction ids are unique in the fact table, so no join back is needed.
    """
    return assign(scoreable(fact), model)


ML_COLUMNS = (
    "id_transaccion", "id_cliente", "monto_clp", "hora", "dia_semana", "canal", "region", "fecha",
    "es_anomalia_flag", "score_generador", "cluster_id", "distancia_centroide", "score_ml",
    "clasificacion_ml", "flag_uaf_threshold", "nivel_riesgo_anomalia", "categoria_riesgo",
    "arcop_estado", "fecha_gold",
)


def ml_table(scored: DataFrame) -> DataFrame:
    """The scored fact table: normalised score and class added, 19 columns."""
    normal = score_normalize(scored)
    return (
        classify_p95(normal)
        .withColumnRenamed("score_anomalia", "score_generador")
        .select(*ML_COLUMNS)
    )


def ml_summary(ml: DataFrame) -> DataFrame:
    """Rows, mean amount, mean score and threshold alerts of each class."""
    return ml.groupBy("clasificacion_ml").agg(
        F.count("*").alias("total"),
        F.round(F.avg(money("monto_clp")), 0).cast("double").alias("monto_promedio"),
        F.round(F.avg(F.col("score_ml").cast("decimal(10,4)")), 4).cast("double").alias("score_ml_promedio"),
        F.count_if("flag_uaf_threshold").alias("alertas_uaf"),
    )
