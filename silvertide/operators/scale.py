"""Measures relative to the whole table, without a one-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.functions.rules import is_true, ratio

# Ranges counted in one pass of the percentile: the most rows that reach the driver.
BUCKETS = 4096
# Size of a quantile sketch; the rank error is 0.27 % then.
SKETCH_K = 1024


def table_max(df: DataFrame, column: str) -> Column:
    """Largest value of a column as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def ratio_to_max(df: DataFrame, column: str, out: str = "porcentaje") -> DataFrame:
    """Share of the largest group in whole percent (the width of a bar)."""
    return df.withColumn(out, F.round(ratio(F.col(column), table_max(df, column)) * 100, 0))


def score_normalize(df: DataFrame, distance: str = "distancia_centroide", out: str = "score_ml") -> DataFrame:
    """Distance as a share of the largest distance, 4 decimals; null when that is 0."""
    return df.withColumn(out, F.round(ratio(F.col(distance), table_max(df, distance)), 4))


def exact_quantile(df: DataFrame, column: str, share: float, buckets: int = BUCKETS) -> float | None:
    """Exact interpolated percentile of a column of any size.

    Each pass counts the values of a bracket in equal ranges and goes on with the one that holds the wanted rank,
    until that range is a single value. A pass is a partial aggregate with at most `buckets` rows, so neither size,
    skew nor the number of different values reaches one task or the driver.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    whole = values.agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    n = whole["n"]
    if not n:
        return None
    if not (math.isfinite(whole["low"]) and math.isfinite(whole["high"])):
        raise ValueError(f"{column} holds values that are not finite")
    counted: dict[tuple[float, float], list] = {}

    def value_at(rank: int) -> float:
        low, high = whole["low"], whole["high"]
        while low < high:
            if (low, high) not in counted:
                counted[low, high] = _histogram(values, low, high, buckets)
            for row in counted[low, high]:
                if rank < row["n"]:
                    low, high = row["low"], row["high"]
                    break
                rank -= row["n"]
        return low

    position = share * (n - 1)
    first = int(position)
    a, b = value_at(first), value_at(min(first + 1, n - 1))
    weight = position - first
    return a if a == b else a * (1 - weight) + b * weight


def _histogram(values: DataFrame, low: float, high: float, buckets: int) -> list:
    """Count, least and largest value of the ranges of a bracket that hold any, in order."""
    middle = low / 2 + high / 2
    # Halves first: the width of the whole may be beyond the largest number, and the cut always parts low from high.
    lower = F.floor((F.col("v") / 2 - low / 2) / (high / 2 - low / 2) * buckets)
    own = F.least(F.greatest(lower, F.lit(0)), F.lit(buckets - 1))
    return (
        values.where(F.col("v").between(low, high))
        .groupBy((F.col("v") > middle).alias("half"), own.alias("range"))
        .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .orderBy("low")
        .collect()
    )


def rank_error(k: int = SKETCH_K) -> float:
    """How far the rank of a sketched quantile is from the wanted one, as a share of all values, in 99 of 100 cases."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, column: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by, filas, boceto): a mergeable quantile sketch of each group's values, as a rule of each day's.

    A sketch holds a few thousand values at most, whatever the number of rows; maps send one per group. Store them by day
    and replace only the days that change: history is not read again. Null and NaN do not count, and a group without
    any other value has no sketch.
    """
    value = F.col(column).cast("double")
    kept = df.select(*by, F.nanvl(value, F.lit(None).cast("double")).alias("valor")).where("valor IS NOT NULL")
    return kept.groupBy(*by).agg(F.count("*").alias("filas"), F.kll_sketch_agg_double("valor", k).alias("boceto")).where("filas > 0")


def sketched_quantile(sketches: DataFrame, share: float, sketch: str = "boceto") -> float | None:
    """Quantile of all values that went into the sketches, in whatever order these are merged; see rank_error."""
    merged = sketches.where(F.col(sketch).isNotNull()).agg(F.count("*").alias("n"), F.kll_merge_agg_double(sketch).alias("merged"))
    return merged.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("merged", F.lit(float(share))))).first()[0]


def classify_p95(
    df: DataFrame,
    distance: str = "distancia_centroide",
    flag: str = "es_anomalia_flag",
    share: float = 0.95,
    out: str = "clasificacion_ml",
    approx: bool = False,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """ANOMALA when flagged or farther than the percentile, else NORMAL.

    The exact percentile reads `df` a few times: pass a written table rather than a
    long plan. With `approx` it is read once, or not at all where stored `sketches`
    of the distance are given (`quantile_sketches`).
    """
    if approx:
        found = sketched_quantile(sketches if sketches is not None else quantile_sketches(df, distance), share)
    else:
        found = exact_quantile(df, distance, share)
    cut = F.lit(found).cast("double")
    odd = is_true(F.col(flag)) | is_true(F.col(distance) > cut)
    return df.withColumn(out, F.when(odd, "ANOMALA").otherwise("NORMAL"))
