"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW = "__rank"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[Column],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest version of every key.

    `newest` are sort orders, newest first. Equal versions are ordered by the
    `ties` columns (all others by default), so a re-run picks the same row. The
    rank filter lets Spark keep one row per key inside each map task before it
    shuffles, so a key with a huge number of versions does not pile up in one task.
    """
    others = ties if ties is not None else [c for c in df.columns if c not in keys]
    order = list(newest) + [F.col(c).asc() for c in others]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_ROW, rank).where(F.col(_ROW) == 1).drop(_ROW)
