"""Version histories as tables: key buckets, with open and closed versions in partitions of their own."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.operators.history import scd2_merge, with_keys
from silvertide.operators.latest import latest_per_key

from . import versions

PARTITIONS = ("is_current", "balde")
BUCKETS = 256


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_history(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Every version of every key, as `scd2_merge` gives them."""
    return versions.read(spark, path, version).drop("balde")


def merge_history(
    snapshot: DataFrame,
    path: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | str,
    newest: Sequence[Column] | None = None,
    buckets: int = BUCKETS,
) -> list[int]:
    """Fold a snapshot into the history at `path`, with the result of `scd2_merge`; the buckets that were rewritten.

    Only buckets with a new or changed key are merged. Their open versions are replaced and newly closed versions added in
    one step; closed versions of earlier runs are neither read nor written. A snapshot without changes publishes nothing.
    The number of buckets is set by the first run. Writers do not merge at the same time: the later one fails.
    """
    spark, keys = snapshot.sparkSession, list(keys)
    last = versions.manifest(spark, path)
    if last:
        buckets = int(last.properties["buckets"])
    incoming = latest_per_key(with_keys(snapshot, keys), keys, newest or []).withColumn("balde", _bucket(keys, buckets))
    if last:
        open_rows = versions.read(spark, path, last.version).where("is_current")
        known = open_rows.select(*keys, F.struct(*tracked).alias("old_tracked"), F.lit(True).alias("is_known"))
        changed = F.col("is_known").isNull() | ~F.col("old_tracked").eqNullSafe(F.struct(*tracked))
        # No more rows than buckets reach the driver.
        touched = sorted(r[0] for r in incoming.join(known, keys, "left").where(changed).select("balde").distinct().collect())
        if not touched:
            return []
        merged = scd2_merge(
            open_rows.where(F.col("balde").isin(touched)).drop("balde"),
            incoming.where(F.col("balde").isin(touched)).drop("balde"), keys, tracked, as_of,
        )
    else:
        touched = list(range(buckets))
        stamp = F.lit(str(as_of)).cast("timestamp")
        none_yet = incoming.drop("balde").where("false").select(
            "*", stamp.alias("valid_from"), stamp.cast("date").alias("valid_to"), F.lit(True).alias("is_current")
        )
        merged = scd2_merge(none_yet, incoming.drop("balde"), keys, tracked, as_of)
    rows = merged.withColumn("balde", _bucket(keys, buckets)).hint("rebalance", *PARTITIONS)
    versions.replace_partitions(
        rows, path, PARTITIONS, [("true", b) for b in touched], add_others=True, based_on=last.version if last else 0,
        properties={"buckets": str(buckets)},
    )
    return touched
