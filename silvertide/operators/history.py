"""Snapshot comparison and version history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import latest_per_key

ACTIVE, BLOCKED, DELETED = "ACTIVO", "BLOQUEADO", "ELIMINADO"
CHANGE_KINDS = ("nuevos", "eliminados", "bloqueados", "reactivados")
END_OF_TIME = "9999-12-31"
#: Ids that one part of a change record may hold on average.
IDS_PER_PART = 100_000


def snapshot_states(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Old and new state of every client, as one shuffle with partial aggregation.

    A union and an aggregate replace a full outer join: a repeated id merges in
    the map tasks instead of multiplying.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        other = "nuevo" if name == "previo" else "previo"
        return df.select(
            "id_cliente",
            F.col("arcop_estado").alias(name),
            F.lit(None).cast("string").alias(other),
            F.lit(name == "previo").alias("en_previo"),
            F.lit(name == "nuevo").alias("en_nuevo"),
        )

    both = side(prev, "previo").unionByName(side(curr, "nuevo"))
    return both.groupBy("id_cliente").agg(
        F.max("previo").alias("previo"),
        F.max("nuevo").alias("nuevo"),
        F.bool_or("en_previo").alias("en_previo"),
        F.bool_or("en_nuevo").alias("en_nuevo"),
    )


def snapshot_delta(prev: DataFrame, curr: DataFrame, day: date | str) -> DataFrame:
    """Change of every client between two snapshots: (fecha, cambio, id_cliente)."""
    was_active = F.col("previo") == ACTIVE
    change = (
        F.when(~F.col("en_previo"), "nuevos")
        .when(was_active & (F.col("nuevo") == DELETED), "eliminados")
        .when(was_active & (F.col("nuevo") == BLOCKED), "bloqueados")
        .when((F.col("previo") == BLOCKED) & (F.col("nuevo") == ACTIVE), "reactivados")
    )
    return (
        snapshot_states(prev, curr)
        .where("en_nuevo")
        .select(F.lit(str(day)).alias("fecha"), change.alias("cambio"), "id_cliente")
        .where(F.col("cambio").isNotNull())
    )


def snapshot_totals(curr: DataFrame) -> DataFrame:
    return curr.agg(
        F.count("*").alias("total_maestro"),
        F.count_if(F.col("arcop_estado") == ACTIVE).alias("total_activos"),
    )


def delta_records(prev: DataFrame, curr: DataFrame, day: date | str, parts: int | None = None) -> DataFrame:
    """The daily change record with one id array per kind of change, in as many `parte` as asked for.

    Together the parts hold every id, whatever their number; `snapshot_delta` has the same changes as rows. Without a
    number, the changes are counted first and IDS_PER_PART go to a part.
    """
    changes = snapshot_delta(prev, curr, day)
    if parts is None:
        parts = max(1, ceil(changes.count() / IDS_PER_PART))
    part = F.pmod(F.xxhash64("id_cliente"), F.lit(parts)).cast("int")
    seed = curr.sparkSession.range(parts).select(
        F.lit(str(day)).alias("fecha"),
        F.lit(None).cast("string").alias("cambio"),
        F.lit(None).cast("string").alias("id_cliente"),
        F.col("id").cast("int").alias("parte"),
    )

    def ids(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("cambio") == kind, F.col("id_cliente")))).alias(kind)

    totals = snapshot_totals(curr)
    return (
        changes.withColumn("parte", part)
        .unionByName(seed)
        .groupBy("fecha", "parte")
        .agg(*[ids(kind) for kind in CHANGE_KINDS])
        .withColumn("total_maestro", totals.select("total_maestro").scalar())
        .withColumn("total_activos", totals.select("total_activos").scalar())
    )


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when a key is null: it could never match and would grow the history on every run."""
    return df.withColumns({
        k: F.coalesce(F.col(k), F.raise_error(F.lit(f"{k} is required")).cast(df.schema[k].dataType)) for k in keys
    })


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | str,
    newest: Sequence[Column] | None = None,
) -> DataFrame:
    """Fold a snapshot into a version history.

    `history` has the snapshot's columns plus valid_from, valid_to, is_current.
    A changed key closes its open version at `as_of` and opens a new one; a new
    key opens one; unchanged and absent keys stay. When the snapshot repeats a
    key, the version that comes first by `newest` (then by all columns) wins.
    Tracked columns are compared as they are, nulls equal to nulls. A null key in
    the snapshot or in an open version is an error. The result is written to a new
    place (`publish_gold` with versions), as the history is its own input.
    """
    keys = list(keys)
    columns = snapshot.columns
    history, snapshot = (with_keys(df, keys) for df in (history, snapshot))
    stamp = F.lit(str(as_of)).cast("timestamp")
    incoming = latest_per_key(snapshot, keys, newest or [])
    old = history.where("is_current").select(
        *keys, F.struct(*history.columns).alias("old"), F.struct(*tracked).alias("old_tracked")
    )
    new = incoming.select(
        *keys,
        F.struct(
            *columns,
            stamp.alias("valid_from"),
            F.lit(END_OF_TIME).cast("date").alias("valid_to"),
            F.lit(True).alias("is_current"),
        ).alias("new"),
        F.struct(*tracked).alias("new_tracked"),
    )
    order = [*columns, "valid_from", "valid_to", "is_current"]

    def version(side: str, **changed: Column) -> Column:
        return F.struct(*[changed.get(c, F.col(side)[c]).alias(c) for c in order])

    closed = version("old", valid_to=stamp.cast("date"), is_current=F.lit(False))
    kept, opened = version("old"), version("new")
    same = F.col("new").isNull() | F.col("old_tracked").eqNullSafe(F.col("new_tracked"))
    rows = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(same, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    merged = old.join(new, keys, "full_outer").select(F.inline(rows))
    return history.where("NOT is_current").select(*order).unionByName(merged)

