"""Incremental forms of the hourly batches: writes that can be repeated, and keyed state bounded by a watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide import schemas
from silvertide.functions.rules import money
from silvertide.plans.deidentify import Keys
from silvertide.sources.bronze import readable
from silvertide.sources.tables import load_named_hours


def stream_bronze(spark: SparkSession, root: str, max_files: int | None = None, by_hour: bool = False) -> DataFrame:
    """Transactions as they arrive, unreadable lines left out; by_hour: below `fecha=/hora=` folders."""
    schema = schemas.with_corrupt(schemas.BRONZE_TRANSACTIONS)
    reader = spark.readStream.schema(schemas.with_hour_partitions(schema) if by_hour else schema)
    reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.json(root)
    return lines if by_hour else readable(lines)


def run_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all available input of a stream to `write`, batch by batch, and stop."""
    df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_silver(
    spark: SparkSession,
    root: str,
    sink: str,
    checkpoint: str,
    as_of: datetime | str,
    keys: Keys,
    rejected: str | None = None,
    max_files: int | None = None,
) -> None:
    """Load every hour of Bronze that has new files since the last run.

    The checkpoint remembers the files. The hours a batch touches are loaded whole and replace their partitions, so a
    repeated batch adds nothing, a late file completes its hour, and `backfill` can replace the same partitions.
    """

    def write(batch: DataFrame, _: int) -> None:
        # One row per hour that has new files; all of them are loaded in one step.
        touched = batch.select(F.col("fecha").cast("string").alias("fecha"), F.col("hora").cast("int").alias("hora")).distinct().collect()
        load_named_hours(spark, root, sink, [(r.fecha, r.hora) for r in touched], as_of, keys, rejected)

    run_batches(stream_bronze(spark, root, max_files, by_hour=True), write, checkpoint)


@dataclass(frozen=True)
class Run:
    """What a run over all available input did; late rows are those behind the watermark, which were dropped."""

    batches: int
    rows: int
    late: int
    most_state_rows: int


def run_appended(df: DataFrame, sink: str, checkpoint: str) -> Run:
    """Append a stateful stream's finished rows to a Parquet sink that takes each batch once, and stop."""
    spark, kept = df.sparkSession, "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "1000000")
    try:
        query = df.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        steps = query.recentProgress
    finally:
        spark.conf.set(kept, before)
    operators = [[o for o in step.stateOperators] for step in steps]
    return Run(
        len(steps), sum(step.numInputRows for step in steps), sum(o.numRowsDroppedByWatermark for own in operators for o in own),
        max((sum(o.numRowsTotal for o in own) for own in operators), default=0),
    )


def stream_dedupe(
    df: DataFrame, sink: str, checkpoint: str, keys: Sequence[str], event_time: str = "fecha_hora", delay: str = "40 days", salts: int = 8
) -> Run:
    """Append the first row of each key; a repetition within `delay` of event time is dropped, in whatever batch it comes.

    The keys seen are state that is let go once the watermark, the latest event time less `delay`, has passed them; the
    sink is never read. Rows behind the watermark are dropped and counted. A key that holds many rows is thinned on
    `salts` tasks before its rows meet. Rows without an event time are told apart within their batch only.
    """
    at, salt = "_evento", "_reparto"
    timed = df.withColumns({at: F.col(event_time).cast("timestamp"), salt: F.spark_partition_id() % salts}).withWatermark(at, delay)
    single = timed.dropDuplicatesWithinWatermark([*keys, salt]).dropDuplicatesWithinWatermark(list(keys))
    return run_appended(single.drop(at, salt), sink, checkpoint)


def stream_alert_windows(
    df: DataFrame, sink: str, checkpoint: str, event_time: str = "fecha_hora", delay: str = "2 hours", width: str = "1 hour"
) -> Run:
    """Append alert counts by window of event time and region, each once and final, when the watermark has passed its end.

    A row up to `delay` behind the latest event time still counts, one behind the watermark is dropped and counted in the
    result of the run. Rows without an event time belong to no window. Partial sums are formed before rows are shuffled.
    """
    at = "_evento"
    timed = df.withColumn(at, F.col(event_time).cast("timestamp")).withWatermark(at, delay)
    closed = timed.groupBy(F.window(at, width).alias("ventana"), "region").agg(
        F.count("*").alias("total_alertas"), F.sum(money("monto_clp")).alias("monto_total_alertado"), F.max("monto_clp").alias("monto_maximo")
    )
    final = closed.select(F.col("ventana.start").alias("desde"), F.col("ventana.end").alias("hasta"), "region", "total_alertas", "monto_total_alertado", "monto_maximo")
    return run_appended(final, sink, checkpoint)


def stream_alerts(df: DataFrame, sink: str, checkpoint: str, event_time: str = "fecha_hora") -> None:
    """Hourly alert counts by region, as partial sums of every batch.

    A batch writes the sums of its own rows to its own partition, which a repeated batch replaces. `alert_windows` adds
    them up, so no window waits to be closed and late rows count.
    """
    spark = df.sparkSession
    start = F.date_trunc("hour", F.col(event_time).cast("timestamp"))

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy(start.alias("desde"), "region").agg(
            F.count("*").alias("total_alertas"), F.sum(money("monto_clp")).alias("monto_total_alertado"),
            F.max("monto_clp").alias("monto_maximo"),
        )
        writer = sums.withColumn("lote", F.lit(number)).write.mode("overwrite").partitionBy("lote")
        writer.option("partitionOverwriteMode", "dynamic").parquet(sink)

    run_batches(df, write, checkpoint)


def alert_windows(spark: SparkSession, sink: str) -> DataFrame:
    """One row per hour and region over all batches so far."""
    return spark.read.parquet(sink).groupBy("desde", "region").agg(
        F.sum("total_alertas").alias("total_alertas"), F.sum("monto_total_alertado").alias("monto_total_alertado"),
        F.max("monto_maximo").alias("monto_maximo"),
    )
