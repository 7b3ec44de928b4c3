"""Tables written once and read again, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local master without it (tests) gets a temporary one."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set(SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses; it goes when Python ends or release() is called."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df once and reads it back: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_name(df: DataFrame, name: str) -> str:
    """name, or name behind as many underscores as it takes to differ from all columns of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def named(column: str) -> Column:
    """A column by its whole name, whatever characters that holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def plain_id(column: Column) -> list[Column]:
    """A column as two that are never null, so that joins and windows on them share one layout of the rows."""
    return [column.isNull(), F.coalesce(column.cast("string"), F.lit(""))]


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """df with columns of these names under other ones, and the columns that give df's own names and order back.

    Names with a dot or a backtick, which Spark's own Arrow functions do not take, are replaced as well.
    """
    aside = {c: spare_name(df, f"aside_{i}") for i, c in enumerate(df.columns) if c.lower() in names or not {".", "`"}.isdisjoint(c)}
    return df.withColumnsRenamed(aside), [named(aside.get(c, c)).alias(c) for c in df.columns]


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with the place (1, 2, 3, ...) of each row in the given order, without a task that sees all rows.

    Rows are sorted by range and written; rows that the order cannot tell apart are spread by their place in df, which
    should be a stored table. One row per range, a number that the cluster sets, gives the places to start from.
    """
    at, salt = spare_name(df, "at"), spare_name(df, "salt")
    salted = df.withColumn(salt, F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*order, salt).sortWithinPartitions(*order, salt).drop(salt)
    stored = materialize(ranged.withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(named(at), 33)
    sizes = {r[0]: r[1] for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for i in sorted(sizes):
        starts.append((i, before))
        before += sizes[i]
    begin, range_no = spare_name(stored, "begin"), spare_name(stored, "range_no")
    table = df.sparkSession.createDataFrame(starts, f"{range_no} long, {begin} long")
    place = named(begin) + named(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return stored.join(F.broadcast(table), part == named(range_no)).withColumn(name, place).drop(at, begin, range_no)


def release(spark: SparkSession) -> None:
    """Deletes what this session has written by new_path(); call it when the results have been stored."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for own in [x for x in _written if x[0] is spark]:
        path = jvm.org.apache.hadoop.fs.Path(own[1])
        path.getFileSystem(conf).delete(path, True)
        _written.remove(own)


@atexit.register
def _release_all() -> None:
    for spark in {id(s): s for s, _ in _written}.values():
        try:
            release(spark)
        except Exception:  # noqa: BLE001  the session has ended; nothing can be deleted through it
            pass
