"""Bronze: JSON lines below Hive-style `fecha=/hora=` paths."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvertide.schemas import CORRUPT, with_corrupt, with_hour_partitions


def _reader(spark: SparkSession, schema: T.StructType):
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def read_bronze(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines with a fixed schema.

    With `keep_corrupt` unreadable lines stay visible in `_corrupt_record`; without it they are left out, and
    `rejected_lines` has them.
    """
    lines = _reader(spark, with_corrupt(schema)).json(path)
    return lines if keep_corrupt else readable(lines)


def readable(lines: DataFrame) -> DataFrame:
    """The lines that could be read, without the column of the others.

    The condition names a second column: Spark refuses to read JSON for the corrupt column alone.
    """
    other = next(c for c in lines.columns if c != CORRUPT)
    broken = F.nullif(F.col(CORRUPT), F.coalesce(F.col(other).cast("string"), F.lit("")))
    return lines.where(broken.isNull()).drop(CORRUPT)


def mark_rejected(lines: DataFrame, required: Sequence[str]) -> DataFrame:
    """`motivo` says why a line cannot be loaded: unreadable, or without a required value. Null for all others."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    reason = F.when(F.col(CORRUPT).isNotNull(), "ilegible").when(
        F.size(F.array_compact(F.array(*missing))) > 0, F.concat(F.lit("falta "), F.array_join(F.array(*missing), ", "))
    )
    return lines.withColumn("motivo", reason)


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can be loaded, and the others with `motivo`."""
    return marked.where("motivo IS NULL").drop("motivo", CORRUPT), marked.where("motivo IS NOT NULL")


def split_rejected(lines: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that can be loaded, and the others with `motivo`; each side reads the lines again."""
    return split_marked(mark_rejected(lines, required))


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """What `read_bronze` leaves out, and rows without a required value."""
    return split_rejected(read_bronze(spark, path, schema, keep_corrupt=True), required)[1]


def days_between(first_day: date | str, last_day: date | str) -> list[str]:
    first, last = (date.fromisoformat(str(d)) for d in (first_day, last_day))
    return [str(first + timedelta(days=i)) for i in range((last - first).days + 1)]


def hour_paths(root: str, days: Sequence[str], hours: Sequence[int]) -> str:
    """Path pattern of some hours of some days; an hour may be written 8 or 08."""
    names = sorted({form for h in hours for form in (str(int(h)), f"{int(h):02d}")})
    return f"{root}/fecha={{{','.join(days)}}}/hora={{{','.join(names)}}}"


def read_bronze_hours(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    days: Sequence[str],
    hours: Sequence[int],
    keep_corrupt: bool = False,
) -> DataFrame:
    """Some hours of some days; only their folders are listed and read.

    Hours that have not arrived are skipped with a warning.
    """
    paths = hour_paths(root, days, hours)
    typed = with_hour_partitions(with_corrupt(schema) if keep_corrupt else schema)
    if not path_exists(spark, paths):
        print(f"no input at {paths}")
        return spark.createDataFrame([], typed)
    if keep_corrupt:
        return _reader(spark, typed).option("basePath", root).json(paths)
    lines = _reader(spark, with_hour_partitions(with_corrupt(schema))).option("basePath", root).json(paths)
    return readable(lines)


def read_named_hours(
    spark: SparkSession, root: str, schema: T.StructType, hours: Collection[tuple[str, int]]
) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Lines of exactly the named (day, hour) pairs, broken ones kept, and the pairs that have arrived.

    Folders are looked up with one pattern and read by their paths in one pass. Hours that have not arrived are skipped
    with a warning.
    """
    named = {(str(d), int(h)) for d, h in hours}
    typed = with_hour_partitions(with_corrupt(schema))
    pattern = hour_paths(root, sorted({d for d, _ in named}), sorted({h for _, h in named})) if named else root
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = (target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target) or []) if named else []
    paths: dict[str, tuple[str, int]] = {}
    for f in found:
        day, hour = (x.split("=", 1)[1] for x in str(f.getPath()).split("/")[-2:])
        if (day, int(hour)) in named:
            paths[str(f.getPath())] = (day, int(hour))
    if missing := len(named) - len(set(paths.values())):
        print(f"no input for {missing} of {len(named)} hours at {root}")
    if not paths:
        return spark.createDataFrame([], typed), []
    return _reader(spark, typed).option("basePath", root).json(sorted(paths)), sorted(set(paths.values()))


def previous_hour(as_of: datetime | str) -> tuple[str, int]:
    """Day and hour before the one of a run; just after midnight it is 23 of the day before."""
    moment = datetime.fromisoformat(str(as_of)) - timedelta(hours=1)
    return str(moment.date()), moment.hour


def read_bronze_hour(spark: SparkSession, root: str, schema: T.StructType, day: date | str, hour: int) -> DataFrame:
    return read_bronze_hours(spark, root, schema, [str(day)], [hour])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that matches a path pattern, exists."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.globStatus(target))


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """None, with a warning, when the input of this run has not arrived."""
    if path_exists(spark, path):
        return read_bronze(spark, path, schema)
    print(f"no input at {path}")
    return None


def write_bronze(
    df: DataFrame, root: str, partition_cols: Sequence[str] = ("fecha", "hora"), mode: str = "overwrite"
) -> None:
    """JSON lines, one folder per partition value.

    Rebalancing gives each folder few files while splitting a crowded one over
    several tasks. Overwriting replaces only the folders that get data.
    """
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.json(root)
