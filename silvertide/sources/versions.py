"""Tables of versions: data folders that never change, and manifests of which the last is the table.

    <table>/data/silvertide_snapshot=<id>/[partition folders/]part files
    <table>/_versions/<number>.json

A write goes to a folder of its own. It becomes visible when its manifest, which lists the folders of the whole table,
gets the next number by a rename that never replaces a file. Until then readers see the last version, afterwards the new
one; a writer that fails leaves only a folder that nothing lists. A writer that finds its number taken lists its folders
again on top of the other's version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SNAPSHOT = "silvertide_snapshot"
ATTEMPTS = 20


@dataclass(frozen=True)
class Manifest:
    """One version of a table; folders are relative to its data folder, either whole snapshots or partitions of them."""

    version: int
    schema: str
    partition_by: tuple[str, ...]
    folders: tuple[str, ...]
    written: str
    properties: dict[str, str] = field(default_factory=dict)


class Files:
    """The few file operations that the driver needs, in whatever file system the path belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def matches(self, pattern: str) -> list:
        """File states that match a pattern, hidden files left out."""
        found = self.fs.globStatus(self.path(pattern)) or []
        return [f for f in found if f.getPath().getName()[0] not in "._"]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_new(self, source: str, target: str) -> bool:
        """Rename unless the target exists; False when it does."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.makeQualified(self.path(source)).toUri(), self.conf)
        no_options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(self.path(source)), self.fs.makeQualified(self.path(target)), no_options)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/_versions/{version:010d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    found = Files(spark, path).matches(f"{path}/_versions/*.json")
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """A version of a table, the last one by default; None where there is no table."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    raw = json.loads(Files(spark, path).read(_manifest_path(path, version)))
    return Manifest(**raw | {"partition_by": tuple(raw["partition_by"]), "folders": tuple(raw["folders"])})


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version. The frame goes on reading that version when a later one is published."""
    found = manifest(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType.fromJson(json.loads(found.schema))
    if not found.folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path}/data")
    return reader.parquet(*[f"{path}/data/{f}" for f in found.folders]).select(*schema.fieldNames())


def _write(df: DataFrame, path: str, partition_by: Sequence[str], options: Mapping[str, str] | None) -> str:
    if SNAPSHOT in df.columns:
        raise ValueError(f"{SNAPSHOT} is the name of a folder")
    snapshot = f"{SNAPSHOT}=v{uuid.uuid4().hex[:16]}"
    writer = df.write.options(**options or {})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/data/{snapshot}")
    return snapshot


def _partitions(files: Files, path: str, snapshot: str, depth: int) -> list[str]:
    """Partition folders of a snapshot, relative to it."""
    found = files.matches(f"{path}/data/{snapshot}" + "/*=*" * depth)
    return sorted("/".join(str(f.getPath()).split("/")[-depth:]) for f in found)


def _publish(spark: SparkSession, path: str, draft) -> Manifest:
    """Gives draft(last version) the next number. Tried again when another writer was first."""
    files = Files(spark, path)
    for _ in range(ATTEMPTS):
        last = manifest(spark, path)
        new = draft(last)
        temporary = f"{path}/_versions/.{uuid.uuid4().hex}"
        files.write(temporary, json.dumps(asdict(new)))
        if files.rename_new(temporary, _manifest_path(path, new.version)):
            return new
        files.delete(temporary)
    raise RuntimeError(f"other writers publish {path} all the time")


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> Manifest:
    """Create the table, or replace it with all its columns; df may read the last version."""
    snapshot = _write(df, path, partition_by, options)
    return _publish(df.sparkSession, path, lambda last: Manifest(
        last.version + 1 if last else 1, df.schema.json(), tuple(partition_by), (snapshot,), _now(), dict(properties or {})
    ))


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Manifest:
    """Add rows; the columns stay those of the table."""
    snapshot = _write(df, path, partition_by, None)

    def draft(last: Manifest | None) -> Manifest:
        kept = last.folders if last else ()
        schema = last.schema if last else df.schema.json()
        return Manifest(last.version + 1 if last else 1, schema, tuple(partition_by), (*kept, snapshot), _now(), dict(last.properties) if last else {})

    return _publish(df.sparkSession, path, draft)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], scope: Collection[Sequence[object]] | None = None,
    add_others: bool = False, based_on: int | None = None, properties: Mapping[str, str] | None = None,
) -> Manifest:
    """Replace the named partitions by the rows of df, all of them at once.

    scope: values of the partition columns. A named partition without rows in df is empty afterwards; rows outside of the
    scope are an error, and nothing changes, or with add_others they are added to their partitions. Without a scope the
    partitions that df has are replaced. based_on is the version that df was made from (0: no table); when another writer
    has published since, it is an error, and nothing changes.
    """
    spark, files, depth = df.sparkSession, Files(df.sparkSession, path), len(partition_by)
    snapshot = _write(df, path, partition_by, None)
    new = _partitions(files, path, snapshot, depth)
    named = set(new) if scope is None else {"/".join(f"{c}={v}" for c, v in zip(partition_by, values, strict=True)) for values in scope}
    if not add_others and (stray := sorted(set(new) - named)):
        files.delete(f"{path}/data/{snapshot}")
        raise ValueError(f"rows outside of the named partitions: {stray[:3]}")

    def draft(last: Manifest | None) -> Manifest:
        if based_on is not None and based_on != (last.version if last else 0):
            raise RuntimeError(f"another writer has changed {path} since version {based_on}")
        kept = []
        for folder in last.folders if last else ():
            if "/" in folder:
                kept += [folder] if folder.split("/", 1)[1] not in named else []
                continue
            own = _partitions(files, path, folder, depth)
            left = [f"{folder}/{p}" for p in own if p not in named]
            kept += [folder] if len(left) == len(own) else left
        schema = last.schema if last else df.schema.json()
        known = (dict(last.properties) if last else {}) | dict(properties or {})
        return Manifest(last.version + 1 if last else 1, schema, tuple(partition_by), (*kept, *([snapshot] if new else [])), _now(), known)

    return _publish(spark, path, draft)


def set_properties(spark: SparkSession, path: str, properties: Mapping[str, str]) -> Manifest:
    """A version that differs in its properties alone."""

    def draft(last: Manifest | None) -> Manifest:
        if last is None:
            raise FileNotFoundError(f"no table at {path}")
        return Manifest(**asdict(last) | {"version": last.version + 1, "written": _now(), "properties": last.properties | dict(properties)})

    return _publish(spark, path, draft)


def expire(spark: SparkSession, path: str, before: datetime) -> list[int]:
    """Delete the versions replaced before an instant, and data folders older than it that no version lists; the last version stays."""
    files, known = Files(spark, path), versions(spark, path)
    found = {v: manifest(spark, path, v) for v in known}
    instant = before if before.tzinfo else before.replace(tzinfo=timezone.utc)
    gone = [v for v, after in zip(known, known[1:], strict=False) if datetime.fromisoformat(found[after].written) < instant]
    for v in gone:
        files.delete(_manifest_path(path, v))
    listed = {f.split("/")[0] for v, m in found.items() if v not in gone for f in m.folders}
    for f in files.matches(f"{path}/data/{SNAPSHOT}=*"):
        if f.getPath().getName() not in listed and f.getModificationTime() < instant.timestamp() * 1000:
            files.delete(str(f.getPath()))
    return gone


def publish_set(spark: SparkSession, root: str, tables: Mapping[str, int]) -> Manifest:
    """Make versions of several tables below root current together."""
    return _publish(spark, root, lambda last: Manifest(
        last.version + 1 if last else 1, "", (), (), _now(), {name: str(v) for name, v in tables.items()}
    ))


def read_set(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a set, each in the version that was current together with the others."""
    found = manifest(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"no tables at {root}")
    return {name: read(spark, f"{root}/{name}", int(v)) for name, v in found.properties.items()}
