"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results or the skew handling depend on; all can be set at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # When every partition of a lookup side turns out to fit a task, hash it instead
    # of sorting the large side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "96m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles a method above 8000 bytes, so a wide projection fused
    # into one generated method would be interpreted; beyond that size Spark splits it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stream state on disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings this library relies on to a session made elsewhere: a required step before its other functions.

    They are the same on every master; the README lists what they change.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "silvertide", cores: str = "*", memory: str = "12g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # On one machine small shuffles should still use every core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the call site of every column expression makes planning slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="silvertide-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so re-runs do not collide."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
