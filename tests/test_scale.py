"""Plans and skew: what must hold whatever the size of the data."""

import pytest
from pyspark.sql import functions as F

from contract.queries import all_queries
from silvertide.plans import marts
from silvertide.session import prepare, scratch_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    saved = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_client_is_split_in_the_join(spark, layers, conf):
    """Half of the transactions belong to one client; both sides are shuffled."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20k",
    )
    copies = 12
    stg = (
        layers.stg_transactions.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .withColumn("id_transaccion", F.concat("id_transaccion", F.lit("-"), F.col("n")))
        .drop("n")
        .withColumn("id_cliente", F.when(F.xxhash64("id_transaccion") % 2 == 0, "C0000001").otherwise(F.col("id_cliente")))
        .repartition(12)
    )
    dim = layers.dim.withColumns({"arcop_estado": F.lit("ACTIVO"), "arcop_cancelacion_solicitado": F.lit(False)})
    fact = marts.build_fact_transactions(stg, dim, "2026-01-01")
    ids = [r["id_transaccion"] for r in fact.collect()]
    assert len(ids) == len(set(ids)) == 1000 * copies
    final = plan_of(fact).split("== Initial Plan ==")[0]
    assert "HashJoin(skew=true)" in final or "MergeJoin(skew=true)" in final


def test_no_join_side_is_forced(layers):
    """Spark and adaptive execution choose: the plans of the marts carry no hint."""
    for df in (layers.fact, layers.fact_requests):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_flagship_plan(layers):
    df = marts.daily_alert_summary(marts.build_anomaly_mart(layers.fact))
    plan = plan_of(df)
    assert plan.count("WindowGroupLimit") == 2  # one row per key leaves each map task
    assert plan.count("Exchange hashpartitioning") == 2  # de-duplication and the final groups
    assert "partial_count" in plan
    scans = [line for line in plan.splitlines() if "customer.parquet" in line]
    assert scans and all("c_name" not in line for line in scans)


LAZY = (
    "fact_transactions", "fact_requests", "mart_anomalies", "quality_mart", "compliance_mart", "scd2_merge",
    "snapshot_changes", "pii_by_field", "redact_documents", "silver_clients", "silver_transactions", "dq_suite",
    "score_normalize", "latest_per_key", "region_commune", "rut_check",
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_single_task_window(spark, sf_dir, name):
    plan = plan_of(all_queries()[name](spark, sf_dir))
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    lines = plan.splitlines()
    for above, below in zip(lines, lines[1:]):
        assert not ("Sort [" in above and "Exchange SinglePartition" in below)


def test_partition_filter_reaches_the_scan(spark, layers, tmp_path):
    from silvertide.plans.staging import date_range
    from silvertide.sources.tables import publish_gold

    gold = publish_gold(layers.fact, str(tmp_path / "fact"), ["fecha"], ["canal"])
    plan = plan_of(date_range(gold, "fecha", "2024-01-05", "2024-01-06").where("canal = 'WEB'").select("monto_clp"))
    assert "PartitionFilters: [isnotnull(fecha" in plan and "EqualTo(canal,WEB)" in plan
    assert "ReadSchema: struct<monto_clp:double,canal:string>" in plan


class _Cluster:
    """The two settings `scratch_path` reads from a session."""

    def __init__(self, master, folder):
        self.master, self.folder = master, folder
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_scratch_is_in_the_shared_folder():
    cluster = _Cluster("yarn", "hdfs://shared/tmp/")
    a, b = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert a.startswith("hdfs://shared/tmp/x-") and a != b
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_Cluster("yarn", None), "x")


def test_prepare_sets_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    assert prepare(spark).conf.get("spark.sql.session.timeZone") == "UTC"
