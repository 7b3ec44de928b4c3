import pytest
from pyspark.sql import functions as F

from contract.gold import TEST_KEYS
from silvertide import schemas
from silvertide.plans import adapters as A
from silvertide.plans import deidentify as D
from silvertide.plans import governance as G
from silvertide.plans import marts, model, serving, staging
from silvertide.sources import bronze, tables, versions


@pytest.fixture
def hourly(spark, layers, tmp_path):
    root = str(tmp_path / "txn")
    bronze.write_bronze(A.with_hour(layers.single_transactions), root)
    return root


# --- sources and sinks ------------------------------------------------------


def test_corrupt_lines_are_kept(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"id_cliente": "C1", "score_crediticio": 5}\n{broken\n')
    df = bronze.read_bronze(spark, str(path), schemas.BRONZE_CLIENTS, keep_corrupt=True).cache()
    assert df.count() == 2 and df.where(f"{schemas.CORRUPT} IS NOT NULL").count() == 1
    assert bronze.read_bronze(spark, str(path), schemas.BRONZE_CLIENTS).columns == schemas.BRONZE_CLIENTS.fieldNames()


def test_missing_input_is_skipped(spark, tmp_path, capsys):
    assert bronze.read_if_exists(spark, str(tmp_path / "none.json"), schemas.BRONZE_CLIENTS) is None
    assert "no input" in capsys.readouterr().out
    empty = bronze.read_bronze_hour(spark, str(tmp_path), schemas.BRONZE_TRANSACTIONS, "2024-01-01", 3)
    assert empty.count() == 0 and "hora" in empty.columns


def test_hour_reads_only_its_folder(spark, hourly, layers):
    df = bronze.read_bronze_hour(spark, hourly, schemas.BRONZE_TRANSACTIONS, "2024-01-10", 13)
    assert all("fecha=2024-01-10/hora=13" in f for f in df.inputFiles()) and df.count() > 0
    moment = F.date_trunc("hour", F.col("fecha_hora").cast("timestamp"))
    want = layers.single_transactions.where(moment == "2024-01-10 13:00:00")
    assert sorted(r[0] for r in df.select("id_transaccion").collect()) == sorted(
        r[0] for r in want.select("id_transaccion").collect()
    )


def test_zero_padded_hours_are_found(spark, tmp_path):
    folder = tmp_path / "fecha=2026-03-25" / "hora=08"
    folder.mkdir(parents=True)
    (folder / "transacciones.json").write_text('{"id_transaccion": "T1", "monto_clp": 5}\n')
    row = bronze.read_bronze_hour(spark, str(tmp_path), schemas.BRONZE_TRANSACTIONS, "2026-03-25", 8).first()
    assert (row["id_transaccion"], row["hora"], str(row["fecha"])) == ("T1", 8, "2026-03-25")


def test_hours_load_again_in_place(spark, hourly, tmp_path):
    sink = str(tmp_path / "silver")
    run = lambda hours, when: tables.load_hours(
        spark, hourly, sink, bronze.days_between("2024-01-01", "2024-01-30"), hours, when, TEST_KEYS
    )
    run(range(24), "2024-02-01 00:00:00")
    assert versions.read(spark, sink).count() == 1000
    run([8, 9], "2024-02-02 00:00:00")
    stamps = versions.read(spark, sink).groupBy("fecha_deidentify", F.col("hora").isin(8, 9).alias("again")).count().collect()
    assert sum(r["count"] for r in stamps) == 1000
    assert all(r["fecha_deidentify"].startswith("2024-02-02") == r["again"] for r in stamps)
    tables.load_hours(spark, hourly, sink, ["2030-01-01"], [1], "2024-02-02", TEST_KEYS)
    assert versions.read(spark, sink).count() == 1000


def test_previous_hour_of_a_run(spark, hourly, tmp_path):
    assert bronze.previous_hour("2026-03-25 00:05:00") == ("2026-03-24", 23)
    assert bronze.previous_hour("2026-01-01T11:59:00") == ("2026-01-01", 10)
    sink = str(tmp_path / "silver")
    tables.load_previous_hour(spark, hourly, sink, "2024-01-10 14:20:00", TEST_KEYS)
    assert {(str(r.fecha), r.hora) for r in versions.read(spark, sink).select("fecha", "hora").distinct().collect()} == {("2024-01-10", 13)}


def test_backfill_rebuilds_gold(spark, layers, hourly, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    tables.load_clients(layers.clients, f"{silver}/clientes", A.CLIENTS_AS_OF, TEST_KEYS)
    for _ in range(2):
        tables.load_requests(layers.requests, f"{silver}/solicitudes", "2024-02-01")
    assert versions.read(spark, f"{silver}/solicitudes").count() == layers.requests.count()
    run = lambda hours: tables.backfill(spark, hourly, silver, gold, "2024-01-01", "2024-01-30", hours, A.TRANSACTIONS_AS_OF, TEST_KEYS)
    first, second = run(range(12)), run(range(12, 24))
    assert set(first) == set(tables.GOLD_LAYOUT)
    counts = [made["fact_transacciones"].count() for made in (first, second)]
    assert 0 < counts[0] < counts[1] == layers.fact.count()
    assert second["fact_transacciones_ml"].count() == layers.distances.count()
    # Another process finds the last complete set; every table carries its aspects.
    found = tables.current_gold(spark, gold)
    assert set(found) == set(first) and found["fact_transacciones"].count() == counts[1]
    paths = {n: f"{gold}/{n}" for n in G.TABLE_ASPECTS if n in tables.GOLD_LAYOUT} | {t: f"{silver}/{n}" for n, t in tables.SILVER_TABLES.items()}
    assert len(paths) == 9 and tables.published_aspects(spark, paths).where("data_owner IS NULL").count() == 0


def test_load_modes_and_required_key(spark, layers, tmp_path):
    sink = str(tmp_path / "clients")
    load = lambda df, mode: tables.load_silver(df, sink, schemas.SILVER_CLIENTS, mode)
    assert load(layers.silver_clients, "append") and load(layers.silver_clients, "append")
    assert versions.read(spark, sink).count() == 300
    assert load(layers.silver_clients, "truncate") and versions.read(spark, sink).count() == 150
    assert not load(layers.silver_clients.limit(0), "truncate") and versions.read(spark, sink).count() == 150
    with pytest.raises(Exception, match="id_cliente is required"):
        load(layers.silver_clients.withColumn("id_cliente", F.lit(None).cast("string")), "append")
    with pytest.raises(ValueError):
        load(layers.silver_clients, "partition")


def test_crowded_day_is_split_over_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(60_000).select(
            F.date_add(F.lit("2026-01-01").cast("date"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).cast("int")).alias("fecha"),
            F.sha2(F.col("id").cast("string"), 256).alias("canal"),
        ).repartition(8)
        path = str(tmp_path / "gold")
        out = tables.publish_gold(df, path, ["fecha"], ["canal"])
        assert out.count() == 60_000
        files = [f for f in out.inputFiles() if "fecha=2026-01-01" in f]
        assert len(files) > 3
        one = spark.read.parquet(files[0]).select("canal").collect()
        assert one == sorted(one)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_clustered_table_is_sorted_in_shares(spark, tmp_path):
    """Without partitions too, one task does not sort the whole table."""
    path, df = str(tmp_path / "dim"), spark.range(60_000).coalesce(1).selectExpr("md5(cast(id % 50000 AS string)) AS id_cliente", "sha2(cast(id AS string), 512) AS text")
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "512k")
    try:
        out = tables.publish_gold(df, path, [], ["id_cliente"], ["id_cliente"])
        assert len(out.inputFiles()) > 3
        assert out.count() == 60_000 and out.exceptAll(df).isEmpty()
        one = spark.read.parquet(out.inputFiles()[0]).select("id_cliente").collect()
        assert one == sorted(one)
    finally:
        spark.conf.set(setting, before)


def test_clients_are_dealt_out_before_they_are_masked(layers):
    plan = layers.silver_clients._jdf.queryExecution().optimizedPlan().toString()
    scan = plan.index("Relation [c_custkey")
    assert "RepartitionByExpression [c_custkey" in plan[:scan]


def test_views_hold_no_data(spark, layers):
    names = tables.register_views(spark, {"v_clients": layers.stg_clients}, "t_")
    assert names == ["t_v_clients"] and spark.table("t_v_clients").count() == 150


# --- de-identification ------------------------------------------------------


def test_silver_has_no_direct_identifier(layers):
    bronze_rows = {r["id_cliente"]: r for r in layers.clients.collect()}
    for row in layers.silver_clients.collect():
        raw = bronze_rows[row["id_cliente"]]
        text = " ".join(str(v) for v in row if v is not None)
        for field in ("rut", "nombre_completo", "email", "telefono", "num_tarjeta", "num_cuenta"):
            assert raw[field] not in text
    assert layers.silver_clients.columns == schemas.SILVER_CLIENTS.fieldNames()
    assert "comuna" not in layers.silver_transactions.columns


def test_keys_come_from_the_session(spark):
    with pytest.raises(ValueError):
        D.Keys.from_session(spark)
    spark.conf.set("spark.silvertide.salt", "a")
    spark.conf.set("spark.silvertide.tokenKey", "b")
    try:
        assert D.Keys.from_session(spark) == D.Keys("a", "b")
    finally:
        spark.conf.unset("spark.silvertide.salt")
        spark.conf.unset("spark.silvertide.tokenKey")


def test_preview(layers):
    assert D.redaction_preview(layers.silver_transactions).count() == 3


# --- Gold -------------------------------------------------------------------


def test_load_times_compare_as_instants(spark, layers):
    # 23:30-04:00 is later than 23:45-03:00, although its text sorts first.
    stg = layers.stg_transactions.where("id_transaccion = 'T000000001'").drop("fecha_deidentify")
    both = stg.withColumn("fecha_deidentify", F.lit("2026-04-04T23:30:00-04:00")).withColumn("monto_clp", F.lit(1.0)).union(
        stg.withColumn("fecha_deidentify", F.lit("2026-04-04T23:45:00-03:00")).withColumn("monto_clp", F.lit(2.0)).select(
            *stg.drop("monto_clp", "fecha_deidentify").columns, "fecha_deidentify", "monto_clp"
        ).select(*stg.columns, "fecha_deidentify")
    )
    fact = marts.build_fact_transactions(both, layers.dim, "2026-05-01")
    assert [r["monto_clp"] for r in fact.collect()] == [1.0]


def test_unknown_and_cancelled_clients_lose_their_transactions(layers):
    lost = layers.dim.where("arcop_estado = 'ELIMINADO' OR arcop_cancelacion_solicitado")
    assert lost.count() > 0
    assert layers.fact.join(lost, "id_cliente", "left_semi").count() == 0
    assert layers.fact.groupBy("id_transaccion").count().where("count > 1").count() == 0


def test_requests_without_a_client_stay(spark, layers):
    fact = marts.build_fact_requests(layers.stg_requests, layers.dim.limit(0), "2026-01-01")
    assert fact.count() == layers.stg_requests.count() and fact.where("rut_pseudo IS NOT NULL").count() == 0


def test_no_completed_request_is_red(layers):
    row = marts.compliance_mart(layers.fact_requests.where("estado = 'PENDIENTE' AND NOT flag_vencida"), "2026-01-01").first()
    assert row["pct_cumplimiento"] is None and row["semaforo_cumplimiento"] == "ROJO"


def test_compliance_of_nothing(layers):
    row = marts.compliance_mart(layers.fact_requests.limit(0), "2026-01-01").first()
    assert row["total_solicitudes"] == 0 and row["pct_vencidas"] is None


def test_quality_mart_pads_with_null(layers):
    rows = {r["tabla"]: r for r in marts.quality_mart(layers.stg_clients, layers.stg_transactions, "2024-01-28").collect()}
    assert rows["clientes_deidentified"]["alertas_uaf"] is None
    assert rows["transacciones_deidentified"]["errores_email"] is None


# --- reporting --------------------------------------------------------------


def test_missing_client_id_is_an_error(layers):
    for text in ("", "  ", None):
        with pytest.raises(ValueError):
            serving.client_detail(layers.dim, text)
    assert serving.client_detail(layers.dim, "x' OR '1'='1").count() == 0


def test_kpis_of_an_empty_period(layers):
    ml = layers.distances.withColumn("clasificacion_ml", F.lit("NORMAL"))
    assert serving.kpis(layers.dim, ml, start="2030-01-01").first() == (150, 0, 0, 0)
    assert serving.kpis(layers.dim, ml).first()["transacciones"] == layers.distances.count()


# --- governance -------------------------------------------------------------


@pytest.mark.parametrize(
    "grants,hidden",
    [
        ((), {"rut_pseudo", "score_crediticio", "num_tarjeta_fpe", "num_cuenta_fpe", "rango_saldo", "rango_renta"}),
        (("INTERNAL",), {"rut_pseudo", "score_crediticio"}),
        (("INTERNAL", "CONFIDENTIAL"), set()),
    ],
)
def test_column_policy(layers, grants, hidden):
    seen = G.apply_column_policy(layers.dim, "dim_cliente", grants)
    assert seen.dtypes == layers.dim.dtypes
    row = seen.first()
    assert {c for c in G.COLUMN_TAGS["dim_cliente"] if row[c] is None} == hidden


USES = {
    "select": lambda d: d.select("rut_pseudo"),
    "star": lambda d: d.select("*"),
    "filter": lambda d: d.where("rut_pseudo > 'a'").select("id_cliente"),
    "join key": lambda d: d.join(d.sparkSession.table("g_other"), "rut_pseudo").select("id_cliente"),
    "group": lambda d: d.groupBy("rut_pseudo").count().select("count"),
    "order": lambda d: d.orderBy("rut_pseudo").select("id_cliente").limit(3),
    "alias": lambda d: d.withColumnRenamed("rut_pseudo", "x").select(F.col("x").alias("y")),
    "expression": lambda d: d.select(F.coalesce(F.lit(None), F.concat(F.lit("a"), F.substring("rut_pseudo", 1, 2))).alias("z")),
    "aggregate": lambda d: d.agg(F.max("rut_pseudo")),
    "subquery": lambda d: d.sparkSession.sql("SELECT 1 AS a WHERE EXISTS (SELECT 1 FROM g_dim WHERE rut_pseudo LIKE 'x%')"),
    "window": lambda d: d.selectExpr("id_cliente", "rank() OVER (ORDER BY rut_pseudo) AS r"),
}


@pytest.mark.parametrize("use", USES)
def test_a_guarded_column_refuses_its_uses(spark, layers, use):
    layers.dim.select("rut_pseudo").createOrReplaceTempView("g_other")
    for grants, refused in (((G.INTERNAL,), True), ((G.INTERNAL, G.CONFIDENTIAL), False)):
        guarded = G.guard_columns(layers.dim, "dim_cliente", grants)
        guarded.createOrReplaceTempView("g_dim")
        query = USES[use](guarded)
        assert guarded.dtypes == layers.dim.dtypes
        if refused:
            assert "dim_cliente.rut_pseudo" in G.denied_columns(query)
            with pytest.raises(PermissionError, match="dim_cliente.rut_pseudo"):
                G.authorize(query)
            with pytest.raises(Exception, match="access denied"):
                query.collect()
        else:
            assert G.authorize(query) is query


def test_other_uses_of_a_guarded_table_run(spark, layers):
    guarded = G.guard_columns(layers.dim, "dim_cliente", [G.INTERNAL])
    total = layers.dim.count()
    assert guarded.count() == total
    for query in (
        guarded.select("id_cliente", "rango_saldo"), guarded.drop("rut_pseudo", "score_crediticio"),
        guarded.withColumn("x", F.upper("rut_pseudo")).select("id_cliente", "region"),
        guarded.groupBy("region").count(), guarded.join(layers.dim.select("id_cliente"), "id_cliente").select("id_cliente"),
    ):
        assert G.authorize(query).count() > 0
    assert G.denied_columns(G.guard_columns(layers.dim, "dim_cliente")) == sorted(f"dim_cliente.{c}" for c in G.COLUMN_TAGS["dim_cliente"])
    local = G.guard_columns(spark.createDataFrame([("a", 1)], "rut_pseudo string, x int"), "dim_cliente")
    assert G.denied_columns(local.select("rut_pseudo")) == ["dim_cliente.rut_pseudo"] and G.denied_columns(local.select("x")) == []
    assert G.denied_columns(spark.sql("SELECT id, assert_true(id >= 0) AS ok FROM range(3)")) == []


def test_aspects_round_trip(spark, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS t_aspects (x INT) USING parquet LOCATION '{tmp_path}/t'")
    G.set_aspects(spark, "t_aspects", G.Aspects("INTERNAL", False, True, "O'Brien", 3, True))
    assert tuple(G.aspects(spark, ["t_aspects"]).first()) == ("t_aspects", "INTERNAL", False, True, "O'Brien", 3, True)
    spark.sql("DROP TABLE t_aspects")


# --- model ------------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(layers):
    return model.train_anomaly_model(model.training_set(layers.fact))


def test_model_invariants(spark, layers, trained):
    assert len(trained.centroids) == 5
    scored = model.apply_model(layers.fact, trained).cache()
    assert scored.count() == layers.distances.count()
    assert scored.select("cluster_id").distinct().count() == 5
    table = model.ml_table(scored)
    assert table.columns == list(model.ML_COLUMNS)
    rows = table.collect()
    assert max(r["score_ml"] for r in rows) == 1.0 and min(r["score_ml"] for r in rows) >= 0.0
    by_distance = [r for r in rows if r["clasificacion_ml"] == "ANOMALA" and not r["es_anomalia_flag"]]
    assert 0 < len(by_distance) <= 0.05 * len(rows)
    row = model.evaluate(model.assign(model.training_set(layers.fact), trained), trained).first()
    assert 0 < row["davies_bouldin_index"] < 3 and 0 < row["mean_squared_distance"] < 4


def test_assignment_is_the_nearest_centroid(layers, trained):
    points = model.assign(model.training_set(layers.fact), trained).limit(200).collect()
    for p in points:
        x = [(p[f] - m) / d for f, m, d in zip(trained.features, trained.means, trained.deviations)]
        gaps = [sum((a - b) ** 2 for a, b in zip(x, c)) ** 0.5 for c in trained.centroids]
        assert p["distancia_centroide"] == pytest.approx(min(gaps)) and gaps[p["cluster_id"] - 1] == pytest.approx(min(gaps))


def test_model_save_load_and_units(spark, trained, tmp_path):
    trained.save(spark, str(tmp_path / "m"))
    assert model.AnomalyModel.load(spark, str(tmp_path / "m")) == trained
    rows = model.centroids(trained, spark).collect()
    assert len(rows) == 20
    hours = [r["numerical_value"] for r in rows if r["feature"] == "hora"]
    assert 0 <= min(hours) and max(hours) <= 23


def test_too_few_rows(layers):
    with pytest.raises(ValueError, match="rows to train on"):
        model.train_anomaly_model(model.training_set(layers.fact).limit(50), min_rows=100)


def test_objections_are_optional(layers):
    everyone = model.training_set(layers.fact).count()
    assert model.training_set(layers.fact, exclude_objections=True).count() < everyone
    assert model.training_count(layers.fact).first()[0] == everyone


def test_staging_threshold_is_an_argument(layers):
    low = staging.stage_transactions(layers.silver_transactions, A.TRANSACTIONS_AS_OF, threshold=0)
    assert low.where("flag_uaf_threshold").count() > layers.stg_transactions.where("flag_uaf_threshold").count()
