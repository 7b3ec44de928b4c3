import json

from pyspark.sql import functions as F

from contract.gold import TEST_KEYS
from silvertide import schemas
from silvertide.plans import adapters as A
from silvertide.plans.deidentify import deidentify_transactions
from silvertide.sources import bronze, tables, versions
from silvertide.streaming import silver as ST


def _drop(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def _txn(i, time, region="R1", amount=10.0):
    return {"id_transaccion": i, "region": region, "monto_clp": amount, "fecha_hora": time, "score_anomalia": 0.9}


def test_stream_equals_batch_and_runs_once(spark, layers, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    bronze.write_bronze(A.with_hour(layers.single_transactions), source)
    run = lambda: ST.stream_silver(spark, source, sink, checkpoint, A.CLIENTS_AS_OF, TEST_KEYS)
    run()
    run()
    want = deidentify_transactions(layers.single_transactions, A.CLIENTS_AS_OF, TEST_KEYS)
    got = versions.read(spark, sink)
    assert got.count() == 1000 and got.drop("fecha", "hora").exceptAll(want).count() == 0
    tables.load_hours(spark, source, sink, bronze.days_between("2024-01-01", "2024-01-31"), range(24), A.CLIENTS_AS_OF, TEST_KEYS)
    assert versions.read(spark, sink).count() == 1000  # batch and stream replace the same partitions


def test_late_files_and_broken_lines(spark, tmp_path):
    source, sink, rejected, checkpoint = (str(tmp_path / n) for n in ("in", "out", "bad", "cp"))
    run = lambda: ST.stream_silver(spark, source, sink, checkpoint, "2026-03-26", TEST_KEYS, rejected, max_files=1)
    hour = tmp_path / "in" / "fecha=2026-03-25" / "hora=10"
    _drop(hour, "1.json", [_txn("a", "2026-03-25T10:10:00Z"), "{broken", {"region": "R1"}])
    run()
    assert [r.id_transaccion for r in versions.read(spark, sink).collect()] == ["a"]
    bad = {(r.motivo, r._corrupt_record, r.hora) for r in versions.read(spark, rejected).collect()}
    assert bad == {("ilegible", "{broken", 10), ("falta id_transaccion", None, 10)}
    _drop(hour, "2.json", [_txn("b", "2026-03-25T09:00:00Z")])
    _drop(tmp_path / "in" / "fecha=2026-03-24" / "hora=23", "3.json", [_txn("c", "2026-03-24T23:30:00Z")])
    run()
    assert sorted(r.id_transaccion for r in versions.read(spark, sink).collect()) == ["a", "b", "c"]
    lost = bronze.rejected_lines(spark, str(hour), schemas.BRONZE_TRANSACTIONS, ["id_transaccion"])
    assert lost.count() == 2 and bronze.read_bronze(spark, str(hour), schemas.BRONZE_TRANSACTIONS).count() == 3


def test_dedupe_keeps_late_ids_and_hot_keys(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        ST.stream_dedupe(ST.stream_bronze(spark, str(source), max_files=2), sink, checkpoint, ["id_transaccion"])

    for part in range(5):
        rows = [_txn("hot", "2026-03-25T10:00:00Z")] * 200 + [_txn(f"k{part}-{i}", "2026-03-25T10:05:00Z") for i in range(50)]
        _drop(source, f"{part}.json", rows)
    run()
    _drop(source, "6.json", [_txn("late", "2026-03-20T10:00:00Z"), _txn("hot", "2026-03-25T10:00:00Z"), _txn("new", "2026-03-25T16:00:00Z"), "{"])
    run()
    run()
    got = [r.id_transaccion for r in spark.read.parquet(sink).collect()]
    assert len(got) == len(set(got)) == 253 and {"late", "new", "hot"} <= set(got)


def test_repeated_batches_add_nothing(spark, tmp_path):
    """A batch whose progress was not noted runs again: same rows, same sums."""
    source = tmp_path / "in"
    _drop(source, "1.json", [_txn("a", "2026-03-25T10:10:00Z"), _txn("b", "2026-03-25T10:50:00Z", amount=30.0)])
    for turn in ("1", "2"):
        ST.stream_dedupe(ST.stream_bronze(spark, str(source)), str(tmp_path / "out"), str(tmp_path / f"cp{turn}"), ["id_transaccion"])
        ST.stream_alerts(ST.stream_bronze(spark, str(source)), str(tmp_path / "sums"), str(tmp_path / f"cps{turn}"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert [r.total_alertas for r in ST.alert_windows(spark, str(tmp_path / "sums")).collect()] == [2]


def test_open_windows_and_late_rows_count(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: ST.stream_alerts(ST.stream_bronze(spark, str(source)), sink, checkpoint)
    _drop(source, "1.json", [_txn("a", "2026-03-25T10:10:00Z"), _txn("b", "2026-03-25T10:50:00Z", amount=30.0)])
    run()
    _drop(source, "2.json", [_txn("c", "2026-03-25T10:20:00Z"), _txn("d", "2026-03-25T15:30:00Z", region=None)])
    run()
    _drop(source, "3.json", [_txn("late", "2026-03-25T10:30:00Z", amount=2.0)])
    run()
    rows = {str(r["desde"]): r for r in ST.alert_windows(spark, sink).orderBy("desde").collect()}
    assert rows["2026-03-25 10:00:00"]["total_alertas"] == 4 and float(rows["2026-03-25 10:00:00"]["monto_total_alertado"]) == 52.0
    assert rows["2026-03-25 15:00:00"]["region"] is None and ST.alert_windows(spark, sink).where(F.col("region").isNull()).count() == 1


def test_dedupe_state_is_bounded_and_the_sink_is_never_read(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        return ST.stream_dedupe(ST.stream_bronze(spark, str(source)), sink, checkpoint, ["id_transaccion"], delay="1 day", salts=2)

    states = []
    for day in range(10, 16):
        rows = [_txn(f"{day}-{i}", f"2026-03-{day}T10:00:00Z") for i in range(30)] + [_txn(f"{day - 1}-3", f"2026-03-{day - 1}T20:00:00Z")]
        _drop(source, f"{day}.json", rows)
        states.append(run().most_state_rows)
    _drop(source, "late.json", [_txn("10-1", "2026-03-10T10:00:00Z"), _txn("behind", "2026-03-12T00:00:00Z")])
    last = run()
    assert last.late == 2
    got = [r.id_transaccion for r in spark.read.parquet(sink).collect()]
    assert len(got) == len(set(got)) == 181  # the first day's repetition of a day before it is new
    assert max(states[3:]) <= 2 * 3 * 31 and states[-1] <= states[3] + 4
    # Deleted files of the sink do not come back: nothing but state decides.
    _drop(source, "again.json", [_txn("15-5", "2026-03-15T11:00:00Z")])
    for f in (tmp_path / "out").glob("*.parquet"):
        f.write_bytes(b"")
    assert run().late == 0


def test_windows_are_final_and_equal_the_batch(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: ST.stream_alert_windows(ST.stream_bronze(spark, str(source)), sink, checkpoint)
    seen = lambda: {(str(r.desde), r.region): (r.total_alertas, float(r.monto_total_alertado), r.monto_maximo) for r in spark.read.parquet(sink).collect()}
    _drop(source, "1.json", [_txn("a", "2026-03-25T10:10:00Z"), _txn("b", "2026-03-25T10:50:00Z", amount=30.0), _txn("c", "2026-03-25T11:05:00Z", region=None)])
    assert run().late == 0 and seen() == {}  # nothing is closed yet
    # Two hours behind at most: counts. The window of 10 closes with the row of 13:30.
    _drop(source, "2.json", [_txn("d", "2026-03-25T10:20:00Z"), _txn("e", "2026-03-25T13:30:00Z")])
    assert run().late == 0
    assert seen() == {("2026-03-25 10:00:00", "R1"): (3, 50.0, 30.0)}
    _drop(source, "3.json", [_txn("late", "2026-03-25T10:30:00Z"), _txn("in time", "2026-03-25T11:40:00Z", region=None), {"id_transaccion": "timeless"}])
    assert run().late == 1
    _drop(source, "4.json", [_txn("f", "2026-03-25T20:00:00Z")])
    run()
    want = {("2026-03-25 10:00:00", "R1"): (3, 50.0, 30.0), ("2026-03-25 11:00:00", None): (2, 20.0, 10.0), ("2026-03-25 13:00:00", "R1"): (1, 10.0, 10.0)}
    assert seen() == want
    assert run().rows == 0 and seen() == want  # a restart adds nothing


def test_windows_do_not_depend_on_the_batches(spark, layers, tmp_path):
    bronze.write_bronze(layers.single_transactions.orderBy("fecha_hora"), str(tmp_path / "in"), ())
    results = []
    for n, files in enumerate((None, 1)):
        sink, rows = str(tmp_path / f"out{n}"), ST.stream_bronze(spark, str(tmp_path / "in"), files)
        run = ST.stream_alert_windows(rows, sink, str(tmp_path / f"cp{n}"), delay="60 days" if n else "1 hour")
        results.append((run, spark.read.parquet(sink) if run.most_state_rows and list((tmp_path / f"out{n}").glob("*.parquet")) else None))
    whole = layers.single_transactions.groupBy(F.date_trunc("hour", F.col("fecha_hora").cast("timestamp")).alias("desde"), "region").count()
    closed = results[0][1]
    assert results[0][0].late == 0 and closed.count() > 0
    assert closed.join(whole.withColumnRenamed("count", "n"), (closed.desde == whole.desde) & closed.region.eqNullSafe(whole.region)).where("n != total_alertas").count() == 0
