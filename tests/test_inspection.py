import re

import pytest
from pyspark.sql import functions as F

from silvertide.functions import patterns as P
from silvertide.operators import inspection as I
from silvertide.operators import quality as Q


def _scan(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, descripcion string")
    return I.scan_pii(df, "id", **options)


def test_hotword_within_ten_characters(spark):
    texts = [
        "RUT 12.345.678-5",
        "rut del cliente es 12.345.678-5",  # 16 characters away
        "Cédula: 12345678-5",
        "1234567-4 7654321-6 rut 7654321-6",
        "sin nada",
    ]
    found = _scan(spark, texts, detectors=[I.DETECTORS[0]]).orderBy("id", "ocurrencia").collect()
    assert [(r["id"], r["muestra"], r["likelihood"], r["ocurrencia"]) for r in found] == [
        ("0", "12.345.678-5", "VERY_LIKELY", 1),
        ("1", "12.345.678-5", "LIKELY", 1),
        ("2", "12345678-5", "VERY_LIKELY", 1),
        ("3", "1234567-4", "LIKELY", 1),
        ("3", "7654321-6", "LIKELY", 2),
        ("3", "7654321-6", "VERY_LIKELY", 3),
    ]


def test_findings_match_brute_force(spark, layers):
    """Every cell of every client, detector by detector, against a plain loop."""
    rows = [r.asDict() for r in layers.clients.collect()]
    ascii_forms = {
        "CHILE_RUT": r"\b\d{1,2}\.?\d{3}\.?\d{3}-[\dkK]\b",
        "CHILE_PHONE": r"\+?56\s?9\s?\d{4}\s?\d{4}",
        "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
        "PHONE_NUMBER": r"\+\d{8,15}\b",
        "CREDIT_CARD_NUMBER": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    }
    want = set()
    for row in rows:
        for field, value in row.items():
            if field == "id_cliente" or not isinstance(value, str):
                continue
            for kind, pattern in ascii_forms.items():
                for n, match in enumerate(re.finditer(pattern, value), start=1):
                    want.add((row["id_cliente"], field, kind, match.group(), n))
    texts = [f.name for f in layers.clients.schema if f.dataType.simpleString() == "string" and f.name != "id_cliente"]
    found = I.scan_pii(layers.clients, "id_cliente", texts, min_likelihood="VERY_UNLIKELY")
    assert {(r["id"], r["campo"], r["info_type"], r["muestra"], r["ocurrencia"]) for r in found.collect()} == want


def test_card_certainty_and_threshold(spark):
    texts = ["4539148803436467", "4539148803436468"]
    assert [r["likelihood"] for r in _scan(spark, texts).collect()] == ["VERY_LIKELY"]
    every = _scan(spark, texts, min_likelihood="VERY_UNLIKELY")
    assert sorted(r["likelihood"] for r in every.collect()) == ["POSSIBLE", "VERY_LIKELY"]


def test_nulls_and_numbers_are_read_as_text(spark):
    df = spark.createDataFrame([(1, None, 56912345678), (2, "a@b.cl", 0)], "id int, t string, n long")
    found = I.scan_pii(df, "id").collect()
    assert {(r["id"], r["campo"], r["info_type"]) for r in found} == {
        ("1", "n", "CHILE_PHONE"), ("2", "t", "EMAIL_ADDRESS"),
    }


def test_fractions_are_read_in_plain_digits(spark):
    values = [41569050.0, 0.0, -12.5, 0.00056912345678, 1e-5, 1.5e16, 123456789.125, None, 7.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, d double")
    got = [r[1] for r in df.select("i", I.cell_text(df, "d")).orderBy("i").collect()]
    assert got == [
        "41569050.0", "0.0", "-12.5", "0.00056912345678", "1.0E-5", "1.5E16", "123456789.125", None, "7.0",
    ]


def test_alerts_and_classes(spark):
    text = "x" * 5 + "@" + "y" * 80 + ".cl"
    found = _scan(spark, [text, "a@b.cl"])
    alerts = I.pii_alerts(found).collect()
    assert len(alerts) == 2 and max(len(r["muestra"]) for r in alerts) == 50
    kinds = spark.createDataFrame([("rut",), ("region",), ("otra",)], "c string").select(I.classify_field("c"))
    assert [r[0] for r in kinds.collect()] == ["esperado", "INESPERADO", "esperado"]


def _least(values, n):
    from hashlib import md5

    return sorted(values, key=lambda v: (md5(v.encode()).hexdigest(), v))[:n]


@pytest.mark.parametrize("n", [0, 1, 37, 400, 1000])
def test_sample_is_the_least_ids_in_any_layout(spark, n):
    texts = [f"u{i}@mail.cl y v{i}@mail.cl" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, descripcion string")
    for layout in (df, df.repartition(7), df.orderBy(F.col("id").desc())):
        found = I.scan_pii(layout, "id", sample_rows=n).collect()
        assert {r["id"] for r in found} == set(_least([str(i) for i in range(400)], n))
        assert len(found) == 2 * min(n, 400)


def test_sample_with_repeated_and_missing_ids(spark):
    rows = [(1, f"a{i}@mail.cl") for i in range(200)] + [(None, "x@mail.cl")] * 150 + [(2, None)] * 50
    df = spark.createDataFrame(rows, "id int, descripcion string")
    kept = [I.scan_pii(d, "id", sample_rows=100).select("id", "muestra").collect() for d in (df, df.repartition(5))]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
    assert I.scan_pii(df, "id", sample_rows=400).count() == 350
    assert I.scan_pii(df.limit(0), "id", sample_rows=5, max_findings=5).count() == 0


def test_findings_have_a_bound(spark):
    texts = [f"u{i}@mail.cl y v{i}@mail.cl" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, descripcion string")
    places = [f"{i}|descripcion|EMAIL_ADDRESS|{k}" for i in range(300) for k in (1, 2)]
    for layout in (df, df.repartition(7)):
        found = I.scan_pii(layout, "id", max_findings=90).collect()
        assert {f"{r['id']}|{r['campo']}|{r['info_type']}|{r['ocurrencia']}" for r in found} == set(_least(places, 90))
    assert I.scan_pii(df, "id", max_findings=10_000).count() == 600


def test_report_has_as_many_parts_as_its_alerts_need(spark, monkeypatch):
    monkeypatch.setattr(I, "ALERTS_PER_PART", 50)
    found = _scan(spark, [f"u{i}@mail.cl" for i in range(180)], table="t")
    scanned = spark.createDataFrame([("t", 180)], "tabla string, registros_muestra long")
    rows = I.pii_report(found, "2026-03-25 10:00:00", scanned).collect()
    assert len(rows) == 4
    assert sum(len(r["resultado"]["alertas_pii_inesperado"] or []) for r in rows) == 180


def test_report_parts_hold_every_alert(spark):
    texts = [f"u{i}@mail.cl" for i in range(300)]
    found = _scan(spark, texts, table="t")
    scanned = spark.createDataFrame([("t", 300), ("vacia", 7)], "tabla string, registros_muestra long")
    rows = I.pii_report(found, "2026-03-25 10:00:00", scanned, parts=6).collect()
    mine = [r for r in rows if r["resultado"]["tabla"] == "t"]
    assert len(mine) == 6
    quotes = [a["muestra"] for r in mine for a in r["resultado"]["alertas_pii_inesperado"] or []]
    assert sorted(quotes) == sorted(texts)
    assert {r["resultado"]["findings_por_campo"]["descripcion"]["EMAIL_ADDRESS"] for r in mine} == {300}
    assert {(r["resumen"]["total_findings"], r["resumen"]["total_alertas"]) for r in rows} == {(300, 300)}
    assert {r["resultado"]["total_findings"] for r in rows if r["resultado"]["tabla"] == "vacia"} == {0}
    assert {(r["fecha"], r["hora"]) for r in rows} == {("2026-03-25", 10)}


def test_patterns_are_unicode_aware(spark):
    assert P.OPEN in P.RUT
    texts = ["ñ12345678-5", "(12345678-5)", "１２３４５６７８-５"]
    assert [r["id"] for r in _scan(spark, texts, detectors=[I.DETECTORS[0]]).orderBy("id").collect()] == ["1", "2"]


# --- data tests -------------------------------------------------------------


def test_suite_on_good_and_bad_tables(spark, layers):
    good = {
        "clientes_deidentified": layers.silver_clients,
        "transacciones_deidentified": layers.silver_transactions.dropDuplicates(["id_transaccion"]),
        "arcop_solicitudes": layers.silver_requests,
    }
    rows = Q.run_checks(good).collect()
    assert len(rows) == 15 and {r["estado"] for r in rows} == {"OK"}

    bad = layers.silver_clients.withColumns(
        {
            "id_cliente": F.lit("same"),
            "rut_pseudo": F.lit(None).cast("string"),
            "arcop_estado": F.when(F.col("genero") == "M", "OTRO").when(F.col("genero") == "X", "MAS").otherwise("ACTIVO"),
        }
    )
    got = {r["prueba"]: r["fallos"] for r in Q.run_checks({"clientes_deidentified": bad}).collect()}
    assert got == {
        "not_null_clientes_deidentified_id_cliente": 0,
        "unique_clientes_deidentified_id_cliente": 1,
        "not_null_clientes_deidentified_rut_pseudo": 150,
        "not_null_clientes_deidentified_score_crediticio": 0,
        "not_null_clientes_deidentified_arcop_estado": 0,
        "accepted_values_clientes_deidentified_arcop_estado": 2,
    }


def test_suite_scans_each_table_once(spark, layers, tmp_path):
    for name, df in (("c", layers.silver_clients), ("t", layers.silver_transactions), ("r", layers.silver_requests)):
        df.write.parquet(str(tmp_path / name))
    c, t, r = (spark.read.parquet(str(tmp_path / n)) for n in "ctr")
    checked = Q.run_checks({"clientes_deidentified": c, "transacciones_deidentified": t, "arcop_solicitudes": r})
    assert checked._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    rows = Q.run_checks({"clientes_deidentified": c.limit(0)}).collect()
    assert len(rows) == 6 and all(x["fallos"] == 0 for x in rows)


def test_row_level_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("z",)], "c string")
    assert Q.check_not_null(df, "c").count() == 2
    assert Q.check_unique(df, "c").collect() == [("a", 2)]
    assert Q.check_accepted(df, "c", ["a"]).collect() == [("z", 1)]


def test_region_commune(spark):
    rows = [("Maule", "Talca"), ("Maule", "Temuco"), (None, "Talca"), ("Maule", None)]
    df = spark.createDataFrame(rows, "region string, comuna string")
    assert Q.check_region_commune(df, Q.region_communes(spark)).collect() == [("Maule", "Temuco")]


@pytest.mark.parametrize("text,hit", [("RUT x", 1), ("tarjeta", 1), ("a@b", 1), (None, 0), ("nada", 0)])
def test_batch_profile(spark, text, hit):
    df = spark.createDataFrame(
        [(text, True, False, None)], "descripcion string, es_duplicado boolean, es_anomalia_flag boolean, categoria_gasto string"
    )
    row = Q.batch_profile(df).first()
    assert (row["pii_en_descripcion"], row["duplicados"], row["anomalas"], row["con_nulos"]) == (hit, 1, 0, 1)
    assert row["pct_duplicados"] == 100.0
