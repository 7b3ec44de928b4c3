import hashlib
import re

from pyspark.sql import functions as F

from silvertide.functions import masking as M


def test_email(one):
    got = one(["ab@xyz", "juan@mail.bank.cl", "@x.cl", "noat", "", None, "a@b@c.cl", "x@y."], M.mask_email)
    assert got == [
        "a*@***.***", "j***@****.cl", "*@*.cl", "***@***.***", "***@***.***", "***@***.***", "*@***.cl", "*@*.",
    ]


def test_phone(one):
    got = one(["+56912345678", "1234", "", None, "(22) 345-6789"], M.mask_phone)
    assert got == ["+569****5678", "****", "", "", "+569**6789"]


def test_name(one):
    got = one(["Juan Perez", "  A  Bo ", "", None, " \t ", "Ñuño Á"], M.mask_name)
    assert got == ["J*** P****", "A B*", "", "", "", "Ñ*** Á"]


def test_mask_middle(one):
    assert one(["123456789", "1234", "", None], lambda c: M.mask_middle(c, "#", 2, 3)) == ["12####789", "####", "", ""]
    assert one(["abc"], M.mask_middle) == ["***"]
    assert one(["abc"], lambda c: M.mask_middle(c, keep_start=1)) == ["a**"]


def test_pseudonym_is_stable_and_salted(one):
    a, b, blank, null = one(["1-9", "1-9", "", None], lambda c: M.pseudonymize(c, "s"))
    assert a == b == hashlib.sha256(b"s:1-9").hexdigest()[:16]
    assert blank == null == ""
    assert one(["1-9"], lambda c: M.pseudonymize(c, "t")) != [a]


def _token(raw, key):
    digits = re.sub(r"\D", "", raw)
    stream = re.sub(r"\D", "", hashlib.sha256(f"fpe:{raw}:{key}".encode()).hexdigest()) * 16
    return (digits[:4] + stream[: max(0, len(digits) - 4)])[:16]


def test_number_token(one):
    raws = ["abc", "12", "4532123456789012", "4532 1234 5678 9012", "12345", "1" * 40, "", None]
    got = one(raws, lambda c: M.tokenize_number(c, "k"))
    assert got == ["abc", "12", *[_token(r, "k") for r in raws[2:6]], "", ""]
    assert got[2] != got[3]  # the written form is part of the key
    assert len(got[5]) == 16
    assert one(["abc"], lambda c: M.tokenize_number(c, "k", passthrough=False)) == [None]


def test_redaction_order_and_boundaries(one):
    texts = [
        "RUT 12.456.789-K y 12345678-5",
        "fono +56 9 1234 5678",
        "a juan.perez@mail.bank.cl hoy",
        "tarjeta 4532 1234-5678 9012.",
        "é12345678-5",
        "ref 14532123456789012",
        "x56912345678y",
        None,
        "nada",
    ]
    assert one(texts, M.redact_text) == [
        "RUT [CHILE_RUT] y [CHILE_RUT]",
        "fono [PHONE_NUMBER]",
        "a [EMAIL_ADDRESS] hoy",
        "tarjeta [CREDIT_CARD_NUMBER].",
        "é12345678-5",
        "ref 14532123456789012",
        "x[PHONE_NUMBER]y",
        "",
        "nada",
    ]


def test_redaction_of_a_long_text_reaches_its_end(spark):
    text = "lorem ipsum " * 50_000 + "juan@mail.cl"
    out = spark.createDataFrame([(text,)], "t string").select(M.redact_text("t")).first()[0]
    assert out.endswith("[EMAIL_ADDRESS]") and len(out) == 12 * 50_000 + 15


def test_expressions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("a@b.cl",)], "v string")
    plan = df.select(M.mask_email("v"), M.redact_text("v"), M.tokenize_number("v", "k"), M.mask_name("v"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.select(F.lit(1)).count() == 1
