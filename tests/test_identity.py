import random

from pyspark.sql import functions as F

from quipu.functions import identity, text


def weights_from_right(body):
    total = sum(int(d) * (2 + k % 6) for k, d in enumerate(reversed(body)))
    rest = 11 - total % 11
    return "0" if rest == 11 else "K" if rest == 10 else str(rest)


def of(spark, values, *columns):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", *columns).collect()
    return {r[0]: tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows}


def test_check_digit_is_that_of_cycling_weights(spark):
    random.seed(5)
    bodies = [str(random.randrange(10 ** random.randint(1, 8))) for _ in range(500)]
    got = of(spark, bodies, identity.rut_check_digit(F.col("v")))
    assert got == {b: weights_from_right(b) for b in bodies}


def test_canonical_form_and_refusals(spark):
    good = "12.345.678-" + weights_from_right("12345678")
    sha = "a" * 40
    got = of(spark, [good, " 0012345678" + good[-1], "12.345.678-X", "", sha, "123456789-1", "7-" + weights_from_right("7")], identity.normalize_rut("v"), identity.identifier_type("v"))
    canonical = "12345678-" + good[-1]
    assert got[good] == (canonical, "RUT")
    assert got[""] == ("", "MISSING")
    assert got[sha] == ("", "HASH_SHA1")
    assert got["12.345.678-X"] == ("", "SOURCE_ID")
    assert got["123456789-1"][0] == ""
    assert got["7-" + weights_from_right("7")][0] == "7-" + weights_from_right("7")
    wrong = "12.345.678-" + ("0" if good[-1] != "0" else "1")
    assert of(spark, [wrong], identity.normalize_rut("v"))[wrong] == ""


def test_ids_by_kind_of_source(spark):
    rut = "7654321-" + weights_from_right("7654321")
    rows = [(rut, "Ana", "1"), ("b" * 40, "Ben", "SI"), ("X9", "Cía", "no"), (None, "Dó", None)]
    df = spark.createDataFrame(rows, "s string, n string, p string").select(identity.recipient_id("s", "n", F.lit("O")).alias("r"), identity.provider_id("s", "n", "p", F.lit("O")).alias("p")).collect()
    assert df[0] == (f"RCV-RUT-{rut}", f"PRV-RUT-{rut}")
    assert df[1] == ("RCV-SHA1-" + "B" * 40, "PRV-SHA1-" + "B" * 40)
    assert df[2]["r"].startswith("RCV-PA-") and df[2]["p"] == ""
    assert df[3]["r"].startswith("RCV-NAME-") and df[3]["p"] == ""


def test_organization_ids(spark):
    row = spark.range(1).select(
        identity.organization_id(F.lit("7"), F.lit("01"), F.lit("3"), F.lit("x")), identity.organization_id(F.lit(""), F.lit("0"), F.lit(None), F.lit("Área")), identity.organization_id(F.lit(""), F.lit("0"), F.lit(None), F.lit("AREA"))
    ).first()
    assert row[0] == "ORG-PA-07-01-003" and row[1] == row[2] and row[1].startswith("ORG-PA-")


def test_text_forms(spark):
    got = of(spark, ["  Ñandú  Ção\t ß ", "Y Comercial Pérez Sociedad Anónima", "Sol E.I.R.L.", "E Sur S.p.A."], text.normalize_text("v"), text.name_key("v"))
    assert got["  Ñandú  Ção\t ß "][0].startswith("NANDU CAO")
    assert got["Y Comercial Pérez Sociedad Anónima"][1] == "COMERCIAL PEREZ SA"
    assert got["Sol E.I.R.L."][1] == "SOL EIRL" and got["E Sur S.p.A."][1] == "SUR SPA"


def test_strict_json_touches_only_bare_tokens(spark):
    raw = '{"a": NaN, "b": "NaN Infinity", "c": -Infinity, "d": [Infinity]}'
    assert of(spark, [raw], text.strict_json("v"))[raw] == '{"a": null, "b": "NaN Infinity", "c": null, "d": [null]}'


def test_money_and_short_forms(spark):
    got = of(spark, ["$ 1.234.567", "-", ""], text.money_int("v"))
    assert got == {"$ 1.234.567": 1234567, "-": None, "": None}
    assert of(spark, ["abcdef"], text.shorten("v", 4))["abcdef"] == "abc…"
    row = spark.range(1).select(text.money_short(F.lit(2.5e9)), text.money_short(F.lit(-3.2e6)), text.money_short(F.lit(1500.0)), text.money_short(F.lit(None).cast("double"))).first()
    assert tuple(row) == ("2.5 B", "-3.2 M", "1.5 K", "-")
