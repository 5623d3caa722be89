import gzip
import json

import pytest
from pyspark.sql import functions as F

from quipu.operators import quality, signals
from quipu.sources import delimited, facts, sinks
from tests.test_identity import weights_from_right

RUT = "76.123.456-" + weights_from_right("76123456")


def write(path, rows, sep=","):
    path.write_text("\n".join(sep.join(r) for r in rows) + "\n", encoding="utf-8")
    return str(path)


def test_delimiters():
    assert delimited.sniff_delimiter("a;b;c\n1;2;3\n") == ";"
    assert delimited.sniff_delimiter("a\tb\n1\t2\n") == "\t"
    assert delimited.sniff_delimiter("word") == ","


def test_gzip_with_byte_order_mark(spark, tmp_path):
    p = tmp_path / "x.gz"
    p.write_bytes(gzip.compress("﻿PERIODO\tMES\tDEVENGO\n2024\t01\t007\n".encode()))
    df = delimited.read_delimited(spark, str(p))
    assert df.columns == ["PERIODO", "MES", "DEVENGO"] and df.first()["DEVENGO"] == "007"


def test_files_with_other_columns_are_united(spark, tmp_path):
    a = write(tmp_path / "a.tsv", [("A", "B"), ("1", "2")], "\t")
    b = write(tmp_path / "b.tsv", [("B", "C"), ("3", "4")], "\t")
    rows = {tuple(r) for r in delimited.read_many_delimited(spark, [a, b]).select("A", "B", "C").collect()}
    assert rows == {("1", "2", None), (None, "3", "4")}


def test_json_lines_tolerate_damage_and_absence(spark, tmp_path):
    p = tmp_path / "f.jsonl"
    p.write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    assert delimited.read_json_lines(spark, str(p), "a long").agg(F.sum("a")).first()[0] == 3
    assert delimited.read_json_lines(spark, str(tmp_path / "none"), "a long").count() == 0
    assert delimited.read_optional(spark, str(tmp_path / "none.parquet"), "b string").columns == ["b"]


def frame(spark, header, rows):
    return facts.normalize(spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header)).coalesce(1), source_file="f.gz")


def test_aliases_and_pseudonymous_ids(spark):
    header = ["PERIODO", "MES", "Partida", "CAPITULO", "AREA", "BENEFICIARIO", "NOMBRE_BENEFICIARIO", "MONEDA", "MONTO", "DEVENGO", "PROVEEDOR", "REGION", "Otra Columna"]
    rows = [("2024", "1", "5", "2", "7", RUT, "Ana", "CLP", "10", "12.5", "1", None, "z"), ("2024", "x", "5", "2", "7", "c" * 40, "Ben", "CLP", "n/a", "3", "0", None, None)]
    a, b = frame(spark, header, rows).orderBy("source_row_number").collect()
    assert a["rut_beneficiario"] == RUT.replace(".", "") and a["entity_id"] == "ENT-RUT-" + a["rut_beneficiario"] and a["identity_status"] == "RESOLVED"
    assert (a["monto_pago"], a["monto_devengado"], a["region"], a["otra_columna"], a["organization_id"]) == (10.0, 12.5, "", "z", "ORG-PA-05-02-007")
    assert b["beneficiario_id_type"] == "HASH_SHA1" and b["provider_id"] == "" and b["recipient_id"] == "RCV-SHA1-" + "C" * 40
    assert b["mes"] is None and b["monto_pago"] is None and b["entity_id"] is None and b["identity_method"] == "SOURCE_LOCAL_ONLY"


def test_two_columns_for_one_name(spark):
    raw = spark.createDataFrame([("  ", "R2"), ("R1", "R2")], "BENEFICIARIO string, RUT_BENEFICIARIO string")
    assert [r[0] for r in facts.canonical_columns(raw).select("beneficiario_source_id").collect()] == ["R2", "R1"]


def test_wrong_check_digit_resolves_nothing(spark):
    wrong = RUT[:-1] + ("1" if RUT[-1] != "1" else "2")
    r = frame(spark, ["RUT_BENEFICIARIO", "NOMBRE_BENEFICIARIO"], [(wrong, "Ana")]).first()
    assert r["entity_id"] is None and r["identity_status"] == "UNRESOLVED" and r["periodo"] is None


def test_dates_row_by_row(spark):
    df = spark.createDataFrame([("2024-02-03",), ("03-02-2024",), ("03/02/2024",), ("2024-02-03T10:00",), ("31-31-2024",), ("",)], "d string").select(facts.parse_date(F.col("d")).cast("date").cast("string"))
    assert [r[0] for r in df.collect()] == ["2024-02-03"] * 4 + [None, None]


def test_physical_ids_differ_and_fingerprints_repeat(spark):
    rows = [("2024", "1", "1", "1", "1", "X", "Ana", "D1", "10")] * 5
    out = frame(spark, ["PERIODO", "MES", "PARTIDA", "CAPITULO", "AREA", "BENEFICIARIO", "NOMBRE_BENEFICIARIO", "NUMERO_DOCUMENTO", "DEVENGO"], rows)
    assert out.select("transaction_id").distinct().count() == 5 and out.select("transaction_fingerprint").distinct().count() == 1
    audit = quality.audit(out).first()
    assert (audit["repeated_fingerprint_rows"], audit["transaction_id_collision_ratio"], audit["status"]) == (4, 0.0, "PASS")
    quality.require_unique_ids(out)
    with pytest.raises(ValueError):
        quality.require_unique_ids(out.union(out))
    again = frame(spark, ["PERIODO", "MES", "PARTIDA", "CAPITULO", "AREA", "BENEFICIARIO", "NOMBRE_BENEFICIARIO", "NUMERO_DOCUMENTO", "DEVENGO"], rows)
    assert {r[0] for r in again.select("transaction_id").collect()} == {r[0] for r in out.select("transaction_id").collect()}


def test_audit_of_nothing_and_of_bad_rows(spark):
    columns = "transaction_id string, transaction_fingerprint string, periodo long, mes long, rut_beneficiario string, beneficiario_id_type string, is_provider boolean, is_person boolean, nombre_beneficiario string, monto_devengado double, monto_pago double, fecha_documento date, fecha_pago date, orden_compra string, codigo_bip string, region string, sector string"
    assert quality.audit(spark.createDataFrame([], columns)).first()["warnings"] == "EMPTY_DATASET"
    row = ("a", "f", None, 13, None, None, None, None, None, None, None, None, None, None, None, None, None)
    r = quality.audit(spark.createDataFrame([row, row], columns)).first()
    assert r["warnings"] == "LOW_DEVENGADO_COVERAGE,TRANSACTION_ID_NOT_UNIQUE,INVALID_PERIOD_ROWS" and r["status"] == "WARN"


def test_years():
    assert facts.parse_years("2024 2026,2025") == [2024, 2025, 2026]
    assert facts.parse_years("2019-2017") == [2017, 2018, 2019]
    for bad in ("", "2015", "x", "2024-"):
        with pytest.raises(ValueError):
            facts.parse_years(bad)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    sinks.write_parquet(spark.range(3), path)
    sinks.replace_parquet(spark.read.parquet(path).selectExpr("id + 10 as id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    assert not sinks.drop_if_empty(spark.range(0), path) and not (tmp_path / "t.parquet").exists()
    sinks.write_json(spark.createDataFrame([(1.0, float("nan")), (2.0, float("inf"))], "a double, b double"), str(tmp_path / "j"))
    lines = [json.loads(x) for p in (tmp_path / "j").glob("part*") for x in p.read_text().splitlines()]
    assert sorted(x["a"] for x in lines) == [1.0, 2.0] and all(x["b"] is None for x in lines)


def test_html_tables_and_links(spark):
    html = "<table><tr><th>RUT</th><th>Name</th><th>Sum</th></tr><tr><td> 1-9 </td><td><b>Ana</b></td><td>10</td></tr><tr><td>x</td></tr></table><a href='q'></a><a href=\"/data/pagos-2024.gz\">"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r["cells"] for r in delimited.table_rows(pages, skip=("RUT",)).collect()] == [["1-9", "Ana", "10"]]
    assert [r["link"] for r in delimited.page_links(pages, r"/data/pagos-(\d{4})\.gz").collect()] == ["2024"]


def test_thresholds_from_a_nested_file():
    t = signals.Thresholds.from_nested({"amount_outlier": {"threshold": 9}, "year_end_spike": None})
    assert t.outlier_z == 9 and t.spike_ratio == 2.5
