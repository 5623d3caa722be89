import io
import json
import urllib.error
import zipfile

import pytest

from quipu import cli
from quipu.operators import light
from quipu.sources import remote
from tests.test_identity import weights_from_right

HEADER = "PERIODO PARTIDA CAPITULO AREA NOMBRE_PARTIDA NOMBRE_CAPITULO NOMBRE_AREA MES SUBTITULO ITEM BENEFICIARIO NOMBRE_BENEFICIARIO NUMERO_DOCUMENTO FECHA_DOCUMENTO TIPO_DOCUMENTO ORDEN_DE_COMPRA DEVENGO FECHA_PAGO MONTO PROVEEDOR REGION DIAS_DE_PAGO".split()


def rut(body):
    return f"{body}-{weights_from_right(str(body))}"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Two small years through the command line."""
    top = tmp_path_factory.mktemp("run")
    paths = []
    for year in (2024, 2025):
        lines = ["\t".join(HEADER)]
        for m in range(1, 13):
            for k in range(3):
                amount = 1_000_000 * (8 if k == 2 and m > 10 else 1) + 1000 * k
                lines.append("\t".join(map(str, [year, "01", "02", "003", "Min", "Servicio Alfa", "Area", m, "22", "01", rut(7_000_000 + k), f"Empresa {k} SPA", f"D{m}-{k}", f"{15:02d}-{m:02d}-{year}", "FACTURA", "OC" if k else "", amount, f"20-{m:02d}-{year}", amount, "1", "Sur", 5])))
        p = top / f"pagos-{year}.tsv"
        p.write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
        paths.append(str(p))
    register = top / "register"
    register.mkdir()
    (register / "providers.jsonl").write_text(json.dumps({"provider_id": "x1", "name": "EMPRESA 2 S.P.A.", "region": "Sur", "confidence": 1.0, "source_document_id": "d1"}) + "\nbroken\n")
    (register / "findings.jsonl").write_text(json.dumps({"document_id": "d1", "finding_id": "f", "aml_score": 80, "severity": "HIGH", "risk_family": "X", "source_url": "u"}) + "\n")
    rules = top / "t.yaml"
    rules.write_text("year_end_spike:\n  ratio: 1.5  # lower\namount_outlier:\n  min_group: 8\n")
    out = str(top / "out")
    cli.main(["run", *paths, "--out", out, "--thresholds", str(rules), "--register", str(register)], spark)
    return out


def test_every_part_is_written(spark, outputs):
    read = lambda n: spark.read.parquet(f"{outputs}/{n}")
    assert read("facts").count() == 72 and read("quality").first()["status"] == "PASS"
    assert read("signals").filter("signal_type = 'YEAR_END_SPIKE'").count() == 2
    link = read("links").first()
    assert link["match_method"] == "EXACT_NORMALIZED_NAME" and link["cgr_finding_count"] == 1 and link["status"] == "CANDIDATE"
    assert read("l12_months").count() == 12 and read("l12_services").first()["monthly"][0]["period"] == "2025-01"
    assert read("documents").count() == 3 and read("years_flows").count() == 6 and read("regions").first()["region"] == "Sur"
    assert read("years_areas").first()["areas"][0]["area"] == "003" and read("l12_compact_providers").count() == 3


def test_search_over_what_was_written(spark, outputs, capsys, tmp_path):
    cli.main(["search", "--facts", f"{outputs}/facts", "--filters", '{"text": "empresa 1", "year": 2024, "limit": 5}'], spark)
    assert len(capsys.readouterr().out.splitlines()) == 5
    cli.main(["fts", "empresa", "--out", outputs, "--limit", "7"], spark)
    assert len(capsys.readouterr().out.splitlines()) == 7
    cli.main(["years", "--facts", f"{outputs}/facts", "--years", "2024-2026", "--out", str(tmp_path), "--filters", '{"has_purchase_order": true}'], spark)
    assert spark.read.csv(f"{tmp_path}/gaps_csv", header=True).first()[0] == "2026"


def test_profile(spark, outputs, capsys, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("PROVEEDOR,Rut Beneficiario\n1," + rut(7654321) + "\n0,zz\n1,\n")
    cli.main(["profile", str(p)], spark)
    got = json.loads(capsys.readouterr().out)
    assert {(r["value"], r["n"]) for r in got["value_counts"]} == {("1", 2), ("0", 1)}
    assert {r["kind"]: r["n"] for r in got["identity_types"]} == {"RUT": 1, "SOURCE_ID": 1, "MISSING": 1}


class Reply(io.BytesIO):
    status, headers = 200, {"Content-Length": "3"}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_download_probe_and_discovery(tmp_path):
    meta = remote.download("http://x/f", str(tmp_path / "d" / "f.gz"), opener=lambda *_, **__: Reply(b"abc"))
    assert (tmp_path / "d" / "f.gz").read_bytes() == b"abc" and meta["sha256"].startswith("ba7816bf") and json.loads((tmp_path / "d" / "f.gz.metadata.json").read_text())["bytes"] == 3

    def refusing(request, timeout):
        if request.get_method() == "HEAD":
            raise urllib.error.HTTPError("u", 405, "no", {}, None)
        return Reply(b"a")

    assert remote.probe("http://x/f", opener=refusing)["probe_method"] == "GET_RANGE"
    state = {"http://h/data/pagos-2020.gz": {"available": True}, "http://h/data/pagos-2021.gz": {"available": False}, "e2022": {"available": True}, "e2023": {"available": False, "error": "X"}, "e2024": {"available": False}}
    found = remote.discover({"http://h/": '<a href="/data/pagos-2020.gz">x</a><a href=\'/data/pagos-2021.gz\'>'}, range(2020, 2025), lambda y: f"e{y}", state.__getitem__)
    assert [r["status"] for r in found] == ["linked_available", "linked_unavailable", "probed_available", "probe_error", "probed_missing"]


def test_archive_members(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/Names_2024.TXT", "x")
        z.writestr("other.csv", "y")
    out = remote.extract_members(str(tmp_path / "a.zip"), {"names": "names*.txt", "none": "zzz*"}, str(tmp_path / "o"))
    assert list(out) == ["names"] and open(out["names"]).read() == "x"


def test_light_facts_never_multiply(spark):
    rows = [("2025", "1", "10", "10", "1", "0", rut(7_000_001), n, "01", "02", c) for n, c in (("Empresa", "Servicio Alfa"), ("Empresa", "SERVICIO ALFA"), ("servicio álfa", "Servicio Alfa"), ("Municipalidad de Sur", "X"))] + [("2025", "13", *["1"] * 9)]
    raw = spark.createDataFrame(rows, "periodo string, mes string, devengo string, monto string, proveedor string, intraestado string, beneficiario string, nombre_beneficiario string, partida string, capitulo string, nombre_capitulo string")
    out = light.light_facts(raw)
    assert out.count() == 4 and {r["nombre_beneficiario"] for r in out.filter("is_provider").collect()} == {"Empresa"}
    assert out.filter("is_provider_source").count() == 4 and light.light_coverage(out).first()["public_name_providers"] == 1


def test_probe_and_query_metadata(spark, outputs, capsys, tmp_path, monkeypatch):
    monkeypatch.setattr(remote.discover, "__defaults__", (lambda url: {"available": "2024" in url, "probe_method": "HEAD"},))
    page = tmp_path / "page.html"
    page.write_text('<a href="/data/pagos-2024.gz">x</a>')
    cli.main(["probe", "--years", "2024-2026", "--address", "https://host/data/pagos-{year}.gz", "--page", f"https://host/={page}", "--facts", f"{outputs}/facts"], spark)
    found = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [(r["periodo"], r["source_status"], r["has_facts"]) for r in found] == [(2024, "linked_available", True), (2025, "probed_missing", True), (2026, "probed_missing", False)]
    (tmp_path / "sources.jsonl").write_text("\n".join(map(json.dumps, found)))
    cli.main(["years", "--facts", f"{outputs}/facts", "--years", "2024 2026", "--out", f"{tmp_path}/q", "--sources", f"{tmp_path}/sources.jsonl", "--filters", '{"limit": 9}'], spark)
    states = {r["periodo"]: r for r in spark.read.json(f"{tmp_path}/q/states_json").collect()}
    assert states[2024]["status"] == "PROCESSED" and states[2024]["normalized_rows"] == 36 and states[2026]["status"] == "SOURCE_NOT_CONFIRMED"
    made = json.loads(spark.read.text(f"{tmp_path}/q/query_metadata").first()[0])
    assert made["years"] == [2024, 2026] and made["rows"]["rows"] == 9
