"""Years kept by their files' digests."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quipu.operators import multiyear
from quipu.plans.years import Years, read_year
from tests.test_run import HEADER, rut


def year_file(folder, year, providers, factor=1):
    lines = ["\t".join(HEADER)]
    for m in range(1, 13):
        for k in providers:
            amount = factor * (1_000_000.25 + 1000 * k)
            lines.append("\t".join(map(str, [year, "01", "02", "003", "Min", "Servicio Alfa", "Area", m, "22", "01", rut(7_000_000 + k), f"Empresa {k} SPA", f"D{m}-{k}", f"{15:02d}-{m:02d}-{year}", "FACTURA", "OC" if k else "", amount, f"20-{m:02d}-{year}", amount, "1", "Sur", 5])))
    folder.mkdir(exist_ok=True)
    text = "\n".join(lines) + "\n"
    (folder / f"{year}.tsv").write_text(text, encoding="utf-8")
    return year, str(folder / f"{year}.tsv"), hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame(rows, "year int, path string, sha256 string")


def sums(rows):
    return sorted((r["organization_id"], r["provider_id"], round(float(r["amount_clp"]), 6), r["transactions"]) for r in rows.collect())


def whole(years):
    return sums(multiyear.relations(years.facts()).groupBy("organization_id", "provider_id").agg(F.sum("amount_clp").alias("amount_clp"), F.sum("transactions").alias("transactions")))


def test_only_changed_years_are_read(spark, tmp_path):
    files, root = tmp_path / "in", f"file://{tmp_path}/kept"
    seen = []

    def read(spark, path):
        seen.append(path.rsplit("/", 1)[1])
        return read_year(spark, path)

    rows = [year_file(files, 2023, range(3)), year_file(files, 2024, range(4))]
    first = Years(spark, root).update(frame(spark, rows), read)
    assert seen == ["2023.tsv", "2024.tsv"] and list(files.iterdir()) == []  # read, committed, deleted
    assert sums(first.totals()) == whole(first)
    rows = [year_file(files, 2023, range(3)), year_file(files, 2024, range(2, 7), 3), year_file(files, 2025, [9]), (2026, "nowhere", None)]
    seen.clear()
    second = Years(spark, root).update(frame(spark, rows), read)
    assert seen == ["2024.tsv", "2025.tsv"] and [p.name for p in files.iterdir()] == ["2023.tsv"]
    assert sums(second.totals()) == whole(second) and second.facts([2025]).count() == 12 and len(sums(second.totals())) == 8
    assert all("/kept/2025/" in f for f in second.facts([2025]).inputFiles())
    marks = lambda rows: sorted(map(str, rows.collect()))
    rules = multiyear.MarkRules(spike=0.1, min_providers=1, min_share=0.1, min_hhi=0.1, min_amount=1.0, min_tx=1, newcomer_amount=1.0)
    edges = multiyear.private_edges(second.relations(), multiyear.service_names(second.services()))
    assert marks(second.marks(rules)) == marks(multiyear.marks(second.facts(), edges, rules)) != []
    assert {p.name.split("_")[0] for p in (tmp_path / "kept" / "2024").iterdir()} == {rows[1][2][:16]}
    assert second.update(frame(spark, rows[:1]), read) is second
    third = Years(spark, root).forget([2024])
    assert sums(third.totals()) == whole(third) and sorted(third.state.years) == [2023, 2025] == sorted(Years(spark, root).state.years)


def test_a_year_that_fails_leaves_all_as_it_was(spark, tmp_path):
    root = f"file://{tmp_path}/kept"
    first = Years(spark, root).update(frame(spark, [year_file(tmp_path / "in", 2023, range(2))]))
    before = sums(first.totals())
    with pytest.raises(Exception):
        Years(spark, root).update(frame(spark, [(2023, f"{tmp_path}/in/none.tsv", "other")]))
    assert sums(Years(spark, root).totals()) == before and json.loads(first.state.text())["version"] == 1


def test_the_command_line_updates(spark, tmp_path, capsys):
    import gzip

    from quipu import cli

    for year in (2023, 2024):
        _, path, _ = year_file(tmp_path / "in", year, range(3))
        (tmp_path / "in" / f"{year}.gz").write_bytes(gzip.compress(open(path, "rb").read()))
    for version in (1, 1):
        cli.main(["update", "--years", "2022-2024", "--address", f"file://{tmp_path}/in/{{year}}.gz", "--out", f"file://{tmp_path}/out"], spark)
        lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
        assert lines[-1] == {"version": version, "years": [2023, 2024]} and [x["status"] for x in sorted(lines[:3], key=lambda x: x["year"])] == ["probed_missing", "downloaded", "downloaded"]
    assert Years(spark, f"file://{tmp_path}/out/years").facts().count() == 72
