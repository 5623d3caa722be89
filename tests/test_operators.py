import datetime as dt
import sqlite3
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quipu.operators import documents, enrich, evidence, explore, fulltext, multiyear, priority, search, signals, spend, territory
from quipu.sources.facts import normalize

HEADER = "PERIODO MES PARTIDA NOMBRE_PARTIDA CAPITULO NOMBRE_CAPITULO AREA NOMBRE_AREA SUBTITULO ITEM BENEFICIARIO NOMBRE_BENEFICIARIO NUMERO_DOCUMENTO FECHA_DOCUMENTO FECHA_PAGO DEVENGO MONTO PROVEEDOR PERSONA REGION DIAS_DE_PAGO ORDEN_DE_COMPRA".split()


def facts_of(spark, rows):
    full = [dict(zip(HEADER, "2025 3 1 Min 2 Cap 3 Area 22 01 X Prov D 2025-03-04 2025-03-20 1000 1000 1 0 Sur 15 ".split(" "))) | r for r in rows]
    return normalize(spark.createDataFrame([tuple(str(r[h]) for h in HEADER) for r in full], ", ".join(f"`{h}` string" for h in HEADER)).coalesce(1), source_file="t.csv")


@pytest.fixture(scope="module")
def suite(spark):
    """24 providers of one organisation, one far above the others and paid late."""
    rows = [{"BENEFICIARIO": f"P{k}", "NOMBRE_BENEFICIARIO": f"Prov {k}", "DEVENGO": 1_000_000 + 10_000 * k, "NUMERO_DOCUMENTO": f"D{k}"} for k in range(1, 24)]
    return facts_of(spark, [*rows, {"BENEFICIARIO": "BIG", "NOMBRE_BENEFICIARIO": "Big", "DEVENGO": 200_000_000, "DIAS_DE_PAGO": 120, "NUMERO_DOCUMENTO": "DB"}]).cache()


RULES = signals.Thresholds(outlier_min_group=20, concentration_min_providers=3, concentration_min_share=0.4, concentration_min_hhi=0.15, concentration_min_amount=1, delay_min_days=60, delay_min_group=20, delay_quantile=0.95)


def test_signals_to_queue(spark, suite):
    found = signals.all_signals(suite, RULES)
    kinds = {r[0] for r in found.select("signal_type").distinct().collect()}
    assert {"AMOUNT_OUTLIER", "PROVIDER_CONCENTRATION", "PAYMENT_DELAY_OUTLIER"} <= kinds
    assert found.count() == found.select("signal_id").distinct().count()
    ranked = priority.prioritize(found, suite)
    rows = priority.queue(ranked).collect()
    assert rows and all(0 <= r["investigation_priority_score"] <= 100 and r["priority_tier"] in ("P1", "P2", "P3") for r in rows)
    scores = [r["investigation_priority_score"] for r in rows]
    assert scores == sorted(scores, reverse=True)


def test_result_does_not_depend_on_partitions(suite):
    rows = lambda df: sorted(map(str, signals.all_signals(df, RULES).collect()))
    assert rows(suite) == rows(suite.repartition(7))


def test_evidence_raises_priority(spark, suite):
    found = signals.all_signals(suite, RULES)
    provider = found.filter("signal_type = 'AMOUNT_OUTLIER'").first()["provider_id"]
    links = spark.createDataFrame([("PROVIDER", provider, 0.9, 75.0, 2)], priority.LINKS)
    before, after = ({r["signal_id"]: r["external_evidence_component"] for r in priority.prioritize(found, suite, x).collect()} for x in (None, links))
    gained = {k for k in before if after[k] - before[k] == 20}
    assert gained == {r["signal_id"] for r in found.filter(F.col("provider_id") == provider).filter("signal_type <> 'YEAR_END_SPIKE'").collect()}


def test_fragmentation_and_duplicates(spark):
    week = [{"FECHA_DOCUMENTO": f"2025-03-0{d}", "DEVENGO": a, "NUMERO_DOCUMENTO": f"N{d}"} for d, a in ((3, 100), (4, 101), (5, 99))]
    f = facts_of(spark, [*week, *[{"BENEFICIARIO": "Q", "NUMERO_DOCUMENTO": "SAME"}] * 3])
    frag = signals.fragmentation(f).filter("provider_id is not null").collect()
    assert [r["observed_value"] for r in frag if r["deviation"] > 0] == [3.0]
    dup = signals.exact_duplicates(f).collect()
    assert [(r["observed_value"], r["deviation"]) for r in dup] == [(3.0, 2.0)] and dup[0]["signal_id"].startswith("SIG-PA-EXACT_DUPLICATE-")


def test_year_end_needs_both_parts(spark):
    months = lambda b, xs: [{"BENEFICIARIO": b, "AREA": b, "MES": m, "DEVENGO": a} for m, a in xs]
    f = facts_of(spark, months("1", [(2, 100), (3, 100), (11, 300), (12, 400)]) + months("4", [(2, 100)]) + months("5", [(11, 100)]))
    assert [(r["expected_value"], r["observed_value"]) for r in signals.year_end_spike(f).collect()] == [(100.0, 350.0)]


def test_new_to_series(spark):
    f = facts_of(spark, [{"PERIODO": 2024, "BENEFICIARIO": "OLD"}, *[{"BENEFICIARIO": "NEW", "DEVENGO": 6e7}] * 3, *[{"BENEFICIARIO": "OLD", "DEVENGO": 9e7}] * 3])
    assert [r["observed_value"] for r in signals.new_to_series(f).collect()] == [1.8e8]


@pytest.fixture(scope="module")
def shop(spark):
    rows = [
        {"NOMBRE_BENEFICIARIO": "Consultoría Andes", "ORDEN_DE_COMPRA": "OC-1", "REGION": "Región Metropolitana", "DEVENGO": 50},
        {"NOMBRE_BENEFICIARIO": "Andes Norte", "NOMBRE_AREA": "Salud", "MES": 5, "DEVENGO": 70},
        {"NOMBRE_BENEFICIARIO": "Mar Ltda", "NOMBRE_AREA": "Obras", "MES": 6, "DEVENGO": 60, "SUBTITULO": "31"},
    ]
    return facts_of(spark, rows).cache()


def names(df):
    return [r["nombre_beneficiario"] for r in df.collect()]


def test_text_modes_and_fields(shop):
    assert names(search.search(shop, text="consultoria ANDES")) == ["Consultoría Andes"]
    assert set(names(search.search(shop, text="norte mar", text_mode="any"))) == {"Andes Norte", "Mar Ltda"}
    assert names(search.search(shop, text="andes norte", text_mode="phrase")) == ["Andes Norte"]
    assert names(search.search(shop, text="andes", exclude_text="norte")) == ["Consultoría Andes"]
    assert names(search.search(shop, text="salud", search_fields=["institution"])) == ["Andes Norte"]
    assert names(search.search(shop, text="salud", search_fields=["beneficiary"])) == []
    assert names(search.search(shop, sort_by="amount_desc")) == ["Andes Norte", "Mar Ltda", "Consultoría Andes"]
    assert names(search.search(shop, sort_by="oldest", limit=1)) == ["Consultoría Andes"]
    assert names(search.search(shop, has_purchase_order=True, region="region metro")) == ["Consultoría Andes"]
    assert names(search.search(shop, budget_code="31.", min_amount=60)) == ["Mar Ltda"]
    for bad in ({"text": "x", "text_mode": "none"}, {"search_fields": ["none"]}, {"sort_by": "none"}, {"rut": "1-1"}, {"unknown": 1}):
        with pytest.raises(ValueError):
            search.search(shop, **bad)


def test_years_and_summary_scope(shop):
    limited, full = (search.search_years(shop, [2025, 2030], scope, limit=1) for scope in ("limited", "full"))
    assert [r["periodo"] for r in limited["gaps"].collect()] == [2030]
    total = lambda x: sum(r["monto_devengado"] for r in x["organizations"].collect())
    assert total(limited) == 60.0 and total(full) == 180.0


QUERIES = ["alpha", "alpha AND beta", "alpha OR gamma", "alpha NOT beta", '"beta alpha"', "gam*", "title:alpha", "(alpha OR beta) AND delta", "nothing"]


def test_ranking_equals_an_embedded_engine(spark):
    rows = [(k, t, b) for k, (t, b) in enumerate([("Álpha beta", "gamma"), ("beta", "alpha alpha delta"), ("gamma gamma", "delta, alpha!"), ("", "beta-alpha x1"), ("alpha", ""), ("delta", "gamut beta"), ("zeta", "eta")])]
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(doc UNINDEXED, title, body, tokenize='unicode61 remove_diacritics 2')")
    con.executemany("INSERT INTO f VALUES (?, ?, ?)", rows)
    index = fulltext.build_index(spark.createDataFrame(rows, "doc long, title string, body string"), "doc", ["title", "body"])
    for q in QUERIES:
        want = sorted(((int(d), round(r, 9)) for d, r in con.execute("SELECT doc, bm25(f) FROM f WHERE f MATCH ?", (q,))), key=lambda x: (x[1], x[0]))
        got = [(r["doc"], round(r["rank"], 9)) for r in fulltext.search(index, q).collect()]
        assert got == want, q
    for bad in ("(alpha", "alpha OR", ")"):
        with pytest.raises(ValueError):
            fulltext.search(index, bad)


def test_fuzzy_names_equal_all_pairs(spark):
    base = [f"SERVICIOS {a} {b} {c} DEL SUR PONIENTE LIMITADA" for a in ("ALFA", "BETA") for b in ("NORTE", "ESTE") for c in ("UNO", "DOS", "TRES")]
    local = spark.createDataFrame([(f"L{k}", n, "Sur") for k, n in enumerate(base)], "local_id string, name string, region string")
    other = [base[0], base[3].replace("BETA", "BETTA"), base[5].replace("LIMITADA", "LTDA"), "OTHER NAME"]
    ext = spark.createDataFrame([(f"E{k}", n, "", "Región Sur", 0.9, "doc") for k, n in enumerate(other)], "external_id string, name string, normalized_name string, region string, confidence double, source_document_id string")
    key = {r[0]: r[1] for r in local.select("name", evidence.name_key("name")).union(ext.select("name", evidence.name_key("name"))).collect()}

    def sim(a, b):
        x, y = set(a.split()), set(b.split())
        return 1.0 if a == b else 0.65 * SequenceMatcher(None, a, b).ratio() + 0.35 * len(x & y) / len(x | y)

    want = {}
    for k, n in enumerate(base):
        s, e = max(((sim(key[n], key[o]), -j) for j, o in enumerate(other)))
        shared = set(key[n].split()) & set(key[other[-e]].split())
        if s == 1.0 or s >= 0.94 and len(shared) / len(set(key[n].split()) | set(key[other[-e]].split())) >= 0.6:
            want[f"L{k}"] = (f"E{-e}", round(s, 9))
    got = {r["local_id"]: (r["external_id"], round(r["similarity"], 9)) for r in evidence.best_matches(local, ext).collect()}
    assert got == want and got["L0"] == ("E0", 1.0)
    findings = spark.createDataFrame([("doc", "f1", 80.0, "low", "B", "u2"), ("doc", "f2", None, "HIGH", "A", "u1"), (" ", "f3", 1.0, "HIGH", "", "")], "document_id string, finding_id string, aml_score double, severity string, risk_family string, source_url string")
    link = evidence.make_links(evidence.best_matches(local, ext), findings, "PROVIDER").filter("local_entity_id = 'L0'").first()
    assert link["status"] == "CANDIDATE" and link["cgr_finding_count"] == 2 and link["cgr_max_severity"] == "HIGH" and link["cgr_risk_families"] == '["A","B"]'
    assert link["region_agreement"] is True and link["confidence"] == round(min(0.93, 0.95 * 0.975), 6)


def test_rolling_year(spark):
    rows = [{"PERIODO": y, "MES": m, "AREA": a, "NOMBRE_AREA": f"Area {a}", "BENEFICIARIO": f"P{a}", "DEVENGO": 100} for y, ms in ((2024, range(9, 13)), (2025, range(1, 13)), (2026, range(1, 9))) for m in ms for a in (1, 2)]
    f = facts_of(spark, rows)
    limits = spend.limits_of(f)
    assert (limits["start_month"], limits["end_month"]) == (dt.date(2025, 9, 1), dt.date(2026, 8, 1))
    now, before = spend.window_of(f, limits)
    months = spend.monthly_calendar(now, limits).orderBy("period").collect()
    assert len(months) == 12 and {r["amount_clp"] for r in months} == {200.0}
    assert spend.services(now, before).count() == 2 and spend.providers(f, now, before).count() == 2
    edges = spend.flows(spend.pairs(now))
    assert edges.count() == 2 and {r["share_of_service"] for r in edges.collect()} == {1.0}
    assert {len(r["monthly"]) for r in spend.flow_months(now, edges).collect()} == {12}
    assert spend.overview(now, before).first()["variation_l12"] == 0.0
    gap = f.filter("mes <> 10")
    assert [r["amount_clp"] for r in spend.monthly_calendar(spend.window_of(gap, limits)[0], limits).orderBy("period").collect()][1] == 0.0


def test_latest_document(spark):
    from tests.test_sources import RUT

    f = facts_of(spark, [{"BENEFICIARIO": RUT, "FECHA_DOCUMENTO": d, "NUMERO_DOCUMENTO": n} for d, n in (("2025-03-04", "A"), ("2025-05-04", "B"))]).withColumn("tipo_documento", F.lit("FACTURA"))
    other = facts_of(spark, [{"BENEFICIARIO": RUT, "FECHA_DOCUMENTO": "2025-09-04"}]).withColumn("tipo_documento", F.lit("FACTURA")).withColumn("is_intra_state", F.lit(True))
    rows = documents.latest_documents(f.unionByName(other)).collect()
    assert [r["numero_documento"] for r in rows] == ["B"]
    assert documents.document_stats(documents.latest_documents(f)).first()["rows"] == 1


def test_territory(spark, suite):
    ranked = priority.prioritize(signals.all_signals(suite, RULES), suite)
    r = territory.regions(suite, ranked).first()
    assert r["region"] == "Sur" and r["transactions"] == 24 and r["anomaly_signals"] == ranked.count()
    blank = suite.withColumn("region", F.lit(" ")).withColumn("codigo_ubicacion_geografica", F.lit("9"))
    moved = priority.prioritize(signals.all_signals(blank, RULES), blank)
    assert territory.regions(blank, moved).first()["region"] == "UNKNOWN"
    moved = priority.prioritize(signals.all_signals(blank, RULES), blank)
    assert territory.geographic_units(blank, moved).first()["anomaly_signals"] == moved.count()


def test_registry_marks(spark):
    h = spark.createDataFrame(
        [("1-9", 2022, 4, 50, "Sur", "A", "", ""), ("1-9", 2023, 10, 2, "Norte", "B", "2020-01-01", "Tramo 3"), ("2-7", 2023, 3, 5, "Sur", "A", "", "")],
        "rut string, commercial_year int, sales_band_code int, workers int, main_region string, main_activity string, termination_date string, negative_equity_band string",
    )
    n = spark.createDataFrame([("1-9", "ACTIVE_AS_PUBLISHED", "2022-05-01")], "rut string, current_status string, activity_start_date string")
    a = spark.createDataFrame([("3-5", str(k), "x", "y", "z") for k in range(6)] * 2, "rut string, activity_code string, activity_name string, activity_status string, activity_category string")
    got = {}
    for r in enrich.registry_marks(h, n, a).collect():
        got.setdefault(r["rut"], set()).add(r["mark"])
    assert got["19"] == {"SALES_BAND_JUMP", "HIGH_SALES_LOW_WORKFORCE", "RECENT_START_HIGH_SALES", "WORKFORCE_DROP_STABLE_SALES", "MAIN_ACTIVITY_CHANGE", "REGION_CHANGE", "REACTIVATION_PATTERN", "HIGH_SALES_NEGATIVE_EQUITY"}
    assert got.get("27") is None and got["35"] == {"ACTIVITY_BREADTH"}


def test_publication_shrinks_to_the_core(spark):
    edges = spark.createDataFrame([(f"O{k % 2}", f"P{k}", 2025, "x", f"n{k}", float(k), 1) for k in range(1, 21)], "organization_id string, provider_id string, year int, organization_name string, provider_name string, amount_clp double, transactions long")
    marks = spark.createDataFrame([("provider", "P1", None, 2025, "M", "LOW", 1.0, None)], "scope string, entity_id string, organization_id string, year int, signal_type string, severity string, metric double, hhi double")
    wide = {r["provider_id"] for r in multiyear.publish(edges, marks, max_seeds=4, core_seeds=2).collect()}
    assert wide == {"P20", "P19", "P18", "P17", "P16", "P15", "P1"}
    core = {r["provider_id"] for r in multiyear.publish(edges, marks, max_seeds=4, core_seeds=2, max_flows=5).collect()}
    assert core == {"P20", "P19", "P1"}


def test_explorer_pieces(spark):
    e = spark.createDataFrame([("O1", "P1", 60.0), ("O1", "P2", 40.0), ("O2", "P1", 40.0)], "organization_id string, provider_id string, amount_clp double")
    d = {r["provider_id"]: (r["dependence"], r["influence"]) for r in explore.dependence_influence(e).collect()}
    assert d == {"P1": (0.6, 0.6), "P2": (1.0, 0.4)}
    marks = spark.createDataFrame([("P1", "M", "2025", "a")] * 2 + [("P1", "M", "2025", "b")], "entity_id string, signal_type string, year string, source string")
    assert explore.union_marks(marks, marks).count() == 2 and explore.with_mark(e, marks, "M").count() == 2
    paid = spark.createDataFrame([("P1", "2025-01", 1.0)], "provider_id string, period string, amount_clp double")
    owed = spark.createDataFrame([("P1", "2025-02", 1.0), ("P2", "2024-02", 2.0)], "provider_id string, period string, amount_clp double")
    assert {(r["provider_id"], r["basis"]) for r in explore.months_with_fallback(paid, owed).collect()} == {("P1", "payment"), ("P2", "accrual")}
    assert {tuple(r) for r in explore.yearly_from_months(owed, "provider_id").collect()} == {("P1", 2025, 1.0), ("P2", 2024, 2.0)}
    found = explore.find_entities(spark.createDataFrame([("Ábaco", "1.234-5"), ("Gran abaco", "9-9"), ("Zeta", "12.34-K")], "provider_name string, rut string"), "abaco").collect()
    assert [r["match_score"] for r in found] == [4, 2]
    assert [r["provider_name"] for r in explore.find_entities(spark.createDataFrame([("Ábaco", "1.234-5"), ("Zeta", "9.123-K")], "provider_name string, rut string"), "123").collect()] == ["Ábaco", "Zeta"]
