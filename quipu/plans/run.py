"""The whole batch: from raw files to facts, audit, profiles, signals, queue, views and feeds."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dashboard, documents, evidence, fulltext, multiyear, priority, profiles, quality, signals, spend, territory
from ..operators.segments import SegmentedIndex
from ..sources import delimited, sinks, snapshots
from ..sources.facts import normalize

EXTERNAL = {
    "providers": "provider_id string, name string, normalized_name string, region string, confidence double, source_document_id string",
    "organizations": "organization_id string, name string, normalized_name string, region string, confidence double, source_document_id string",
    "findings": "document_id string, finding_id string, aml_score double, severity string, risk_family string, source_url string",
}
# The columns that full-text search reads.
INDEXED = (
    "rut_beneficiario", "beneficiario_source_id", "nombre_beneficiario", "nombre_partida", "nombre_capitulo", "nombre_area", "nombre_subtitulo",
    "nombre_item", "numero_documento", "tipo_documento", "orden_compra", "codigo_bip", "sector", "region",
)


def ingest(spark: SparkSession, raw_paths: list[str], out: str, delimiter: str | None = None) -> DataFrame:
    """Normalise each file and write all as Parquet, partitioned by year."""
    parts = [normalize(delimited.read_delimited(spark, p, delimiter), source_url=p, source_file=os.path.basename(p)) for p in raw_paths]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    sinks.write_parquet(whole, f"{out}/facts", partition_by="periodo")
    return delimited.read_parquet(spark, f"{out}/facts")


def analyze(facts: DataFrame, out: str, thresholds: signals.Thresholds = signals.Thresholds(), register: str | None = None, index: bool = True) -> dict[str, str]:
    """Everything that follows from facts, each part written below ``out`` and read back by the next; returns their paths.

    A collision of transaction ids stops the run before anything is derived.
    """
    spark = facts.sparkSession
    paths: dict[str, str] = {}

    def put(name: str, rows: DataFrame) -> DataFrame:
        paths[name] = f"{out}/{name}"
        sinks.write_parquet(rows, paths[name])
        return spark.read.parquet(paths[name])

    quality.require_unique_ids(facts)
    put("quality", quality.audit(facts))
    put("manifest", sinks.manifest(facts))
    put("profiles_provider", profiles.provider_profiles(facts))
    put("profiles_recipient", profiles.recipient_profiles(facts))
    put("profiles_organization", profiles.organization_profiles(facts))
    found = put("signals", signals.all_signals(facts, thresholds))
    sources = {k: delimited.read_json_lines(spark, f"{register or out + '/register'}/{k}.jsonl", schema) for k, schema in EXTERNAL.items()}
    links = put("links", evidence.correlate(facts, sources["providers"], sources["organizations"], sources["findings"]))
    put("links_summary", evidence.summarize_links(links))
    ranked = put("prioritized", priority.prioritize(found, facts, links))
    best = put("queue", priority.queue(ranked))
    put("tiers", priority.tier_histogram(ranked))
    put("dashboard", dashboard.metrics(facts, found))
    put("preview", dashboard.preview(best))
    put("documents", documents.latest_documents(facts))
    put("regions", territory.regions(facts, ranked))
    put("units", territory.geographic_units(facts, ranked))
    rolling_view(facts, ranked, put)
    years_view(facts, put)
    if index:
        paths["index"] = update_index(facts, out)
    return paths


def rolling_view(facts: DataFrame, ranked: DataFrame, put) -> None:
    """The twelve-month view; none where no month has spend."""
    try:
        limits = spend.limits_of(facts)
    except ValueError:
        return
    now, before = spend.window_of(facts, limits)
    put("l12_overview", spend.overview(now, before).crossJoin(spend.concentration(now).drop("total")))
    put("l12_months", spend.monthly_calendar(now, limits))
    services = put("l12_services_plain", spend.services(now, before))
    put("l12_services", spend.services_nested(services, spend.service_months(now, services), spend.service_concentration(now), spend.signal_overlay(ranked, limits, "organization_id")))
    people = put("l12_providers", spend.providers(facts, now, before))
    flows = put("l12_flows", spend.flows(spend.pairs(now)))
    put("l12_flow_months", spend.flow_months(now, flows))
    edges, kept = spend.compact(flows, people, multiyear.service_names(services))
    put("l12_compact_flows", edges)
    put("l12_compact_providers", kept)


def years_view(facts: DataFrame, put) -> None:
    services = put("years_services", multiyear.service_years(facts))
    edges = put("years_relations", multiyear.private_edges(multiyear.relations(facts), multiyear.service_names(services)))
    marks = put("years_marks", multiyear.marks(facts, edges))
    shown = put("years_flows", multiyear.publish(edges, marks))
    published = shown.select("provider_id").distinct()
    put("years_providers", multiyear.provider_years(edges).join(published, "provider_id", "left_semi"))
    put("years_payment_months", multiyear.payment_months(facts).join(published, "provider_id", "left_semi"))
    put("years_accrual_months", multiyear.accrual_months(facts).join(published, "provider_id", "left_semi"))
    put("years_areas", multiyear.service_areas(facts))


#: Segments that an index keeps before the smallest are merged.
MOST_SEGMENTS = 8


def update_index(facts: DataFrame, out: str) -> str:
    """Add ``facts`` to the index below ``out``, which is made if there is none; its path."""
    spark, root = facts.sparkSession, f"{out}/index"
    if snapshots.latest(spark, root):
        index = SegmentedIndex.open(spark, root)
    else:
        index = SegmentedIndex.create(spark, root, "transaction_id", [c for c in INDEXED if c in facts.columns])
    index = index.add(facts.select("transaction_id", *index.snapshot.fields))
    if len(index.snapshot.segments) > MOST_SEGMENTS:
        index.merge(MOST_SEGMENTS // 2)
    return root


def open_index(spark: SparkSession, out: str) -> fulltext.Index:
    return SegmentedIndex.open(spark, f"{out}/index").index()


def coverage_gaps(spark: SparkSession, facts: DataFrame, years: list[int]) -> DataFrame:
    return delimited.coverage_states(facts.select(F.col("periodo").cast("int").alias("periodo")), years, spark)
