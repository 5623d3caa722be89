"""Investigation priority: explainable components, a score up to 100, tiers, and the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import blank_to_null, present
from ..functions.text import finite
from ..scratch import materialize
from .narrow import sieve
from .signals import severity_rank

# Points by type of signal.
TYPE_POINTS = {
    "AMOUNT_OUTLIER": 15, "PROVIDER_CONCENTRATION": 15, "NEW_TO_SERIES_HIGH_SPEND": 15, "POTENTIAL_FRAGMENTATION": 12,
    "EXACT_DUPLICATE_CANDIDATE": 10, "PAYMENT_DELAY_OUTLIER": 10, "YEAR_END_SPIKE": 8,
}
LINKS = "local_entity_type string, local_entity_id string, confidence double, cgr_max_aml_score double, cgr_finding_count long"
#: Carried along for the territorial view.
PLACES = ("codigo_ubicacion_geografica", "nombre_ubicacion_geografica")
COMPONENTS = ("severity", "signal", "cooccurrence", "external_evidence", "actionability", "materiality")


def _ladder(c: Column | str, *steps: tuple[float, int]) -> Column:
    """Points of the first step that the value reaches, else 0."""
    x = F.col(c) if isinstance(c, str) else c
    out = None
    for least, points in steps:
        out = F.when(x >= least, points) if out is None else out.when(x >= least, points)
    return out.otherwise(0)


def _evidence(links: DataFrame, kind: str, key: str, prefix: str) -> DataFrame:
    return links.filter(F.col("local_entity_type") == kind).groupBy(F.col("local_entity_id").alias(key)).agg(
        F.count("*").alias(f"{prefix}_matches"), F.max("confidence").alias(f"{prefix}_confidence"),
        F.max(F.col("cgr_max_aml_score").cast("double")).alias(f"{prefix}_aml"), F.max("cgr_finding_count").alias(f"{prefix}_findings"),
    )


def transaction_context(facts: DataFrame, signals: DataFrame) -> DataFrame:
    """What the flagged transactions were; facts are reduced to about these where they are, and to these by a semi-join, before they are grouped."""
    flagged = materialize(signals.select("transaction_id").distinct().withColumn("flagged_", F.xxhash64("transaction_id")), "flagged")
    places = [c for c in PLACES if c in facts.columns]
    rows = sieve(facts, F.xxhash64("transaction_id"), flagged, "flagged_").select(
        "transaction_id", F.coalesce(blank_to_null("nombre_area"), blank_to_null("nombre_capitulo"), F.col("nombre_partida")).alias("organization_name"),
        "nombre_beneficiario", finite("monto_devengado").alias("amount"), present("orden_compra").alias("order"), present("codigo_bip").alias("bip"), "region",
        *[blank_to_null(c).alias(c) for c in places],
    )
    return rows.join(flagged, "transaction_id", "left_semi").groupBy("transaction_id").agg(
        F.min("organization_name").alias("organization_name"), F.min("nombre_beneficiario").alias("provider_or_recipient_name"), F.max("amount").alias("transaction_amount"),
        F.bool_or("order").alias("has_purchase_order"), F.bool_or("bip").alias("has_bip"), F.min("region").alias("region"), *[F.min(c).alias(c) for c in places],
    )


def prioritize(signals: DataFrame, facts: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Signals with context, six components, score, tier and a textual explanation."""
    links = links if links is not None else signals.sparkSession.createDataFrame([], LINKS)
    spike = F.col("signal_type") == "YEAR_END_SPIKE"
    counted = lambda rows, key, p: rows.filter(present(key)).groupBy(key).agg(F.count("*").alias(f"{p}_signal_count"), F.count_distinct("signal_type").alias(f"{p}_signal_types"))
    rows = (
        signals.join(transaction_context(facts, signals), "transaction_id", "left")
        .join(counted(signals.filter(~spike), "provider_id", "provider"), "provider_id", "left")
        .join(counted(signals, "organization_id", "organization"), "organization_id", "left")
        .join(_evidence(links, "PROVIDER", "provider_id", "p"), "provider_id", "left")
        .join(_evidence(links, "ORGANIZATION", "organization_id", "o"), "organization_id", "left")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = rows.withColumns({
        **{c: zero(c).cast("long") for p in ("provider", "organization") for c in (f"{p}_signal_count", f"{p}_signal_types")},
        **{c: F.coalesce(F.col(c), F.lit(False)) for c in ("has_purchase_order", "has_bip")},
        **{name: F.when(spike, zero(f"o_{x}")).otherwise(F.greatest(zero(f"p_{x}"), zero(f"o_{x}"))) for name, x in
           (("cgr_match_count", "matches"), ("cgr_max_confidence", "confidence"), ("cgr_max_aml_score", "aml"), ("cgr_finding_count", "findings"))},
    }).drop(*[f"{p}_{x}" for p in "po" for x in ("matches", "confidence", "aml", "findings")])
    by_type = None
    for kind, points in TYPE_POINTS.items():
        by_type = F.when(F.col("signal_type") == kind, points) if by_type is None else by_type.when(F.col("signal_type") == kind, points)
    parts = {
        "severity": F.when(F.col("severity") == "HIGH", 30).when(F.col("severity") == "MEDIUM", 20).otherwise(10),
        "signal": by_type.otherwise(6),
        "cooccurrence": _ladder("provider_signal_types", (3, 20), (2, 12)) + _ladder("organization_signal_types", (4, 10), (2, 5)),
        "external_evidence": _ladder("cgr_max_confidence", (0.88, 15), (0.80, 10)) + _ladder("cgr_max_aml_score", (70, 5)),
        "actionability": F.when(F.col("has_purchase_order") | F.col("has_bip"), 5).otherwise(0),
        "materiality": _ladder(F.coalesce("transaction_amount", F.lit(0.0)), (1e9, 10), (1e8, 7), (1e7, 4)),
    }
    rows = rows.withColumns({f"{k}_component": v.cast("int") for k, v in parts.items()})
    score = F.least(F.lit(100), sum((F.col(f"{k}_component") for k in COMPONENTS), F.lit(0))).cast("int")
    rows = rows.withColumn("investigation_priority_score", score)
    named = zip(("severidad", "señal", "coocurrencia", "evidencia_CGR", "accionabilidad", "materialidad"), COMPONENTS)
    return rows.withColumns({
        "priority_tier": F.when(F.col("investigation_priority_score") >= 70, "P1").when(F.col("investigation_priority_score") >= 50, "P2").otherwise("P3"),
        "priority_explanation": F.concat_ws(" | ", *[F.concat(F.lit(f"{n}="), F.col(f"{k}_component").cast("string")) for n, k in named]),
    })


def queue(prioritized: DataFrame, top: int = 250) -> DataFrame:
    """The first of the queue, by score, severity, deviation and id: a distributed top-k."""
    return prioritized.orderBy(F.desc("investigation_priority_score"), severity_rank(), F.coalesce("deviation", F.lit(0.0)).desc(), "signal_id").limit(top)


def tier_histogram(prioritized: DataFrame) -> DataFrame:
    return prioritized.groupBy("priority_tier").agg(F.count("*").alias("signals"))
