"""Territorial context: spend and signals by region and by geographic unit.

Prioritised signals carry the place of their transaction, so facts are read for
the spend only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import blank_to_null, present, total

UNKNOWN = "UNKNOWN"


def region_of(rows: DataFrame):
    return F.coalesce(blank_to_null("region"), F.lit(UNKNOWN)) if "region" in rows.columns else F.lit(UNKNOWN)


def _spend():
    return (
        F.count("*").alias("transactions"), F.coalesce(total(), F.lit(0.0)).alias("amount_clp"), F.count_distinct("organization_id").alias("organizations"),
        F.count_distinct(F.when(present("provider_id"), F.col("provider_id"))).alias("providers"),
    )


def _per_100k(c: str):
    return F.round(100000.0 * F.col(c) / F.col("transactions"), 4)


def regions(facts: DataFrame, prioritized: DataFrame) -> DataFrame:
    spend = facts.groupBy(region_of(facts).alias("region")).agg(*_spend())
    signals = prioritized.groupBy(region_of(prioritized).alias("region")).agg(
        F.count("*").alias("anomaly_signals"), F.count_if(F.col("priority_tier") == "P1").alias("p1_signals"), F.count_if(F.upper("severity") == "HIGH").alias("high_severity_signals"),
        F.round(F.avg("investigation_priority_score"), 3).alias("avg_investigation_priority"), F.count_if(F.coalesce("cgr_match_count", F.lit(0)) > 0).alias("cgr_linked_signals"),
        F.count_distinct("signal_type").alias("signal_type_count"),
    )
    counts = ("anomaly_signals", "p1_signals", "high_severity_signals", "cgr_linked_signals", "signal_type_count")
    out = spend.join(signals, "region", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
    return out.withColumns({
        "p1_per_100k_transactions": _per_100k("p1_signals"), "signals_per_100k_transactions": _per_100k("anomaly_signals"),
        "amount_per_transaction": F.round(F.col("amount_clp") / F.col("transactions"), 2),
    })


def geographic_units(facts: DataFrame, prioritized: DataFrame) -> DataFrame:
    code, name = blank_to_null("codigo_ubicacion_geografica"), blank_to_null("nombre_ubicacion_geografica")
    places = {"region": region_of(facts), "geographic_unit_code": code, "geographic_unit_name": name}
    spend = facts.filter(code.isNotNull() | name.isNotNull()).groupBy(*[v.alias(k) for k, v in places.items()]).agg(*_spend())
    signals = prioritized.groupBy(*[v.alias(k) for k, v in places.items()]).agg(
        F.count("*").alias("anomaly_signals"), F.count_if(F.col("priority_tier") == "P1").alias("p1_signals"), F.round(F.avg("investigation_priority_score"), 3).alias("avg_investigation_priority")
    )
    s = signals.select(*[F.col(k).alias(f"s_{k}") for k in places], "anomaly_signals", "p1_signals", "avg_investigation_priority")
    on = (F.col("region") == F.col("s_region")) & F.col("geographic_unit_code").eqNullSafe(F.col("s_geographic_unit_code")) & F.col("geographic_unit_name").eqNullSafe(F.col("s_geographic_unit_name"))
    out = spend.join(s, on, "left").drop(*[f"s_{k}" for k in places])
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("anomaly_signals", "p1_signals")}).withColumn("p1_per_100k_transactions", _per_100k("p1_signals"))
